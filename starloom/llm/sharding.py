"""Rendezvous hashing of record keys over weighted shards.

Every shard draws a number in (0, 1) from the record key and its own number; the
shard with the largest ``-weight / ln(draw)`` holds the record. The draws of the
shards that stay do not change, so one more shard takes records only into itself,
its share by weight, and moves no other record.

Slots number the rows of a shard from 0 without gaps. They come from range
partitions over the whole row and one offset per range, so a shard is no task:
eight shards do not limit the job to eight tasks, and copies of one row spread.

NULL keys count as the key "null", NULL texts as empty. Equal rows get
neighbouring slots in no stated order among themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import materialize, text_or_empty
from starloom.operators.keys import with_dense_id

HEX_DIGITS = 12


def draw(key: Column, shard: int) -> Column:
    """A number in (0, 1) that key and shard determine."""
    digest = F.md5(F.concat(key, F.lit(f"#{shard}")))
    number = F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("double")
    return (number + F.lit(0.5)) / F.lit(float(16**HEX_DIGITS))


def shard_of(key: Column, weights: list[float]) -> Column:
    """The shard of each key; on equal scores the smaller one."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    scores = [
        F.struct((F.lit(-float(w)) / F.log(draw(key, i))).alias("s"), F.lit(-i).alias("i"))
        for i, w in enumerate(weights)
    ]
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return (-best["i"]).cast("int")


def assign(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    weights: list[float] | None = None,
    added_weight: float = 1.0,
) -> DataFrame:
    """Shard, slot, and the shard after one more joins, of every row."""
    weights = weights or [1.0] * 8
    text = text_or_empty(text_col)
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null"))
    sized = materialize(
        docs.select(
            shard_of(key, weights).alias("shard"),
            F.col(f"`{id_col}`").alias("doc_id"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text).cast("long").alias("text_crc32"),
            shard_of(key, [*weights, added_weight]).alias("grown_shard"),
        ),
        "sharding",
    )
    numbered = with_dense_id(sized, ["shard", "doc_id"], "position", start=0)
    # One row per shard.
    first = sized.groupBy("shard").count()
    first = first.alias("a").join(
        F.broadcast(first.alias("b")), F.col("a.shard") > F.col("b.shard"), "left"
    )
    first = first.groupBy(F.col("a.shard").alias("shard")).agg(
        F.coalesce(F.sum("b.count"), F.lit(0)).alias("first")
    )
    return numbered.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("position") - F.col("first")).alias("slot"),
        "grown_shard",
    )
