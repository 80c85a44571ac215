"""Broadcast after a size check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Most bytes of values a replicated side may hold. In memory, as a hash table,
# that is some five times as much on every executor and on the driver.
REPLICATE_BYTES = 64 * 1024 * 1024


def row_bytes(df: DataFrame) -> Column:
    """Size of the values of a row: 8 bytes each, and the bytes of texts and binaries;
    of arrays, maps and structs the bytes of their JSON text."""
    size = F.lit(8 * len(df.columns)).cast("long")
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            column = F.to_json(column)
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            continue
        size = size + F.coalesce(F.octet_length(column), F.lit(0))
    return size


def payload_bytes(df: DataFrame) -> int:
    """Size of the values in ``df``. One pass, one number per task."""
    return df.agg(F.sum(row_bytes(df))).first()[0] or 0


def key_profile(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """Size of the values in ``df``, and the rows of the most frequent key: how
    often a join on ``keys`` can multiply a row of the other side. Counts combine
    map-side, so a frequent key sends one row per map task."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(row_bytes(df)).alias("bytes"))
    size, most = per_key.agg(F.sum("bytes"), F.max("n")).first()
    return size or 0, most or 0


def replicate(df: DataFrame, max_bytes: int = REPLICATE_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its counted size is within ``max_bytes``,
    else as it is, to be joined by shuffle.

    Spark's own estimate knows neither the selectivity of a filter nor the size
    of a join, so it often shuffles the fact for a side that would have fit. The
    count reads the side's few columns once, against a shuffle of the fact.
    """
    return F.broadcast(df) if payload_bytes(df) <= max_bytes else df
