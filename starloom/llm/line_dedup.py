"""Line dedup by content-defined chunks of lines.

Line hashes are rolled over two lines; a line whose rolling hash is smaller
than the one before and not larger than the one behind begins a chunk. The rule
looks at nearby lines only, so a passage pasted elsewhere is cut at the same lines
whatever stands before it, and a chunk inside a document has two lines or more.

A chunk of two lines or more that occurs again, anywhere, is removed but for its
first occurrence, by document id (NULL last), text hash and place. Occurrences are
found by hash, then compared byte by byte: both the grouping and the join that
decide use the chunk's text as key.

Built from DataFrame functions only. Chunk hashes are counted first, map-side
combined; only texts of chunks whose hash repeats are shuffled. First occurrences are
written before the join, so that its sides are plain tables: they are broadcast, like
the repeated hashes and the removals, if their counted size allows; beyond it both
sides are shuffled, and adaptive execution splits the rows of a hot chunk.

NULL texts stay NULL. A document whose chunks all go keeps its row with the empty
text. Rows equal in id and text are one document: they keep and lose the same chunks.
Chunks without a visible character are never removed. The last line of a text may
lack its newline; chunks are joined by newlines as they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import fresh, materialize, replicate

# Of the rolling hash, a prime below 2**31 and its multiplier.
PRIME = 2_147_483_647
BASE = 1_103_515_245
MIN_LINES = 2


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def with_chunks(docs: DataFrame, text: Column, name: str) -> DataFrame:
    """``docs`` with the array of its text's chunks, arrays of lines, as column ``name``.

    In steps of one column each: an array that a lambda looks into has to be a
    column, or it would be computed again for every element.
    """
    lines, hashes, rolled, starts = fresh(docs, "lines", "hashes", "rolled", "starts")
    step = docs.withColumn(lines, F.split(text, "\n", -1))
    step = step.withColumn(hashes, F.transform(lines, line_hash))
    step = step.withColumn(
        rolled,
        F.transform(
            hashes,
            lambda h, i: (F.coalesce(F.get(F.col(hashes), i - 1), F.lit(0)) * BASE + h) % PRIME,
        ),
    )

    def begins(i: Column) -> Column:
        here = F.get(F.col(rolled), i)
        behind = F.coalesce(F.get(F.col(rolled), i + 1), F.lit(PRIME))
        return (i == 0) | ((i > 1) & (here < F.get(F.col(rolled), i - 1)) & (here <= behind))

    step = step.withColumn(starts, F.filter(F.sequence(F.lit(0), F.size(lines) - 1), begins))
    step = step.withColumn(
        name,
        F.transform(
            starts,
            lambda s, k: F.slice(
                F.col(lines), s + 1, F.coalesce(F.get(F.col(starts), k + 1), F.size(lines)) - s
            ),
        ),
    )
    return step.drop(lines, hashes, rolled, starts)


def _occurrences(slim: DataFrame) -> DataFrame:
    """id, version, place, chunk of every chunk that may be removed."""
    cut = with_chunks(slim.filter(F.col("text").isNotNull()), F.col("text"), "chunks")
    # The outer form: for the inner one the optimizer adds a filter on the array, and
    # pushing that down repeats the whole array's definition inside its lambdas.
    return (
        cut.select("id", "version", F.posexplode_outer("chunks").alias("place", "lines"))
        .filter(F.size("lines") >= MIN_LINES)
        .select("id", "version", "place", F.array_join("lines", "\n").alias("chunk"))
        .filter(F.col("chunk").rlike(r"\S"))
    )


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, version (hash of the text), and the places of chunks to remove."""
    slim = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.md5(F.col(f"`{text_col}`")).alias("version"),
        F.col(f"`{text_col}`").alias("text"),
    )
    found = _occurrences(slim).withColumn("hash", F.xxhash64("chunk"))
    repeated = materialize(
        found.groupBy("hash")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .select("hash"),
        "line-chunk-hashes",
    )
    again = materialize(found.join(replicate(repeated), "hash", "left_semi"), "line-chunks")
    here = F.struct(F.col("id").isNull().alias("no_id"), "id", "version", "place")
    first = materialize(
        again.groupBy("hash", "chunk").agg(F.min(here).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n"),
        "line-chunk-firsts",
    )
    return (
        again.join(replicate(first), ["hash", "chunk"])
        .filter(~here.eqNullSafe(F.col("first")))
        .groupBy("id", "version")
        .agg(F.collect_set("place").alias("places"))
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str, str]:
    """``docs`` with cleaned texts, and the names of two new columns: chunks in the
    text, and chunks removed."""
    version, places, cut, total, gone = fresh(docs, "version", "places", "cut", "n_chunks", "n_removed")
    gone_from = removals(docs, id_col, text_col).select(
        F.col("id").alias(f"{version}_id"), F.col("version").alias(f"{version}_of"), F.col("places").alias(places)
    )
    # The removals are written first, so counting their size does not repeat the work.
    gone_from = replicate(materialize(gone_from, "line-removals"))
    keyed = docs.withColumn(version, F.md5(F.col(f"`{text_col}`")))
    joined = keyed.join(
        gone_from,
        F.col(f"`{id_col}`").eqNullSafe(F.col(f"{version}_id"))
        & (F.col(version) == F.col(f"{version}_of")),
        "left",
    )
    joined = joined.withColumn(places, F.coalesce(places, F.array().cast("array<int>")))
    out = with_chunks(joined, F.col(f"`{text_col}`"), cut)
    staying = F.array_except(F.sequence(F.lit(0), F.size(cut) - 1), F.col(places))
    kept = F.transform(staying, lambda i: F.get(F.col(cut), i))
    cleaned = F.when(F.size(places) == 0, F.col(f"`{text_col}`")).otherwise(
        F.array_join(F.flatten(kept), "\n")
    )
    return (
        out.withColumn(total, F.coalesce(F.size(cut), F.lit(0)).cast("long"))
        .withColumn(gone, F.size(places).cast("long"))
        .withColumn(text_col, cleaned)
        .drop(version, places, cut, f"{version}_id", f"{version}_of"),
        total,
        gone,
    )
