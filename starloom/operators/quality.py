"""Checks the warehouse's constraints would have made, as reports."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.broadcasting import REPLICATE_BYTES, replicate
from starloom.session import materialize

# The two outcomes of a duplicate check.
FOUND = "Duplicates found"
NOT_FOUND = "No duplicates found"


def _row_count(weight: str | None) -> Column:
    """Number of rows; where a row stands for several, ``weight`` names their number."""
    return F.sum(weight) if weight else F.count("*")


def duplicates(df: DataFrame, keys: list[str], weight: str | None = None) -> DataFrame:
    """Keys that occur more than once, with their number of rows. Rows with a
    NULL key count as one group, as in GROUP BY."""
    return df.groupBy(*keys).agg(_row_count(weight).alias("occurrences")).where("occurrences > 1")


# Generated keys are looked at in stretches of as many as a BIGINT has bits.
STRETCH_BITS = 6


def duplicates_of_ids(df: DataFrame, key: str, max_bytes: int = REPLICATE_BYTES) -> DataFrame:
    """``duplicates`` of a generated integer key, as many as the table has rows.

    A task holds long stretches of such keys. First 64 neighbours are one group, with
    its number of rows and a bit for each key that is there: where these differ, a key
    repeats. So the shuffle carries a row for 64 keys. Only rows of such stretches go
    on to be grouped by the key. ``df`` is read twice.
    """
    value = F.col(f"`{key}`").cast("long")
    stretch = F.shiftright(value, STRETCH_BITS)
    place = value.bitwiseAND(F.lit((1 << STRETCH_BITS) - 1)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    met = df.groupBy(stretch.alias("_stretch")).agg(
        F.count("*").alias("_n"), F.coalesce(F.bit_count(F.bit_or(bit)), F.lit(1)).alias("_keys")
    )
    again = materialize(met.where("_n > _keys").select("_stretch"), "repeated-stretches")
    repeated = replicate(again, max_bytes)
    rest = df.select(key, stretch.alias("_own")).join(
        repeated, F.col("_own").eqNullSafe(F.col("_stretch")), "left_semi"
    )
    return duplicates(rest, [key])


def duplicates_by_hash(
    df: DataFrame, keys: list[str], max_bytes: int = REPLICATE_BYTES, weight: str | None = None
) -> DataFrame:
    """``duplicates`` where keys are wide and repeat seldom, as they should.

    First only 64-bit hashes of the keys are counted, combined map-side; keys whose hash
    is met once cannot repeat. Only rows of hashes met twice go on to be grouped by the
    keys themselves, which tells chance from repetition. So the first shuffle carries
    eight bytes for a key, whatever it is made of, and the second repeated keys alone,
    combined map-side. The repeated hashes are broadcast after a size check, else both
    sides are shuffled by hash. ``df`` is read twice: pass stored rows.
    """
    hashed = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    met = df.select("*", hashed.alias("_hash")).groupBy("_hash").agg(_row_count(weight).alias("_n"))
    again = materialize(met.where("_n > 1").select("_hash"), "repeated-hashes")
    rest = df.select("*", hashed.alias("_hash")).join(replicate(again, max_bytes), "_hash", "left_semi")
    return duplicates(rest, keys, weight)


def _counted(df: DataFrame, repeated: DataFrame, weight: str | None) -> DataFrame:
    """The figures of a report on ``df`` whose repeated keys are known."""
    none = F.lit(0).cast("long")
    rows = F.coalesce(_row_count(weight), none)
    counted = df.agg(rows.alias("row_count"), none.alias("duplicate_keys"), none.alias("extra_rows"))
    found = repeated.agg(
        none.alias("row_count"),
        F.count("*").alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("occurrences") - 1), none).alias("extra_rows"),
    )
    return counted.unionByName(found).agg(
        *[F.sum(c).alias(c) for c in ("row_count", "duplicate_keys", "extra_rows")]
    )


def _reported(name: str, figures: DataFrame) -> DataFrame:
    verdict = F.when(F.col("duplicate_keys") > 0, FOUND).otherwise(NOT_FOUND)
    return figures.select(F.lit(name).alias("table_name"), "*", verdict.alias("verdict"))


def duplicate_report(
    tables: Mapping[str, tuple[DataFrame, list[str]]],
    weights: Mapping[str, str] | None = None,
    generated: Collection[str] = (),
) -> DataFrame:
    """One row per table: rows, keys that repeat, rows beyond the first. ``weights``: of
    tables whose rows stand for several, the column with their number; ``generated``:
    tables whose key is a generated integer, checked by ``duplicates_of_ids``."""
    parts = []
    for name, (df, keys) in tables.items():
        weight = (weights or {}).get(name)
        if name in generated:
            parts.append(_reported(name, _counted(df, duplicates_of_ids(df, *keys), weight)))
            continue
        found = (
            df.groupBy(*keys)
            .agg(_row_count(weight).alias("n"))
            .agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                F.count_if(F.col("n") > 1).alias("duplicate_keys"),
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"),
            )
        )
        parts.append(_reported(name, found))
    return _union(parts)


def duplicate_report_by_hash(
    tables: Mapping[str, tuple[DataFrame, list[str]]],
    max_bytes: int = REPLICATE_BYTES,
    weights: Mapping[str, str] | None = None,
    generated: Collection[str] = (),
) -> DataFrame:
    """``duplicate_report`` by ``duplicates_by_hash``: the same rows, for wide keys. Each
    table is read three times, two of them for its keys alone: pass stored rows."""
    parts = []
    for name, (df, keys) in tables.items():
        weight = (weights or {}).get(name)
        if name in generated:
            repeated = duplicates_of_ids(df, *keys, max_bytes)
        else:
            repeated = duplicates_by_hash(df, keys, max_bytes, weight)
        parts.append(_reported(name, _counted(df, repeated, weight)))
    return _union(parts)


def null_violations(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, nulls) for every column that must not hold NULL, counted
    in one pass."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    return counts.unpivot([], cols, "column_name", "nulls")


def null_report(tables: Mapping[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    return _named_union(
        {name: null_violations(df, cols) for name, (df, cols) in tables.items() if cols}
    )


def length_violations(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    """(column_name, too_long): values longer than declared. Declared lengths
    are bytes, not characters."""
    cols = list(lengths)
    counts = df.agg(
        *[F.count_if(F.octet_length(F.col(f"`{c}`")) > lengths[c]).alias(c) for c in cols]
    )
    return counts.unpivot([], cols, "column_name", "too_long")


def length_report(tables: Mapping[str, tuple[DataFrame, Mapping[str, int]]]) -> DataFrame:
    return _named_union(
        {name: length_violations(df, lengths) for name, (df, lengths) in tables.items() if lengths}
    )


def _named_union(parts: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        [part.select(F.lit(name).alias("table_name"), "*") for name, part in parts.items()]
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
