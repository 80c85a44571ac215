"""Star Schema Benchmark queries.

Dimensions are filtered and cut to the columns in use before they join, the
most selective first. What is left of part, supplier and customer is counted:
within ``max_bytes`` it is broadcast and the fact is not shuffled; beyond, lines that a
Bloom filter of its keys rules out leave first, and what is left is shuffled, where
adaptive execution splits hot keys. The calendar has one row per
day and is small enough for Spark's own estimate.

Money is in integer cents and multiplied as BIGINT: INTEGER products overflow,
and double sums depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.broadcasting import REPLICATE_BYTES, payload_bytes
from starloom.operators.key_filter import MAX_WORDS, KeyFilter

# The benchmark's own query parameters.
YEAR = 1997
DISCOUNTS = (1, 3)
QUANTITY = 24
CATEGORY = "MFGR#12"
REGION = "AMERICA"
CITIES = ("UNITED KI1", "UNITED KI5")
YEARMONTH = "Dec1997"


def _gain() -> Column:
    return F.sum(F.col("lo_extendedprice").cast("long") * F.col("lo_discount").cast("long"))


def _revenue() -> Column:
    return F.sum(F.col("lo_revenue").cast("long"))


def _within(lo: DataFrame, days: DataFrame) -> DataFrame:
    """Lines from the first to the last of ``days``. One row of the calendar turns
    the date join into a range on the sort key that the scan can skip blocks by."""
    first, last = days.agg(F.min("d_datekey"), F.max("d_datekey")).first()
    return lo.where(F.col("lo_orderdate").between(F.lit(first), F.lit(last)))


def _reduced(
    lo: DataFrame,
    sides: Sequence[tuple[DataFrame, str, str]],
    max_bytes: int,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """``lo`` joined with each (side, its key, the key in ``lo``). Sides beyond
    ``max_bytes`` are filtered for first, by filters of at most ``max_words`` words.

    All filters come before the first shuffle, so that is of lines with a partner on
    every side.
    """
    small, large = [], []
    for side, key, fact_key in sides:
        if payload_bytes(side) <= max_bytes:
            small.append((F.broadcast(side), key, fact_key))
            continue
        known = KeyFilter.of(side, key, max_words=max_words)
        lo = known.apply(lo, fact_key) if known else lo
        large.append((side, key, fact_key))
    for side, key, fact_key in [*small, *large]:
        lo = lo.join(side, F.col(fact_key) == F.col(key))
    return lo


def one_dim(
    lo: DataFrame,
    d: DataFrame,
    year: int = YEAR,
    disc: tuple[int, int] = DISCOUNTS,
    qty: int = QUANTITY,
) -> DataFrame:
    """Revenue gained without the discounts of a band, in one year."""
    days = d.where(F.col("d_year") == year).select("d_datekey")
    sold = lo.where(F.col("lo_discount").between(*disc) & (F.col("lo_quantity") < qty))
    return _within(sold, days).join(days, F.col("lo_orderdate") == F.col("d_datekey")).agg(_gain().alias("revenue"))


def two_dim(
    lo: DataFrame,
    d: DataFrame,
    p: DataFrame,
    s: DataFrame,
    category: str = CATEGORY,
    region: str = REGION,
    max_bytes: int = REPLICATE_BYTES,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """Revenue by year and brand, for one category and one supplier region."""
    parts = p.where(F.col("p_category") == category).select("p_partkey", "p_brand1")
    suppliers = s.where(F.col("s_region") == region).select("s_suppkey")
    days = d.select("d_datekey", "d_year")
    sides = [(parts, "p_partkey", "lo_partkey"), (suppliers, "s_suppkey", "lo_suppkey")]
    return (
        _reduced(lo, sides, max_bytes, max_words)
        .join(days, F.col("lo_orderdate") == F.col("d_datekey"))
        .groupBy("d_year", "p_brand1")
        .agg(_revenue().alias("revenue"))
    )


def drill(
    lo: DataFrame,
    c: DataFrame,
    s: DataFrame,
    d: DataFrame,
    c_cities: Sequence[str] = CITIES,
    s_cities: Sequence[str] = CITIES,
    yearmonth: str = YEARMONTH,
    max_bytes: int = REPLICATE_BYTES,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """Revenue by customer city, supplier city and year within one month."""
    days = d.where(F.col("d_yearmonth") == yearmonth).select("d_datekey", "d_year")
    suppliers = s.where(F.col("s_city").isin(*s_cities)).select("s_suppkey", "s_city")
    customers = c.where(F.col("c_city").isin(*c_cities)).select("c_custkey", "c_city")
    sides = [(suppliers, "s_suppkey", "lo_suppkey"), (customers, "c_custkey", "lo_custkey")]
    return (
        _reduced(_within(lo, days).join(days, F.col("lo_orderdate") == F.col("d_datekey")), sides, max_bytes, max_words)
        .groupBy("c_city", "s_city", "d_year")
        .agg(_revenue().alias("revenue"))
        .orderBy(F.col("d_year").asc(), F.col("revenue").desc())
    )


def same_dist(lo: DataFrame, p: DataFrame) -> DataFrame:
    """Revenue gain by order date, for lines whose part exists.

    Nothing of ``part`` is read but its key; the join drops orphan lines. With
    both tables bucketed on the part key it needs no shuffle: ``read_layout`` asks
    for a merge join there. Elsewhere part, which nothing filters here, is left to
    Spark's own choice.
    """
    return (
        lo.join(p.select("p_partkey"), F.col("lo_partkey") == F.col("p_partkey"))
        .groupBy("lo_orderdate")
        .agg(_gain().alias("revenue"))
        .orderBy("lo_orderdate")
    )
