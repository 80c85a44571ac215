"""What paired timings say: gains, their spread, and a sign test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Above so many pairs that differ, binomials leave the range of doubles.
MOST_PAIRS = 1000
LEVEL = 0.05


def sign_test(wins: Column, losses: Column) -> Column:
    """Probability of a split at least as uneven if both sides were alike; ties left out.

    Twice the smaller tail of the binomial at one half, 1 at most. The terms are made
    one from the other, so no factorial is needed.
    """
    n, k = wins + losses, F.least(wins, losses)
    start = F.struct(F.pow(F.lit(0.5), n).alias("term"), F.pow(F.lit(0.5), n).alias("sum"))
    tail = F.aggregate(
        F.sequence(F.lit(1), F.greatest(k, F.lit(1))),
        start,
        lambda acc, i: F.struct(
            (acc["term"] * (n - i + 1) / i).alias("term"),
            (acc["sum"] + F.when(i <= k, acc["term"] * (n - i + 1) / i).otherwise(0.0)).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )
    return F.when(n > 0, F.least(F.lit(1.0), 2 * tail)).otherwise(F.lit(1.0))


def paired_gain(pairs: DataFrame, by: str, first: str, second: str) -> DataFrame:
    """Per value of ``by``: pairs, wins and losses of ``second``, median, smallest and
    largest gain over ``first`` in percent, the sign test's probability, and whether it
    is below ``LEVEL``.

    A pair is one run of each side under like conditions; a pair with a NULL or with a
    first time that is not positive is left out. Groups combine map-side but for the
    median, which holds one number per distinct gain.
    """
    a, b = F.col(first), F.col(second)
    gains = pairs.where((a > 0) & b.isNotNull()).select(by, (100.0 * (a - b) / a).alias("gain"))
    counted = gains.groupBy(by).agg(
        F.count("*").alias("pairs"),
        F.count_if(F.col("gain") > 0).alias("wins"),
        F.count_if(F.col("gain") < 0).alias("losses"),
        F.median("gain").alias("median_gain"),
        F.min("gain").alias("least_gain"),
        F.max("gain").alias("most_gain"),
    )
    p = sign_test(F.col("wins"), F.col("losses"))
    too_many = F.raise_error(F.lit(f"more than {MOST_PAIRS} pairs that differ")).cast("double")
    return counted.withColumn(
        "p_value", F.when(F.col("wins") + F.col("losses") > MOST_PAIRS, too_many).otherwise(p)
    ).withColumn("proven", F.col("p_value") < LEVEL)
