"""Loading the benchmark tables into two layouts, and comparing the layouts."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from starloom import schemas
from starloom.operators import layout
from starloom.operators.evidence import paired_gain
from starloom.plans import ssb
from starloom.sources import read_delimited, require, use

# The four queries with the benchmark's own parameters, over tables by name.
QUERIES: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = {
    "oneDim": lambda t: ssb.one_dim(t["lineorder"], t["dwdate"]),
    "twoDim": lambda t: ssb.two_dim(t["lineorder"], t["dwdate"], t["part"], t["supplier"]),
    "drill": lambda t: ssb.drill(t["lineorder"], t["customer"], t["supplier"], t["dwdate"]),
    "oneDimSameDist": lambda t: ssb.same_dist(t["lineorder"], t["part"]),
}


def read_benchmark(
    spark: SparkSession, root: str, wide_ids: bool = True, trailing_sep: bool = False
) -> dict[str, DataFrame]:
    """The five tables from the files ``<root>/<table>*``, ``|`` between fields.
    NULL in a column declared NOT NULL fails the load."""
    frames = {}
    for name, declared in schemas.SSB.items():
        schema = schemas.widen_ids(declared) if wide_ids else declared
        rows = read_delimited(spark, f"{root}/{name}*", schema, trailing_sep=trailing_sep)
        frames[name] = require(rows, schemas.required_columns(declared))
    return frames


def load_both(
    spark: SparkSession,
    root: str,
    databases: Mapping[str, str] | None = None,
    locations: Mapping[str, str] | None = None,
    **reading,
) -> DataFrame:
    """Load the five tables into every layout, each into its own namespace.

    The files are parsed once, into the plain layout; the other one is written from
    that. Returns the load times side by side, the latter's without parsing:
    (table_name, loadtime_<layout>, ..., buckets, hot).
    """
    databases = databases or {name: name for name in layout.LAYOUTS}
    frames = read_benchmark(spark, root, **reading)
    stats = None
    for name, spec in layout.LAYOUTS.items():
        db = use(spark, databases[name], (locations or {}).get(name))
        times = layout.load_layout(spark, db, frames, spec)
        times = times.withColumnRenamed("seconds", f"loadtime_{name}")
        if stats is None:
            stats = times.drop("buckets", "hot")
            frames = {table: spark.table(f"{db}.{table}") for table in frames}
        else:
            stats = stats.join(times, "table_name", "left")
    return stats


def compare(
    spark: SparkSession,
    databases: Mapping[str, str] | None = None,
    queries: Mapping[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = QUERIES,
) -> DataFrame:
    """Query times of both layouts, the gain in percent, and whether the results
    agree, one row per query."""
    plain, spread = _readers(spark, databases)
    return layout.compare_layouts(spark, queries, plain, spread, tuple(layout.LAYOUTS))


def evidence(
    spark: SparkSession,
    runs: int,
    databases: Mapping[str, str] | None = None,
    queries: Mapping[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = QUERIES,
) -> DataFrame:
    """The gain of the second layout per query over ``runs`` pairs of runs: median,
    spread, and how likely it is by chance."""
    names = tuple(layout.LAYOUTS)
    pairs = layout.paired_timings(spark, queries, *_readers(spark, databases), runs, names)
    return paired_gain(pairs, "query", f"seconds_{names[0]}", f"seconds_{names[1]}")


def _readers(spark: SparkSession, databases: Mapping[str, str] | None):
    databases = databases or {name: name for name in layout.LAYOUTS}
    return [
        partial(layout.read_layout, spark, databases[name], spec)
        for name, spec in layout.LAYOUTS.items()
    ]
