"""Physical table layouts: hash-distributed, sorted, replicated or plain, and
the comparison of two of them."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.broadcasting import REPLICATE_BYTES, replicate
from starloom.session import materialize

# A bucket of this many times the mean makes one task the bottleneck of a co-located
# join. Keys spread by hash stay well below; a key with a third of all rows is above
# from eight buckets on.
SKEW_FACTOR = 2.5

# Rows a bucket is meant to hold. Numbers of buckets are powers of two; Spark refuses
# more than 100,000 buckets, so beyond MAX_BUCKETS of them buckets hold more rows.
BUCKET_ROWS = 1_000_000
MAX_BUCKETS = 1 << 16

# Table properties a bucketed table carries; hot buckets as numbers, comma-joined.
BUCKETS, HOT, HOT_BUCKETS = "starloom.buckets", "starloom.hot", "starloom.hot_buckets"

# The bucket a file of a bucketed table belongs to stands at the end of its name.
BUCKET_OF_FILE = r"_(\d+)(?:\..*)?$"


@dataclass(frozen=True)
class Layout:
    """``bucket``: distribution key; ``sort``: sort key; ``replicate``: a full
    copy on every node for joins, which in Spark is a matter of reading."""

    bucket: str | None = None
    sort: str | None = None
    replicate: bool = False


# The two layouts under comparison.
LAYOUTS: dict[str, dict[str, Layout]] = {
    "nodist": {
        "customer": Layout(),
        "dwdate": Layout(),
        "supplier": Layout(),
        "part": Layout(),
        "lineorder": Layout(),
    },
    "dist": {
        "customer": Layout(sort="c_custkey", replicate=True),
        "dwdate": Layout(sort="d_datekey", replicate=True),
        "supplier": Layout(sort="s_suppkey", replicate=True),
        "part": Layout(bucket="p_partkey", sort="p_partkey"),
        "lineorder": Layout(bucket="lo_partkey", sort="lo_orderdate"),
    },
}


def bucket_sizes(df: DataFrame, n: int, col: str) -> dict[int, int]:
    """Rows per bucket for ``n`` buckets on ``col``. Reads one column; at most
    one row per bucket leaves a map task or reaches the driver."""
    bucket = F.pmod(F.hash(F.col(col)), F.lit(n)).alias("bucket")
    return {r.bucket: r.n for r in df.groupBy(bucket).agg(F.count("*").alias("n")).collect()}


def bucket_count(rows: int, cores: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Buckets for a table of so many rows, no fewer than cores."""
    wanted = max(cores, math.ceil(rows / bucket_rows))
    return min(MAX_BUCKETS, 1 << (wanted - 1).bit_length())


def hot_buckets(sizes: Mapping[int, int], n: int, factor: float = SKEW_FACTOR) -> list[int]:
    """The buckets far above the mean, at most ``n / factor`` of them."""
    return sorted(b for b, size in sizes.items() if size > factor * sum(sizes.values()) / n)


def is_hot(sizes: Mapping[int, int], n: int, factor: float = SKEW_FACTOR) -> bool:
    """Whether one of ``n`` buckets is far above the mean."""
    return bool(hot_buckets(sizes, n, factor))


def _spread(df: DataFrame, n: int, col: str, sizes: Mapping[int, int]) -> DataFrame:
    """Rows of one bucket in one partition; those of a hot one hashed over all
    partitions, copies of a row split by where they come from."""
    mean = max(1, sum(sizes.values()) // n)
    parts = [(b, 8 * -(-size // mean)) for b, size in sizes.items() if size > SKEW_FACTOR * mean]
    if not parts:
        return df.repartition(n, col)
    # At most n / SKEW_FACTOR rows.
    hot = df.sparkSession.createDataFrame(parts, "_bucket int, _parts int")
    salt = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.spark_partition_id())
    return (
        df.withColumns({"_bucket": F.pmod(F.hash(F.col(col)), F.lit(n)), "_salt": salt})
        .join(F.broadcast(hot), "_bucket", "left")
        .withColumn("_salt", F.pmod("_salt", F.coalesce("_parts", F.lit(1))))
        .repartition(n, "_bucket", "_salt")
        .drop("_bucket", "_salt", "_parts")
    )


def write_layout(
    df: DataFrame,
    table: str,
    bucket: tuple[int, str] | None = None,
    sort: str | None = None,
    mode: str = "overwrite",
) -> bool:
    """Write ``df`` as ``table``; True if a bucket is hot.

    Bucketed: rows are spread on the bucket column beforehand, so a task writes one
    file of one bucket, sorted inside. Bucket sizes are counted first, combined
    map-side; a hot bucket is written by several tasks into several files. The table
    is bucketed as declared whatever its size, and carries what was counted as table
    properties, by which ``read_layout`` picks the plan.

    Sorted: ranges of the sort column, sorted inside, so that row-group
    statistics let scans skip blocks. A value with too many rows for one range
    is split by the rest of the row and, for copies, by where they come from.
    """
    hot: list[int] = []
    if bucket:
        n, col = bucket
        sizes = bucket_sizes(df, n, col)
        hot = hot_buckets(sizes, n)
        writer = _spread(df, n, col, sizes).write.bucketBy(n, col)
        writer = writer.sortBy(sort) if sort else writer
    elif sort:
        writer = (
            df.withColumns({"_hash": F.xxhash64(*df.columns), "_from": F.spark_partition_id()})
            .repartitionByRange(sort, "_hash", "_from")
            .drop("_hash", "_from")
            .sortWithinPartitions(sort)
            .write
        )
    else:
        writer = df.write
    writer.mode(mode).format("parquet").saveAsTable(table)
    if bucket:
        df.sparkSession.sql(
            f"ALTER TABLE {table} SET TBLPROPERTIES "
            f"('{BUCKETS}' = '{bucket[0]}', '{HOT}' = '{str(bool(hot)).lower()}', "
            f"'{HOT_BUCKETS}' = '{','.join(map(str, hot))}')"
        )
    return bool(hot)


def load_layout(
    spark: SparkSession,
    db: str,
    frames: Mapping[str, DataFrame],
    layout: Mapping[str, Layout],
    buckets: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Write every table of ``frames`` into ``db`` by ``layout``.

    Bucketed tables share one number of buckets, by default after the largest of
    them. Returns (table_name, seconds, buckets, hot); buckets is NULL for tables
    that are not bucketed.
    """
    keys = {name: layout[name].bucket for name in frames if layout[name].bucket}
    if keys and not buckets:
        cores = spark.sparkContext.defaultParallelism
        buckets = max(bucket_count(frames[name].count(), cores, bucket_rows) for name in keys)
    outcome = []
    for name, df in frames.items():
        started = time.monotonic()
        bucket = (buckets, keys[name]) if name in keys else None
        hot = write_layout(df, f"{db}.{name}", bucket, layout[name].sort)
        outcome.append((name, time.monotonic() - started, buckets if bucket else None, hot))
    return spark.createDataFrame(outcome, "table_name string, seconds double, buckets int, hot boolean")


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _unbucketed(spark: SparkSession, table: str) -> DataFrame:
    """The table's rows without its buckets, so that joins shuffle and adaptive
    execution splits what is hot."""
    described = spark.sql(f"DESCRIBE EXTENDED {table}").collect()
    (location,) = (r["data_type"] for r in described if r["col_name"] == "Location")
    return spark.read.schema(spark.table(table).schema).parquet(location)


def read_layout(
    spark: SparkSession,
    db: str,
    layout: Mapping[str, Layout],
    max_bytes: int = REPLICATE_BYTES,
) -> dict[str, DataFrame]:
    """The tables of ``db``, replicated ones marked after a size check.

    Bucketed tables are joined bucket by bucket: of those joined with each other, the
    one whose key it is (its sort key) asks for a merge join. If one of them has a
    hot bucket, all are read without buckets: a join with one bucketed side would
    bring the hot key into one task, where it cannot be split.
    """
    bucketed = {name for name, spec in layout.items() if spec.bucket}
    known = {name: properties(spark, f"{db}.{name}") for name in bucketed}
    hot = any(p.get(HOT) == "true" for p in known.values())
    tables = {}
    for name, spec in layout.items():
        if name in bucketed and hot:
            df = _unbucketed(spark, f"{db}.{name}")
        else:
            df = spark.table(f"{db}.{name}")
            if name in bucketed and spec.bucket == spec.sort:
                df = df.hint("merge")
        tables[name] = replicate(df, max_bytes) if spec.replicate else df
    return tables


def _in_buckets(df: DataFrame, buckets: list[int]) -> Column:
    """Whether a row lies in a file of one of ``buckets``. Files of others are not
    opened: the condition is on the file's name."""
    bucket = F.regexp_extract(df.metadataColumn("_metadata")["file_name"], BUCKET_OF_FILE, 1)
    return bucket.cast("int").isin(buckets)


def hybrid_join(
    spark: SparkSession,
    left: str,
    right: str,
    left_key: str,
    right_key: str,
    left_columns: list[str],
    right_columns: list[str],
    max_bytes: int = REPLICATE_BYTES,
) -> DataFrame:
    """Inner join of two tables bucketed alike on their keys, hot buckets or not.

    Cold buckets are merged bucket by bucket, without an exchange. A bucket that is hot
    on either side is taken out of that: its files are read without buckets, by as many
    tasks as they are long, against the few rows the other side has in the bucket, which
    are broadcast after a size check. Beyond ``max_bytes`` that part alone is shuffled,
    and adaptive execution splits the hot key. Files of a part are picked by name, so no
    file is opened twice.
    """
    known = [properties(spark, name) for name in (left, right)]
    counts = {p[BUCKETS] for p in known}
    if len(counts) != 1:
        raise ValueError(f"{left} and {right} are not bucketed alike")
    hot = sorted({int(b) for p in known for b in p.get(HOT_BUCKETS, "").split(",") if b})
    sides = [(left, left_key, left_columns), (right, right_key, right_columns)]

    def part(read: Callable[[str], DataFrame], inside: bool) -> tuple[DataFrame, DataFrame]:
        out = []
        for table, key, columns in sides:
            df = read(table)
            if hot:
                within = _in_buckets(df, hot)
                df = df.where(within if inside else ~within)
            out.append(df.select(key, *[c for c in columns if c != key]))
        return out[0], out[1]

    def joined(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.join(b, F.col(left_key) == F.col(right_key)).select(*left_columns, *right_columns)

    a, b = part(spark.table, inside=False)
    cold = joined(a, b.hint("merge"))
    if not hot:
        return cold
    a, b = part(lambda table: _unbucketed(spark, table), inside=True)
    return cold.unionByName(joined(a, replicate(b, max_bytes)))


def _side_by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Each distinct row of the two results with its copies in ``a`` (``copies``)
    and those less its copies in ``b`` (``surplus``). Reads each side once."""
    tagged = a.withColumn("_n", F.lit(1)).unionByName(b.withColumn("_n", F.lit(-1)))
    return tagged.groupBy(*a.columns).agg(
        F.count_if(F.col("_n") > 0).alias("copies"), F.sum("_n").alias("surplus")
    )


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows the two results do not hold equally often, with ``surplus``."""
    return _side_by_side(a, b).where("surplus <> 0").drop("copies")


def _agreement_of(name: str, a: DataFrame, b: DataFrame) -> DataFrame:
    return (
        _side_by_side(a, b)
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("result_rows"),
            F.count_if(F.col("surplus") != 0).alias("differing_rows"),
        )
        .select(F.lit(name).alias("query"), "result_rows", "differing_rows")
    )


def agreement(
    queries: Mapping[str, Callable[[Mapping[str, DataFrame]], DataFrame]],
    a: Mapping[str, DataFrame],
    b: Mapping[str, DataFrame],
) -> DataFrame:
    """(query, result_rows, differing_rows) per query, run on both layouts."""
    parts = [_agreement_of(name, query(a), query(b)) for name, query in queries.items()]
    return reduce(DataFrame.unionByName, parts)


Tables = Mapping[str, DataFrame] | Callable[[], Mapping[str, DataFrame]]


def _seconds(query: Callable, tables: Tables) -> float:
    """One run to its end with the rows thrown away. ``tables`` that still have to be
    opened, with their size checks, are opened within the time."""
    started = time.monotonic()
    opened = tables() if callable(tables) else tables
    query(opened).write.format("noop").mode("overwrite").save()
    return time.monotonic() - started


def improvement(a: DataFrame, b: DataFrame, names: tuple[str, str] = ("nodist", "dist")) -> DataFrame:
    """Timings side by side with the gain of ``b`` over ``a`` in percent. A
    query without a time in ``b`` stays, with NULL."""
    first, second = (f"seconds_{name}" for name in names)
    return (
        a.withColumnRenamed("seconds", first)
        .join(b.withColumnRenamed("seconds", second), "query", "left")
        .withColumn(
            f"{names[1]}_improvement",
            F.try_divide(100.0 * (F.col(first) - F.col(second)), F.col(first)),
        )
    )


def paired_timings(
    spark: SparkSession,
    queries: Mapping[str, Callable[[Mapping[str, DataFrame]], DataFrame]],
    a: Tables,
    b: Tables,
    runs: int,
    names: tuple[str, str] = ("nodist", "dist"),
) -> DataFrame:
    """(query, run, seconds of each side): ``runs`` pairs per query after an untimed one.

    The two runs of a pair follow each other, and which comes first changes from pair
    to pair, so that drift of the machine meets both sides alike.
    """
    taken = []
    for name, query in queries.items():
        for tables in (a, b):
            _seconds(query, tables)
        for run in range(runs):
            sides = [a, b] if run % 2 == 0 else [b, a]
            seconds = [_seconds(query, tables) for tables in sides]
            taken.append((name, run, *(seconds if run % 2 == 0 else reversed(seconds))))
    columns = ", ".join(f"seconds_{name} double" for name in names)
    return spark.createDataFrame(taken, f"query string, run int, {columns}")


def compare_layouts(
    spark: SparkSession,
    queries: Mapping[str, Callable[[Mapping[str, DataFrame]], DataFrame]],
    a: Tables,
    b: Tables,
    names: tuple[str, str] = ("nodist", "dist"),
) -> DataFrame:
    """Run every query on both layouts: seconds, gain, and whether the results
    agree (``differing_rows`` is 0).

    A first run of each query and layout is not timed: it pays for compilation and
    cold files, and writes the results that are compared. The timed runs alternate.
    """
    times: tuple[list, list] = ([], [])
    parts = []
    for name, query in queries.items():
        kept = [
            materialize(query(t() if callable(t) else t), f"result-{name}") for t in (a, b)
        ]
        parts.append(_agreement_of(name, *kept))
        for taken, tables in zip(times, (a, b)):
            taken.append((name, _seconds(query, tables)))
    first, second = (
        spark.createDataFrame(taken, "query string, seconds double") for taken in times
    )
    return improvement(first, second, names).join(reduce(DataFrame.unionByName, parts), "query")
