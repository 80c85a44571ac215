"""Generated keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import materialize

# monotonically_increasing_id: partition number above, row number below.
ROW_BITS = 33


def with_identity(df: DataFrame, id_col: str, start: int = 1) -> DataFrame:
    """Unique BIGINT keys from ``start`` on, with gaps, in no stated order.

    Costs neither a shuffle nor a sort. The numbers follow the partitions, so
    another run over the same rows may number them differently; write the
    result before reading it twice.
    """
    return df.select((F.monotonically_increasing_id() + F.lit(start)).alias(id_col), "*")


def with_dense_id(df: DataFrame, order_cols: list[str], id_col: str, start: int = 1) -> DataFrame:
    """Keys ``start``, ``start + 1``, ... along ``order_cols``, NULLs first.

    The remaining columns break ties, so the numbering is repeatable. Rows are
    range-partitioned on the whole ordering: sampled bounds give even ranges
    whatever a single day, user or key holds, and copies of one row are split by
    the partition they come from. Each range is sorted and numbered by itself,
    and the ranges' row counts, one row per partition, give the offsets. No step
    puts all rows into one partition.

    The numbered ranges are written once: the counting pass reads one narrow
    column of it, and both passes see the same ranges.
    """
    rest = [c for c in df.columns if c not in order_cols]
    ordering: list[Column] = [F.col(f"`{c}`").asc_nulls_first() for c in [*order_cols, *rest]]
    row = F.monotonically_increasing_id()
    numbered = materialize(
        df.withColumn("_from", F.spark_partition_id())
        .repartitionByRange(*ordering, "_from")
        .drop("_from")
        .sortWithinPartitions(*ordering)
        .select(
            "*",
            F.shiftright(row, ROW_BITS).alias("_range"),
            row.bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_row"),
        ),
        "dense-id",
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per range: bounded by the number of shuffle partitions.
    return numbered.join(F.broadcast(offsets), "_range").select(
        (F.col("_offset") + F.col("_row") + F.lit(start)).alias(id_col), *df.columns
    )


def running_totals(df: DataFrame, order_cols: list[str], totals: dict[str, str]) -> DataFrame:
    """``df`` with the sums of some columns over all rows before a row along
    ``order_cols``, NULLs first, which tell the rows apart. ``totals``: column of each
    summed one.

    As in ``with_dense_id`` ranges are sorted and added up by themselves, and the sums
    of the ranges, one row per partition, give the offsets.
    """
    ordering = [F.col(f"`{c}`").asc_nulls_first() for c in order_cols]
    ranged = materialize(
        df.repartitionByRange(*ordering).select(
            "*", F.shiftright(F.monotonically_increasing_id(), ROW_BITS).alias("_range")
        ),
        "running-totals",
    )
    ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_range").orderBy(*ordering).rowsBetween(Window.unboundedPreceding, -1)

    def before(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    # One row per range: bounded by the number of shuffle partitions.
    offsets = ranged.groupBy("_range").agg(*[F.sum(c).alias(c) for c in totals])
    offsets = offsets.select("_range", *[before(c, ranges).alias(f"_offset_{c}") for c in totals])
    summed = ranged.select("*", *[before(c, inside).alias(name) for c, name in totals.items()])
    return summed.join(F.broadcast(offsets), "_range").select(
        *df.columns,
        *[(F.col(name) + F.col(f"_offset_{c}")).alias(name) for c, name in totals.items()],
    )


def with_dense_id_in_place(df: DataFrame, id_col: str, start: int = 1) -> DataFrame:
    """Keys ``start``, ``start + 1``, ... without gaps, in no stated order.

    Where no order is asked for, no row has to move: the rows are written once as they
    lie, each with its partition and its place there, and the partitions' row counts,
    added up, give the offsets. The counting pass reads two narrow columns, and nothing
    is exchanged but one number per partition.
    """
    place = F.monotonically_increasing_id()
    part = F.shiftright(place, ROW_BITS).cast("int")
    numbered = materialize(
        df.select(
            "*",
            part.alias("_part"),
            place.bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_row"),
        ),
        "dense-in-place",
    )
    # One row per partition; a partition's places are 0 to its largest.
    seen = numbered.groupBy("_part").agg(F.max("_row").alias("last")).collect()
    offsets, before = [], start
    for row in sorted(seen, key=lambda r: r["_part"]):
        offsets.append((row["_part"], before))
        before += row["last"] + 1
    table = df.sparkSession.createDataFrame(offsets, "_part int, _offset long")
    return numbered.join(F.broadcast(table), "_part").select(
        (F.col("_offset") + F.col("_row")).alias(id_col), *df.columns
    )
