"""Which lines a load refuses: file, line number, column and reason of each.

A load that meets a bad line fails and tells little of it. These passes read the same
files as plain lines and report what the load would refuse, all of it. They are run
after a failure; the load itself stays as it is.

Lines are numbered without a shuffle of lines: inside a split by their place, and
splits by the lines of those before them in the file, one small row per split. Line
numbers begin with 1 and count blank lines, which JSON loads skip.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.text import parse_text
from starloom.schemas import is_text
from starloom.session import materialize
from starloom.sources.delimited import NULL_TEXT
from starloom.sources.json_files import path_column, path_steps

SHOWN = 80  # characters of a refused value that a reason shows
# Lines without anything else are skipped by both loads.
VISIBLE = r"[^\x00-\x20]"


def _numbered(lines: DataFrame, bad: DataFrame) -> DataFrame:
    """``bad`` with ``line``, its number in its file. Both hold file, block, row."""
    split = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        lines.groupBy("file", "block")
        .agg(F.min("row").alias("first"), F.count("*").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(split), F.lit(0)))
    )
    return bad.join(splits, ["file", "block"]).withColumn(
        "line", F.col("before") + F.col("row") - F.col("first") + 1
    )


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return (
        spark.read.option("recursiveFileLookup", True)
        .text(path)
        .select(
            F.col("value"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
    )


def _refusal(name: str, text: Column, field: T.StructField, required: bool) -> Column:
    """(column_name, reason) if the load refuses this text for the column, else NULL."""
    shown = F.substring(text, 1, SHOWN)
    value = parse_text(text, field.dataType, strict=False)
    missing = F.when(value.isNull(), F.lit("NULL in a required column")) if required else F.lit(None).cast("string")
    reason = missing
    if not is_text(field.dataType):
        wrong = F.nullif(F.trim(text), F.lit("")).isNotNull() & value.isNull()
        reason = F.when(
            wrong, F.concat(F.lit(f"not a valid {field.dataType.simpleString()}: "), shown)
        ).otherwise(missing)
    return F.when(reason.isNotNull(), F.struct(F.lit(name).alias("column_name"), reason.alias("reason")))


def _report(spark: SparkSession, path: str | list[str], lines: DataFrame, reasons: Column) -> DataFrame:
    bad = materialize(
        lines.select("file", "block", "row", F.explode(F.filter(reasons, lambda r: r.isNotNull())).alias("r")),
        "bad-lines",
    )
    found = _numbered(_lines(spark, path), bad)
    return found.select("file", "line", "r.column_name", "r.reason")


def bad_json_lines(
    spark: SparkSession, path: str | list[str], paths: list[str], schema: T.StructType
) -> DataFrame:
    """(file, line, column_name, reason) for every line or value that
    ``read_json_paths`` with the same arguments, and an insert into a table of
    ``schema``, refuse. ``column_name`` is NULL where the line is no JSON object."""
    steps = [path_steps(p) for p in paths]
    fields = [T.StructField(n, T.StringType()) for n in {s[0]: None for s in steps}]
    parsed = T.StructType([*fields, T.StructField("_line", T.StringType())])
    lines = _lines(spark, path).where(F.col("value").rlike(VISIBLE))
    read = F.from_json("value", parsed, {"columnNameOfCorruptRecord": "_line"}).alias("j")
    opened = lines.select("*", read).select("file", "block", "row", "value", "j.*")
    refused = [
        _refusal(f.name, path_column(s), f, not f.nullable) for s, f in zip(steps, schema)
    ]
    no_json = F.struct(
        F.lit(None).cast("string").alias("column_name"),
        F.concat(F.lit("no JSON object: "), F.substring("value", 1, SHOWN)).alias("reason"),
    )
    reasons = F.when(F.col("_line").isNotNull(), F.array(no_json)).otherwise(F.array(*refused))
    return _report(spark, path, opened, reasons)


def bad_delimited_lines(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = "|",
    trailing_sep: bool = False,
) -> DataFrame:
    """(file, line, column_name, reason) for every line or value that
    ``read_delimited`` with the same arguments, and an insert into a table of
    ``schema``, refuse. ``column_name`` is NULL where the number of fields is wrong."""
    wanted = len(schema) + int(trailing_sep)
    lines = _lines(spark, path).where(F.col("value").rlike(VISIBLE))
    cut = lines.withColumn("fields", F.split("value", f"\\Q{sep}\\E", -1))
    refused = [
        _refusal(f.name, F.nullif(F.get("fields", F.lit(i)), F.lit(NULL_TEXT)), f, not f.nullable)
        for i, f in enumerate(schema)
    ]
    miscounted = F.struct(
        F.lit(None).cast("string").alias("column_name"),
        F.concat(F.size("fields").cast("string"), F.lit(f" fields instead of {wanted}")).alias("reason"),
    )
    reasons = F.when(F.size("fields") != wanted, F.array(miscounted)).otherwise(F.array(*refused))
    return _report(spark, path, cut, reasons)


def by_reason(bad: DataFrame) -> DataFrame:
    """(column_name, kind, lines): reasons without the values they show."""
    return bad.groupBy("column_name", F.substring_index("reason", ":", 1).alias("kind")).agg(
        F.count("*").alias("lines")
    )
