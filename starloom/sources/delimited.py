"""Loads of delimited text, gzip or plain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.text import parse_text
from starloom.schemas import is_text

# Fixed value: the text that stands for NULL in delimited loads.
NULL_TEXT = r"\N"


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = "|",
    repartition: int | None = None,
    trailing_sep: bool = False,
    strict: bool = True,
) -> DataFrame:
    """Load every file ``path`` names (a prefix glob such as ``split/part*``).

    Compression follows the file suffix. Quotes and backslashes are plain
    characters. An empty field is a NULL number but empty text, and ``\\N`` is
    NULL. A line with too few or too many fields fails the load, and so does a
    value its column cannot hold unless ``strict`` is off; lines that end in the
    separator are read with ``trailing_sep``. Fields are counted whatever columns a
    query reads; values are checked where they are read, so on every write.

    A gzip file cannot be split: it is one task's work however large it is.
    Many files give many tasks; for a few large ones ``repartition`` spreads
    the rows right after the scan, so that at least the work behind it is even.
    """
    fields = [T.StructField(f.name, _reader_type(f, strict)) for f in schema]
    if trailing_sep:
        fields.append(T.StructField("_after_last_sep", T.StringType()))
    # Without pruning, since a line's fields are counted only where all are read.
    rows = spark.read.schema(T.StructType(fields)).option("columnPruning", False).csv(
        path,
        sep=sep,
        quote="",
        escape="\0",
        nullValue="\0",
        mode="FAILFAST",
        enforceSchema=True,
    )
    if repartition:
        rows = rows.repartition(repartition)
    return rows.select(
        [_value(f, read, strict).alias(f.name) for f, read in zip(schema, fields)]
    )


def _reader_type(field: T.StructField, strict: bool) -> T.DataType:
    """Numbers that must not be NULL are parsed by the reader, at half the cost
    of a cast: the NULL text, which the reader would refuse, is an error there
    anyway. Everything else is read as text."""
    by_reader = strict and not field.nullable and not is_text(field.dataType)
    return field.dataType if by_reader else T.StringType()


def _value(field: T.StructField, read: T.StructField, strict: bool) -> Column:
    column = F.col(f"`{field.name}`")
    if not is_text(read.dataType):
        return column
    raw = F.nullif(F.coalesce(column, F.lit("")), F.lit(NULL_TEXT))
    return raw if is_text(field.dataType) else parse_text(raw, field.dataType, strict)
