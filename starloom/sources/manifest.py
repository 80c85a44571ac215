"""Listing of input objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def source_manifest(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Path, length and modification time of every file below ``path``.

    The file content is a pruned column, so no file is opened.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
    )
