"""Session settings, and the shared folder for written intermediate results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


_NAMESPACES: list[str] = []


def pin_utc(spark: SparkSession) -> SparkSession:
    """Zone-less timestamps pass through zoned ones only under UTC unchanged."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Without that setting it lies in the warehouse directory, which the executors
    share as well; never in a machine-local temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """The folder of everything this application writes for itself."""
    return f"{scratch_root(spark)}/starloom/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def scratch_namespace(label: str) -> str:
    """A new namespace's name, to be dropped by ``release``."""
    name = f"starloom_{label}_{uuid.uuid4().hex[:12]}"
    _NAMESPACES.append(name)
    return name


def release(spark: SparkSession) -> None:
    """Drop this run's scratch namespaces and delete its folder. To be called after
    the last read: results that are not written elsewhere are gone then."""
    while _NAMESPACES:
        spark.sql(f"DROP DATABASE IF EXISTS {_NAMESPACES.pop()} CASCADE")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage so that later passes, retries and lost executors all see the
    same rows, and keeps the result columnar, so those passes prune columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
