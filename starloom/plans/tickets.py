"""The ticket load: both tables from their declared columns, split files, one file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom import schemas
from starloom.sources import create_tables, insert_into
from starloom.sources.delimited import read_delimited

TABLE = "sporting_event_ticket"


def load_tickets(
    spark: SparkSession, db: str, path: str, table: str = TABLE, repartition: int | None = None
) -> DataFrame:
    """Append the ticket files of ``path`` to ``db.table`` and return the table.

    The table is created with its declared columns if absent. Loading again
    appends again. For one large gzip file ``repartition`` spreads the rows.
    """
    create_tables(spark, db, {table: schemas.TICKETS}, wide_ids=False)
    rows = read_delimited(spark, path, schemas.TICKETS, sep=";", repartition=repartition)
    insert_into(rows, f"{db}.{table}", rows.columns)
    return spark.table(f"{db}.{table}")
