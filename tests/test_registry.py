"""Every registered query against its SQL in DuckDB, over whole tables."""

import duckdb
import pytest
from conftest import plan_of

import __spark_entry__ as driver
from starloom import registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


SLOW_OPERATORS = ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin")
DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return con


def normal(rows):
    cells = (
        tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in rows
    )
    return sorted(cells, key=lambda r: [(v is not None, v) if v is not None else (False, 0) for v in r])


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = driver.queries()[name](spark, DATA)
    plan = plan_of(df)
    assert not [operator for operator in SLOW_OPERATORS if operator in plan]
    columns = sorted(df.columns)
    relation = duck.sql(driver.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    declared = {c: TYPES[str(t)] for c, t in zip(relation.columns, relation.types)}
    assert {f.name: f.dataType.simpleString() for f in df.schema} == declared
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = duck.sql(f"SELECT {listed} FROM ({driver.oracle_sql()[name]})").fetchall()
    assert normal(map(tuple, df.select(columns).collect())) == normal(expected)


def test_every_sql_has_its_query():
    assert set(registry.QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[0] == "start_time"
    assert df.count() == 211
