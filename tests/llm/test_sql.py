"""Every query that has SQL against it, in DuckDB, over whole tables."""

import duckdb
import pytest

from starloom.llm import oracles, registry

DATA = "/root/testdata/sf0.01"
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    found = registry.QUERIES[name](spark, DATA)
    sql = oracles.oracle_sql()[name]
    relation = duck.sql(sql)
    declared = {c: TYPES[str(t)] for c, t in zip(relation.columns, relation.types)}
    assert {f.name: f.dataType.simpleString() for f in found.schema} == declared
    columns = ", ".join(sorted(declared))
    expected = duck.sql(f"SELECT {columns} FROM ({sql})").fetchall()
    got = [tuple(r) for r in found.select(sorted(declared)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_every_sql_has_its_query():
    assert set(oracles.oracle_sql()) <= set(registry.QUERIES)
