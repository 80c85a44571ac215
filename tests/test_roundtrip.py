"""The star as the queries store it, over tables of their own."""

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starloom import registry, schemas, sources
from starloom.session import materialize


@pytest.fixture
def tables(spark, tmp_path):
    """Plays of two names, each of them two songs'."""
    parts = [(i, f"name {i % 2}", "Brand#7", "LARGE", i, 900.0 + i) for i in range(4)]
    spark.createDataFrame(
        parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ).write.parquet(str(tmp_path / "part.parquet"))
    events = [
        (i, datetime(2024, 1, 1) + timedelta(minutes=i), i % 5, "view", 1.5 * i, f'{{"k": {i % 4}}}')
        for i in range(20)
    ]
    spark.createDataFrame(
        events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    ).write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


STORED = {"songplay": 40, "users": 5, "songs": 4, "artists": 1, "time": 20}


def test_roundtrip_fills_the_whole_star_twice(spark, tables, monkeypatch):
    found, reset = [], sources.reset

    def counted(session, db, *given):
        if spark.catalog.tableExists(f"{db}.songplay"):
            found.append({name: spark.table(f"{db}.{name}").count() for name in schemas.STAR})
        return reset(session, db, *given)

    monkeypatch.setattr(registry.sources, "reset", counted)
    counts = registry.QUERIES["star_roundtrip"](spark, tables)
    assert {r["table_name"]: r["row_count"] for r in counts.collect()} == STORED
    assert found == [STORED]


def test_generated_keys_take_next_to_no_room(spark, database, tmp_path):
    sources.reset(spark, database, schemas.STAR)
    n = 400_000
    sources.insert_into(spark.range(n).select((F.col("id") + 2**40).alias("songplay_id")), f"{database}.songplay", ["songplay_id"])
    found = spark.table(f"{database}.songplay").agg(F.count("*"), F.min("songplay_id"), F.max("songplay_id"))
    assert rows(found) == [(n, 2**40, 2**40 + n - 1)]
    files = (tmp_path / "db" / "songplay").glob("*.parquet")
    assert 0 < sum(f.stat().st_size for f in files) < n / 4


def test_report_by_hash_stores_no_generated_keys(spark, tables, monkeypatch):
    stored = []

    def watched(df, label):
        stored.append((label, df.columns))
        return materialize(df, label)

    lines = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "l_orderkey long, l_linenumber int")
    lines.write.parquet(f"{tables}/lineitem.parquet")
    monkeypatch.setattr(registry, "materialize", watched)
    found = rows(registry.QUERIES["duplicate_report_by_hash"](spark, tables))
    assert found == rows(registry.QUERIES["duplicate_report"](spark, tables))
    assert ("songplay", 40, 0, 0, "No duplicates found") in found
    assert ("lineitem", 3, 1, 1, "Duplicates found") in found
    assert ("keys", ["user_id"]) in stored and ("keys", ["songplay_id"]) not in stored
