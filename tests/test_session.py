"""Scratch folders and namespaces end with ``release``; sizes count every type."""

import os

from starloom import session
from starloom.operators.broadcasting import payload_bytes
from starloom.sources import use


def test_release_leaves_nothing(spark):
    db = session.scratch_namespace("gone")
    use(spark, db, session.scratch_path(spark, db))
    kept = session.materialize(spark.range(5), "kept")
    kept.write.saveAsTable(f"{db}.t")
    folder = session.run_folder(spark)
    assert os.path.isdir(folder)
    session.release(spark)
    assert not os.path.exists(folder)
    assert db not in {r[0] for r in spark.sql("SHOW DATABASES").collect()}


def test_nested_and_binary_values_count(spark):
    rows = [(bytearray(1000), list(range(500)))]
    assert payload_bytes(spark.createDataFrame(rows, "b binary, a array<int>")) > 1000 + 500
