from conftest import rows

from starloom.operators import (
    duplicate_report,
    duplicates,
    length_report,
    length_violations,
    null_report,
    null_violations,
)


def test_duplicates_by_any_keys(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, v string"
    )
    assert rows(duplicates(df, ["k"])) == [(None, 2), (1, 3)]
    assert rows(duplicates(df, ["k", "v"])) == [(None, "c", 2), (1, "a", 2)]


def test_duplicate_report(spark):
    dup = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,), (3,)], "k int")
    clean = spark.range(4)
    empty = spark.range(0)
    report = duplicate_report({"dup": (dup, ["k"]), "clean": (clean, ["id"]), "e": (empty, ["id"])})
    assert rows(report) == [
        ("clean", 4, 0, 0, "No duplicates found"),
        ("dup", 6, 2, 3, "Duplicates found"),
        ("e", 0, 0, 0, "No duplicates found"),
    ]


def test_nulls_per_column(spark):
    df = spark.createDataFrame([(1, None), (None, None), (2, "")], "k int, v string")
    assert rows(null_violations(df, ["k", "v"])) == [("k", 1), ("v", 2)]
    report = null_report({"t": (df, ["v"]), "none declared": (df, [])})
    assert rows(report) == [("t", "v", 2)]


def test_lengths_are_bytes(spark):
    df = spark.createDataFrame([("ääää", "x"), ("aaaa", None), ("aaaaa", "xy")], "a string, b string")
    assert rows(length_violations(df, {"a": 4, "b": 1})) == [("a", 2), ("b", 1)]
    assert rows(length_report({"t": (df, {"a": 8}), "u": (df, {})})) == [("t", "a", 0)]


def test_checks_take_one_pass_each(spark):
    from conftest import plan_of

    df = spark.range(10).selectExpr("id as a", "id as b", "cast(id as string) as c")
    for check in (null_violations(df, ["a", "b", "c"]), length_violations(df, {"c": 2})):
        assert plan_of(check).count("Range (") == 1
