from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.operators import with_dense_id, with_identity


def numbered(df):
    return [tuple(r) for r in df.orderBy("id").collect()]


def test_dense_ids_follow_the_order_nulls_first(spark):
    df = spark.createDataFrame([(3, "c"), (None, "z"), (1, "b"), (1, "a")], "k int, v string")
    assert numbered(with_dense_id(df, ["k"], "id")) == [
        (1, None, "z"),
        (2, 1, "a"),
        (3, 1, "b"),
        (4, 3, "c"),
    ]


def test_dense_ids_start_where_told_and_take_no_rows(spark):
    df = spark.range(3).withColumnRenamed("id", "k")
    assert [r[0] for r in numbered(with_dense_id(df, ["k"], "id", start=101))] == [101, 102, 103]
    assert with_dense_id(df.where("k < 0"), ["k"], "id").count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3) | st.none(), st.text("ab", max_size=2)), min_size=1))
def test_dense_ids_are_1_to_n_in_order(spark, data):
    df = spark.createDataFrame(data, "k int, v string").repartition(5)
    expected = sorted(data, key=lambda r: ((r[0] is not None, r[0] or 0), r[1]))
    got = numbered(with_dense_id(df, ["k"], "id"))
    assert got == [(i, *row) for i, row in enumerate(expected, start=1)]


def test_hot_key_and_copies_are_split_over_the_ranges(spark):
    """A third of the rows share a key and a third are copies of one row; no
    range gets much more than its share, and the ids stay dense."""
    n = 30_000
    base = spark.range(0, n, 1, 16)
    df = base.select(
        F.when(F.col("id") % 3 == 2, F.col("id")).otherwise(-1).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = with_dense_id(df, ["k"], "id")
        ids = keyed.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first()
        assert tuple(ids) == (1, n, n)
        assert keyed.where("k = -1 and v = -1").count() == n // 3
        # The written ranges, found below the join with the offsets.
        sizes = [
            r["count"]
            for r in spark.read.parquet(_written(keyed)).groupBy("_range").count().collect()
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8
    assert max(sizes) < 2.5 * n / 8


def _written(df):
    return df.inputFiles()[0].rsplit("/", 1)[0]


def test_identity_is_unique_without_a_shuffle(spark):
    from conftest import plan_of

    df = with_identity(spark.range(0, 1000, 1, 7), "key", start=5)
    assert df.columns == ["key", "id"]
    assert df.select("key").distinct().count() == 1000
    assert df.agg(F.min("key")).first()[0] == 5
    assert "Exchange" not in plan_of(df)


def test_dense_id_equals_identity_up_to_numbering(spark):
    df = spark.range(50)
    a = with_dense_id(df, ["id"], "key").select("id")
    b = with_identity(df, "key").select("id")
    assert rows(a) == rows(b)
