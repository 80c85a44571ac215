import uuid

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from starloom import plans, registry
from starloom.operators import layout
from starloom.operators.broadcasting import payload_bytes, replicate
from starloom.sources import use


@pytest.fixture(scope="module")
def frames(spark):
    lines = spark.range(0, 4000, 1, 6).selectExpr(
        "id as lo_orderkey",
        "id * 7 % 90 as lo_partkey",
        "id % 11 as lo_suppkey",
        "id % 13 as lo_custkey",
        "cast(19970101 + id * 31 % 28 as int) as lo_orderdate",
        "id * 10 as lo_extendedprice",
        "cast(id % 11 as int) as lo_discount",
        "cast(id % 50 as int) as lo_quantity",
        "id * 9 as lo_revenue",
    )
    return {
        "customer": spark.range(13).selectExpr(
            "id as c_custkey", "concat('City', id % 3) as c_city"
        ),
        "dwdate": spark.range(28).selectExpr(
            "cast(19970101 + id as int) as d_datekey", "1997 as d_year", "'Jan1997' as d_yearmonth"
        ),
        "supplier": spark.range(11).selectExpr(
            "id as s_suppkey",
            "concat('City', id % 3) as s_city",
            "if(id % 2 = 0, 'AMERICA', 'ASIA') as s_region",
        ),
        "part": spark.range(80).selectExpr(
            "id as p_partkey",
            "if(id % 2 = 0, 'MFGR#12', 'MFGR#13') as p_category",
            "concat('B', id % 5) as p_brand1",
        ),
        "lineorder": lines,
    }


@pytest.fixture(scope="module")
def databases(spark, tmp_path_factory, frames):
    names = {}
    for name, spec in layout.LAYOUTS.items():
        db = f"{name}_{uuid.uuid4().hex[:8]}"
        use(spark, db, str(tmp_path_factory.mktemp(name) / "db"))
        times = layout.load_layout(spark, db, frames, spec)
        assert [t.table_name for t in times.collect()] == list(frames)
        names[name] = db
    return names


QUERIES = {
    "one_dim": lambda t: plans.one_dim(t["lineorder"], t["dwdate"]),
    "two_dim": lambda t: plans.two_dim(t["lineorder"], t["dwdate"], t["part"], t["supplier"]),
    "drill": lambda t: plans.drill(
        t["lineorder"], t["customer"], t["supplier"], t["dwdate"],
        ["City0", "City1"], ["City1"], "Jan1997",
    ),
    "same_dist": lambda t: plans.same_dist(t["lineorder"], t["part"]),
}


def read(spark, databases, name):
    return layout.read_layout(spark, databases[name], layout.LAYOUTS[name])


def test_both_layouts_hold_the_same_rows(spark, databases, frames):
    for name in layout.LAYOUTS:
        for table, df in read(spark, databases, name).items():
            assert layout.difference(df, frames[table]).count() == 0


def test_bucketed_join_needs_no_exchange(spark, databases):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = {}
        for name in layout.LAYOUTS:
            t = read(spark, databases, name)
            join = t["lineorder"].join(t["part"], F.col("lo_partkey") == F.col("p_partkey"))
            found[name] = plan_of(join).count("Exchange hashpartitioning")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 << 20)
    assert found == {"nodist": 2, "dist": 0}


def test_one_sorted_file_per_bucket(spark, databases):
    table = spark.table(f"{databases['dist']}.lineorder")
    assert len(table.inputFiles()) <= spark.sparkContext.defaultParallelism
    days = [r[0] for r in spark.read.parquet(table.inputFiles()[0]).select("lo_orderdate").collect()]
    assert days == sorted(days)


def test_sorted_table_has_disjoint_ranges_for_block_skipping(spark, database, frames):
    layout.write_layout(frames["lineorder"], f"{database}.t", sort="lo_orderkey")
    files = spark.table(f"{database}.t").groupBy(F.input_file_name()).agg(
        F.min("lo_orderkey").alias("lo"), F.max("lo_orderkey").alias("hi")
    )
    spans = sorted((r.lo, r.hi) for r in files.collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_hot_sort_value_is_split(spark, database):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = spark.range(0, 20_000, 1, 16).selectExpr("if(id % 3 > 0, 1, id) as k", "1 as v")
        layout.write_layout(hot, f"{database}.hot", sort="k")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    table = spark.table(f"{database}.hot")
    sizes = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 2.5 * 20_000 / 8
    assert layout.difference(table, hot).count() == 0


def test_hot_bucket_stays_bucketed_and_is_written_by_several_tasks(spark, database):
    hot = spark.range(0, 3000, 1, 8).selectExpr("if(id % 3 > 0, -1, id) as k", "id as v")
    assert layout.write_layout(hot, f"{database}.a", (8, "k"), "v")
    assert not layout.write_layout(hot.withColumn("k", F.col("v")), f"{database}.b", (8, "k"), "v")
    for table, flag in (("a", "true"), ("b", "false")):
        known = layout.properties(spark, f"{database}.{table}")
        assert (known[layout.BUCKETS], known[layout.HOT]) == ("8", flag)
        described = spark.sql(f"DESCRIBE EXTENDED {database}.{table}").collect()
        assert [r.data_type for r in described if r.col_name == "Num Buckets"] == ["8"]
    table = spark.table(f"{database}.a")
    assert layout.difference(table, hot).count() == 0
    sizes = [r["count"] for r in table.where("k = -1").groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 2 and max(sizes) < 2000 / 2


def test_hot_table_is_read_without_buckets(spark, database, frames):
    hot = frames["lineorder"].withColumn(
        "lo_partkey", F.expr("if(lo_orderkey % 3 > 0, 5, lo_partkey)")
    )
    pair = {"part": frames["part"], "lineorder": hot}
    outcome = layout.load_layout(spark, database, pair, layout.LAYOUTS["dist"]).collect()
    assert {r.table_name: r.hot for r in outcome} == {"part": False, "lineorder": True}
    assert len({r.buckets for r in outcome}) == 1
    t = layout.read_layout(spark, database, {n: layout.LAYOUTS["dist"][n] for n in pair})
    join = t["lineorder"].join(t["part"].hint("merge"), F.col("lo_partkey") == F.col("p_partkey"))
    plan = plan_of(join)
    assert "Bucketed: true" not in plan and plan.count("Exchange hashpartitioning") == 2
    got = rows(plans.same_dist(t["lineorder"], t["part"]))
    assert got == rows(plans.same_dist(hot, frames["part"]))


def test_registered_join_merges_buckets_without_a_shuffle(spark):
    plan = plan_of(registry.QUERIES["layout_bucketed_join"](spark, "/root/testdata/sf0.001"))
    below = plan[plan.index("SortMergeJoin") :]
    assert "Bucketed: true" in below and "Exchange hashpartitioning" not in below
    assert "BroadcastHashJoin" not in plan


def test_sort_key_range_reaches_the_scan(spark, databases):
    length = "spark.sql.maxMetadataStringLength"  # else the plan's text is cut short
    before = spark.conf.get(length)
    spark.conf.set(length, "5000")
    try:
        check_sort_key_range(spark, databases)
    finally:
        spark.conf.set(length, before)


def check_sort_key_range(spark, databases):
    t = read(spark, databases, "dist")
    days = t["dwdate"].where("d_datekey between 19970105 and 19970106")
    for query in (
        plans.one_dim(t["lineorder"], days),
        plans.drill(t["lineorder"], t["customer"], t["supplier"], days, ["City0"], ["City1"], "Jan1997"),
    ):
        plan = plan_of(query)
        assert "GreaterThanOrEqual(lo_orderdate,19970105)" in plan
        assert "LessThanOrEqual(lo_orderdate,19970106)" in plan
    empty = plans.one_dim(t["lineorder"], t["dwdate"], year=1900)
    assert rows(empty) == [(None,)]


def test_bucket_of_the_count_is_spark_s_bucket(spark, database):
    df = spark.range(1000)
    layout.write_layout(df, f"{database}.t", (4, "id"))
    sizes = layout.bucket_sizes(df, 4, "id")
    table = spark.table(f"{database}.t")
    files = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
    assert sorted(files) == sorted(sizes.values())


@pytest.mark.parametrize(
    "rows, cores, buckets",
    [(0, 8, 8), (5, 6, 8), (9_000_000, 8, 16), (600 * 10**9, 8000, 1 << 16)],
)
def test_number_of_buckets(rows, cores, buckets):
    assert layout.bucket_count(rows, cores) == buckets


def test_replicated_only_within_the_size_limit(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "k int, v string")
    assert payload_bytes(df) == 2 * 16 + 2
    assert payload_bytes(df.where("k > 5")) == 0
    for limit, expected in ((33, False), (34, True)):
        plan = replicate(df, limit)._jdf.queryExecution().logical().toString()
        assert ("Hint broadcast" in plan) == expected


def test_difference_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    assert rows(layout.difference(a, b)) == [(1, 1), (2, 1), (3, -1)]
    assert layout.difference(a, a).count() == 0


def test_layouts_agree_on_every_query(spark, databases):
    pair = [read(spark, databases, name) for name in ("nodist", "dist")]
    found = {r["query"]: r for r in layout.agreement(QUERIES, *pair).collect()}
    assert set(found) == set(QUERIES)
    assert all(r.differing_rows == 0 and r.result_rows > 0 for r in found.values())


def test_agreement_reports_a_difference(spark, databases):
    plain, spread = (read(spark, databases, name) for name in ("nodist", "dist"))
    broken = {**spread, "lineorder": spread["lineorder"].where("lo_orderdate <> 19970101")}
    found = {r["query"]: r for r in layout.agreement(QUERIES, plain, broken).collect()}
    assert found["same_dist"].differing_rows == 1
    assert found["one_dim"].differing_rows == 2


def test_improvement_in_percent(spark):
    a = spark.createDataFrame([("x", 4.0), ("y", 2.0), ("z", 0.0), ("w", 1.0)], "query string, seconds double")
    b = spark.createDataFrame([("x", 1.0), ("y", 3.0), ("z", 1.0)], "query string, seconds double")
    result = layout.improvement(a, b)
    assert result.columns == ["query", "seconds_nodist", "seconds_dist", "dist_improvement"]
    assert rows(result) == [
        ("w", 1.0, None, None),
        ("x", 4.0, 1.0, 75.0),
        ("y", 2.0, 3.0, -50.0),
        ("z", 0.0, 1.0, None),
    ]


def test_compare_layouts(spark, databases):
    pair = [read(spark, databases, name) for name in ("nodist", "dist")]
    result = layout.compare_layouts(spark, QUERIES, *pair).collect()
    assert {r["query"] for r in result} == set(QUERIES)
    assert all(r.seconds_nodist > 0 and r.seconds_dist > 0 for r in result)
    assert all(r.differing_rows == 0 for r in result)
