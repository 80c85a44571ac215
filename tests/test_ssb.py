"""Benchmark queries against brute force on small tables."""

import itertools
import random
from collections import Counter

import pytest
from conftest import plan_of

from starloom import plans

R = random.Random(7)
DATES = [(19970101 + i, 1997, "Jan1997") for i in range(5)] + [
    (19971201, 1997, "Dec1997"),
    (19971202, 1997, "Dec1997"),
    (19981201, 1998, "Dec1998"),
]
PARTS = [(i, ("MFGR#12", "MFGR#13")[i % 2], f"MFGR#12{i % 3}") for i in range(10)]
CITIES = ["UNITED KI1", "UNITED KI5", "UNITED KI2"]
SUPPLIERS = [(i, CITIES[i % 3], ("AMERICA", "ASIA")[i % 2]) for i in range(6)]
CUSTOMERS = [(i, CITIES[i % 3]) for i in range(7)]
LINES = [
    (
        R.choice(DATES)[0] if i % 20 else 20200101,  # some without a day
        R.randrange(12),  # parts 10 and 11 do not exist
        R.randrange(7),  # supplier 6 does not exist
        R.randrange(7),
        R.randrange(1, 50),
        R.randrange(100_000, 9_999_999),
        R.randrange(0, 11),
        R.randrange(100_000, 9_999_999),
    )
    for i in range(600)
]


@pytest.fixture(scope="module")
def ssb(spark):
    return {
        "lo": spark.createDataFrame(
            LINES,
            "lo_orderdate int, lo_partkey int, lo_suppkey int, lo_custkey int, lo_quantity int,"
            "lo_extendedprice int, lo_discount int, lo_revenue int",
        ),
        "d": spark.createDataFrame(DATES, "d_datekey int, d_year int, d_yearmonth string"),
        "p": spark.createDataFrame(PARTS, "p_partkey int, p_category string, p_brand1 string"),
        "s": spark.createDataFrame(SUPPLIERS, "s_suppkey int, s_city string, s_region string"),
        "c": spark.createDataFrame(CUSTOMERS, "c_custkey int, c_city string"),
    }


def joined(dates=False, parts=False, suppliers=False, customers=False):
    for line in LINES:
        choices = [
            [d for d in DATES if d[0] == line[0]] if dates else [None],
            [p for p in PARTS if p[0] == line[1]] if parts else [None],
            [s for s in SUPPLIERS if s[0] == line[2]] if suppliers else [None],
            [c for c in CUSTOMERS if c[0] == line[3]] if customers else [None],
        ]
        for combination in itertools.product(*choices):
            yield line, *combination


def test_one_dim(ssb):
    expected = sum(
        line[5] * line[6]
        for line, d, *_ in joined(dates=True)
        if d[1] == 1997 and 1 <= line[6] <= 3 and line[4] < 24
    )
    result = plans.one_dim(ssb["lo"], ssb["d"])
    assert result.columns == ["revenue"]
    assert result.first().revenue == expected > 0


def test_one_dim_without_a_match_is_null(ssb):
    assert plans.one_dim(ssb["lo"], ssb["d"], year=1900).first().revenue is None


@pytest.mark.parametrize("max_bytes", [0, 1 << 20])
def test_two_dim(ssb, max_bytes):
    expected = Counter()
    for line, d, p, s, _ in joined(dates=True, parts=True, suppliers=True):
        if p[1] == "MFGR#12" and s[2] == "AMERICA":
            expected[d[1], p[2]] += line[7]
    result = plans.two_dim(ssb["lo"], ssb["d"], ssb["p"], ssb["s"], max_bytes=max_bytes)
    assert {(r.d_year, r.p_brand1): r.revenue for r in result.collect()} == expected


@pytest.mark.parametrize("max_bytes", [0, 1 << 20])
def test_drill_and_its_order(ssb, max_bytes):
    expected = Counter()
    for line, d, _, s, c in joined(dates=True, suppliers=True, customers=True):
        if d[2] == "Dec1997" and s[1] in CITIES[:2] and c[1] in CITIES[:2]:
            expected[c[1], s[1], d[1]] += line[7]
    result = plans.drill(ssb["lo"], ssb["c"], ssb["s"], ssb["d"], max_bytes=max_bytes).collect()
    assert {tuple(r)[:3]: r.revenue for r in result} == expected
    assert [r.revenue for r in result] == sorted(expected.values(), reverse=True)


def test_same_dist_drops_orphans_and_keeps_copies(ssb, spark):
    expected = Counter()
    for line, _, _p, *_ in joined(parts=True):
        expected[line[0]] += line[5] * line[6]
    result = plans.same_dist(ssb["lo"], ssb["p"]).collect()
    assert [tuple(r) for r in result] == sorted(expected.items())
    doubled = plans.same_dist(ssb["lo"], ssb["p"].union(ssb["p"])).collect()
    assert [r.revenue for r in doubled] == [2 * r.revenue for r in result]


def test_int_money_does_not_overflow(spark):
    lo = spark.createDataFrame(
        [(1, 1, 2_000_000_000, 10)] * 3,
        "lo_orderdate int, lo_partkey int, lo_extendedprice int, lo_discount int",
    )
    p = spark.createDataFrame([(1,)], "p_partkey int")
    assert plans.same_dist(lo, p).first().revenue == 60_000_000_000


def test_small_dimensions_are_broadcast_large_ones_shuffled(ssb, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    tables = ssb["lo"], ssb["d"], ssb["p"], ssb["s"]
    try:
        small = plan_of(plans.two_dim(*tables))
        large = plan_of(plans.two_dim(*tables, max_bytes=0, max_words=0))
        filtered = plan_of(plans.two_dim(*tables, max_bytes=0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 << 20)
    assert (small.count("BroadcastHashJoin"), large.count("BroadcastHashJoin")) == (2, 0)
    # The filters are broadcast, the dimensions are not.
    assert filtered.count("BroadcastHashJoin [_word") == filtered.count("BroadcastHashJoin") == 2


def test_city_filters_reach_the_scans(ssb, tmp_path, spark):
    tables = {}
    for name, df in ssb.items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    plan = plan_of(plans.drill(tables["lo"], tables["c"], tables["s"], tables["d"]))
    assert plan.count("In(") == 2 or plan.count("Or(EqualTo") + plan.count("In(") == 2
    assert "EqualTo(d_yearmonth,Dec1997)" in plan
    assert "lo_extendedprice" not in plan  # pruned
