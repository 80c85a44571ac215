"""Loads that count, refuse and explain; increments; keys without a shuffle."""

import gzip
import json
import math
from collections import Counter

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import operators as ops
from starloom import plans, schemas, sources
from starloom.operators import evidence, layout
from starloom.operators.key_filter import KeyFilter
from starloom.sources.diagnose import bad_delimited_lines, bad_json_lines

NAMED = T.StructType(
    [T.StructField("id", T.LongType(), False), T.StructField("name", T.VarcharType(4))]
)


# --- figures and lengths ---------------------------------------------------------


def test_figures_come_from_the_write(spark, database):
    sources.create_tables(spark, database, {"named": NAMED})
    figures = sources.LoadFigures()
    lengths = schemas.text_lengths(NAMED)
    for part in ([(1, "Ä"), (2, None)], [(3, "ÄÄÄ"), (4, "abcd")], []):
        df = spark.createDataFrame(part, "id long, name string")
        sources.insert_into(df, f"{database}.named", required=["id"], lengths=lengths, figures=figures)
    assert rows(figures.report(spark)) == [("named", "id", 4, 0, None), ("named", "name", 4, 1, 1)]


def test_watched_rows_are_scanned_once(spark, tmp_path):
    spark.range(50).selectExpr("id", "string(id) AS name").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    figures = sources.LoadFigures()
    watched = sources.within_lengths(figures.watch(stored, "t", {"name": 1}), {"name": 2})
    plan = plan_of(watched)
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan and "Exchange" not in plan
    watched.write.parquet(str(tmp_path / "u"))
    assert rows(figures.report(spark)) == [("t", "id", 50, 0, None), ("t", "name", 50, 0, 40)]


def test_overlong_text_fails_the_load(spark, database):
    sources.create_tables(spark, database, {"named": NAMED})
    lengths = schemas.text_lengths(NAMED)
    good = spark.createDataFrame([(1, "ÄÄ"), (2, "")], "id long, name string")
    sources.insert_into(good, f"{database}.named", lengths=lengths, refuse_overlong=True)
    bad = spark.createDataFrame([(3, "ok"), (4, "ÄÄa")], "id long, name string")
    with pytest.raises(Exception, match="value too long for column name: 5 bytes, 4 allowed"):
        sources.insert_into(bad, f"{database}.named", lengths=lengths, refuse_overlong=True)
    assert spark.table(f"{database}.named").count() == 2
    sources.insert_into(bad, f"{database}.named", lengths=lengths)
    assert spark.table(f"{database}.named").count() == 4


def event(**fields):
    base = {"page": "NextSong", "userId": "1", "ts": 1_541_000_000_000, "firstName": "A"}
    return json.dumps({**base, **fields})


def config(db, tmp_path, **options):
    return plans.RunConfig(
        db=db,
        events=str(tmp_path / "events"),
        songs=str(tmp_path / "songs"),
        json_paths=[f"$.{c}" for c in schemas.EVENTS.names],
        **options,
    )


def write_input(tmp_path, lines):
    for name in ("events", "songs"):
        (tmp_path / name).mkdir(exist_ok=True)
    (tmp_path / "events" / "a.json").write_text("\n".join(lines))
    song = {"artist_id": "AR", "artist_name": "N", "song_id": "S", "title": "T", "year": 2000}
    (tmp_path / "songs" / "s.json").write_text(json.dumps(song))


def test_run_refuses_or_counts_overlong_text(spark, database, tmp_path):
    write_input(tmp_path, [event(), event(location="x" * 300, userId="2")])
    with pytest.raises(Exception, match="value too long for column location: 300 bytes, 256"):
        plans.run(spark, config(database, tmp_path, refuse_overlong=True))
    found = plans.run_counted(spark, config(database, tmp_path))
    told = {(r["table_name"], r["column_name"]): r for r in found.collect()}
    assert told["staging_events", "location"]["too_long"] == 1
    assert told["staging_events", "location"]["row_count"] == 2
    assert told["users", "user_id"]["row_count"] == 2 and told["users", "last_name"]["nulls"] == 2


# --- appends that keep the latest row --------------------------------------------


def test_appends_merge_the_latest_rows(spark, database, tmp_path):
    write_input(tmp_path, [event(level="free", ts=5000), event(userId="2", level="paid", ts=9000)])
    plans.run(spark, config(database, tmp_path, merge_latest=True))
    write_input(tmp_path, [event(level="paid", ts=7000), event(userId="2", level="free", ts=8000)])
    report = plans.run(spark, config(database, tmp_path, merge_latest=True, append=True))
    levels = {r["user_id"]: r["level"] for r in spark.table(f"{database}.users").collect()}
    assert levels == {1: "paid", 2: "paid"}
    by_table = {r["table_name"]: r["duplicate_keys"] for r in report.collect()}
    assert by_table["users"] == by_table["artists"] == 0
    # Loading the same again changes nothing; a reset forgets.
    plans.run(spark, config(database, tmp_path, merge_latest=True, append=True))
    assert spark.table(f"{database}.users").count() == 2
    plans.run(spark, config(database, tmp_path, merge_latest=True))
    levels = {r["user_id"]: r["level"] for r in spark.table(f"{database}.users").collect()}
    assert levels == {1: "paid", 2: "free"}


# --- bad lines -------------------------------------------------------------------


@pytest.mark.parametrize("split", [None, "64b"])
def test_bad_json_lines_are_named(spark, tmp_path, split):
    schema = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType())])
    lines = ['{"a": 1, "b": "x"}', "", '{"a": "two"}', '{"a": ', '{"b": "y"}', "7", '{"a": "  "}', '{"a": 3}']
    (tmp_path / "deep").mkdir()
    (tmp_path / "one.json").write_text("\n".join(lines) + "\n")
    (tmp_path / "deep" / "two.json.gz").write_bytes(gzip.compress(("\n".join(lines[3:])).encode()))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = bad_json_lines(spark, str(tmp_path), ["$.a", "$.b"], schema).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    missing = ("a", "NULL in a required column")
    expected = {
        ("one.json", 3): ("a", "not a valid bigint: two"),
        ("one.json", 4): (None, 'no JSON object: {"a": '),
        ("one.json", 5): missing,
        ("one.json", 6): (None, "no JSON object: 7"),
        ("one.json", 7): missing,
        ("two.json.gz", 1): (None, 'no JSON object: {"a": '),
        ("two.json.gz", 2): missing,
        ("two.json.gz", 3): (None, "no JSON object: 7"),
        ("two.json.gz", 4): missing,
    }
    told = {(r["file"].rsplit("/", 1)[1], r["line"]): (r["column_name"], r["reason"]) for r in found}
    assert told == expected and len(found) == len(expected)
    with pytest.raises(Exception):
        sources.read_json_paths(spark, str(tmp_path), ["$.a", "$.b"], schema).collect()


def test_bad_delimited_lines_are_named(spark, tmp_path):
    schema = schemas.table(("id", schemas.INT, schemas.REQUIRED), ("name", schemas.TEXT), ("n", schemas.DOUBLE))
    lines = ["1;a;2.5", "x;b;1", "2;c", " ", "3;;", "\\N;d;1", "4;e;two;", "5;f;two"]
    (tmp_path / "t.csv").write_text("\n".join(lines))
    found = bad_delimited_lines(spark, str(tmp_path), schema, sep=";").collect()
    assert sorted((r["line"], r["column_name"] or "", r["reason"]) for r in found) == [
        (2, "id", "not a valid int: x"),
        (3, "", "2 fields instead of 3"),
        (6, "id", "NULL in a required column"),
        (7, "", "4 fields instead of 3"),
        (8, "n", "not a valid double: two"),
    ]


def test_good_lines_are_not_named(spark, tmp_path):
    (tmp_path / "t.csv").write_text("1|a\n2|\n")
    assert bad_delimited_lines(spark, str(tmp_path), NAMED).count() == 0


# --- keys and duplicates ---------------------------------------------------------


def test_dense_keys_in_place(spark):
    df = spark.range(0, 5000, 1, 7).where("id % 7 <> 3 or id > 900").select("id")
    keyed = ops.with_dense_id_in_place(df, "key", start=10)
    assert "Exchange hash" not in plan_of(keyed) and "Exchange range" not in plan_of(keyed)
    found = keyed.collect()
    assert sorted(r["key"] for r in found) == list(range(10, 10 + len(found)))
    assert sorted(r["id"] for r in found) == sorted(r["id"] for r in df.collect())
    assert ops.with_dense_id_in_place(df.limit(0), "key").count() == 0


def test_duplicates_by_hash(spark):
    data = [(i % 50 if i < 60 else i, None if i % 2 else "x") for i in range(300)] + [(None, None)] * 3
    df = spark.createDataFrame(data, "a long, b string")
    found = ops.duplicates_by_hash(df, ["a", "b"])
    assert rows(found) == rows(ops.duplicates(df, ["a", "b"]))
    shuffled = ops.duplicates_by_hash(df, ["a", "b"], max_bytes=-1)
    assert rows(shuffled) == rows(found)
    # Rows meet the repeated hashes before they are shuffled by their keys.
    plan = plan_of(found)
    assert plan.index("hashpartitioning(a") < plan.index("BroadcastHashJoin")


# --- filters of keys, hybrid joins, paired timings -------------------------------


def test_key_filter_keeps_every_partner(spark):
    keys = spark.range(0, 3000, 3).withColumnRenamed("id", "k")
    known = KeyFilter.of(keys, "k")
    passed = {r["id"] for r in known.apply(spark.range(60_000), "id").collect()}
    partners = set(range(0, 3000, 3))
    assert partners <= passed and len(passed - partners) < 0.09 * 60_000
    assert KeyFilter.of(keys, "k", max_words=20) is None
    named = keys.selectExpr("concat('n', k) AS k")
    kept = KeyFilter.of(named, "k").apply(spark.range(9000).selectExpr("concat('n', id) AS id"), "id")
    assert 1000 <= kept.count() < 2000
    none = KeyFilter.of(keys.limit(0), "k")
    assert none.apply(spark.range(10), "id").count() == 0


def test_filter_stands_before_the_shuffle(spark):
    lo = spark.range(1000).selectExpr(
        "id % 50 AS lo_partkey", "id % 20 AS lo_suppkey", "int(19970101) AS lo_orderdate", "id AS lo_revenue"
    )
    d = spark.createDataFrame([(19970101, 1997)], "d_datekey int, d_year int")
    p = spark.range(50).selectExpr("id AS p_partkey", "'c' AS p_category", "string(id % 5) AS p_brand1")
    s = spark.range(20).selectExpr("id AS s_suppkey", "IF(id < 5, 'R', 'S') AS s_region")
    narrow = plans.two_dim(lo, d, p, s, "c", "R", max_bytes=0)
    assert rows(narrow) == rows(plans.two_dim(lo, d, p, s, "c", "R"))
    plan = plan_of(narrow)
    assert plan.count("bit_or") >= 2 and "shiftright(_bits" in plan


def test_hybrid_join_merges_cold_buckets(spark, database):
    lines = spark.range(0, 6000).selectExpr("IF(id % 3 = 0, 7, id % 400) AS k", "id AS v")
    parts = spark.range(0, 300).selectExpr("id AS p", "concat('n', id) AS name")
    spec = {"parts": layout.Layout(bucket="p", sort="p"), "lines": layout.Layout(bucket="k")}
    layout.load_layout(spark, database, {"parts": parts, "lines": lines}, spec, buckets=16)
    assert layout.properties(spark, f"{database}.lines")[layout.HOT_BUCKETS]

    def join(**how):
        return layout.hybrid_join(spark, f"{database}.lines", f"{database}.parts", "k", "p", ["v"], ["name"], **how)

    expected = rows(lines.join(parts, F.col("k") == F.col("p")).select("v", "name"))
    assert rows(join()) == expected == rows(join(max_bytes=-1))
    cold, hot = plan_of(join()).split("Union", 1)[1].split("BroadcastHashJoin")[0], plan_of(join())
    assert "SortMergeJoin" in cold and "hashpartitioning" not in hot
    with pytest.raises(ValueError):
        layout.load_layout(spark, database, {"parts": parts}, spec, buckets=8)
        join()


def test_hybrid_join_without_hot_buckets(spark, database):
    lines = spark.range(0, 6000).selectExpr("id AS k", "id AS v")
    parts = spark.range(0, 300).selectExpr("id AS p", "concat('n', id) AS name")
    spec = {"parts": layout.Layout(bucket="p", sort="p"), "lines": layout.Layout(bucket="k")}
    layout.load_layout(spark, database, {"parts": parts, "lines": lines}, spec, buckets=8)
    joined = layout.hybrid_join(spark, f"{database}.lines", f"{database}.parts", "k", "p", ["v"], ["name"])
    assert joined.count() == 300 and "Union" not in plan_of(joined)


def test_paired_gain(spark):
    pairs = [("a", 10.0, 9.0)] * 9 + [("a", 10.0, 11.0), ("b", 4.0, 3.0), ("b", 0.0, 1.0), ("c", 1.0, 1.0), ("b", 1.0, None)]
    found = ops.paired_gain(spark.createDataFrame(pairs, "q string, x double, y double"), "q", "x", "y")
    told = {r["q"]: r.asDict() for r in found.collect()}
    assert told["a"]["p_value"] == pytest.approx(2 * (1 + 10) / 2**10) and told["a"]["proven"]
    assert (told["a"]["median_gain"], told["a"]["least_gain"]) == (pytest.approx(10), pytest.approx(-10))
    assert told["b"]["pairs"] == 1 and told["b"]["p_value"] == 1.0 and not told["b"]["proven"]
    assert told["c"]["p_value"] == 1.0
    tails = Counter((n, k) for n in (1, 7, 200, 1000) for k in (0, 1, n // 3, n // 2))
    df = spark.createDataFrame([(n - k, k) for n, k in tails if n >= 2 * k], "w long, l long")
    for r in df.select("w", "l", evidence.sign_test(F.col("w"), F.col("l")).alias("p")).collect():
        n = r["w"] + r["l"]
        exact = min(1.0, 2 * sum(math.comb(n, i) for i in range(r["l"] + 1)) / 2**n)
        assert r["p"] == pytest.approx(exact)


def test_timings_come_in_pairs(spark):
    tables = {"t": spark.range(10)}
    found = layout.paired_timings(spark, {"q": lambda t: t["t"]}, tables, lambda: tables, 3).collect()
    assert [r["run"] for r in found] == [0, 1, 2]
    assert all(r["seconds_nodist"] > 0 and r["seconds_dist"] > 0 for r in found)


# --- command line ----------------------------------------------------------------


def test_commands(spark, database, tmp_path, capsys):
    from starloom.__main__ import main

    write_input(tmp_path, [event(artist="N", song="T"), event(artist="N", song="T", ts=1_541_003_600_000)])
    paths = tmp_path / "paths.json"
    paths.write_text(json.dumps({"jsonpaths": [f"$.{c}" for c in schemas.EVENTS.names]}))
    load = ["--db", database, "--events", str(tmp_path / "events"), "--songs", str(tmp_path / "songs"), "--paths", str(paths)]
    main(["run", *load, "--refuse-overlong"])
    main(["answers", "--db", database])
    assert "No duplicates found" in capsys.readouterr().out
    main(["etl", *load])
    main(["keys", "--db", database])
    told = capsys.readouterr().out
    assert "Duplicates found" in told and "|users" in told
    main(["figures", *load, "--merge-latest"])
    assert "too_long" in capsys.readouterr().out
    (tmp_path / "events" / "a.json").write_text("{")
    main(["diagnose", "--events", str(tmp_path / "events"), "--paths", str(paths)])
    assert "no JSON object: {" in capsys.readouterr().out
    (tmp_path / "t.csv").write_text("1;2;3;4;s;r;a;;9.50\n")
    main(["tickets", "--db", database, "--files", str(tmp_path / "t.csv")])
    assert "sporting_event_ticket" in capsys.readouterr().out


def test_checks_by_hash_agree(spark, database, tmp_path):
    write_input(tmp_path, [event(), event(userId="2")])
    plans.run(spark, config(database, tmp_path))
    by_hash = plans.run(spark, config(database, tmp_path, append=True, check_by_hash=True))
    told = {r["table_name"]: r for r in by_hash.collect()}
    assert told["users"]["duplicate_keys"] == 2 and told["users"]["row_count"] == 4
    assert told["artists"]["verdict"] == "Duplicates found"
