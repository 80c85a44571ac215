import gzip
import json
from decimal import Decimal

import pytest
from conftest import rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from starloom import schemas
from starloom.sources import (
    LoadSpec,
    create_tables,
    drop_tables,
    insert_into,
    load_append,
    load_json_paths,
    load_tables,
    read_delimited,
    read_json_auto,
    read_json_paths,
    reset,
    source_manifest,
)

# A failed task arrives as either, depending on the cause.
LOAD_ERRORS = (PySparkException, Py4JJavaError)

NAMED = schemas.table(("name", schemas.TEXT), ("id", schemas.INT), ("size", schemas.DOUBLE))


def write_lines(folder, name, *lines):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(line + "\n" for line in lines))
    return str(folder)


def write_gzip(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as out:
        out.write("".join(line + "\n" for line in lines))
    return str(path)


# --- JSON ------------------------------------------------------------------------


def test_user_id_quoted_bare_empty_null_and_missing(spark, tmp_path):
    """A reader schema with INT would give NULL for the quoted one."""
    path = write_lines(
        tmp_path,
        "2018/11/2018-11-12-events.json",
        '{"userId": "39"}',
        '{"userId": 39}',
        '{"userId": ""}',
        '{"userId": " 39 "}',
        '{"userId": null}',
        "",
        "{}",
    )
    df = read_json_paths(spark, path, ["$.userId"], schemas.table(("userId", schemas.INT)))
    assert rows(df) == [(None,)] * 3 + [(39,)] * 3


def test_paths_map_fields_by_position_at_any_depth(spark, tmp_path):
    write_lines(tmp_path / "in", "a/b/x.json", '{"n": {"first": "Ada"}, "l": [{"v": 7}, 2.5], "z": 1}')
    path = write_lines(tmp_path / "in", "a/y.json", '{"n": {}, "l": []}')
    write_lines(tmp_path / "in", "a/z.json", '{"n": 5, "l": [1, 2, 3], "more": [{}]}')
    df = read_json_paths(spark, path, ["$.n.first", "$['l'][0].v", '$["l"][1]'], NAMED_TEXT)
    assert rows(df) == [(None, None, None), (None, None, "2"), ("Ada", "7", "2.5")]
    df = read_json_paths(spark, path, ["$.n", "$.l[0]", "$.z"], NAMED_TEXT)
    assert rows(df) == [
        ("5", "1", None),
        ('{"first": "Ada"}', '{"v":7}', "1"),
        ("{}", None, None),
    ]


NAMED_TEXT = schemas.table(("a", schemas.TEXT), ("b", schemas.TEXT), ("c", schemas.TEXT))


@pytest.mark.parametrize("path", ["userId", "$", "$.", "$.a..b", "$[0]", "$.a[x]"])
def test_unsupported_paths_are_refused(spark, tmp_path, path):
    with pytest.raises(ValueError):
        read_json_paths(spark, str(tmp_path), [path], schemas.table(("a", schemas.TEXT)))


def test_one_path_per_column(spark, tmp_path):
    with pytest.raises(ValueError):
        read_json_paths(spark, str(tmp_path), ["$.a"], NAMED)


def test_control_file(spark, tmp_path):
    paths = ["$.artist", "$['auth']"]
    (tmp_path / "log_paths.json").write_text(json.dumps({"jsonpaths": paths}, indent=1))
    assert load_json_paths(spark, str(tmp_path / "log_paths.json")) == paths


def test_auto_matches_names_exactly_and_missing_is_null(spark, tmp_path):
    path = write_lines(
        tmp_path,
        "A/B/C/s.json",
        '{"id": 5, "name": "", "size": 152.92036, "more": 1}',
    )
    write_lines(tmp_path, "A/A/B/t.json", '{"ID": 6, "name": "x"}')
    df = read_json_auto(spark, path, NAMED)
    assert rows(df) == [("", 5, 152.92036), ("x", None, None)]


def test_bad_json_fails_the_load(spark, tmp_path):
    path = write_lines(tmp_path, "x.json", '{"id": 1}', "{oops")
    with pytest.raises(LOAD_ERRORS):
        read_json_auto(spark, path, NAMED).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_number_fails_the_load_unless_lenient(spark, tmp_path, ansi):
    path = write_lines(tmp_path, "x.json", '{"id": "abc", "name": "n"}')
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(LOAD_ERRORS, match="(not a valid int: |')abc"):
            read_json_auto(spark, path, NAMED).collect()
        assert rows(read_json_auto(spark, path, NAMED, strict=False)) == [("n", None, None)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_event_schema_reads_a_log_line(spark, tmp_path):
    line = {
        "artist": "Muse", "auth": "Logged In", "firstName": "Ada", "gender": "F",
        "itemInSession": 1, "lastName": "L", "length": 303.1, "level": "free",
        "location": "Oslo", "method": "PUT", "page": "NextSong",
        "registration": 1540919166796.0, "sessionId": 38, "song": "Uprising",
        "status": 200, "ts": 1541121934796, "userAgent": '"Mozilla/5.0"', "userId": "39",
    }
    path = write_lines(tmp_path, "x.json", json.dumps(line))
    paths = [f"$['{n}']" for n in schemas.EVENTS.names]
    got = read_json_paths(spark, path, paths, schemas.EVENTS).first().asDict()
    assert got == {**line, "userId": 39}


# --- delimited text --------------------------------------------------------------

TICKET = "{0};2;3;4;box;r{0};s;{1};{2}"


def test_split_gzip_files_by_prefix(spark, tmp_path):
    for i in range(4):
        write_gzip(tmp_path / f"split/part-{i}.csv.gz", TICKET.format(i, 9, "12.50"))
    write_gzip(tmp_path / "split/other.csv.gz", TICKET.format(99, 9, "1.00"))
    df = read_delimited(spark, f"{tmp_path}/split/part*", schemas.TICKETS, sep=";")
    assert df.schema == schemas.readable(schemas.TICKETS)
    assert df.count() == 4
    assert df.where("id = 2").first() == (
        2.0, 2.0, 3.0, Decimal(4), "box", "r2", "s", 9.0, Decimal("12.50"),
    )


def test_single_gzip_file_is_one_partition_until_spread(spark, tmp_path):
    lines = [TICKET.format(i, i, "1.00") for i in range(2000)]
    path = write_gzip(tmp_path / "full/full.csv.gz", *lines)
    single = read_delimited(spark, path, schemas.TICKETS, sep=";")
    spread = read_delimited(spark, path, schemas.TICKETS, sep=";", repartition=6)
    assert single.rdd.getNumPartitions() == 1
    assert spread.rdd.getNumPartitions() == 6
    assert rows(spread) == rows(single)


def test_empty_field_is_null_number_and_empty_text(spark, tmp_path):
    path = write_gzip(
        tmp_path / "x.gz",
        r";1;",
        r"\N;\N;\N",
        r'"a;2; 3.5 ',
        r"b\;3;1e3",
    )
    df = read_delimited(spark, path, NAMED, sep=";")
    assert rows(df) == [(None, None, None), ("", 1, None), ('"a', 2, 3.5), ("b\\", 3, 1000.0)]


def test_required_numbers_are_parsed_by_the_reader(spark, tmp_path):
    """Same values as by cast; blank stays NULL for the insert to refuse."""
    path = write_gzip(tmp_path / "x.gz", "7;1e3;1.255;a", "-8;.5;2;", ";;;")
    fields = [("i", schemas.BIGINT), ("d", schemas.DOUBLE), ("m", T.DecimalType(8, 2))]
    required = schemas.table(*[(*f, schemas.REQUIRED) for f in fields], ("t", schemas.TEXT))
    nullable = schemas.table(*fields, ("t", schemas.TEXT))
    got = read_delimited(spark, path, required, sep=";")
    assert rows(got) == rows(read_delimited(spark, path, nullable, sep=";"))
    assert rows(got)[-1] == (7, 1000.0, Decimal("1.26"), "a")
    for bad in (r"\N;1;1;a", "x;1;1;a", "1;1;1234567;a"):
        path = write_gzip(tmp_path / "bad.gz", bad)
        with pytest.raises(LOAD_ERRORS):
            read_delimited(spark, path, required, sep=";").collect()


@pytest.mark.parametrize("line", ["a|1", "a|1|2|3", "a|x|2", "a|1|2|"])
def test_bad_line_fails_the_load(spark, tmp_path, line):
    path = write_gzip(tmp_path / "x.gz", "ok|1|2", line)
    with pytest.raises(LOAD_ERRORS):
        read_delimited(spark, path, NAMED).collect()


def test_trailing_separator(spark, tmp_path):
    path = write_gzip(tmp_path / "x.gz", "a|1|2|", "b|2|3|")
    assert rows(read_delimited(spark, path, NAMED, trailing_sep=True)) == [
        ("a", 1, 2.0),
        ("b", 2, 3.0),
    ]


def test_bad_price_fails_the_load(spark, tmp_path):
    path = write_gzip(tmp_path / "x.gz", TICKET.format(1, 1, "cheap"))
    with pytest.raises(LOAD_ERRORS):
        read_delimited(spark, path, schemas.TICKETS, sep=";").collect()


def test_manifest_lists_every_file_and_reads_none(spark, tmp_path):
    from conftest import plan_of

    write_lines(tmp_path, "a/x.json", "12345")
    write_lines(tmp_path, "a/b/y.json", "1")
    df = source_manifest(spark, str(tmp_path))
    assert df.columns == ["path", "length", "modificationTime"]
    assert sorted((r.path.rsplit("/", 1)[1], r.length) for r in df.collect()) == [
        ("x.json", 6),
        ("y.json", 2),
    ]
    assert "content" not in plan_of(df)


# --- tables ----------------------------------------------------------------------


def columns_of(spark, table):
    return [f"{c.col_name} {c.data_type}" for c in spark.sql(f"DESCRIBE {table}").collect()]


def test_create_is_idempotent_and_keeps_declared_types(spark, database):
    create_tables(spark, database, wide_ids=False)
    create_tables(spark, database, wide_ids=False)
    assert {t.name for t in spark.catalog.listTables(database)} == set(schemas.WAREHOUSE)
    assert columns_of(spark, f"{database}.users") == [
        "user_id int",
        "first_name string",
        "last_name string",
        "gender char(1)",
        "level string",
    ]


def test_ids_are_wide_by_default(spark, database):
    create_tables(spark, database, schemas.SSB)
    assert columns_of(spark, f"{database}.lineorder")[:2] == [
        "lo_orderkey bigint",
        "lo_linenumber int",
    ]
    create_tables(spark, database, schemas.TICKET_TABLES)
    assert "ticket_price decimal(8,2)" in columns_of(spark, f"{database}.sporting_event_ticket_full")


def test_reset_empties_and_drop_removes(spark, database):
    reset(spark, database, schemas.STAR)
    row = spark.createDataFrame([("SO1", "t", "AR1", 1, 2.0)], schemas.readable(schemas.SONGS))
    insert_into(row, f"{database}.songs")
    assert spark.table(f"{database}.songs").count() == 1
    reset(spark, database, schemas.STAR)
    assert spark.table(f"{database}.songs").count() == 0
    drop_tables(spark, database, schemas.STAR)
    drop_tables(spark, database, schemas.STAR)
    assert spark.catalog.listTables(database) == []


def test_loading_twice_doubles(spark, database):
    df = spark.range(5)
    load_append(df, f"{database}.t")
    load_append(df, f"{database}.t")
    assert spark.table(f"{database}.t").count() == 10


def test_insert_by_listed_order_fills_the_rest_with_null(spark, database):
    create_tables(spark, database, schemas.STAR)
    df = spark.createDataFrame([("paid", 7)], "x string, y int")
    insert_into(df, f"{database}.users", ["level", "user_id"])
    assert rows(spark.table(f"{database}.users")) == [(7, None, None, None, "paid")]
    for cols in (["level"], ["level", "nope"]):
        with pytest.raises(ValueError):
            insert_into(df, f"{database}.users", cols)


def test_insert_refuses_null_in_required_column_and_long_text(spark, database):
    create_tables(spark, database, schemas.STAR)
    null_key = spark.createDataFrame([(None, "paid")], "user_id long, level string")
    insert_into(null_key, f"{database}.users")
    with pytest.raises(LOAD_ERRORS, match="NULL in"):
        insert_into(null_key, f"{database}.users", required=["user_id"])
    long_text = spark.createDataFrame([(1, "FF")], "user_id long, gender string")
    with pytest.raises(LOAD_ERRORS, match="EXCEED_LIMIT_LENGTH"):
        insert_into(long_text, f"{database}.users")


def test_insert_refuses_values_that_do_not_fit(spark, database):
    create_tables(spark, database, schemas.STAR, wide_ids=False)
    big = spark.createDataFrame([(2**40,)], "user_id long")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(LOAD_ERRORS, match="OVERFLOW"):
                insert_into(big, f"{database}.users")
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")


def test_load_tables_in_order_with_times(spark, database, tmp_path):
    create_tables(spark, database, schemas.TICKET_TABLES)
    path = write_gzip(tmp_path / "in/part-0.csv.gz", TICKET.format(1, "", "1.00"))
    specs = [
        LoadSpec(
            name,
            lambda s: read_delimited(s, path, schemas.TICKETS, sep=";"),
            schemas.TICKETS,
        )
        for name in schemas.TICKET_TABLES
    ]
    times = load_tables(spark, database, specs).collect()
    assert [t.table_name for t in times] == list(schemas.TICKET_TABLES)
    assert all(t.seconds > 0 for t in times)
    stored = spark.table(f"{database}.sporting_event_ticket").first()
    assert stored.ticketholder_id is None and stored.ticket_price == Decimal("1.00")


@pytest.mark.parametrize("line", ["b|1", "c|1|2|3"])
@pytest.mark.parametrize("read", ["count", "one column"])
def test_malformed_lines_fail_under_any_projection(spark, tmp_path, line, read):
    (tmp_path / "a.txt").write_text(f"a|1|2\n{line}\n")
    df = read_delimited(spark, str(tmp_path), T.StructType.fromDDL("name string, x int, y int"))
    with pytest.raises((PySparkException, Py4JJavaError)):
        df.count() if read == "count" else df.select("name").collect()


def test_song_object_over_several_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n  "song_id": "S1",\n  "title": "T",\n  "year": 1999\n}\n')
    schema = T.StructType.fromDDL("song_id string, title string, year int")
    df = read_json_auto(spark, str(tmp_path), schema, multi_line=True)
    assert [tuple(r) for r in df.collect()] == [("S1", "T", 1999)]
