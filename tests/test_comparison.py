import gzip
import uuid

import pytest
from conftest import rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from starloom import plans, schemas
from starloom.__main__ import main
from starloom.plans import comparison

ROWS = {
    "customer": ["1|C1|Street|UNITED KI1|UNITED KINGDOM|EUROPE|10-1|AUTOMOBILE",
                 "2|C2|Street|UNITED KI5|UNITED KINGDOM|EUROPE|10-2|AUTOMOBILE"],
    "dwdate": ["19971201|December 1, 1997|Monday|December|1997|199712|Dec1997|2|1|335|12|49|"
               "Christmas|0|0|0|1",
               "19980101|January 1, 1998|Thursday|January|1998|199801|Jan1998|5|1|1|1|1|"
               "Winter|0|0|1|1"],
    "supplier": ["1|S1|Street|UNITED KI5|UNITED KINGDOM|AMERICA|10-1",
                 "2|S2|Street|PERU     1|PERU|AMERICA|10-2"],
    "part": ["1|red pin|MFGR#1|MFGR#12|MFGR#121|red|SMALL|5|BOX 1",
             "2|blue pin|MFGR#1|MFGR#13|MFGR#131|blue|SMALL|5|BOX 1"],
    "lineorder": [f"{i}|1|{1 + i % 2}|{1 + i % 3}|{1 + i % 2}|{(19971201, 19980101)[i % 2]}|1-URGENT|0|"
                  f"{i}|{1000 * i}|9000|{i % 5}|{900 * i}|600|2|19980102|MAIL" for i in range(30)],
}


@pytest.fixture
def files(tmp_path):
    for name, lines in ROWS.items():
        for part in range(2):
            with gzip.open(tmp_path / f"{name}{part}.gz", "wt") as out:
                out.write("".join(line + "\n" for line in lines[part::2]))
    return tmp_path


def test_read_benchmark(spark, files):
    frames = plans.read_benchmark(spark, str(files))
    assert {n: df.count() for n, df in frames.items()} == {n: len(r) for n, r in ROWS.items()}
    for name, df in frames.items():
        assert df.columns == schemas.SSB[name].names
    narrow = plans.read_benchmark(spark, str(files), wide_ids=False)
    for name, df in narrow.items():
        assert [f.dataType for f in df.schema] == [
            f.dataType for f in schemas.readable(schemas.SSB[name])
        ]


def test_null_in_a_required_column_fails(spark, files):
    with gzip.open(files / "part2.gz", "wt") as out:
        out.write("|x|MFGR#1|MFGR#12|MFGR#121|red|SMALL|5|BOX 1\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="NULL in required column p_partkey"):
        plans.read_benchmark(spark, str(files))["part"].collect()


def test_load_both_then_compare(spark, files, tmp_path):
    databases = {n: f"{n}_{uuid.uuid4().hex[:8]}" for n in ("nodist", "dist")}
    locations = {n: str(tmp_path / db) for n, db in databases.items()}
    stats = plans.load_both(spark, str(files), databases, locations)
    assert stats.columns == ["table_name", "loadtime_nodist", "loadtime_dist", "buckets", "hot"]
    assert {r.table_name for r in stats.collect()} == set(schemas.SSB)
    result = {r["query"]: r for r in plans.compare(spark, databases).collect()}
    assert set(result) == set(comparison.QUERIES)
    assert all(r.differing_rows == 0 for r in result.values())
    # The benchmark's own parameters find rows in this data.
    assert all(r.result_rows > 0 for r in result.values())
    tables = {n: spark.table(f"{databases['dist']}.{n}") for n in schemas.SSB}
    expected = sum(
        1000 * i * (i % 5) for i in range(30) if i % 2 == 0 and 1 <= i % 5 <= 3 and i < 24
    )
    assert comparison.QUERIES["oneDim"](tables).first().revenue == expected
    assert rows(comparison.QUERIES["drill"](tables)) == [
        ("UNITED KI1", "UNITED KI5", 1997, sum(900 * i for i in range(0, 30, 2)))
    ]


def test_command_line(spark, tmp_path, capsys):
    db = f"cli_{uuid.uuid4().hex[:8]}"
    (tmp_path / "log").mkdir()
    (tmp_path / "song").mkdir()
    (tmp_path / "log" / "x.json").write_text('{"artist": "A", "song": "T", "page": "NextSong", "ts": 0, "userId": "1"}')
    (tmp_path / "song" / "y.json").write_text(
        '{"artist_name": "A", "title": "T", "song_id": "S", "artist_id": "R", "year": 0}'
    )
    paths = ", ".join(f'"$.{n}"' for n in schemas.EVENTS.names)
    (tmp_path / "paths.json").write_text(f'{{"jsonpaths": [{paths}]}}')
    inputs = ["--events", f"{tmp_path}/log", "--songs", f"{tmp_path}/song", "--paths", f"{tmp_path}/paths.json"]
    main(["create", "--db", db, "--location", str(tmp_path / "db")])
    assert spark.table(f"{db}.songplay").count() == 0
    for command, plays in (("etl", 1), ("etl", 2), ("run", 1)):
        main([command, "--db", db, *inputs])
        assert spark.table(f"{db}.songplay").count() == plays
    assert "No duplicates found" in capsys.readouterr().out
