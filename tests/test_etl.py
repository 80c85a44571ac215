import json

import pytest
from conftest import rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from starloom import plans, schemas
from starloom.plans.etl import check

PATHS = [f"$['{name}']" for name in schemas.EVENTS.names]


@pytest.fixture
def inputs(tmp_path):
    def event(**given):
        base = dict(
            artist="Muse", auth="Logged In", firstName="Ada", gender="F", itemInSession=0,
            lastName="L", length=200.5, level="free", location="Oslo", method="PUT",
            page="NextSong", registration=1.5e12, sessionId=7, song="Uprising", status=200,
            ts=1541121934796, userAgent="A", userId="39",
        )
        return {**base, **given}

    def song(**given):
        base = dict(
            num_songs=1, artist_id="AR1", artist_latitude=None, artist_longitude=None,
            artist_location="", artist_name="Muse", song_id="SO1", title="Uprising",
            duration=303.1, year=2009,
        )
        return {**base, **given}

    logs = {
        "2018/11/a.json": [event(), event(), event(ts=1541121999000, userId=40, level="paid")],
        "2018/12/b.json": [event(userId="", page="Home"), event(userId=41, page="About")],
    }
    for name, lines in logs.items():
        path = tmp_path / "log_data" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(map(json.dumps, lines)))
    for i, line in enumerate([song(), song(song_id="SO2", title="Other"), song(duration=1.0)]):
        path = tmp_path / "song_data" / "A" / "BC"[i % 2] / f"T{i}.json"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(line))
    (tmp_path / "paths.json").write_text(json.dumps({"jsonpaths": PATHS}))
    return tmp_path


def config(inputs, db, **given):
    return plans.RunConfig(
        db=db,
        events=str(inputs / "log_data"),
        songs=str(inputs / "song_data"),
        json_paths=str(inputs / "paths.json"),
        **given,
    )


def test_run_builds_the_star_and_reports(spark, database, inputs):
    report = plans.run(spark, config(inputs, database))
    assert rows(report) == [
        ("artists", 1, 0, 0, "No duplicates found"),
        ("songplay", 2, 0, 0, "No duplicates found"),
        ("songs", 3, 1, 1, "Duplicates found"),
        ("time", 2, 0, 0, "No duplicates found"),
        ("users", 3, 0, 0, "No duplicates found"),
    ]
    assert spark.table(f"{database}.staging_events").count() == 5
    plays = spark.table(f"{database}.songplay")
    assert plays.columns == schemas.SONGPLAY.names
    assert plays.where("songplay_id < 1").count() == 0
    users = {r.user_id: r.level for r in spark.table(f"{database}.users").collect()}
    assert users == {39: "free", 40: "paid", 41: "free"}


def test_rerun_starts_over_and_append_adds(spark, database, inputs):
    plans.run(spark, config(inputs, database))
    again = {r.table_name: r.row_count for r in plans.run(spark, config(inputs, database)).collect()}
    assert again["songplay"] == 2
    appended = plans.run(spark, config(inputs, database, append=True))
    found = {r.table_name: (r.row_count, r.duplicate_keys) for r in appended.collect()}
    # Staging is read whole again: old rows twice, the fact's copies collapse per run.
    assert found["songplay"] == (4, 0)  # new keys
    assert found["users"] == (6, 3)
    assert rows(check(spark, database)) == rows(appended)


def test_declared_integer_ids_are_dense(spark, database, inputs):
    plans.run(spark, config(inputs, database, wide_ids=False))
    plans.run(spark, config(inputs, database, wide_ids=False, append=True))
    plays = spark.table(f"{database}.songplay")
    assert plays.schema["songplay_id"].dataType == schemas.INT
    assert sorted(r.songplay_id for r in plays.collect()) == [1, 2, 3, 4]


def test_null_song_id_fails_the_insert(spark, database, inputs):
    (inputs / "song_data" / "A" / "B" / "bad.json").write_text('{"title": "no id"}')
    with pytest.raises((PySparkException, Py4JJavaError), match="NULL in"):
        plans.run(spark, config(inputs, database))
