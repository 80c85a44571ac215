"""Star builders against hand-made logs, one test per trap."""

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starloom import operators as ops
from starloom import schemas
from starloom.functions import calendar_parts, epoch_ms_to_seconds

T0 = 1541121934000  # 2018-11-02 01:25:34 UTC


def event(**given):
    base = dict(
        artist="Muse", auth="Logged In", firstName="Ada", gender="F", itemInSession=0,
        lastName="L", length=200.5, level="free", location="Oslo", method="PUT",
        page="NextSong", registration=1.5e12, sessionId=7, song="Uprising", status=200,
        ts=T0, userAgent="A", userId=39,
    )
    return {**base, **given}


def song(**given):
    base = dict(
        num_songs=1, artist_id="AR1", artist_latitude=None, artist_longitude=None,
        artist_location="", artist_name="Muse", song_id="SO1", title="Uprising",
        duration=303.1, year=2009,
    )
    return {**base, **given}


@pytest.fixture
def events(spark):
    def make(*events):
        schema = schemas.readable(schemas.EVENTS)
        return spark.createDataFrame([tuple(e[n] for n in schema.names) for e in events], schema)

    return make


@pytest.fixture
def songs(spark):
    def make(*songs):
        schema = schemas.readable(schemas.SONGS_SOURCE)
        return spark.createDataFrame([tuple(s[n] for n in schema.names) for s in songs], schema)

    return make


def test_fact_columns_types_and_values(events, songs):
    fact = ops.songplay(events(event()), songs(song()))
    assert fact.columns == schemas.SONGPLAY.names[1:]
    assert fact.schema["start_time"].dataType == schemas.TIMESTAMP
    assert rows(fact) == [
        (datetime(2018, 11, 2, 1, 25, 34), 39, "free", "SO1", "AR1", 7, "Oslo", "A")
    ]


def test_fact_keeps_plays_with_a_match_only(events, songs):
    fact = ops.songplay(
        events(
            event(),
            event(page="Home", userId=1),
            event(page=None, userId=2),
            event(song="Unknown", userId=3),
            event(artist="muse", userId=4),
            event(artist=None, userId=5),
            event(song=None, userId=6),
        ),
        songs(song(), song(artist_name=None, song_id="SO9"), song(title=None, song_id="SO8")),
    )
    assert [r.user_id for r in fact.collect()] == [39]


def test_title_with_two_songs_multiplies_plays(events, songs):
    fact = ops.songplay(events(event()), songs(song(), song(song_id="SO2", artist_id="AR2")))
    assert sorted(r.song_id for r in fact.collect()) == ["SO1", "SO2"]


def test_same_second_collapses_and_next_second_stays(events, songs):
    fact = ops.songplay(
        events(event(ts=T0), event(ts=T0 + 999), event(ts=T0 + 1000), event(ts=T0)),
        songs(song(), song()),
    )
    assert sorted(r.start_time.second for r in fact.collect()) == [34, 35]


def test_two_catalogue_names_of_one_song_give_one_play(events, songs):
    """The distinct after the join is needed: the names are not in the result."""
    fact = ops.songplay(
        events(event(), event(song="Uprising (live)")),
        songs(song(), song(title="Uprising (live)")),
    )
    assert fact.count() == 1


def test_null_time_and_null_user_stay_in_the_fact(events, songs):
    fact = ops.songplay(events(event(ts=None), event(userId=None)), songs(song()))
    assert {(r.start_time is None, r.user_id) for r in fact.collect()} == {(True, 39), (False, None)}


def test_trailing_blanks_count_unless_switched_off(events, songs):
    logs, catalogue = events(event(song="Uprising ")), songs(song(artist_name="Muse  "))
    assert ops.songplay(logs, catalogue).count() == 0
    assert ops.songplay(logs, catalogue, ignore_trailing_blanks=True).count() == 1


@pytest.mark.parametrize(
    "ms, expected",
    [
        (T0 + 796, datetime(2018, 11, 2, 1, 25, 34)),
        (999, datetime(1970, 1, 1)),
        (0, datetime(1970, 1, 1)),
        (-1500, datetime(1969, 12, 31, 23, 59, 59)),
        (None, None),
    ],
)
def test_epoch_cuts_to_whole_seconds(spark, ms, expected):
    df = spark.createDataFrame([(ms,)], "ts long").select(epoch_ms_to_seconds(F.col("ts")))
    assert df.first()[0] == expected


def test_epoch_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(T0,)], "ts long")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        text = df.select(epoch_ms_to_seconds(F.col("ts")).cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert text == "2018-11-02 01:25:34"


def test_users_take_latest_row_of_any_page(events):
    users = ops.users(
        events(
            event(ts=1, level="free"),
            event(ts=3, level="paid"),
            event(ts=2, level="free"),
            event(userId=8, page="Home", level="free"),
            event(userId=None),
        )
    )
    assert users.columns == schemas.USERS.names
    assert [(r[0], r[4]) for r in rows(users)] == [(39, "paid"), (8, "free")]


def test_users_null_time_ranks_first(events):
    users = ops.users(events(event(ts=5, level="free"), event(ts=None, level="paid")))
    assert users.first().level == "paid"


def test_users_tie_is_broken_by_the_attributes(events):
    tied = [event(ts=5, level="paid"), event(ts=5, level="free"), event(ts=5, firstName="Zoe")]
    for order in (tied, tied[::-1]):
        assert rows(ops.users(events(*order))) == [(39, "Ada", "L", "F", "free")]


def test_one_row_per_user_where_plain_distinct_keeps_versions(events):
    logs = events(*[event(ts=i, level=("free", "paid")[i % 2], userId=i % 3) for i in range(30)])
    assert ops.duplicates(ops.users(logs), ["user_id"]).count() == 0
    versions = logs.select("userId", "firstName", "lastName", "gender", "level").distinct()
    assert rows(ops.duplicates(versions, ["userId"])) == [(0, 2), (1, 2), (2, 2)]


def test_songs_keep_differing_rows_of_one_id(songs):
    dim = ops.songs(songs(song(), song(), song(duration=1.0)))
    assert dim.columns == schemas.SONGS.names
    assert dim.count() == 2
    assert rows(ops.duplicates(dim, ["song_id"])) == [("SO1", 2)]


def test_artists_take_latest_year(songs):
    dim = ops.artists(
        songs(
            song(year=2001, artist_name="old"),
            song(year=2010, artist_name="new", artist_latitude=1.5),
            song(year=0, artist_name="unknown year"),
            song(artist_id="AR2", year=0, artist_name="only"),
            song(artist_id="AR3", year=None, artist_name="null year"),
            song(artist_id="AR3", year=2020, artist_name="dated"),
            song(artist_id="AR4", year=2000, artist_name="b"),
            song(artist_id="AR4", year=2000, artist_name="a"),
        )
    )
    assert dim.columns == schemas.ARTISTS.names
    assert [(r.artist_id, r.name) for r in dim.orderBy("artist_id").collect()] == [
        ("AR1", "new"),
        ("AR2", "only"),
        ("AR3", "null year"),
        ("AR4", "a"),
    ]
    # Empty text stays empty text.
    assert dim.where("location = ''").count() == 4


def test_artist_versions_are_flagged_without_the_pick(songs):
    catalogue = songs(song(artist_name="a", year=1), song(artist_name="b", year=2))
    versions = catalogue.select("artist_id", "artist_name").distinct()
    assert ops.duplicates(versions, ["artist_id"]).count() == 1
    assert ops.duplicates(ops.artists(catalogue), ["artist_id"]).count() == 0


@pytest.mark.parametrize(
    "moment, parts",
    [
        (datetime(2018, 11, 4, 23, 0, 1), (23, 4, 44, 11, 2018, "0")),  # a Sunday
        (datetime(2018, 11, 3, 5), (5, 3, 44, 11, 2018, "6")),  # a Saturday
        (datetime(2018, 12, 31), (0, 31, 1, 12, 2018, "1")),  # week 1 in the old year
        (datetime(2021, 1, 1), (0, 1, 53, 1, 2021, "5")),  # week 53 in the new year
    ],
)
def test_calendar_parts(spark, moment, parts):
    df = spark.createDataFrame([(moment,)], "t timestamp_ntz").select(*calendar_parts(F.col("t")))
    assert tuple(df.first()) == parts


def test_time_holds_the_distinct_times_of_the_fact(events, songs):
    fact = ops.songplay(
        events(event(), event(userId=1), event(ts=T0 + 5000), event(ts=T0 + 9000, song="none")),
        songs(song()),
    )
    dim = ops.time_dim(fact)
    assert dim.columns == schemas.TIME.names
    assert dim.schema["weekday"].dataType == schemas.TEXT
    assert sorted(r.start_time.second for r in dim.collect()) == [34, 39]


def test_build_star_in_order(events, songs):
    star = ops.build_star(events(event()), songs(song()))
    assert list(star) == list(schemas.STAR)
    assert {name: df.count() for name, df in star.items()} == dict.fromkeys(schemas.STAR, 1)
