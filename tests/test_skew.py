"""Hot keys and copies: a third of all rows on one song, user and second."""

from collections import Counter
from datetime import datetime

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from starloom import operators as ops
from starloom.operators.broadcasting import key_profile, payload_bytes

N = 6000
EPOCH = datetime(1970, 1, 1)


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the events are copies of one play, another third plays of the
    same song by many; a third of the catalogue rows carry that song's name."""
    third = F.col("id") % 3
    events = spark.range(0, N, 1, 8).select(
        F.when(third < 2, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 50)).alias("artist"),
        F.when(third < 2, "hit").otherwise(F.concat(F.lit("t"), F.col("id") % 50)).alias("song"),
        F.lit("NextSong").alias("page"),
        F.when(third == 0, 0).otherwise(F.col("id") * 700).cast("long").alias("ts"),
        F.when(third == 0, 1).otherwise(F.col("id") % 200).alias("userId"),
        F.when(third == 0, 9).otherwise(F.col("id") % 300).alias("sessionId"),
        F.lit("free").alias("level"),
        F.lit("Oslo").alias("location"),
        F.lit("A").alias("userAgent"),
        F.lit("Ada").alias("firstName"),
        F.lit("L").alias("lastName"),
        F.lit("F").alias("gender"),
    )
    songs = spark.range(0, 90, 1, 4).select(
        F.when(third == 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id"))).alias("artist_name"),
        F.when(third == 0, "hit").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("title"),
        F.when(third == 0, F.col("id") % 12).otherwise(F.col("id")).cast("string").alias("song_id"),
        F.lit("AR").alias("artist_id"),
    )
    return events, songs


def brute_force(events, songs):
    names = {}
    for s in songs.collect():
        names.setdefault((s.artist_name, s.title), set()).add((s.song_id, s.artist_id))
    return {
        (e.ts // 1000, e.userId, e.sessionId, *song)
        for e in events.collect()
        for song in names.get((e.artist, e.song), ())
    }


@pytest.mark.parametrize("fan_out", [0, 1000])
@pytest.mark.parametrize("shuffled", [False, True])
def test_hot_song_on_both_sides(spark, hot, monkeypatch, shuffled, fan_out):
    events, songs = hot
    monkeypatch.setattr("starloom.operators.star.FAN_OUT", fan_out)
    settings = {}
    if shuffled:  # as if the catalogue counted as too large
        monkeypatch.setattr("starloom.operators.star.REPLICATE_BYTES", 0)
        settings = {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        fact = ops.songplay(events, songs)
        collected = fact.collect()
        final = plan_of(fact)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    got = {
        (int((r.start_time - EPOCH).total_seconds()), r.user_id, r.session_id, r.song_id, r.artist_id)
        for r in collected
    }
    assert got == brute_force(events, songs)
    assert len(collected) == len(got)
    assert ("SortMergeJoin" in final) == shuffled
    # With its copies, the hot song is what makes a partition too large.
    assert ("SortMergeJoin(skew=true)" in final) == (shuffled and fan_out == 1000)


def test_fan_out_is_counted(hot):
    _, songs = hot
    size, fan_out = key_profile(songs, ["artist_name", "title"])
    assert fan_out == 30
    assert size == payload_bytes(songs)


def test_hot_user(hot):
    events, _ = hot
    expected = Counter(e.userId for e in events.collect())
    assert expected[1] > N / 3
    users = ops.users(events)
    assert users.count() == len(expected)
    assert ops.duplicates(users, ["user_id"]).count() == 0


def test_hot_copies_in_the_duplicate_check(hot):
    events, _ = hot
    found = ops.duplicates(events, ["ts", "userId", "sessionId"]).collect()
    assert max(r.occurrences for r in found) == N // 3
