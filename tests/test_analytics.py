from datetime import datetime

from conftest import rows

from starloom import plans
from starloom.operators import time_dim


def test_most_played_with_ties_and_double_listed_songs(spark):
    plays = spark.createDataFrame([(s,) for s in "aabbcccd"], "song_id string")
    songs = spark.createDataFrame(
        [("a", "A"), ("b", "B2"), ("b", "B1"), ("c", "C"), ("d", "D")], "song_id string, title string"
    )
    assert [tuple(r) for r in plans.most_played(plays, songs, 3).collect()] == [
        ("c", "C", 3),
        ("a", "A", 2),
        ("b", "B1", 2),
    ]


def test_plays_by_hour(spark):
    plays = spark.createDataFrame(
        [(datetime(2018, 11, d, h),) for d in (1, 2) for h in (5, 5, 23)], "start_time timestamp_ntz"
    )
    assert rows(plans.plays_by_hour(plays, time_dim(plays))) == [(23, 2), (5, 4)]


def test_row_counts(spark):
    assert rows(plans.row_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]
