"""Builders of the star schema: one fact and four dimensions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.temporal import calendar_parts, epoch_ms_to_seconds
from starloom.operators.broadcasting import REPLICATE_BYTES, key_profile, payload_bytes, replicate
from starloom.operators.keys import running_totals, with_dense_id
from starloom.operators.latest import latest_by
from starloom.session import materialize

# The page of a play, and the fact columns next to the key.
PLAY_PAGE = "NextSong"
FACT_COLUMNS = [
    "start_time",
    "user_id",
    "level",
    "song_id",
    "artist_id",
    "session_id",
    "location",
    "user_agent",
]


# Catalogue rows of one name up to which a play may meet them with its copies.
FAN_OUT = 32

# Plays and songs of a name that meet: as many plays as are packed in a row, and songs in
# a row; rows of songs that a row of plays meets, and rows of plays that stay together.
# Spark keeps what comes of one row of plays in memory: 32 * 512 * 16 rows of the fact.
PLAY_BLOCK = 32
SONG_BLOCK = 512
SONG_BLOCKS = 16
PLAY_BLOCKS = 128

NAME = ["_artist", "_title"]
SONG_COLUMNS = ["song_id", "artist_id"]
PLAY_COLUMNS = [c for c in FACT_COLUMNS if c not in SONG_COLUMNS]
# The columns that come before the song in the order of the fact, and those after it.
BEFORE_SONG = FACT_COLUMNS[: FACT_COLUMNS.index("song_id")]
AFTER_SONG = [c for c in PLAY_COLUMNS if c not in BEFORE_SONG]


def _sides(
    events: DataFrame, songs: DataFrame, ignore_trailing_blanks: bool
) -> tuple[DataFrame, DataFrame]:
    """Plays and catalogue rows that have a name, with it, as they come."""

    def name(column: str) -> Column:
        text = F.col(column)
        return F.rtrim(text) if ignore_trailing_blanks else text

    named = "_artist is not null and _title is not null"
    plays = (
        events.where(F.col("page") == PLAY_PAGE)
        .select(
            epoch_ms_to_seconds(F.col("ts")).alias("start_time"),
            F.col("userId").alias("user_id"),
            "level",
            F.col("sessionId").alias("session_id"),
            "location",
            F.col("userAgent").alias("user_agent"),
            name("artist").alias("_artist"),
            name("song").alias("_title"),
        )
        .where(named)
    )
    names = songs.select(
        name("artist_name").alias("_artist"), name("title").alias("_title"), *SONG_COLUMNS
    ).where(named)
    return plays, names


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equality in ``columns``, NULLs included."""
    return reduce(Column.__and__, [left[c].eqNullSafe(right[c]) for c in columns])


def _spread(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that a join is about to multiply, in as many partitions as the session
    shuffles into: adaptive execution would merge partitions by their bytes before the
    join."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *columns)


def _div(number: Column, by: int) -> Column:
    return F.call_function("div", number, F.lit(by))


@dataclass(frozen=True)
class PlayFactors:
    """The fact before the join that multiplies its rows.

    A name that stands for many songs gives every play of it that many rows, so the
    fact grows with the product of plays and catalogue; its factors do not. ``plays``
    are distinct plays with their name, ``songs`` distinct songs that are listed under
    one name: their join on the name gives no row twice. Songs that are listed under
    several names may give a row twice, so theirs are joined and made distinct, in
    ``rest`` (None: there are none).
    """

    plays: DataFrame
    songs: DataFrame
    rest: DataFrame | None = None

    def _ranked(self) -> tuple[DataFrame, DataFrame]:
        """Songs with their number inside their name, from 0 on, and the names with their
        number of songs; both are written once."""
        numbered = with_dense_id(self.songs.select(*NAME, *SONG_COLUMNS), NAME, "_number", 0)
        names = numbered.groupBy(*NAME).agg(F.min("_number").alias("_first"), F.count("*").alias("_songs"))
        names = materialize(names, "songs-of-names")
        ranked = numbered.join(replicate(names.drop("_songs")), NAME).select(
            *NAME, *SONG_COLUMNS, (F.col("_number") - F.col("_first")).alias("_rank")
        )
        return materialize(ranked, "ranked-songs"), names.drop("_first")

    def rows(self) -> DataFrame:
        """The fact. Songs that cannot be broadcast are joined by shuffle, play by play."""
        if payload_bytes(self.songs) > REPLICATE_BYTES:
            rows = self.plays.join(self.songs, NAME).select(FACT_COLUMNS)
        else:
            rows = self._rows_in_blocks()
        return rows if self.rest is None else rows.unionByName(self.rest)

    def _rows_in_blocks(self) -> DataFrame:
        """Rows of songs that are broadcast.

        Plays and songs of a name are packed in blocks; the blocks are joined and unpacked.
        So some plays in a row meet the same songs: what repeats in the fact does so inside
        a page of a stored table, where its compression finds it. Songs of very many blocks
        are joined in parts, for which plays are repeated.
        """
        ranked, names = self._ranked()
        key = [*NAME, "_part"]
        block = _div(F.col("_rank"), SONG_BLOCK)
        songs = ranked.select(
            *NAME, _div(block, SONG_BLOCKS).alias("_part"), block.alias("_block"), F.struct(*SONG_COLUMNS).alias("_song")
        )
        songs = songs.groupBy(*key, "_block").agg(F.collect_list("_song").alias("_songs")).drop("_block")

        members = self.plays.groupBy(*NAME).agg(F.count("*").alias("_members"))
        names = materialize(names.join(members, NAME), "blocks-of-names")
        last = _div(F.col("_songs") - 1, SONG_BLOCK * SONG_BLOCKS)
        block = F.pmod(F.xxhash64(*PLAY_COLUMNS), _div(F.col("_members") - 1, PLAY_BLOCK) + 1)
        plays = self.plays.join(replicate(names), NAME).select(
            *NAME,
            F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_part"),
            _div(block, PLAY_BLOCKS).alias("_blocks"),
            block.alias("_block"),
            F.struct(*PLAY_COLUMNS).alias("_play"),
        )
        together = [*key, "_blocks"]
        plays = _spread(plays, together).groupBy(*together, "_block").agg(F.collect_list("_play").alias("_plays"))
        pairs = plays.join(F.broadcast(songs), key).select(F.explode("_plays").alias("_play"), "_songs")
        pairs = pairs.select("_play", F.explode("_songs").alias("_song"))
        return pairs.select(*[F.col(f"_{'song' if c in SONG_COLUMNS else 'play'}.{c}") for c in FACT_COLUMNS])

    def weighted(self, columns: list[str], weight: str) -> DataFrame:
        """The fact's rows in some ``columns`` of the play or of the song, each standing
        for ``weight`` rows of the fact; the same values may come in several rows.

        Both factors are counted per name first, so nothing is multiplied unless
        columns of both are asked for.
        """
        of_song = [c for c in columns if c in SONG_COLUMNS]
        of_play = [c for c in columns if c not in SONG_COLUMNS]
        plays = self.plays.groupBy(*NAME, *of_play).agg(F.count("*").alias("_plays"))
        songs = self.songs.groupBy(*NAME, *of_song).agg(F.count("*").alias("_songs"))
        joined = plays.join(replicate(songs), NAME) if of_play else songs.join(replicate(plays), NAME)
        rows = joined.select(*columns, (F.col("_plays") * F.col("_songs")).alias(weight))
        if self.rest is None:
            return rows
        return rows.unionByName(self.rest.select(*columns, F.lit(1).cast("long").alias(weight)))

    def keyed(self, id_col: str, start: int = 1) -> DataFrame:
        """The fact with keys ``start``, ``start + 1``, ... along its columns, NULLs
        first: the rows and keys of ``with_dense_id(rows, ["start_time"], id_col)``.

        The fact is neither sorted nor shuffled. Songs are numbered inside their name.
        Plays are grouped by the columns that come before the song, and the groups'
        numbers of rows are added up in their order. A row of a play that is alone in
        its group has the sum before the group and the song's number. Groups of several
        plays, and those with rows of ``rest``, are numbered row by row among
        themselves, and have the sum of the groups of single plays before them on top.
        """
        ranked, names = self._ranked()
        counted = self.plays.join(replicate(names), NAME)
        play = F.struct(*AFTER_SONG, *NAME)
        groups = counted.groupBy(*BEFORE_SONG).agg(
            F.sum("_songs").alias("_size"), F.count("*").alias("_members"), F.min(play).alias("_play")
        )
        if self.rest is not None:
            none = F.lit(None).cast(groups.schema["_play"].dataType)
            more = self.rest.groupBy(*BEFORE_SONG).agg(F.count("*").alias("_size"))
            more = more.select("*", F.lit(2).cast("long").alias("_members"), none.alias("_play"))
            groups = groups.unionByName(more).groupBy(*BEFORE_SONG).agg(
                F.sum("_size").alias("_size"), F.sum("_members").alias("_members"), F.min("_play").alias("_play")
            )
        alone = F.col("_members") == 1
        groups = groups.withColumn("_single", F.when(alone, F.col("_size")).otherwise(0))
        placed = running_totals(groups, BEFORE_SONG, {"_size": "_before", "_single": "_before_single"})
        placed = materialize(placed, "placed-plays")

        single = placed.where(alone).select(*BEFORE_SONG, "_play.*", "_before")
        if payload_bytes(ranked) <= REPLICATE_BYTES:
            single, ranked_side = _spread(single, ["_before"]), F.broadcast(ranked)
        else:
            ranked_side = ranked
        key = (F.col("_before") + F.col("_rank") + F.lit(start)).alias(id_col)
        rows = single.join(ranked_side, NAME).select(key, *FACT_COLUMNS)

        shared = placed.where(~alone).select(*BEFORE_SONG, "_before_single")
        if not shared.take(1):
            return rows
        shared = replicate(shared)

        def in_shared(df: DataFrame) -> DataFrame:
            kept = [df[c] for c in df.columns]
            return df.join(shared, _same(df, shared, BEFORE_SONG)).select(*kept, "_before_single")

        members = in_shared(self.plays).join(replicate(self.songs), NAME).select(*FACT_COLUMNS, "_before_single")
        if self.rest is not None:
            members = members.unionByName(in_shared(self.rest).select(*FACT_COLUMNS, "_before_single"))
        members = with_dense_id(members, FACT_COLUMNS, "_place", 0)
        key = (F.col("_before_single") + F.col("_place") + F.lit(start)).alias(id_col)
        return rows.unionByName(members.select(key, *FACT_COLUMNS))


def _factors(plays: DataFrame, names: DataFrame) -> PlayFactors:
    """``plays`` and ``names``: distinct. Songs under several names are few; they are
    counted first."""
    several = names.groupBy(*SONG_COLUMNS).agg(F.count("*").alias("_names")).where("_names > 1")
    several = materialize(several.select(*SONG_COLUMNS), "songs-of-several-names")
    if not several.take(1):
        return PlayFactors(plays, names)
    several = replicate(several)
    once = names.join(several, _same(names, several, SONG_COLUMNS), "left_anti")
    again = names.join(several, _same(names, several, SONG_COLUMNS), "left_semi")
    return PlayFactors(plays, once, plays.join(replicate(again), NAME).select(FACT_COLUMNS).distinct())


def play_factors(
    events: DataFrame, songs: DataFrame, ignore_trailing_blanks: bool = False
) -> PlayFactors:
    """The factors of ``songplay``, written once. Names without plays are left out."""
    plays, names = _sides(events, songs, ignore_trailing_blanks)
    plays = materialize(plays.distinct(), "plays")
    played = replicate(plays.select(*NAME).distinct())
    names = materialize(names.distinct().join(played, NAME, "left_semi"), "names")
    factors = _factors(plays, names)
    if factors.rest is None:
        return factors
    return PlayFactors(plays, materialize(factors.songs, "songs"), materialize(factors.rest, "rest"))


def songplay(events: DataFrame, songs: DataFrame, ignore_trailing_blanks: bool = False) -> DataFrame:
    """Distinct plays with a match in the catalogue, without a key.

    Artist name and title match exactly. A name that stands for several
    catalogue songs gives one play per song; a play without a match is left out.

    The catalogue's names are counted first. If they are small, they are
    broadcast, and only matched plays are shuffled, once, for the distinct;
    larger ones are shuffled, and adaptive execution splits the partitions of hot
    songs. If some name stands for very many rows, the fact is far larger than the
    plays: then plays and names lose their copies before the join, and its result
    is not shuffled (``PlayFactors``).
    """
    plays, names = _sides(events, songs, ignore_trailing_blanks)
    size, fan_out = key_profile(names, NAME)
    if fan_out > FAN_OUT:
        plays, names = plays.distinct(), names.distinct()
        if size > REPLICATE_BYTES:
            names = names.join(replicate(plays.select(*NAME).distinct()), NAME, "left_semi")
        return _factors(plays, names).rows()
    catalogue = names.distinct()
    if size <= REPLICATE_BYTES:
        catalogue = F.broadcast(catalogue)
    return plays.join(catalogue, NAME).select(FACT_COLUMNS).distinct()


# Dimensions of latest rows: key, order column, and the attributes that break ties.
LATEST = {
    "users": (["user_id"], "ts", ["first_name", "last_name", "gender", "level"]),
    "artists": (["artist_id"], "year", ["name", "location", "latitude", "longitude"]),
}


def _latest(name: str, versions: DataFrame) -> DataFrame:
    keys, order, attributes = LATEST[name]
    return latest_by(versions, keys, [F.col(order).desc_nulls_first()], attributes).drop(order)


def user_versions(events: DataFrame) -> DataFrame:
    """The attributes of every user on any page, not only on plays, with their time."""
    return events.where(F.col("userId").isNotNull()).select(
        F.col("userId").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
        "ts",
    )


def users(events: DataFrame) -> DataFrame:
    """Latest attributes of every user; a missing time counts as latest."""
    return _latest("users", user_versions(events))


def songs(catalogue: DataFrame) -> DataFrame:
    """Distinct songs. A song_id with two differing rows stays twice, for the
    duplicate check to report."""
    return catalogue.select("song_id", "title", "artist_id", "year", "duration").distinct()


def artist_versions(catalogue: DataFrame) -> DataFrame:
    """The attributes of every artist in each catalogue row, with its year."""
    return catalogue.select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        F.col("artist_latitude").cast("double").alias("latitude"),
        F.col("artist_longitude").cast("double").alias("longitude"),
        "year",
    )


def artists(catalogue: DataFrame) -> DataFrame:
    """Every artist as in the row of their latest year. Year 0 is "unknown" and
    sorts last, a missing year first."""
    return _latest("artists", artist_versions(catalogue))


def time_dim(plays: DataFrame) -> DataFrame:
    """Distinct start times of the fact with their calendar parts, which depend
    on the time alone and so are added after the distinct."""
    start = F.col("start_time")
    return plays.select(start).distinct().select(start, *calendar_parts(start))


def build_star(events: DataFrame, catalogue: DataFrame) -> dict[str, DataFrame]:
    """The five tables in build order, the fact still without its key.

    ``time`` reads the fact; write the fact first and pass the written rows to
    ``time_dim`` where building it twice would cost more.
    """
    fact = songplay(events, catalogue)
    return {
        "songplay": fact,
        "users": users(events),
        "songs": songs(catalogue),
        "artists": artists(catalogue),
        "time": time_dim(fact),
    }
