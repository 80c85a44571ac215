"""Queries for the driver, each over the whole tables of ``sf_dir``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import operators as ops
from starloom import plans, schemas, sources, standins
from starloom.operators import layout
from starloom.session import materialize, pin_utc, scratch_namespace, scratch_path
from starloom.sources.delimited import read_delimited

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def under_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(pin_utc(spark), sf_dir)

    QUERIES[fn.__name__] = under_utc
    return under_utc


# Parameters under which the driver's tables give rows.
SSB_CATEGORY = "MFGR#12"
SSB_REGION = "AMERICA"
SSB_CUSTOMER_CITIES = ("NATION_2 0", "NATION_2 1")
SSB_SUPPLIER_CITIES = ("NATION_9 0", "NATION_9 1")
SSB_YEARMONTH = "Dec1997"
TOP_SONGS = 10
HOT_BUCKETS = 16


# --- the star --------------------------------------------------------------------


@query
def songplay_fact(spark, sf_dir):
    return ops.songplay(
        standins.staging_events(spark, sf_dir), standins.staging_songs(spark, sf_dir)
    )


def _play_factors(spark, sf_dir):
    return ops.play_factors(
        standins.staging_events(spark, sf_dir), standins.staging_songs(spark, sf_dir)
    )


# Keys of the fact as the star uses them, and the column that says for how many rows of
# the fact a row of its factors stands.
NATURAL_KEY = ["start_time", "user_id", "session_id"]
WEIGHT = "fact_rows"


@query
def songplay_keyed(spark, sf_dir):
    return _play_factors(spark, sf_dir).keyed("songplay_id")


@query
def users_latest(spark, sf_dir):
    return ops.users(standins.activity(spark, sf_dir))


@query
def songs_dim(spark, sf_dir):
    return ops.songs(standins.staging_songs(spark, sf_dir))


@query
def artists_latest(spark, sf_dir):
    return ops.artists(standins.staging_songs(spark, sf_dir))


@query
def time_dim(spark, sf_dir):
    return ops.time_dim(_play_factors(spark, sf_dir).weighted(["start_time"], WEIGHT))


# --- checks ----------------------------------------------------------------------


@query
def dup_songplay(spark, sf_dir):
    return ops.duplicates_of_ids(songplay_keyed(spark, sf_dir), "songplay_id")


@query
def dup_users(spark, sf_dir):
    return ops.duplicates(users_latest(spark, sf_dir), ["user_id"])


@query
def dup_songs(spark, sf_dir):
    return ops.duplicates(songs_dim(spark, sf_dir), ["song_id"])


@query
def dup_artists(spark, sf_dir):
    return ops.duplicates(artists_latest(spark, sf_dir), ["artist_id"])


@query
def dup_time(spark, sf_dir):
    return ops.duplicates(time_dim(spark, sf_dir), ["start_time"])


@query
def dup_songplay_natural(spark, sf_dir):
    plays = _play_factors(spark, sf_dir).weighted(NATURAL_KEY, WEIGHT)
    return ops.duplicates(plays, NATURAL_KEY, WEIGHT)


@query
def dup_catalogue_name(spark, sf_dir):
    return ops.duplicates(standins.staging_songs(spark, sf_dir), ["artist_name", "title"])


@query
def dup_users_distinct(spark, sf_dir):
    """Users as plain distinct rows: one user with two sets of attributes repeats."""
    events = standins.activity(spark, sf_dir).where("userId is not null")
    return ops.duplicates(events.select("userId", "level").distinct(), ["userId"])


@query
def dup_lineitem(spark, sf_dir):
    lines = standins.source(spark, sf_dir, "lineitem")
    return ops.duplicates(lines, ["l_orderkey", "l_linenumber"])


@query
def dup_songplay_natural_by_hash(spark, sf_dir):
    """The same in two phases: hashes first, keys of repeated hashes after."""
    plays = materialize(_play_factors(spark, sf_dir).weighted(NATURAL_KEY, WEIGHT), "fact")
    return ops.duplicates_by_hash(plays, NATURAL_KEY, weight=WEIGHT)


@query
def dup_catalogue_name_by_hash(spark, sf_dir):
    return ops.duplicates_by_hash(standins.staging_songs(spark, sf_dir), ["artist_name", "title"])


def _keyed_tables(spark, sf_dir):
    catalogue = standins.staging_songs(spark, sf_dir)
    factors = _play_factors(spark, sf_dir)
    return {
        "songplay": (factors.keyed("songplay_id"), ["songplay_id"]),
        "songplay natural key": (factors.weighted(NATURAL_KEY, WEIGHT), NATURAL_KEY),
        "users": (users_latest(spark, sf_dir), ["user_id"]),
        "songs": (ops.songs(catalogue), ["song_id"]),
        "artists": (ops.artists(catalogue), ["artist_id"]),
        "time": (ops.time_dim(factors.weighted(["start_time"], WEIGHT)), ["start_time"]),
        "catalogue names": (catalogue, ["artist_name", "title"]),
        "lineitem": (standins.source(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]),
    }


# How the tables above are checked: rows that stand for several, and generated keys.
CHECKED = {"weights": {"songplay natural key": WEIGHT}, "generated": {"songplay"}}


@query
def duplicate_report(spark, sf_dir):
    return ops.duplicate_report(_keyed_tables(spark, sf_dir), **CHECKED)


@query
def duplicate_report_by_hash(spark, sf_dir):
    weights, generated = CHECKED["weights"], CHECKED["generated"]

    def keys_of(name, df, keys):
        """Stored, but for generated keys: these follow from the fact's stored factors, which
        are far smaller than the fact, and are made again wherever they are read."""
        found = df.select(*keys, *[weights[n] for n in weights if n == name])
        return found if name in generated else materialize(found, "keys")

    tables = {
        name: (keys_of(name, df, keys), keys)
        for name, (df, keys) in _keyed_tables(spark, sf_dir).items()
    }
    return ops.duplicate_report_by_hash(tables, **CHECKED)


@query
def null_report(spark, sf_dir):
    """Every staging column, and the columns the star and the benchmark tables
    declare NOT NULL."""
    events = standins.staging_events(spark, sf_dir)
    catalogue = standins.staging_songs(spark, sf_dir)
    tables = {
        "staging_events": (events, events.columns),
        "staging_songs": (catalogue, catalogue.columns),
    }
    star = {
        "users": users_latest(spark, sf_dir),
        "songs": ops.songs(catalogue),
        "artists": ops.artists(catalogue),
        "time": time_dim(spark, sf_dir),
    }
    for name, df in star.items():
        tables[name] = (df, schemas.required_columns(schemas.STAR[name]))
    tables["sporting_event_ticket"] = (
        standins.tickets(spark, sf_dir),
        schemas.TICKETS.names,
    )
    for name, df in standins.ssb(spark, sf_dir).items():
        tables[name] = (df, schemas.required_columns(schemas.SSB[name]))
    return ops.null_report(tables)


@query
def length_report(spark, sf_dir):
    """Declared lengths; plain text, as in the staging tables and ``documents``,
    is checked against the default."""
    default = schemas.DEFAULT_TEXT_BYTES
    tables = {
        "staging_events": (
            standins.staging_events(spark, sf_dir),
            schemas.text_lengths(schemas.EVENTS, default),
        ),
        "staging_songs": (
            standins.staging_songs(spark, sf_dir),
            schemas.text_lengths(schemas.SONGS_SOURCE, default),
        ),
        "sporting_event_ticket": (
            standins.tickets(spark, sf_dir),
            schemas.text_lengths(schemas.TICKETS),
        ),
        "documents": (
            standins.source(spark, sf_dir, "documents"),
            {"text": default, "lang": 1, "source": 4},
        ),
    }
    for name, df in standins.ssb(spark, sf_dir).items():
        tables[name] = (df, schemas.text_lengths(schemas.SSB[name]))
    return ops.length_report(tables)


# --- sources and sinks -----------------------------------------------------------

# Where the written logs hold staging_events columns; the others lie on top.
NESTED = {
    "firstName": "$.user.firstName",
    "gender": "$.user.gender",
    "itemInSession": "$['session']['item']",
    "lastName": "$.user.lastName",
    "method": "$.request[0]",
    "registration": "$.user.registration",
    "sessionId": "$.session.id",
    "status": "$.request[1]",
}
LOG_PATHS = [NESTED.get(c, f"$.{c}") for c in schemas.EVENTS.names]


def _log_line(user_id) -> F.Column:
    return F.to_json(
        F.struct(
            "artist",
            "auth",
            "length",
            "level",
            "location",
            "page",
            F.array(F.col("method"), F.col("status").cast("string")).alias("request"),
            F.struct(
                F.col("sessionId").alias("id"),
                F.col("itemInSession").alias("item"),
            ).alias("session"),
            "song",
            "ts",
            F.struct("firstName", "gender", "lastName", "registration").alias("user"),
            "userAgent",
            user_id.alias("userId"),
        )
    )


def _write_logs(spark: SparkSession, sf_dir: str) -> str:
    """Logs as a JSON producer may write them: user ids quoted for even ones,
    bare for odd ones, empty for visitors; NULL fields missing."""
    path = scratch_path(spark, "logs")
    user = F.col("userId")
    quoted = _log_line(F.coalesce(user.cast("string"), F.lit("")))
    line = F.when(user % 2 == 1, _log_line(user)).otherwise(quoted)
    standins.staging_events(spark, sf_dir).select(line.alias("value")).write.text(path)
    return path


def _write_catalogue(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "catalogue")
    standins.staging_songs(spark, sf_dir).write.json(path)
    return path


def _write_gzip(df: DataFrame, path: str, sep: str, even: bool = False) -> str:
    """Delimited text in gzip files of even size: each is read by one task. ``even``:
    the partitions are so already, and another shuffle would gain nothing."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    lines = (df if even else df.hint("rebalance")).select(F.concat_ws(sep, *fields).alias("value"))
    lines.write.text(path, compression="gzip")
    return f"{path}/part*"


@query
def json_paths_scan(spark, sf_dir):
    return sources.read_json_paths(
        spark, _write_logs(spark, sf_dir), LOG_PATHS, schemas.widen_ids(schemas.EVENTS)
    )


@query
def json_flat_scan(spark, sf_dir):
    """Flat log lines, one field per column, each path naming its column."""
    path = scratch_path(spark, "flat-logs")
    standins.staging_events(spark, sf_dir).write.json(path)
    return sources.read_json_paths(
        spark, path, [f"$.{c}" for c in schemas.EVENTS.names], schemas.widen_ids(schemas.EVENTS)
    )


@query
def json_auto_scan(spark, sf_dir):
    return sources.read_json_auto(spark, _write_catalogue(spark, sf_dir), schemas.SONGS_SOURCE)


def _decimals_as_text(tickets: DataFrame) -> DataFrame:
    """Every digit as stored, the scale included."""
    return tickets.withColumns(
        {c: F.col(c).cast("string") for c in ("seat_level", "ticket_price")}
    )


@query
def delimited_scan(spark, sf_dir):
    path = _write_gzip(standins.tickets(spark, sf_dir), scratch_path(spark, "tickets"), ";")
    return _decimals_as_text(read_delimited(spark, path, schemas.TICKETS, sep=";"))


@query
def delimited_scan_spread(spark, sf_dir):
    """The same load with the rows spread over all cores right after the scan,
    for inputs that come in a few large files."""
    path = _write_gzip(standins.tickets(spark, sf_dir), scratch_path(spark, "tickets"), ";")
    cores = spark.sparkContext.defaultParallelism
    return _decimals_as_text(
        read_delimited(spark, path, schemas.TICKETS, sep=";", repartition=cores)
    )


@query
def delimited_scan_pipe(spark, sf_dir):
    lines = standins.lineorder(spark, sf_dir, spread=True)
    path = _write_gzip(lines, scratch_path(spark, "lineorder"), "|", even=True)
    return read_delimited(spark, path, schemas.widen_ids(schemas.SSB["lineorder"]))


def _database(spark: SparkSession, label: str) -> str:
    """A namespace of its own, its tables in the shared folder."""
    db = scratch_namespace(label)
    return sources.use(spark, db, scratch_path(spark, db))


@query
def append_twice(spark, sf_dir):
    """The declared table, loaded twice from the same split files."""
    path = _write_gzip(standins.tickets(spark, sf_dir), scratch_path(spark, "tickets"), ";")
    db = _database(spark, "append")
    plans.load_tickets(spark, db, path)
    return _decimals_as_text(plans.load_tickets(spark, db, path))


def _fill_star(spark, sf_dir, db):
    catalogue = standins.staging_songs(spark, sf_dir)
    fact = ops.with_identity(songplay_fact(spark, sf_dir), "songplay_id")
    sources.insert_into(fact, f"{db}.songplay")
    star = {
        "users": users_latest(spark, sf_dir),
        "songs": ops.songs(catalogue),
        "artists": ops.artists(catalogue),
        "time": ops.time_dim(spark.table(f"{db}.songplay")),
    }
    for name, df in star.items():
        required = schemas.required_columns(schemas.STAR[name])
        sources.insert_into(df, f"{db}.{name}", df.columns, required)


@query
def star_roundtrip(spark, sf_dir):
    """Fill the star tables, reset them, fill them again, count what is stored."""
    db = _database(spark, "star")
    for _ in range(2):
        sources.reset(spark, db, schemas.STAR)
        _fill_star(spark, sf_dir, db)
    return plans.row_counts({name: spark.table(f"{db}.{name}") for name in schemas.STAR})


@query
def etl_report(spark, sf_dir):
    db = scratch_namespace("etl")
    return plans.run(
        spark,
        plans.RunConfig(
            db=db,
            events=_write_logs(spark, sf_dir),
            songs=_write_catalogue(spark, sf_dir),
            json_paths=LOG_PATHS,
            location=scratch_path(spark, db),
        ),
    )


@query
def etl_load_figures(spark, sf_dir):
    """The whole run again; rows, NULLs and overlong texts as its writes counted them."""
    db = scratch_namespace("figures")
    return plans.run_counted(
        spark,
        plans.RunConfig(
            db=db,
            events=_write_logs(spark, sf_dir),
            songs=_write_catalogue(spark, sf_dir),
            json_paths=LOG_PATHS,
            location=scratch_path(spark, db),
        ),
    )


# Declared bytes under which texts of ``documents`` fit, or do not.
DOCUMENT_LENGTHS = {"text": schemas.DEFAULT_TEXT_BYTES, "lang": 2, "source": 4}


@query
def overlong_load(spark, sf_dir):
    """A text column of ``documents`` at a time, loaded under a declared length: an
    overlong value fails the load and leaves nothing behind."""
    db = _database(spark, "lengths")
    outcome = []
    for name, most in DOCUMENT_LENGTHS.items():
        rows = standins.source(spark, sf_dir, "documents").select(name)
        sources.create_tables(spark, db, {name: schemas.readable(rows.schema)})
        try:
            sources.insert_into(
                rows, f"{db}.{name}", lengths={name: most}, refuse_overlong=True
            )
            refused = False
        except Exception as error:
            if f"value too long for column {name}" not in str(error):
                raise
            refused = True
        outcome.append((name, most, refused, spark.table(f"{db}.{name}").count()))
    return spark.createDataFrame(
        outcome, "column_name string, allowed int, refused boolean, row_count long"
    )


@query
def load_diagnosis(spark, sf_dir):
    """Logs in which some lines are cut off and some hold a value that does not fit:
    the lines a load refuses, by column and kind of reason."""
    path = scratch_path(spark, "bad-logs")
    item, line = F.col("itemInSession"), _log_line(F.col("userId"))
    wrong = _log_line(F.concat(F.lit("user "), F.col("sessionId")))
    text = (
        F.when(item % 50 == 7, F.expr("substr(line, 1, length(line) - 9)"))
        .when(item % 50 == 9, wrong)
        .otherwise(F.col("line"))
    )
    events = standins.staging_events(spark, sf_dir).withColumn("line", line)
    events.select(text.alias("value")).write.text(path)
    schema = schemas.widen_ids(schemas.EVENTS)
    return sources.by_reason(sources.bad_json_lines(spark, path, LOG_PATHS, schema))


def _two_appends(spark, sf_dir, name, first, second):
    db = _database(spark, "appends")
    sources.reset(spark, db, {name: schemas.STAR[name]})
    for versions in (first, second):
        plans.merge_dimension(spark, db, name, versions)
    return spark.table(f"{db}.{name}")


@query
def users_two_appends(spark, sf_dir):
    """The later half of the log first, then the rest: the same users as from one load."""
    versions = ops.user_versions(standins.activity(spark, sf_dir))
    early = (F.col("ts") % 3 == 0) | F.col("ts").isNull()
    return _two_appends(spark, sf_dir, "users", versions.where(~early), versions.where(early))


@query
def artists_two_appends(spark, sf_dir):
    versions = ops.artist_versions(standins.staging_songs(spark, sf_dir))
    some = F.coalesce(F.col("year") % 2 == 0, F.lit(False))
    return _two_appends(spark, sf_dir, "artists", versions.where(some), versions.where(~some))


@query
def offending_keys(spark, sf_dir):
    """The star filled, users and songs twice: the keys that repeat."""
    db = _database(spark, "offending")
    sources.reset(spark, db, schemas.STAR)
    catalogue = standins.staging_songs(spark, sf_dir)
    star = {
        "songplay": ops.with_identity(songplay_fact(spark, sf_dir), "songplay_id"),
        "users": users_latest(spark, sf_dir),
        "songs": ops.songs(catalogue),
        "artists": ops.artists(catalogue),
    }
    for name in [*star, "users", "songs"]:
        sources.insert_into(star[name], f"{db}.{name}")
    sources.insert_into(ops.time_dim(spark.table(f"{db}.songplay")), f"{db}.time")
    return plans.offending_keys(spark, db)


@query
def lineitem_keyed_in_place(spark, sf_dir):
    """Dense keys of every line, given where the rows lie: nothing is shuffled."""
    lines = standins.source(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return ops.with_dense_id_in_place(lines, "line_id").select("line_id")


# --- star schema benchmark and layouts -------------------------------------------

SSB_QUERIES = {
    "one_dim": lambda t: plans.one_dim(t["lineorder"], t["dwdate"]),
    "two_dim": lambda t: plans.two_dim(
        t["lineorder"], t["dwdate"], t["part"], t["supplier"], SSB_CATEGORY, SSB_REGION
    ),
    "drill": lambda t: plans.drill(
        t["lineorder"],
        t["customer"],
        t["supplier"],
        t["dwdate"],
        SSB_CUSTOMER_CITIES,
        SSB_SUPPLIER_CITIES,
        SSB_YEARMONTH,
    ),
    "same_dist": lambda t: plans.same_dist(t["lineorder"], t["part"]),
}


@query
def ssb_one_dim(spark, sf_dir):
    return SSB_QUERIES["one_dim"](standins.ssb(spark, sf_dir))


@query
def ssb_two_dim(spark, sf_dir):
    return SSB_QUERIES["two_dim"](standins.ssb(spark, sf_dir))


@query
def ssb_drill(spark, sf_dir):
    return SSB_QUERIES["drill"](standins.ssb(spark, sf_dir))


@query
def ssb_same_dist(spark, sf_dir):
    return SSB_QUERIES["same_dist"](standins.ssb(spark, sf_dir))


@query
def ssb_two_dim_filtered(spark, sf_dir):
    """Nothing is broadcast but Bloom filters of the dimensions' keys."""
    t = standins.ssb(spark, sf_dir)
    return plans.two_dim(
        t["lineorder"], t["dwdate"], t["part"], t["supplier"], SSB_CATEGORY, SSB_REGION, max_bytes=0
    )


@query
def ssb_drill_filtered(spark, sf_dir):
    t = standins.ssb(spark, sf_dir)
    return plans.drill(
        t["lineorder"],
        t["customer"],
        t["supplier"],
        t["dwdate"],
        SSB_CUSTOMER_CITIES,
        SSB_SUPPLIER_CITIES,
        SSB_YEARMONTH,
        max_bytes=0,
    )


# The part that lines of unknown part are booked on: a third of all lines.
UNKNOWN_PART = -1


@query
def layout_hybrid_join(spark, sf_dir):
    """Lines and parts bucketed on the part key, returned lines booked on one part: its
    bucket is joined by broadcast, all others bucket by bucket."""
    db = _database(spark, "hybrid")
    key = F.when(F.col("l_returnflag") == "R", UNKNOWN_PART).otherwise(F.col("l_partkey"))
    lines = standins.source(spark, sf_dir, "lineitem").select(
        key.cast("long").alias("l_partkey"), "l_quantity", "l_returnflag"
    )
    parts = standins.source(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("long").alias("p_partkey"), "p_brand"
    )
    parts = parts.unionByName(
        spark.range(1).select(F.lit(UNKNOWN_PART).cast("long").alias("p_partkey"), F.lit("unknown").alias("p_brand"))
    )
    by_part = {
        "part": layout.Layout(bucket="p_partkey", sort="p_partkey"),
        "lines": layout.Layout(bucket="l_partkey"),
    }
    layout.load_layout(spark, db, {"part": parts, "lines": lines}, by_part, buckets=HOT_BUCKETS)
    joined = layout.hybrid_join(
        spark, f"{db}.lines", f"{db}.part", "l_partkey", "p_partkey", ["l_quantity"], ["p_brand"]
    )
    return joined.groupBy("p_brand").agg(
        F.count("*").alias("line_count"), F.sum(F.col("l_quantity").cast("long")).alias("quantity")
    )


@query
def layout_bucketed_join(spark, sf_dir):
    """The part query on tables bucketed by part key: no shuffle for the join."""
    db = _database(spark, "dist")
    frames = {
        "part": standins.ssb_part(spark, sf_dir),
        "lineorder": materialize(standins.lineorder(spark, sf_dir), "lineorder"),
    }
    dist = {name: layout.LAYOUTS["dist"][name] for name in frames}
    layout.load_layout(spark, db, frames, dist)
    tables = layout.read_layout(spark, db, dist)
    return plans.same_dist(tables["lineorder"], tables["part"])


@query
def layout_hot_bucket(spark, sf_dir):
    """Lines bucketed by their return flag, one of three values: the declared buckets
    stay, a bucket is hot, and the table says so."""
    db = _database(spark, "hot")
    lines = standins.source(spark, sf_dir, "lineitem")
    by_flag = {"lineitem": layout.Layout(bucket="l_returnflag")}
    outcome = layout.load_layout(spark, db, {"lineitem": lines}, by_flag, buckets=HOT_BUCKETS)
    stored = layout.read_layout(spark, db, by_flag)["lineitem"]
    (told,) = outcome.collect()  # one row per table
    return (
        stored.groupBy("l_returnflag")
        .agg(F.count("*").alias("row_count"))
        .withColumns({c: F.lit(told[c]) for c in ("table_name", "buckets", "hot")})
    )


@query
def layout_load(spark, sf_dir):
    """Load the five tables from gzip files into both layouts; rows in each."""
    root = scratch_path(spark, "ssb")
    for name, df in standins.ssb(spark, sf_dir, spread=True).items():
        _write_gzip(df, f"{root}/{name}", "|", even=name == "lineorder")
    databases = {name: scratch_namespace(name) for name in layout.LAYOUTS}
    locations = {name: scratch_path(spark, db) for name, db in databases.items()}
    plans.load_both(spark, root, databases, locations)
    counts = [
        plans.row_counts({t: spark.table(f"{db}.{t}") for t in schemas.SSB}).withColumnRenamed(
            "row_count", f"rows_{name}"
        )
        for name, db in databases.items()
    ]
    return counts[0].join(counts[1], "table_name")


def _both_layouts(spark: SparkSession, sf_dir: str) -> tuple[dict, dict]:
    """The five tables in both layouts; the second is copied from the first."""
    plain, spread = _database(spark, "nodist"), _database(spark, "dist")
    layout.load_layout(spark, plain, standins.ssb(spark, sf_dir), layout.LAYOUTS["nodist"])
    nodist = layout.read_layout(spark, plain, layout.LAYOUTS["nodist"])
    layout.load_layout(spark, spread, nodist, layout.LAYOUTS["dist"])
    return nodist, layout.read_layout(spark, spread, layout.LAYOUTS["dist"])


@query
def layout_agreement(spark, sf_dir):
    return layout.agreement(SSB_QUERIES, *_both_layouts(spark, sf_dir))


@query
def layout_gain(spark, sf_dir):
    """The four queries timed on both layouts: what is determined about the times."""
    found = layout.compare_layouts(spark, SSB_QUERIES, *_both_layouts(spark, sf_dir))
    a, b = F.col("seconds_nodist"), F.col("seconds_dist")
    return found.select(
        "query",
        "result_rows",
        "differing_rows",
        ((a > 0) & (b > 0)).alias("timed"),
        (F.abs(F.col("dist_improvement") - 100 * (a - b) / a) < 1e-9).alias("gain_is_percent"),
    )


@query
def paired_gains(spark, sf_dir):
    """The arithmetic of paired comparisons over given pairs: of each supplier's lines,
    the price and the price less discount plus tax."""
    price = F.col("l_extendedprice")
    lines = standins.source(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        price.alias("list_price"),
        (price * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("charge"),
    )
    found = ops.paired_gain(lines, "l_suppkey", "list_price", "charge")
    rounded = ["median_gain", "least_gain", "most_gain", "p_value"]
    return found.withColumns({c: F.round(c, 6) for c in rounded})


# --- reports ---------------------------------------------------------------------


@query
def most_played(spark, sf_dir):
    plays = _play_factors(spark, sf_dir).weighted(["song_id"], WEIGHT)
    return plans.most_played(plays, songs_dim(spark, sf_dir), TOP_SONGS, WEIGHT)


@query
def plays_by_hour(spark, sf_dir):
    plays = materialize(_play_factors(spark, sf_dir).weighted(["start_time"], WEIGHT), "fact")
    return plans.plays_by_hour(plays, ops.time_dim(plays), WEIGHT)


@query
def row_counts(spark, sf_dir):
    plays = materialize(_play_factors(spark, sf_dir).weighted(["start_time"], WEIGHT), "fact")
    catalogue = standins.staging_songs(spark, sf_dir)
    return plans.row_counts(
        {
            "staging_events": standins.staging_events(spark, sf_dir),
            "staging_songs": catalogue,
            "songplay": plays,
            "users": users_latest(spark, sf_dir),
            "songs": ops.songs(catalogue),
            "artists": ops.artists(catalogue),
            "time": ops.time_dim(plays),
        },
        {"songplay": WEIGHT},
    )
