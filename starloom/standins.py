"""Staging, ticket and benchmark tables derived from the driver's tables.

The driver has no play logs, no song catalogue and no tickets, so these map its
tables onto the declared shapes. Every row of the source tables is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions.temporal import date_key


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- music streaming ---------------------------------------------------------


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """staging_events without the columns of the song, and with its event_id.

    ``signup`` events come from visitors who have no user id yet. ``_part`` is
    the part a play is about.
    """
    user = F.when(F.col("event_type") != "signup", F.col("user_id"))
    # Under UTC, floor of microseconds; unix_millis would need the same cast.
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return source(spark, sf_dir, "events").select(
        F.when(user.isNull(), "Logged Out").otherwise("Logged In").alias("auth"),
        F.concat(F.lit("First"), user % 97).alias("firstName"),
        F.when(user % 2 == 0, "F").when(user % 2 == 1, "M").alias("gender"),
        (F.col("event_id") % 100).cast("int").alias("itemInSession"),
        F.concat(F.lit("Last"), user % 89).alias("lastName"),
        F.when(F.col("value") >= 50, "paid").otherwise("free").alias("level"),
        F.concat(F.lit("City "), F.col("user_id") % 50).alias("location"),
        F.when(F.col("event_type") == "view", "PUT").otherwise("GET").alias("method"),
        F.when(F.col("event_type") == "view", "NextSong")
        .otherwise(F.col("event_type"))
        .alias("page"),
        (F.lit(1.5e12) + user * 1000).cast("double").alias("registration"),
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("sessionId"),
        F.when(F.col("event_type") == "error", 404).otherwise(200).alias("status"),
        F.call_function("div", micros, F.lit(1000)).alias("ts"),
        F.concat(F.lit("Agent/"), F.col("user_id") % 7).alias("userAgent"),
        user.alias("userId"),
        F.get_json_object("props", "$.k").try_cast("long").alias("_part"),
    )


def staging_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 18 columns; artist, song and length come from the part."""
    part = source(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("_part"),
        F.col("p_brand").alias("artist"),
        F.col("p_name").alias("song"),
        F.col("p_retailprice").alias("length"),
    )
    return activity(spark, sf_dir).join(part, "_part", "left").select(schemas.EVENTS.names)


def staging_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "part").select(
        F.lit(1).alias("num_songs"),
        F.concat(F.lit("AR"), F.regexp_extract("p_brand", r"\d+", 0)).alias("artist_id"),
        (F.col("p_size") * 1.5).alias("artist_latitude"),
        (F.lit(180.0) - F.col("p_size")).alias("artist_longitude"),
        F.col("p_type").alias("artist_location"),
        F.col("p_brand").alias("artist_name"),
        F.concat(F.lit("SO"), F.col("p_partkey")).alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("duration"),
        (F.col("p_size") + 1960).alias("year"),
    )


# --- tickets -------------------------------------------------------------------


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticket per order; tickets of status P are not sold yet."""
    order = F.col("o_orderkey")
    return source(spark, sf_dir, "orders").select(
        order.cast("double").alias("id"),
        (order % 1000).cast("double").alias("sporting_event_id"),
        (order % 25).cast("double").alias("sport_location_id"),
        (order % 10).cast("decimal(1,0)").alias("seat_level"),
        F.col("o_orderpriority").alias("seat_section"),
        F.col("o_orderstatus").alias("seat_row"),
        (order % 500).cast("string").alias("seat"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
        .cast("double")
        .alias("ticketholder_id"),
        F.col("o_totalprice").cast("decimal(8,2)").alias("ticket_price"),
    )


# --- star schema benchmark -----------------------------------------------------


def _hundredths(amount: str) -> Column:
    """The nearest integer. ``round`` would go through BigDecimal per row."""
    return F.rint(F.col(amount) * 100).cast("long")


def lineorder(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Lines with their orders. What follows from a line's other columns is added after
    the join, so that a shuffle does not carry it. ``spread``: both sides are shuffled
    whatever their size, which leaves the lines in partitions of even size."""
    orders = source(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("lo_orderkey"),
        F.col("o_custkey").alias("lo_custkey"),
        date_key(F.col("o_orderdate")).alias("lo_orderdate"),
        F.col("o_orderpriority").alias("lo_orderpriority"),
        _hundredths("o_totalprice").alias("lo_ordertotalprice"),
    )
    lines = source(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("lo_orderkey"),
        F.col("l_linenumber").alias("lo_linenumber"),
        F.col("l_partkey").alias("lo_partkey"),
        F.col("l_suppkey").alias("lo_suppkey"),
        F.col("l_quantity").cast("int").alias("lo_quantity"),
        _hundredths("l_extendedprice").alias("lo_extendedprice"),
        _hundredths("l_discount").cast("int").alias("lo_discount"),
        _hundredths("l_tax").cast("int").alias("lo_tax"),
        date_key(F.col("l_shipdate")).alias("lo_commitdate"),
        "l_returnflag",
    )
    price, discount = F.col("lo_extendedprice"), F.col("lo_discount")
    return lines.join(orders.hint("merge") if spread else orders, "lo_orderkey").select(
        "lo_orderkey", "lo_linenumber", "lo_custkey", "lo_partkey", "lo_suppkey",
        "lo_orderdate", "lo_orderpriority", F.lit("0").alias("lo_shippriority"), "lo_quantity",
        "lo_extendedprice", "lo_ordertotalprice", "lo_discount",
        F.call_function("div", price * (100 - discount), F.lit(100)).alias("lo_revenue"),
        F.call_function("div", price * 6, F.lit(10)).alias("lo_supplycost"),
        "lo_tax", "lo_commitdate",
        F.concat(F.lit("MODE "), F.col("l_returnflag")).alias("lo_shipmode"),
    )


def ssb_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.regexp_extract("p_brand", r"\d+", 0).cast("int") - 1
    manufacturer = F.concat(F.lit("MFGR#"), 1 + brand % 5)
    category = F.concat(manufacturer, 1 + F.floor(brand / 5))
    return source(spark, sf_dir, "part").select(
        "p_partkey",
        "p_name",
        manufacturer.alias("p_mfgr"),
        category.alias("p_category"),
        F.concat(category, 1 + F.col("p_size") % 40).alias("p_brand1"),
        F.substring_index("p_name", " ", 1).alias("p_color"),
        "p_type",
        "p_size",
        F.concat(F.lit("BOX "), F.col("p_size") % 10).alias("p_container"),
    )


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 nations with their regions; Spark broadcasts them by size."""
    nation = source(spark, sf_dir, "nation")
    region = source(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )


def _city(key: str) -> Column:
    """Nine characters of the nation and a digit, as the benchmark names cities."""
    return F.concat(F.substring(F.rpad("n_name", 9, " "), 1, 9), F.col(key) % 2)


def _phone(key: str) -> Column:
    """Kept to 15 characters for keys of any length."""
    return F.concat(F.lit("10-"), F.col(key) % 1_000_000)


def ssb_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = source(spark, sf_dir, "supplier")
    return supplier.join(
        _places(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(
        "s_suppkey",
        "s_name",
        F.concat(F.lit("Street "), F.col("s_suppkey") % 1000).alias("s_address"),
        _city("s_suppkey").alias("s_city"),
        F.col("n_name").alias("s_nation"),
        F.col("r_name").alias("s_region"),
        _phone("s_suppkey").alias("s_phone"),
    )


def ssb_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = source(spark, sf_dir, "customer")
    return customer.join(
        _places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        "c_custkey",
        "c_name",
        F.concat(F.lit("Street "), F.col("c_custkey") % 1000).alias("c_address"),
        _city("c_custkey").alias("c_city"),
        F.col("n_name").alias("c_nation"),
        F.col("r_name").alias("c_region"),
        _phone("c_custkey").alias("c_phone"),
        "c_mktsegment",
    )


def dwdate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar from the first to the last order date, one row per day."""
    span = source(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").cast("date").alias("first"),
        F.max("o_orderdate").cast("date").alias("last"),
    )
    days = span.select(F.explode(F.sequence("first", "last")).alias("day"))
    day, month = F.col("day"), F.month("day")
    season = (
        F.when(month == 12, "Christmas")
        .when(month.between(9, 11), "Fall")
        .when(month.between(6, 8), "Summer")
        .when(month.between(3, 5), "Spring")
        .otherwise("Winter")
    )

    def flag(condition: Column) -> Column:
        return F.when(condition, "1").otherwise("0")

    return days.select(
        date_key(day).alias("d_datekey"),
        F.date_format(day, "MMMM d, yyyy").alias("d_date"),
        F.date_format(day, "EEEE").alias("d_dayofweek"),
        F.date_format(day, "MMMM").alias("d_month"),
        F.year(day).alias("d_year"),
        (F.year(day) * 100 + month).alias("d_yearmonthnum"),
        F.date_format(day, "MMMyyyy").alias("d_yearmonth"),
        F.dayofweek(day).alias("d_daynuminweek"),
        F.dayofmonth(day).alias("d_daynuminmonth"),
        F.dayofyear(day).alias("d_daynuminyear"),
        month.alias("d_monthnuminyear"),
        F.weekofyear(day).alias("d_weeknuminyear"),
        season.alias("d_sellingseason"),
        flag(F.dayofweek(day) == 7).alias("d_lastdayinweekfl"),
        flag(day == F.last_day(day)).alias("d_lastdayinmonthfl"),
        flag((month == 12) & (F.dayofmonth(day) == 25)).alias("d_holidayfl"),
        flag(F.dayofweek(day).between(2, 6)).alias("d_weekdayfl"),
    )


def ssb(spark: SparkSession, sf_dir: str, spread: bool = False) -> dict[str, DataFrame]:
    """The five tables by name; ``spread`` as in ``lineorder``."""
    return {
        "customer": ssb_customer(spark, sf_dir),
        "dwdate": dwdate(spark, sf_dir),
        "supplier": ssb_supplier(spark, sf_dir),
        "part": ssb_part(spark, sf_dir),
        "lineorder": lineorder(spark, sf_dir, spread),
    }
