"""Declared table schemas, and the small helpers that derive reader schemas,
table DDL and check lists from them.

A declared schema keeps VARCHAR(n), CHAR(n) and NOT NULL as written, because the
checks in ``operators.quality`` and the table DDL are built from those. Readers
get ``readable(schema)``, where text is plain string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT = T.StringType()
INT = T.IntegerType()
BIGINT = T.LongType()
DOUBLE = T.DoubleType()  # FLOAT without a precision is 8 bytes in the warehouse
TIMESTAMP = T.TimestampNTZType()


def varchar(n: int) -> T.VarcharType:
    return T.VarcharType(n)


def char(n: int) -> T.CharType:
    return T.CharType(n)


def table(*fields: tuple) -> T.StructType:
    """Build a schema from ``(name, type)`` or ``(name, type, "required")``."""
    return T.StructType(
        [T.StructField(name, dtype, not rest) for name, dtype, *rest in fields]
    )


REQUIRED = "required"

# Column names, order and types of the tables are the contract
# that loaders, queries and users of the tables share.

EVENTS = table(
    ("artist", TEXT),
    ("auth", TEXT),
    ("firstName", TEXT),
    ("gender", char(1)),
    ("itemInSession", INT),
    ("lastName", TEXT),
    ("length", DOUBLE),
    ("level", TEXT),
    ("location", TEXT),
    ("method", TEXT),
    ("page", TEXT),
    ("registration", DOUBLE),
    ("sessionId", INT),
    ("song", TEXT),
    ("status", INT),
    ("ts", BIGINT),
    ("userAgent", TEXT),
    ("userId", INT),
)

SONGS_SOURCE = table(
    ("num_songs", INT),
    ("artist_id", TEXT),
    ("artist_latitude", DOUBLE),
    ("artist_longitude", DOUBLE),
    ("artist_location", TEXT),
    ("artist_name", TEXT),
    ("song_id", TEXT),
    ("title", TEXT),
    ("duration", DOUBLE),
    ("year", INT),
)

SONGPLAY = table(
    ("songplay_id", INT, REQUIRED),
    ("start_time", TIMESTAMP),
    ("user_id", INT),
    ("level", TEXT),
    ("song_id", TEXT),
    ("artist_id", TEXT),
    ("session_id", INT),
    ("location", TEXT),
    ("user_agent", TEXT),
)

USERS = table(
    ("user_id", INT, REQUIRED),
    ("first_name", TEXT),
    ("last_name", TEXT),
    ("gender", char(1)),
    ("level", TEXT),
)

SONGS = table(
    ("song_id", TEXT, REQUIRED),
    ("title", TEXT),
    ("artist_id", TEXT),
    ("year", INT),
    ("duration", DOUBLE),
)

ARTISTS = table(
    ("artist_id", TEXT, REQUIRED),
    ("name", TEXT),
    ("location", TEXT),
    ("latitude", DOUBLE),
    ("longitude", DOUBLE),
)

TIME = table(
    ("start_time", TIMESTAMP, REQUIRED),
    ("hour", INT),
    ("day", INT),
    ("week", INT),
    ("month", INT),
    ("year", INT),
    ("weekday", TEXT),
)

TICKETS = table(
    ("id", DOUBLE, REQUIRED),
    ("sporting_event_id", DOUBLE, REQUIRED),
    ("sport_location_id", DOUBLE, REQUIRED),
    ("seat_level", T.DecimalType(1, 0), REQUIRED),
    ("seat_section", varchar(15), REQUIRED),
    ("seat_row", varchar(10), REQUIRED),
    ("seat", varchar(10), REQUIRED),
    ("ticketholder_id", DOUBLE),
    ("ticket_price", T.DecimalType(8, 2), REQUIRED),
)

SSB_PART = table(
    ("p_partkey", INT, REQUIRED),
    ("p_name", varchar(22), REQUIRED),
    ("p_mfgr", varchar(6), REQUIRED),
    ("p_category", varchar(7), REQUIRED),
    ("p_brand1", varchar(9), REQUIRED),
    ("p_color", varchar(11), REQUIRED),
    ("p_type", varchar(25), REQUIRED),
    ("p_size", INT, REQUIRED),
    ("p_container", varchar(10), REQUIRED),
)

SSB_SUPPLIER = table(
    ("s_suppkey", INT, REQUIRED),
    ("s_name", varchar(25), REQUIRED),
    ("s_address", varchar(25), REQUIRED),
    ("s_city", varchar(10), REQUIRED),
    ("s_nation", varchar(15), REQUIRED),
    ("s_region", varchar(12), REQUIRED),
    ("s_phone", varchar(15), REQUIRED),
)

SSB_CUSTOMER = table(
    ("c_custkey", INT, REQUIRED),
    ("c_name", varchar(25), REQUIRED),
    ("c_address", varchar(25), REQUIRED),
    ("c_city", varchar(10), REQUIRED),
    ("c_nation", varchar(15), REQUIRED),
    ("c_region", varchar(12), REQUIRED),
    ("c_phone", varchar(15), REQUIRED),
    ("c_mktsegment", varchar(10), REQUIRED),
)

SSB_DWDATE = table(
    ("d_datekey", INT, REQUIRED),
    ("d_date", varchar(19), REQUIRED),
    ("d_dayofweek", varchar(10), REQUIRED),
    ("d_month", varchar(10), REQUIRED),
    ("d_year", INT, REQUIRED),
    ("d_yearmonthnum", INT, REQUIRED),
    ("d_yearmonth", varchar(8), REQUIRED),
    ("d_daynuminweek", INT, REQUIRED),
    ("d_daynuminmonth", INT, REQUIRED),
    ("d_daynuminyear", INT, REQUIRED),
    ("d_monthnuminyear", INT, REQUIRED),
    ("d_weeknuminyear", INT, REQUIRED),
    ("d_sellingseason", varchar(13), REQUIRED),
    ("d_lastdayinweekfl", varchar(1), REQUIRED),
    ("d_lastdayinmonthfl", varchar(1), REQUIRED),
    ("d_holidayfl", varchar(1), REQUIRED),
    ("d_weekdayfl", varchar(1), REQUIRED),
)

SSB_LINEORDER = table(
    ("lo_orderkey", INT, REQUIRED),
    ("lo_linenumber", INT, REQUIRED),
    ("lo_custkey", INT, REQUIRED),
    ("lo_partkey", INT, REQUIRED),
    ("lo_suppkey", INT, REQUIRED),
    ("lo_orderdate", INT, REQUIRED),
    ("lo_orderpriority", varchar(15), REQUIRED),
    ("lo_shippriority", varchar(1), REQUIRED),
    ("lo_quantity", INT, REQUIRED),
    ("lo_extendedprice", INT, REQUIRED),
    ("lo_ordertotalprice", INT, REQUIRED),
    ("lo_discount", INT, REQUIRED),
    ("lo_revenue", INT, REQUIRED),
    ("lo_supplycost", INT, REQUIRED),
    ("lo_tax", INT, REQUIRED),
    ("lo_commitdate", INT, REQUIRED),
    ("lo_shipmode", varchar(10), REQUIRED),
)

# Length the warehouse gives a VARCHAR written without one, in bytes.
DEFAULT_TEXT_BYTES = 256

# Identifier columns: declared INTEGER, which ends at 2^31. ``widen_ids`` turns
# these into BIGINT for tables that may hold more rows, users or orders.
ID_COLUMNS = {
    "userId", "sessionId", "songplay_id", "user_id", "session_id",
    "p_partkey", "s_suppkey", "c_custkey",
    "lo_orderkey", "lo_custkey", "lo_partkey", "lo_suppkey",
}

STAGING = {"staging_events": EVENTS, "staging_songs": SONGS_SOURCE}
STAR = {
    "songplay": SONGPLAY,
    "users": USERS,
    "songs": SONGS,
    "artists": ARTISTS,
    "time": TIME,
}
WAREHOUSE = {**STAGING, **STAR}
TICKET_TABLES = {
    "sporting_event_ticket": TICKETS,
    "sporting_event_ticket_full": TICKETS,
}
SSB = {
    "customer": SSB_CUSTOMER,
    "dwdate": SSB_DWDATE,
    "supplier": SSB_SUPPLIER,
    "part": SSB_PART,
    "lineorder": SSB_LINEORDER,
}

# Key columns per star table, for the duplicate checks.
STAR_KEYS = {
    "songplay": ["songplay_id"],
    "users": ["user_id"],
    "songs": ["song_id"],
    "artists": ["artist_id"],
    "time": ["start_time"],
}


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.VarcharType, T.CharType))


def widen_ids(schema: T.StructType) -> T.StructType:
    """The same schema with INTEGER identifiers as BIGINT."""
    return T.StructType(
        [
            T.StructField(f.name, BIGINT, f.nullable)
            if f.name in ID_COLUMNS and f.dataType == INT
            else f
            for f in schema
        ]
    )


def readable(schema: T.StructType) -> T.StructType:
    """Schema for readers: plain strings, everything nullable."""
    return T.StructType(
        [T.StructField(f.name, TEXT if is_text(f.dataType) else f.dataType) for f in schema]
    )


def columns_ddl(schema: T.StructType) -> str:
    """Column list for CREATE TABLE. NOT NULL is left out: Spark would not
    enforce it on Parquet, so it is checked on insert and in the null report."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if not f.nullable]


def text_lengths(schema: T.StructType, default: int | None = None) -> dict[str, int]:
    """Declared byte length per text column; ``default`` covers plain text."""
    lengths = {}
    for field in schema:
        if isinstance(field.dataType, (T.VarcharType, T.CharType)):
            lengths[field.name] = field.dataType.length
        elif default is not None and is_text(field.dataType):
            lengths[field.name] = default
    return lengths


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` in order, cast to its types."""
    return df.select([_as(F.col(f"`{f.name}`"), f) for f in readable(schema)])


def _as(column: Column, field: T.StructField) -> Column:
    return column.cast(field.dataType).alias(field.name)
