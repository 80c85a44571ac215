"""The registered queries as DuckDB SQL over the driver's tables.

Where the formulation is free it differs from the Spark one (QUALIFY, arg_max,
plain date arithmetic), so that both sides do not share a mistake.
"""

from __future__ import annotations

from starloom import schemas

# --- common table expressions ----------------------------------------------------

CTES = {
    "staging_events": """
        SELECT p.p_brand AS artist,
               CASE WHEN e.event_type = 'signup' THEN 'Logged Out' ELSE 'Logged In' END AS auth,
               'First' || (u.id % 97) AS "firstName",
               CASE u.id % 2 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END AS gender,
               CAST(e.event_id % 100 AS INTEGER) AS "itemInSession",
               'Last' || (u.id % 89) AS "lastName",
               p.p_retailprice AS length,
               CASE WHEN e.value >= 50 THEN 'paid' ELSE 'free' END AS level,
               'City ' || (e.user_id % 50) AS location,
               CASE WHEN e.event_type = 'view' THEN 'PUT' ELSE 'GET' END AS method,
               CASE WHEN e.event_type = 'view' THEN 'NextSong' ELSE e.event_type END AS page,
               CAST(1500000000000 + u.id * 1000 AS DOUBLE) AS registration,
               e.user_id * 100 + extract(day FROM e.ts) AS "sessionId",
               p.p_name AS song,
               CASE WHEN e.event_type = 'error' THEN 404 ELSE 200 END AS status,
               epoch_us(e.ts) // 1000 AS ts,
               'Agent/' || (e.user_id % 7) AS "userAgent",
               u.id AS "userId"
        FROM events e
        JOIN (SELECT event_id, CASE WHEN event_type <> 'signup' THEN user_id END AS id
              FROM events) u ON u.event_id = e.event_id
        LEFT JOIN part p
               ON p.p_partkey = TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT)
    """,
    "staging_songs": """
        SELECT 1 AS num_songs,
               'AR' || regexp_extract(p_brand, '[0-9]+') AS artist_id,
               p_size * 1.5::DOUBLE AS artist_latitude,
               180::DOUBLE - p_size AS artist_longitude,
               p_type AS artist_location,
               p_brand AS artist_name,
               'SO' || p_partkey AS song_id,
               p_name AS title,
               p_retailprice AS duration,
               p_size + 1960 AS year
        FROM part
    """,
    "fact": """
        SELECT DISTINCT
               make_timestamp((e.ts // 1000) * 1000000) AS start_time,
               e."userId" AS user_id, e.level, s.song_id, s.artist_id,
               e."sessionId" AS session_id, e.location, e."userAgent" AS user_agent
        FROM staging_events e, staging_songs s
        WHERE e.page = 'NextSong' AND s.artist_name = e.artist AND s.title = e.song
    """,
    "users": """
        SELECT "userId" AS user_id, "firstName" AS first_name, "lastName" AS last_name,
               gender, level
        FROM staging_events
        WHERE "userId" IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY "userId" ORDER BY ts DESC NULLS FIRST,
            "firstName" NULLS FIRST, "lastName" NULLS FIRST, gender NULLS FIRST,
            level NULLS FIRST) = 1
    """,
    "songs": """
        SELECT song_id, title, artist_id, year, duration
        FROM staging_songs GROUP BY ALL
    """,
    "artists": """
        SELECT artist_id, artist_name AS name, artist_location AS location,
               artist_latitude AS latitude, artist_longitude AS longitude
        FROM staging_songs
        QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY year DESC NULLS FIRST,
            artist_name NULLS FIRST, artist_location NULLS FIRST,
            artist_latitude NULLS FIRST, artist_longitude NULLS FIRST) = 1
    """,
    "times": """
        SELECT start_time,
               CAST(extract(hour FROM start_time) AS INTEGER) AS hour,
               CAST(extract(day FROM start_time) AS INTEGER) AS day,
               CAST(strftime(start_time, '%V') AS INTEGER) AS week,
               CAST(extract(month FROM start_time) AS INTEGER) AS month,
               CAST(extract(year FROM start_time) AS INTEGER) AS year,
               strftime(start_time, '%w') AS weekday
        FROM fact GROUP BY start_time
    """,
    "keyed": """
        SELECT row_number() OVER (ORDER BY start_time NULLS FIRST, user_id NULLS FIRST,
                   level NULLS FIRST, song_id NULLS FIRST, artist_id NULLS FIRST,
                   session_id NULLS FIRST, location NULLS FIRST, user_agent NULLS FIRST
               ) AS songplay_id, *
        FROM fact
    """,
    "tickets": """
        SELECT CAST(o_orderkey AS DOUBLE) AS id,
               CAST(o_orderkey % 1000 AS DOUBLE) AS sporting_event_id,
               CAST(o_orderkey % 25 AS DOUBLE) AS sport_location_id,
               CAST(o_orderkey % 10 AS INTEGER) AS seat_level,
               o_orderpriority AS seat_section,
               o_orderstatus AS seat_row,
               CAST(o_orderkey % 500 AS VARCHAR) AS seat,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS DOUBLE) END AS ticketholder_id,
               CAST(CAST(o_totalprice AS DECIMAL(8, 2)) AS DOUBLE) AS ticket_price
        FROM orders
    """,
    "priced": """
        SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS price,
               CAST(round(l_discount * 100) AS INTEGER) AS percent
        FROM lineitem
    """,
    "lineorder": """
        SELECT l_orderkey AS lo_orderkey, l_linenumber AS lo_linenumber,
               o_custkey AS lo_custkey, l_partkey AS lo_partkey, l_suppkey AS lo_suppkey,
               CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS lo_orderdate,
               o_orderpriority AS lo_orderpriority, '0' AS lo_shippriority,
               CAST(l_quantity AS INTEGER) AS lo_quantity,
               CAST(price AS INTEGER) AS lo_extendedprice,
               CAST(round(o_totalprice * 100) AS INTEGER) AS lo_ordertotalprice,
               percent AS lo_discount,
               CAST(price * (100 - percent) // 100 AS INTEGER) AS lo_revenue,
               CAST(price * 6 // 10 AS INTEGER) AS lo_supplycost,
               CAST(round(l_tax * 100) AS INTEGER) AS lo_tax,
               CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS lo_commitdate,
               'MODE ' || l_returnflag AS lo_shipmode
        FROM priced JOIN orders ON l_orderkey = o_orderkey
    """,
    "dwdate": """
        SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS d_datekey,
               strftime(day, '%B %-d, %Y') AS d_date,
               dayname(day) AS d_dayofweek,
               monthname(day) AS d_month,
               CAST(year(day) AS INTEGER) AS d_year,
               CAST(strftime(day, '%Y%m') AS INTEGER) AS d_yearmonthnum,
               strftime(day, '%b%Y') AS d_yearmonth,
               CAST(dayofweek(day) + 1 AS INTEGER) AS d_daynuminweek,
               CAST(day(day) AS INTEGER) AS d_daynuminmonth,
               CAST(dayofyear(day) AS INTEGER) AS d_daynuminyear,
               CAST(month(day) AS INTEGER) AS d_monthnuminyear,
               CAST(strftime(day, '%V') AS INTEGER) AS d_weeknuminyear,
               CASE WHEN month(day) = 12 THEN 'Christmas' WHEN month(day) >= 9 THEN 'Fall'
                    WHEN month(day) >= 6 THEN 'Summer' WHEN month(day) >= 3 THEN 'Spring'
                    ELSE 'Winter' END AS d_sellingseason,
               CASE WHEN dayname(day) = 'Saturday' THEN '1' ELSE '0' END AS d_lastdayinweekfl,
               CASE WHEN day(day + INTERVAL 1 DAY) = 1 THEN '1' ELSE '0' END AS d_lastdayinmonthfl,
               CASE WHEN strftime(day, '%m%d') = '1225' THEN '1' ELSE '0' END AS d_holidayfl,
               CASE WHEN dayname(day) IN ('Saturday', 'Sunday') THEN '0' ELSE '1' END AS d_weekdayfl
        FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE))::TIMESTAMP,
                  max(CAST(o_orderdate AS DATE))::TIMESTAMP, INTERVAL 1 DAY)) AS day
              FROM orders)
    """,
    "ssb_part": """
        SELECT p_partkey, p_name, m AS p_mfgr, m || (1 + (b - 1) // 5) AS p_category,
               m || (1 + (b - 1) // 5) || (1 + p_size % 40) AS p_brand1,
               split_part(p_name, ' ', 1) AS p_color, p_type, p_size,
               'BOX ' || (p_size % 10) AS p_container
        FROM (SELECT *, 'MFGR#' || (1 + (b - 1) % 5) AS m
              FROM (SELECT *, CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS b FROM part))
    """,
    "ssb_supplier": """
        SELECT s_suppkey, s_name, 'Street ' || (s_suppkey % 1000) AS s_address,
               substr(rpad(n_name, 9, ' '), 1, 9) || (s_suppkey % 2) AS s_city,
               n_name AS s_nation, r_name AS s_region,
               '10-' || (s_suppkey % 1000000) AS s_phone
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
    """,
    "ssb_customer": """
        SELECT c_custkey, c_name, 'Street ' || (c_custkey % 1000) AS c_address,
               substr(rpad(n_name, 9, ' '), 1, 9) || (c_custkey % 2) AS c_city,
               n_name AS c_nation, r_name AS c_region,
               '10-' || (c_custkey % 1000000) AS c_phone, c_mktsegment
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
    """,
    "one_dim": """
        SELECT CAST(sum(CAST(lo_extendedprice AS BIGINT) * lo_discount) AS BIGINT) AS revenue
        FROM lineorder
        WHERE lo_discount IN (1, 2, 3) AND lo_quantity <= 23
          AND lo_orderdate IN (SELECT d_datekey FROM dwdate WHERE d_year = 1997)
    """,
    "two_dim": """
        SELECT d_year, p_brand1, CAST(sum(lo_revenue) AS BIGINT) AS revenue
        FROM lineorder
        JOIN dwdate ON d_datekey = lo_orderdate
        JOIN ssb_part ON p_partkey = lo_partkey AND p_category = 'MFGR#12'
        JOIN ssb_supplier ON s_suppkey = lo_suppkey AND s_region = 'AMERICA'
        GROUP BY ALL
    """,
    "drill": """
        SELECT c_city, s_city, d_year, CAST(sum(lo_revenue) AS BIGINT) AS revenue
        FROM lineorder
        JOIN dwdate ON d_datekey = lo_orderdate AND d_yearmonth = 'Dec1997'
        JOIN ssb_supplier ON s_suppkey = lo_suppkey AND s_city LIKE 'NATION_9 %'
        JOIN ssb_customer ON c_custkey = lo_custkey AND c_city LIKE 'NATION_2 %'
        GROUP BY ALL
    """,
    "same_dist": """
        SELECT lo_orderdate,
               CAST(sum(CAST(lo_extendedprice AS BIGINT) * lo_discount) AS BIGINT) AS revenue
        FROM lineorder JOIN part ON p_partkey = lo_partkey
        GROUP BY lo_orderdate
    """,
}

# What each expression reads, in the order it must be defined.
NEEDS = {
    "fact": ["staging_events", "staging_songs"],
    "users": ["staging_events"],
    "songs": ["staging_songs"],
    "artists": ["staging_songs"],
    "times": ["fact"],
    "keyed": ["fact"],
    "lineorder": ["priced"],
    "one_dim": ["lineorder", "dwdate"],
    "two_dim": ["lineorder", "dwdate", "ssb_part", "ssb_supplier"],
    "drill": ["lineorder", "dwdate", "ssb_supplier", "ssb_customer"],
    "same_dist": ["lineorder"],
}


def _over(names: str, body: str) -> str:
    """``body`` after WITH clauses for the named expressions and their inputs."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    clauses = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in ordered)
    return f"WITH {clauses}\n{body.strip()}"


def _rows_of(name: str) -> str:
    return _over(name, f"SELECT * FROM {name}")


def _repeated(name: str, keys: str) -> str:
    return f"SELECT {keys}, count(*) AS occurrences FROM {name} GROUP BY {keys} HAVING count(*) > 1"


def _checked(label: str, name: str, keys: str) -> str:
    return f"""
        SELECT '{label}' AS table_name, n AS row_count, d AS duplicate_keys, x AS extra_rows,
               CASE WHEN d > 0 THEN 'Duplicates found' ELSE 'No duplicates found' END AS verdict
        FROM (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n,
                     count(*) FILTER (c > 1) AS d,
                     CAST(coalesce(sum(c), 0) - count(*) AS BIGINT) AS x
              FROM (SELECT count(*) AS c FROM {name} GROUP BY {keys}))"""


def _null_count(label: str, name: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, '{c}' AS column_name, "
        f'count(*) FILTER ("{c}" IS NULL) AS nulls FROM {name}'
        for c in columns
    )


def _too_long(label: str, name: str, lengths: dict[str, int]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, '{c}' AS column_name, "
        f'count(*) FILTER (strlen("{c}") > {n}) AS too_long FROM {name}'
        for c, n in lengths.items()
    )


# Benchmark tables by the name of their expression.
_SSB = {
    "customer": "ssb_customer",
    "dwdate": "dwdate",
    "supplier": "ssb_supplier",
    "part": "ssb_part",
    "lineorder": "lineorder",
}


def _loaded(label: str, name: str, declared) -> str:
    """Rows, NULLs and overlong texts of each column, as a load reports them."""
    lengths = schemas.text_lengths(declared, schemas.DEFAULT_TEXT_BYTES)

    def too_long(c: str) -> str:
        if c not in lengths:
            return "CAST(NULL AS BIGINT)"
        return f'count(*) FILTER (strlen("{c}") > {lengths[c]})'

    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, '{c}' AS column_name, count(*) AS row_count, "
        f'count(*) FILTER ("{c}" IS NULL) AS nulls, {too_long(c)} AS too_long FROM {name}'
        for c in declared.names
    )


def _counts(names: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, count(*) AS row_count FROM {name}"
        for label, name in names.items()
    )


_STAR = {
    "songplay": "fact",
    "users": "users",
    "songs": "songs",
    "artists": "artists",
    "time": "times",
}

_STAR_CHECKS = [
    _checked("songplay", "keyed", "songplay_id"),
    _checked("users", "users", "user_id"),
    _checked("songs", "songs", "song_id"),
    _checked("artists", "artists", "artist_id"),
    _checked("time", "times", "start_time"),
]


_TICKETS_AS_TEXT = (
    "SELECT * REPLACE (CAST(CAST(seat_level AS DECIMAL(1, 0)) AS VARCHAR) AS seat_level, "
    "CAST(CAST(ticket_price AS DECIMAL(8, 2)) AS VARCHAR) AS ticket_price) FROM tickets"
)


def oracle_sql() -> dict[str, str]:
    star = "keyed users songs artists times"
    return {
        "songplay_fact": _rows_of("fact"),
        "songplay_keyed": _rows_of("keyed"),
        "users_latest": _rows_of("users"),
        "songs_dim": _rows_of("songs"),
        "artists_latest": _rows_of("artists"),
        "time_dim": _rows_of("times"),
        "dup_songplay": _over("keyed", _repeated("keyed", "songplay_id")),
        "dup_users": _over("users", _repeated("users", "user_id")),
        "dup_songs": _over("songs", _repeated("songs", "song_id")),
        "dup_artists": _over("artists", _repeated("artists", "artist_id")),
        "dup_time": _over("times", _repeated("times", "start_time")),
        "dup_songplay_natural": _over(
            "fact", _repeated("fact", "start_time, user_id, session_id")
        ),
        "dup_catalogue_name": _over(
            "staging_songs", _repeated("staging_songs", "artist_name, title")
        ),
        "dup_users_distinct": _over(
            "staging_events",
            """
            SELECT "userId", count(*) AS occurrences
            FROM (SELECT DISTINCT "userId", level FROM staging_events WHERE "userId" IS NOT NULL)
            GROUP BY ALL HAVING count(*) > 1
            """,
        ),
        "dup_lineitem": _repeated("lineitem", "l_orderkey, l_linenumber"),
        "duplicate_report": _over(
            star,
            " UNION ALL ".join(
                [
                    *_STAR_CHECKS,
                    _checked("songplay natural key", "fact", "start_time, user_id, session_id"),
                    _checked("catalogue names", "staging_songs", "artist_name, title"),
                    _checked("lineitem", "lineitem", "l_orderkey, l_linenumber"),
                ]
            ),
        ),
        "duplicate_report_by_hash": _over(
            star,
            " UNION ALL ".join(
                [
                    *_STAR_CHECKS,
                    _checked("songplay natural key", "fact", "start_time, user_id, session_id"),
                    _checked("catalogue names", "staging_songs", "artist_name, title"),
                    _checked("lineitem", "lineitem", "l_orderkey, l_linenumber"),
                ]
            ),
        ),
        "null_report": _over(
            "users songs artists times tickets " + " ".join(_SSB.values()),
            " UNION ALL ".join(
                [
                    _null_count("staging_events", "staging_events", schemas.EVENTS.names),
                    _null_count("staging_songs", "staging_songs", schemas.SONGS_SOURCE.names),
                    _null_count("users", "users", ["user_id"]),
                    _null_count("songs", "songs", ["song_id"]),
                    _null_count("artists", "artists", ["artist_id"]),
                    _null_count("time", "times", ["start_time"]),
                    _null_count("sporting_event_ticket", "tickets", schemas.TICKETS.names),
                    *[
                        _null_count(table, name, schemas.required_columns(schemas.SSB[table]))
                        for table, name in _SSB.items()
                    ],
                ]
            ),
        ),
        "length_report": _over(
            "staging_events staging_songs tickets " + " ".join(_SSB.values()),
            " UNION ALL ".join(
                [
                    _too_long(
                        "staging_events",
                        "staging_events",
                        schemas.text_lengths(schemas.EVENTS, schemas.DEFAULT_TEXT_BYTES),
                    ),
                    _too_long(
                        "staging_songs",
                        "staging_songs",
                        schemas.text_lengths(schemas.SONGS_SOURCE, schemas.DEFAULT_TEXT_BYTES),
                    ),
                    _too_long(
                        "sporting_event_ticket", "tickets", schemas.text_lengths(schemas.TICKETS)
                    ),
                    _too_long(
                        "documents",
                        "documents",
                        {"text": schemas.DEFAULT_TEXT_BYTES, "lang": 1, "source": 4},
                    ),
                    *[
                        _too_long(table, name, schemas.text_lengths(schemas.SSB[table]))
                        for table, name in _SSB.items()
                    ],
                ]
            ),
        ),
        "json_paths_scan": _rows_of("staging_events"),
        "json_flat_scan": _rows_of("staging_events"),
        "json_auto_scan": _rows_of("staging_songs"),
        "delimited_scan": _over("tickets", _TICKETS_AS_TEXT),
        "delimited_scan_spread": _over("tickets", _TICKETS_AS_TEXT),
        "delimited_scan_pipe": _rows_of("lineorder"),
        "append_twice": _over(
            "tickets", f"{_TICKETS_AS_TEXT} UNION ALL {_TICKETS_AS_TEXT}"
        ),
        "star_roundtrip": _over("fact users songs artists times", _counts(_STAR)),
        "dup_songplay_natural_by_hash": _over(
            "fact", _repeated("fact", "start_time, user_id, session_id")
        ),
        "dup_catalogue_name_by_hash": _over(
            "staging_songs", _repeated("staging_songs", "artist_name, title")
        ),
        "etl_load_figures": _over(
            "staging_events staging_songs " + star,
            " UNION ALL ".join(
                [
                    _loaded("staging_events", "staging_events", schemas.EVENTS),
                    _loaded("staging_songs", "staging_songs", schemas.SONGS_SOURCE),
                    _loaded("songplay", "keyed", schemas.SONGPLAY),
                    _loaded("users", "users", schemas.USERS),
                    _loaded("songs", "songs", schemas.SONGS),
                    _loaded("artists", "artists", schemas.ARTISTS),
                    _loaded("time", "times", schemas.TIME),
                ]
            ),
        ),
        "overlong_load": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {most} AS allowed, "
            f"coalesce(max(strlen({c})), 0) > {most} AS refused, "
            f"CASE WHEN coalesce(max(strlen({c})), 0) > {most} THEN 0 ELSE count(*) END AS row_count "
            "FROM documents"
            for c, most in (("text", schemas.DEFAULT_TEXT_BYTES), ("lang", 2), ("source", 4))
        ),
        "load_diagnosis": _over(
            "staging_events",
            """
            SELECT column_name, kind, count(*) AS lines
            FROM (SELECT CASE WHEN "itemInSession" % 50 = 9 THEN 'userId' END AS column_name,
                         CASE WHEN "itemInSession" % 50 = 9 THEN 'not a valid bigint'
                              ELSE 'no JSON object' END AS kind
                  FROM staging_events WHERE "itemInSession" % 50 IN (7, 9))
            GROUP BY ALL
            """,
        ),
        "users_two_appends": _rows_of("users"),
        "artists_two_appends": _rows_of("artists"),
        "offending_keys": _over(
            "users songs",
            "SELECT 'users' AS table_name, CAST(user_id AS VARCHAR) AS key, "
            "CAST(2 AS BIGINT) AS occurrences FROM users UNION ALL "
            "SELECT 'songs', coalesce(song_id, 'NULL'), 2 * count(*) FROM songs GROUP BY song_id",
        ),
        "lineitem_keyed_in_place": "SELECT unnest(range(1, (SELECT count(*) FROM lineitem) + 1)) AS line_id",
        "layout_hybrid_join": """
            SELECT coalesce(p_brand, 'unknown') AS p_brand, count(*) AS line_count,
                   CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
            FROM (SELECT l_quantity, CASE WHEN l_returnflag <> 'R' THEN l_partkey ELSE -1 END AS k
                  FROM lineitem) LEFT JOIN part ON p_partkey = k
            WHERE k = -1 OR p_partkey IS NOT NULL
            GROUP BY ALL
        """,
        "paired_gains": """
            WITH gains AS (
              SELECT l_suppkey, 100 * (p - c) / p AS gain
              FROM (SELECT l_suppkey, l_extendedprice AS p,
                           l_extendedprice * (1 - l_discount) * (1 + l_tax) AS c FROM lineitem)
              WHERE p > 0 AND c IS NOT NULL
            ), counted AS (
              SELECT l_suppkey, count(*) AS pairs, count(*) FILTER (gain > 0) AS wins,
                     count(*) FILTER (gain < 0) AS losses, round(median(gain), 6) AS median_gain,
                     round(min(gain), 6) AS least_gain, round(max(gain), 6) AS most_gain
              FROM gains GROUP BY l_suppkey
            ), tested AS (
              SELECT *, CASE WHEN wins + losses = 0 THEN 1.0::DOUBLE ELSE least(1.0::DOUBLE, 2 * list_sum(
                list_transform(range(0, least(wins, losses) + 1), lambda i:
                  exp(lgamma(wins + losses + 1) - lgamma(i + 1) - lgamma(wins + losses - i + 1)
                      - (wins + losses) * ln(2))))) END AS p
              FROM counted
            )
            SELECT l_suppkey, pairs, wins, losses, median_gain, least_gain, most_gain,
                   round(p, 6) AS p_value, p < 0.05 AS proven
            FROM tested
        """,
        "etl_report": _over(star, " UNION ALL ".join(_STAR_CHECKS)),
        "ssb_one_dim": _rows_of("one_dim"),
        "ssb_two_dim": _rows_of("two_dim"),
        "ssb_drill": _rows_of("drill"),
        "ssb_same_dist": _rows_of("same_dist"),
        "ssb_two_dim_filtered": _rows_of("two_dim"),
        "ssb_drill_filtered": _rows_of("drill"),
        "layout_bucketed_join": _rows_of("same_dist"),
        "layout_load": _over(
            " ".join(_SSB.values()),
            " UNION ALL ".join(
                f"SELECT '{table}' AS table_name, count(*) AS rows_nodist, count(*) AS rows_dist "
                f"FROM {name}"
                for table, name in _SSB.items()
            ),
        ),
        "layout_agreement": _over(
            "one_dim two_dim drill same_dist",
            " UNION ALL ".join(
                f"SELECT '{q}' AS query, count(*) AS result_rows, "
                f"CAST(0 AS BIGINT) AS differing_rows FROM {q}"
                for q in ("one_dim", "two_dim", "drill", "same_dist")
            ),
        ),
        "layout_gain": _over(
            "one_dim two_dim drill same_dist",
            " UNION ALL ".join(
                f"SELECT '{q}' AS query, count(*) AS result_rows, "
                f"CAST(0 AS BIGINT) AS differing_rows, true AS timed, true AS gain_is_percent FROM {q}"
                for q in ("one_dim", "two_dim", "drill", "same_dist")
            ),
        ),
        "layout_hot_bucket": "SELECT l_returnflag, count(*) AS row_count, 'lineitem' AS table_name, "
        "16 AS buckets, true AS hot FROM lineitem GROUP BY l_returnflag",
        "most_played": _over(
            "fact songs",
            """
            SELECT song_id, (SELECT min(title) FROM songs s WHERE s.song_id = f.song_id) AS title,
                   plays
            FROM (SELECT song_id, count(*) AS plays FROM fact GROUP BY song_id
                  ORDER BY plays DESC, song_id LIMIT 10) f
            """,
        ),
        "plays_by_hour": _over(
            "fact",
            "SELECT CAST(extract(hour FROM start_time) AS INTEGER) AS hour, count(*) AS plays "
            "FROM fact GROUP BY ALL",
        ),
        "row_counts": _over(
            "fact users songs artists times",
            _counts(
                {"staging_events": "staging_events", "staging_songs": "staging_songs", **_STAR}
            ),
        ),
    }
