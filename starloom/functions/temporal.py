"""Timestamp expressions. All run inside whole-stage codegen and none depends
on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms_to_seconds(ms: Column) -> Column:
    """Epoch milliseconds as a zone-less timestamp, cut to whole seconds.

    Integer division drops the milliseconds; a fractional one would keep them
    and split plays that share a second.
    """
    seconds = F.call_function("div", ms, F.lit(1000))
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + seconds.cast("interval second")


def date_key(ts: Column) -> Column:
    """Calendar date as an integer yyyymmdd, without formatting text."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def calendar_parts(ts: Column) -> list[Column]:
    """hour, day, ISO week, month, calendar year and weekday of a timestamp.

    ``weekday`` is text with Sunday as "0". Around New Year the ISO week can
    belong to the other year than ``year``.
    """
    return [
        F.hour(ts).alias("hour"),
        F.dayofmonth(ts).alias("day"),
        F.weekofyear(ts).alias("week"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        (F.dayofweek(ts) - 1).cast("string").alias("weekday"),
    ]
