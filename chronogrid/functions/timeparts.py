"""Calendar parts, cyclic encodings, time zones and timestamp parsing."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day-first text, then ISO text with or without seconds and offset.
TIMESTAMP_FORMATS = (
    "dd-MM-yyyy HH:mm",
    "dd-MM-yyyy HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
)
LOCAL_ZONE = "Europe/Amsterdam"

# Cycle length of each encoded calendar part.
CYCLE_PERIODS = {
    "day_of_year": 365.25,
    "week_of_year": 52.1775,
    "hour": 24,
    "dayofweek": 7,
    "month": 12,
    "quarter": 4,
}


def as_utc(ts: Column) -> Column:
    """Read a zone-less timestamp as UTC (session zone is pinned to UTC)."""
    return ts.cast("timestamp")


def calendar_parts(ts: Column) -> dict[str, Column]:
    """All calendar parts by name; Monday is weekday 0, weeks are ISO weeks."""
    weekday = F.weekday(ts)
    return {
        "year": F.year(ts).cast("bigint"),
        "quarter": F.quarter(ts).cast("bigint"),
        "month": F.month(ts).cast("bigint"),
        "day": F.dayofmonth(ts).cast("bigint"),
        "day_of_year": F.dayofyear(ts).cast("bigint"),
        "week_of_year": F.weekofyear(ts).cast("bigint"),
        "dayofweek": weekday.cast("bigint"),
        "hour": F.hour(ts).cast("bigint"),
        "is_weekend": weekday.isin(5, 6).cast("bigint"),
    }


def cyclic(part: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a calendar part on a cycle of the given length."""
    angle = part * F.lit(2 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def to_local(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """UTC instant to local wall-clock time, daylight saving included."""
    return F.from_utc_timestamp(ts, zone)


def to_utc(ts_local: Column, zone: str = LOCAL_ZONE) -> Column:
    """Local wall-clock time to UTC."""
    return F.to_utc_timestamp(ts_local, zone)


def parse_timestamp(text: Column, formats: tuple[str, ...] = TIMESTAMP_FORMATS) -> Column:
    """First format that fits wins, row by row; unreadable text becomes NULL."""
    tries = [F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats]
    return F.coalesce(*tries, F.try_to_timestamp(text))


def epoch_hour(ts: Column) -> Column:
    """Whole hours since 1970-01-01 UTC."""
    return F.floor(F.unix_seconds(ts) / F.lit(3600)).cast("bigint")


def date_ordinal(ts: Column) -> Column:
    """Days since 0001-01-01, which is day 1."""
    return (F.datediff(F.to_date(ts), F.lit("0001-01-01").cast("date")) + 1).cast("bigint")


def hours(n: int) -> Column:
    """Interval of n hours."""
    return F.expr(f"INTERVAL {int(n)} HOURS")


def days(n: int) -> Column:
    """Interval of n days."""
    return F.expr(f"INTERVAL {int(n)} DAYS")
