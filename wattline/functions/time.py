"""Time expressions: buckets, parsing, calendar attributes."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted timestamp layouts besides ISO, each with the shape that selects it.
TIMESTAMP_LAYOUTS = (
    (r"^\d{1,2}/\d{1,2}/\d{4} ", "d/M/yyyy H:m:s"),
    (r"^\d{4}-\d{2}-\d{2} \d{1,2}-\d{1,2}-\d{1,2}$", "yyyy-MM-dd H-m-s"),
)
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}"


def floor_bucket(ts: Column, minutes: int) -> Column:
    """Start of the N-minute bucket counted from midnight of the same day."""
    day = F.date_trunc("day", ts)
    minute_of_day = F.hour(ts) * 60 + F.minute(ts)
    start = F.floor(minute_of_day / minutes) * minutes
    return F.timestamp_seconds(F.unix_timestamp(day) + start * 60)


def time_bucket(ts: Column, width: str) -> Column:
    """Start of the fixed-width bucket; calendar units use ``date_trunc`` so they stay codegen-friendly."""
    unit = {"1 hour": "hour", "1 day": "day", "1 minute": "minute"}.get(width)
    return F.date_trunc(unit, ts) if unit else F.window(ts, width)["start"]


def parse_time(text: Column, strict: bool = False) -> Column:
    """Timestamp from ISO text (with or without zone) or one of the known layouts; null or error otherwise."""
    trimmed = F.trim(text)
    # The shape picks one parser per value, so no row pays for failed attempts.
    parsed = F.when(trimmed.isNull(), F.lit(None).cast("timestamp"))
    for shape, layout in TIMESTAMP_LAYOUTS:
        parsed = parsed.when(trimmed.rlike(shape), F.try_to_timestamp(trimmed, F.lit(layout)))
    parsed = parsed.when(trimmed.rlike(ISO_SHAPE), trimmed.try_cast("timestamp"))
    if not strict:
        return parsed
    failed = F.raise_error(F.concat(F.lit("Unsupported timestamp format: "), text)).cast("timestamp")
    return F.when(text.isNull() | parsed.isNotNull(), parsed).otherwise(failed)


def minutes_between(later: Column, earlier: Column) -> Column:
    """Whole minutes from ``earlier`` to ``later``, rounded down."""
    return F.floor((F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(60_000_000))


def plus_minutes(ts: Column, minutes: Column) -> Column:
    """``ts`` shifted by a whole number of minutes given per row."""
    return F.timestamp_micros(F.unix_micros(ts) + minutes.cast("long") * F.lit(60_000_000))


def date_key(ts: Column) -> Column:
    """Integer yyyymmdd."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def day_of_week(ts: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(ts) - 1).cast("int")


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def season(ts: Column) -> Column:
    """Meteorological season of the northern hemisphere."""
    month = F.month(ts)
    return (
        F.when(month.isin(12, 1, 2), "winter")
        .when(month.between(3, 5), "spring")
        .when(month.between(6, 8), "summer")
        .otherwise("autumn")
    )


def calendar_features(ts: Column) -> dict[str, Column]:
    """Cyclic hour-of-day and weekday (Monday = 0) coordinates."""
    hour_angle = (F.hour(ts) + F.minute(ts) / 60.0) * (2 * math.pi / 24)
    week_angle = F.weekday(ts) * (2 * math.pi / 7)
    return {
        "hour_sin": F.sin(hour_angle),
        "hour_cos": F.cos(hour_angle),
        "dow_sin": F.sin(week_angle),
        "dow_cos": F.cos(week_angle),
    }


def horizon_steps(hours: int, cadence: Column) -> Column:
    """Number of samples covering ``hours`` at a cadence in minutes, at least one."""
    return F.greatest(F.lit(1), F.floor(F.lit(hours * 60) / cadence)).cast("int")
