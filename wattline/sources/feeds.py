"""Normalisers of raw feeds into canonical readings."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.text import amp_to_kw, find_column, kw_to_kwh, normalize_name
from wattline.functions.time import minutes_between, parse_time, plus_minutes
from wattline.schema import require_columns

# Header spellings of long CSV feeds, in order of preference.
METER_HEADERS = ("lclid", "meter_id", "household_id", "id")
TIME_HEADERS = ("tstp", "timestamp", "time", "datetime", "date_time")
KWH_HEADERS = ("energy(kwh/halfhour)", "energy_kwh_halfhour", "kwh", "energy")
# Header spellings of the time column of a city sheet.
SHEET_TIME_HEADERS = ("timestamp", "time", "datetime", "date", "date_time")
# Meter and source names of the feeds.
MINUTE_POWER_METER = "UCI_HOUSEHOLD_001"
MINUTE_POWER_SOURCE = "uci_household_power"
SERIES_SOURCE = "london_smart_meters"
CITY_SOURCE = "morocco_high_resolution"
INTERVAL_SOURCE = "nigeria_smart_meter"
INTERVAL_UNKNOWN_METER = "NIG_UNKNOWN"


def _canonical(df: DataFrame, time: Column, meter: Column, kwh: Column, source: str, max_rows: int = 0) -> DataFrame:
    out = df.select(
        time.alias("time"),
        meter.alias("meter_id"),
        kwh.cast("double").alias("kwh"),
        F.lit(False).alias("is_anomaly"),
        F.lit(source).alias("source"),
    )
    return out.limit(max_rows) if max_rows else out


def read_minute_power(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon text of one-minute active power; a question mark means missing."""
    return spark.read.csv(path, sep=";", header=True, encoding="ISO-8859-1", nullValue="?")


def normalize_minute_power(
    df: DataFrame, meter_id: str = MINUTE_POWER_METER, source: str = MINUTE_POWER_SOURCE, max_rows: int = 0
) -> DataFrame:
    """kW sampled every minute to kWh per minute; rows without a value are dropped."""
    power = F.nullif(F.nullif(F.trim("Global_active_power"), F.lit("?")), F.lit("")).cast("double")
    rows = df.withColumn("_kw", power).filter(F.col("_kw").isNotNull())
    stamp = F.to_timestamp(F.concat_ws(" ", "Date", "Time"), "d/M/yyyy H:m:s")
    return _canonical(rows, stamp, F.lit(meter_id), F.round(kw_to_kwh(F.col("_kw"), 1), 8), source, max_rows)


def normalize_series_lines(
    df: DataFrame, step_minutes: int = 30, source: str = SERIES_SOURCE, max_rows: int = 0
) -> DataFrame:
    """``meter:start:v0,v1,...`` lines to one row per value.

    Header (``@``), comment (``#``) and blank lines are skipped, as are lines without three parts and
    empty or ``?`` values; the offset in the list sets the time.
    """
    line = F.trim("value")
    data = df.filter((line != "") & ~F.substring(line, 1, 1).isin("@", "#"))
    parts = F.split(line, ":", 3)
    data = data.select(parts.alias("p")).filter(F.size("p") == 3)
    values = data.select(
        F.col("p")[0].alias("meter_id"),
        F.to_timestamp(F.trim(F.col("p")[1]), "yyyy-MM-dd H-m-s").alias("start"),
        F.posexplode(F.split(F.col("p")[2], ",")).alias("offset", "text"),
    ).withColumn("text", F.trim("text"))
    kept = values.filter(~F.col("text").isin("", "?"))
    time = plus_minutes(F.col("start"), F.col("offset") * step_minutes)
    return _canonical(kept, time, F.col("meter_id"), F.col("text"), source, max_rows)


def normalize_long_csv(df: DataFrame, source: str = SERIES_SOURCE, max_rows: int = 0) -> DataFrame | None:
    """Long CSV with varying headers; ``None`` when a needed column cannot be recognised."""
    meter, time, kwh = (find_column(df.columns, names) for names in (METER_HEADERS, TIME_HEADERS, KWH_HEADERS))
    if not (meter and time and kwh):
        return None
    value = F.trim(F.col(f"`{kwh}`").cast("string"))
    kept = df.filter(~F.lower(value).isin("", "null", "nan"))
    stamp = F.col(f"`{time}`")
    stamp = stamp if dict(df.dtypes)[time].startswith("timestamp") else parse_time(stamp)
    return _canonical(kept, stamp.cast("timestamp"), F.col(f"`{meter}`"), value, source, max_rows)


def sheet_minutes(name: str, df: DataFrame | None = None, time_column: str | None = None) -> int:
    """Sampling period of a city sheet: from the file name, else from its two earliest rows, else 10."""
    lowered = name.lower()
    for mark, minutes in (("30t", 30), ("30min", 30), ("10t", 10), ("10min", 10)):
        if mark in lowered:
            return minutes
    if df is None or time_column is None:
        return 10
    stamp = F.col(f"`{time_column}`")
    stamp = stamp if dict(df.dtypes)[time_column].startswith("timestamp") else parse_time(stamp)
    times = df.select(stamp.alias("_time")).filter("_time IS NOT NULL")
    first = [row[0] for row in times.orderBy("_time").limit(2).collect()]
    return (int((first[1] - first[0]).total_seconds() // 60) or 10) if len(first) == 2 else 10


def unpivot_city(
    df: DataFrame, stem: str, unit: str = "ampere", minutes: int | None = None, source: str = CITY_SOURCE
) -> DataFrame:
    """Wide sheet (one column per zone) to readings named ``stem_zone``.

    ``unit`` is ``ampere`` (converted with the fixed factor) or ``kw``; cells that are not numbers vanish.
    """
    columns = df.columns
    time = find_column(columns, SHEET_TIME_HEADERS) or columns[0]
    zones = [name for name in columns if name != time]
    minutes = minutes or sheet_minutes(stem, df, time)
    cells = df.select(F.col(f"`{time}`").alias("_t"), *[F.col(f"`{z}`").cast("string").alias(z) for z in zones])
    long = cells.unpivot(["_t"], [F.col(f"`{z}`") for z in zones], "zone", "cell")
    long = long.withColumn("v", F.trim("cell").try_cast("double")).filter("v IS NOT NULL")
    kw = F.col("v") if unit == "kw" else amp_to_kw(F.col("v"))
    time_value = F.col("_t") if dict(df.dtypes)[time].startswith("timestamp") else parse_time(F.col("_t"))
    meter = F.concat(F.lit(f"{stem}_"), normalize_name(F.col("zone")))
    return _canonical(long, time_value.cast("timestamp"), meter, F.round(kw_to_kwh(kw, minutes), 8), source)


def city_unit(stem: str) -> str:
    """Only the Marrakech sheet is in kW, the others are in amperes."""
    return "kw" if re.search("marrakech", stem, re.IGNORECASE) else "ampere"


def normalize_interval_kwh(
    df: DataFrame, source: str = INTERVAL_SOURCE, unknown: str = INTERVAL_UNKNOWN_METER, max_rows: int = 0
) -> DataFrame:
    """Tabular electrical feed: interval kWh as is, missing values dropped, blank meters named."""
    require_columns(df.columns, {"timestamp", "meter_id", "consumption_kwh"}, "electrical feed")
    kept = df.filter(F.col("consumption_kwh").isNotNull())
    stamp = F.col("timestamp")
    stamp = stamp if dict(df.dtypes)["timestamp"].startswith("timestamp") else parse_time(stamp)
    meter = F.coalesce(F.nullif(F.col("meter_id"), F.lit("")), F.lit(unknown))
    return _canonical(
        kept, stamp.cast("timestamp"), meter, F.round(F.col("consumption_kwh").cast("double"), 8), source, max_rows
    )


def series_lines(df: DataFrame, step_minutes: int, days_per_line: int = 1) -> DataFrame:
    """Inverse of :func:`normalize_series_lines`: text lines of regular series, one per meter and span of days.

    Values are summed per slot, so a line is bounded by the calendar; empty slots become ``?``.
    """
    slots = days_per_line * 1440 // step_minutes
    span_seconds = days_per_line * 86_400
    start = F.timestamp_seconds(F.floor(F.unix_timestamp("time") / span_seconds) * span_seconds)
    offset = F.floor(minutes_between(F.col("time"), F.col("_start")) / step_minutes).cast("int")
    placed = df.withColumn("_start", start).withColumn("_slot", offset)
    placed = placed.groupBy("meter_id", "_start", "_slot").agg(F.sum("kwh").alias("kwh"))
    lines = placed.groupBy("meter_id", "_start").agg(
        F.map_from_entries(F.collect_list(F.struct("_slot", F.col("kwh").cast("string")))).alias("_by_slot")
    )
    texts = F.transform(
        F.sequence(F.lit(0), F.lit(slots - 1)), lambda i: F.coalesce(F.try_element_at("_by_slot", i), F.lit("?"))
    )
    return lines.select(
        F.concat_ws(
            ":", "meter_id", F.date_format("_start", "yyyy-MM-dd HH-mm-ss"), F.array_join(texts, ",")
        ).alias("value")
    )


