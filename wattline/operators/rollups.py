"""Rollups, dashboard queries and top lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.time import floor_bucket, time_bucket
from wattline.sinks.tables import replace_slice, time_chunk

# Refresh window and lag of each maintained rollup.
REFRESH_POLICIES = {
    "15 minutes": (timedelta(days=1), timedelta(minutes=15)),
    "1 hour": (timedelta(hours=3), timedelta(hours=1)),
    "1 day": (timedelta(days=7), timedelta(days=1)),
}


def time_filter(df: DataFrame, column: str, lo: datetime, hi: datetime) -> DataFrame:
    """Rows with ``lo <= column <= hi``; the matching chunk predicate is added so that folders are pruned."""
    lo, hi = F.lit(lo).cast("timestamp"), F.lit(hi).cast("timestamp")
    kept = df.filter(F.col(column).between(lo, hi))
    if "time_chunk" in df.columns:
        kept = kept.filter(F.col("time_chunk").between(time_chunk(lo), time_chunk(hi)))
    return kept


def since(df: DataFrame, column: str, interval: str, now: datetime) -> DataFrame:
    """Rows no older than ``interval`` before ``now``."""
    return df.filter(F.col(column) >= F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {interval}"))


def rollup_columns(width: str, anomalies: bool = False) -> list[Column]:
    """Aggregates of a rollup; the daily one names its maximum a peak and counts anomalies."""
    daily = width == "1 day"
    columns = [
        F.sum("kwh").alias("kwh_total"),
        F.avg("kwh").alias("kwh_avg"),
        F.max("kwh").alias("kwh_peak" if daily else "kwh_max"),
    ]
    if not daily:
        columns.append(F.count(F.lit(1)).alias("reading_count"))
    if daily or anomalies:
        columns.append(F.count_if(F.coalesce("is_anomaly", F.lit(False))).alias("anomaly_count"))
    return columns


def rollup(df: DataFrame, width: str, keys: Sequence[str] = ("meter_id",), anomalies: bool = False) -> DataFrame:
    """Totals per fixed-width bucket and key, combined on the map side."""
    return df.groupBy(time_bucket(F.col("time"), width).alias("bucket"), *keys).agg(*rollup_columns(width, anomalies))


def refresh_rollup(
    existing: DataFrame,
    raw: DataFrame,
    width: str,
    lo: datetime | None = None,
    hi: datetime | None = None,
    keys: Sequence[str] = ("meter_id",),
) -> DataFrame:
    """Recompute the buckets lying fully inside ``[lo, hi)`` and replace them; no bounds means a rebuild."""
    if lo is None and hi is None:
        return rollup(raw, width, keys)
    step = F.expr(f"INTERVAL {width}")

    def covered(bucket: Column) -> Column:
        inside = F.lit(True)
        if lo is not None:
            inside = inside & (bucket >= F.lit(lo).cast("timestamp"))
        if hi is not None:
            inside = inside & (bucket + step <= F.lit(hi).cast("timestamp"))
        return inside

    # The plain time bounds reach the scan; the bucket condition then drops partly covered edges.
    if lo is not None:
        raw = raw.filter(F.col("time") >= F.lit(lo).cast("timestamp"))
    if hi is not None:
        raw = raw.filter(F.col("time") < F.lit(hi).cast("timestamp"))
    fresh = rollup(raw, width, keys).filter(covered(F.col("bucket")))
    return replace_slice(existing, fresh, covered(F.col("bucket")))


def scheduled_refresh(
    existing: DataFrame, raw: DataFrame, width: str, now: datetime, keys: Sequence[str] = ("meter_id",)
) -> DataFrame:
    """Refresh of a rollup as its policy does at ``now``: the recent window, without the still open buckets."""
    start, end = REFRESH_POLICIES[width]
    return refresh_rollup(existing, raw, width, now - start, now - end, keys)


def resample(df: DataFrame, minutes: int, keys: Sequence[str] = ("meter_id", "source")) -> DataFrame:
    """Readings summed per bucket of the day and key, labels reset; values kept to eight decimals."""
    grouped = df.groupBy(floor_bucket(F.col("time"), minutes).alias("time"), *keys)
    out = grouped.agg(F.round(F.sum("kwh"), 8).alias("kwh")).withColumn("is_anomaly", F.lit(False))
    return out.select("time", *keys, "kwh", "is_anomaly")


def resample_meta(raw: DataFrame, resampled: DataFrame, minutes: int) -> DataFrame:
    """One row describing a resample."""
    before = raw.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_distinct("meter_id").alias("distinct_meters"),
        F.min("time").alias("start_timestamp"),
        F.max("time").alias("end_timestamp"),
    )
    rows_out = resampled.agg(F.count(F.lit(1)).alias("rows_out"))
    return before.select(
        "rows_in",
        rows_out.scalar().alias("rows_out"),
        "distinct_meters",
        "start_timestamp",
        "end_timestamp",
        F.lit(minutes).alias("target_frequency_minutes"),
    )


def load_curve(hourly: DataFrame, meter_id: str, lo: datetime | None = None) -> DataFrame:
    """Bucket totals of one meter in time order."""
    picked = hourly.filter(F.col("meter_id") == meter_id)
    if lo is not None:
        picked = picked.filter(F.col("bucket") >= F.lit(lo).cast("timestamp"))
    return picked.select("bucket", "kwh_total").orderBy("bucket")


def total_load(hourly: DataFrame) -> DataFrame:
    """Consumption of all meters per bucket."""
    return hourly.groupBy(F.col("bucket").alias("time")).agg(F.sum("kwh_total").alias("kwh"))


def forecast_vs_actual(readings: DataFrame, predictions: DataFrame) -> DataFrame:
    """Actual and predicted totals per time; either side may be missing."""
    actual = readings.groupBy("time").agg(F.sum("kwh").alias("actual"))
    predicted = predictions.groupBy("time").agg(F.sum("kwh_pred").alias("predicted"))
    return actual.join(predicted, "time", "full")


def by_source(df: DataFrame) -> DataFrame:
    return df.groupBy(F.coalesce("source", F.lit("unknown")).alias("source")).agg(F.sum("kwh").alias("kwh"))


def table_counts(tables: Mapping[str, DataFrame], distinct: Mapping[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """Labelled counts: rows of each table and distinct values of chosen columns."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("item"), "n") for name, df in tables.items()]
    for name, (df, column) in (distinct or {}).items():
        parts.append(df.agg(F.count_distinct(column).alias("n")).select(F.lit(name).alias("item"), "n"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def anomaly_counts(events: DataFrame, detected: str, interval: str, now: datetime) -> DataFrame:
    """Recent anomaly events per meter, most first."""
    recent = since(events, detected, interval, now)
    counted = recent.groupBy("meter_id").agg(F.count(F.lit(1)).alias("anomaly_count"))
    return counted.orderBy(F.desc("anomaly_count"), "meter_id")


def latest_events(events: DataFrame, n: int = 50) -> DataFrame:
    """The newest events for a table panel."""
    newest = events.orderBy(F.desc("reading_time"), "meter_id").limit(n)
    return newest.select(F.col("reading_time").alias("time"), "meter_id", "kwh_actual", "kwh_expected", "severity")


def top_meters_on(daily: DataFrame, day: date, n: int = 10) -> DataFrame:
    """Meters with the highest consumption on a day."""
    on_day = daily.filter(F.col("bucket") == F.lit(day).cast("timestamp"))
    totals = on_day.groupBy("meter_id").agg(F.sum("kwh_total").alias("total_kwh"))
    return totals.orderBy(F.desc("total_kwh"), "meter_id").limit(n)


def top_meter_stats(df: DataFrame, n: int = 10) -> DataFrame:
    """Rows, mean, total and maximum of the meters with the highest total."""
    stats = df.groupBy("meter_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("kwh").alias("mean_kwh"),
        F.sum("kwh").alias("total_kwh"),
        F.max("kwh").alias("max_kwh"),
    )
    return stats.orderBy(F.desc("total_kwh"), "meter_id").limit(n)


def keep_largest(daily: DataFrame, n: int = 12) -> DataFrame:
    """Daily rows of the ``n`` meters with the highest total (all of them when there are no more than ``n``)."""
    totals = daily.groupBy("meter_id").agg(F.sum("daily_kwh").alias("_total"))
    largest = totals.orderBy(F.desc("_total"), "meter_id").limit(n).select("meter_id")
    return daily.join(largest, "meter_id", "left_semi")


def stable_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """At most ``n`` rows picked by a hash of their key, the same on every run."""
    rank = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(seed).cast("string")))
    return df.withColumn("_rank", rank).orderBy("_rank", *keys).limit(n).drop("_rank")


def daily_series(df: DataFrame, source: str | None = None) -> DataFrame:
    """Daily totals as ``(ds, y)``, of one source or per source."""
    if source is not None:
        df = df.filter(F.col("source") == source)
    grouped = df.groupBy(F.date_trunc("day", "time").alias("ds"), *([] if source is not None else ["source"]))
    return grouped.agg(F.sum("kwh").alias("y"))
