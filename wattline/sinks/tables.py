"""Writers and set-based table updates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.text import encode_message

CHUNK_DAYS = 7


def time_chunk(ts: Column, days: int = CHUNK_DAYS) -> Column:
    """First day of the fixed-width chunk a time falls in, counted from the epoch."""
    days_since = F.unix_date(F.to_date(ts))
    return F.date_from_unix_date((F.floor(days_since / days) * days).cast("int"))


def write_fact(df: DataFrame, path: str, keys: Sequence[str], time: str = "time", mode: str = "append") -> None:
    """Parquet partitioned by time chunk and clustered by key.

    The range layout cuts a large chunk over many tasks, yet keeps each key's rows adjacent, so row-group
    statistics serve both the time and the key predicate.
    """
    layout = ["time_chunk", *keys, time]
    (
        df.withColumn("time_chunk", time_chunk(F.col(time)))
        .repartitionByRange(*layout)
        .sortWithinPartitions(*layout)
        .write.mode(mode)
        .partitionBy("time_chunk")
        .parquet(path)
    )


def write_readings(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append readings to the raw table."""
    write_fact(df, path, ["meter_id"], mode=mode)


def write_predictions(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append predictions, one folder per model."""
    layout = ["model", "meter_id", "time"]
    df.repartitionByRange(*layout).sortWithinPartitions(*layout).write.mode(mode).partitionBy("model").parquet(path)


def first_per_key(df: DataFrame, keys: Sequence[str], prefer: Sequence[str]) -> DataFrame:
    """One row per key, the smallest in ``prefer`` order; a partial aggregate, so copies collapse before the shuffle."""
    rest = [name for name in df.columns if name not in keys]
    ranked = [*prefer, *[name for name in rest if name not in prefer]]
    best = F.min(F.struct(*ranked)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)


def insert_missing(existing: DataFrame, new: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """Existing rows plus those new rows whose key is not there yet."""
    fresh = first_per_key(new, keys, prefer or [c for c in new.columns if c not in keys])
    return existing.unionByName(fresh.join(existing, list(keys), "left_anti"), allowMissingColumns=True)


def replace_slice(existing: DataFrame, new: DataFrame, condition: Column) -> DataFrame:
    """Existing rows outside the slice plus the new rows."""
    return existing.filter(~F.coalesce(condition, F.lit(False))).unionByName(new)


def predictions_from_forecasts(forecasts: DataFrame, default_model: str = "demo_forecast") -> DataFrame:
    """Prediction rows with a ten-percent band; the series key stands in the meter column."""
    return forecasts.select(
        "time",
        F.col("group_key").alias("meter_id"),
        F.coalesce(F.nullif(F.col("model_type"), F.lit("")), F.lit(default_model)).alias("model"),
        F.col("forecast").alias("kwh_pred"),
        (F.col("forecast") * 0.9).alias("kwh_lower"),
        (F.col("forecast") * 1.1).alias("kwh_upper"),
    )


def events_from_flags(df: DataFrame) -> DataFrame:
    """Anomaly events of flagged readings with the demo expectation (actual over 1.75)."""
    expected = F.col("kwh") / 1.75
    deviation = F.col("kwh") - expected
    return df.filter("is_anomaly").select(
        F.coalesce(F.nullif(F.col("source"), F.lit("")), F.col("meter_id")).alias("meter_id"),
        F.col("time").alias("reading_time"),
        F.col("kwh").alias("kwh_actual"),
        expected.alias("kwh_expected"),
        deviation.alias("deviation"),
        F.when(deviation > 1.0, "high").otherwise("medium").alias("severity"),
    )


def to_messages(df: DataFrame) -> DataFrame:
    """Key and JSON value of each reading, ready for a broker."""
    return df.select(
        F.col("meter_id").alias("key"),
        encode_message(*[F.col(c) for c in ("time", "meter_id", "kwh", "is_anomaly", "source")]).alias("value"),
    )


def publish(df: DataFrame, options: dict[str, str] | None = None, folder: str | None = None) -> None:
    """Send messages to a broker topic, or append them as text files below ``folder``."""
    messages = to_messages(df)
    if folder is not None:
        messages.select("value").write.mode("append").text(folder)
    else:
        messages.write.format("kafka").options(**(options or {})).save()


def apply_retention(df: DataFrame, days: int, now: datetime, time: str = "time") -> DataFrame:
    """Rows no older than ``days``; also prunes chunks when the table has them."""
    limit = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")
    kept = df.filter(F.col(time) >= limit)
    return kept.filter(F.col("time_chunk") >= time_chunk(limit)) if "time_chunk" in df.columns else kept

