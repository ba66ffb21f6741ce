"""The engine's inputs expressed over the test tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.operators.rollups import resample
from wattline.operators.series import index_series, rolling
from wattline.session import configure

NOW = datetime(2024, 1, 25, 12)
DAY = datetime(2024, 1, 15)

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def as_readings(events: DataFrame) -> DataFrame:
    """Events as meter readings: the type is the source, ten meters per source."""
    number = F.lpad((F.col("user_id") % 10).cast("string"), 2, "0")
    return events.select(
        F.col("ts").cast("timestamp").alias("time"),
        F.concat(F.lit("MTR_"), "event_type", F.lit("_"), number).alias("meter_id"),
        F.col("value").alias("kwh"),
        (F.col("event_type") == "error").alias("is_anomaly"),
        F.col("event_type").alias("source"),
    )


def readings(spark: SparkSession, folder: str) -> DataFrame:
    return as_readings(table(spark, folder, "events"))


def with_copies(df: DataFrame) -> DataFrame:
    """Readings with every one of source ``error`` twice, as input for the duplicate rules."""
    return df.unionByName(df.filter(F.col("source") == "error"))


def readings_stream(spark: SparkSession, folder: str) -> DataFrame:
    # As a pattern the path may be one file or a folder of files.
    files = configure(spark).readStream.schema(EVENTS).parquet(f"{folder}/events.parque[t]")
    return as_readings(files)


def source_series(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly totals per source, indexed; one row per source and hour."""
    hourly = resample(readings(spark, folder), 60, ["source"])
    return index_series(hourly, "source", ("time",), calendar_bound=True)


def meter_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly totals per meter."""
    return resample(readings(spark, folder), 60)


def meter_series(spark: SparkSession, folder: str) -> DataFrame:
    return index_series(meter_hours(spark, folder), "meter_id", ("time",), calendar_bound=True)


def meter_predictions(series: DataFrame) -> DataFrame:
    """Each meter's previous hourly value as its prediction."""
    past = rolling(series, "meter_id", 1, {"kwh_pred": lambda w: F.lag("kwh").over(w)})
    return past.filter("kwh_pred IS NOT NULL").select(
        "time",
        "meter_id",
        F.lit("last_value").alias("model"),
        "kwh_pred",
        (F.col("kwh_pred") * 0.9).alias("kwh_lower"),
        (F.col("kwh_pred") * 1.1).alias("kwh_upper"),
    )


def electrical(spark: SparkSession, folder: str) -> DataFrame:
    """Line items in the shape of the electrical feed."""
    return table(spark, folder, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.when(F.col("l_returnflag") == "A", "").otherwise(F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).alias("meter_id"),
        F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice")).alias("consumption_kwh"),
        F.lit(230.0).alias("voltage_v"),
        F.col("l_quantity").alias("current_a"),
        (F.col("l_tax") + 0.9).alias("power_factor"),
        F.col("l_returnflag").alias("disco"),
    )


def meters(spark: SparkSession, folder: str) -> DataFrame:
    """Meter metadata from customers: a meter per customer, its segment as profile, its nation as location."""
    nation = table(spark, folder, "nation")
    customer = table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return customer.select(
        F.concat(F.lit("CUST_"), F.col("c_custkey").cast("string")).alias("meter_id"),
        F.col("c_mktsegment").alias("profile"),
        F.col("n_name").alias("location"),
    )


def order_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as readings of their customer's meter."""
    return table(spark, folder, "orders").select(
        F.col("o_orderdate").cast("timestamp").alias("time"),
        F.concat(F.lit("CUST_"), F.col("o_custkey").cast("string")).alias("meter_id"),
        F.col("o_totalprice").alias("kwh"),
        (F.col("o_orderstatus") == "F").alias("is_anomaly"),
        F.col("o_orderpriority").alias("source"),
    )


def plain(df: DataFrame) -> DataFrame:
    """Zone-free timestamps, as the SQL side has them."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned}) if zoned else df
