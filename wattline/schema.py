"""Table layouts."""

from __future__ import annotations

from pyspark.sql import types as T

READINGS = T.StructType(
    [
        T.StructField("time", T.TimestampType(), False),
        T.StructField("meter_id", T.StringType(), False),
        T.StructField("kwh", T.DoubleType(), False),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("source", T.StringType()),
    ]
)
READING_COLUMNS = tuple(READINGS.fieldNames())

METERS = T.StructType(
    [
        T.StructField("meter_id", T.StringType(), False),
        T.StructField("profile", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("installed_at", T.TimestampType()),
    ]
)

# Live messages carry the reading time under "timestamp".
MESSAGE = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("meter_id", T.StringType()),
        T.StructField("kwh", T.DoubleType()),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("source", T.StringType()),
    ]
)

FORECASTS = T.StructType(
    [
        T.StructField("group_key", T.StringType()),
        T.StructField("fold", T.IntegerType()),
        T.StructField("horizon_step", T.IntegerType()),
        T.StructField("time", T.TimestampType()),
        T.StructField("actual", T.DoubleType()),
        T.StructField("forecast", T.DoubleType()),
        T.StructField("model_type", T.StringType()),
    ]
)

SEVERITIES = ("low", "medium", "high")


def require_columns(columns, required, what: str) -> None:
    """Fail early when an input lacks one of the columns it must have."""
    missing = sorted(set(required) - set(columns))
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")
