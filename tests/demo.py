"""The documented demo series: four sources, 21 days of half hours, as one expression over steps and profiles."""

from pyspark.sql import functions as F

# Source, level, base, morning peak, evening peak, phase.
PROFILES = (
    ("morocco_high_resolution", 1.05, 0.62, 0.62, 0.78, 0.2),
    ("london_smart_meters", 1.18, 0.70, 0.48, 1.05, 1.0),
    ("nigeria_smart_meter", 0.92, 0.58, 0.35, 0.70, 2.1),
    ("uci_household_power", 0.68, 0.42, 0.22, 0.38, 3.4),
)
# Fixed formula of the published series, in kWh per half hour.
KWH = """
    greatest(0.05, 0.5 * (
        level * if(weekday(time) < 5, 1.08, 0.92) * (1 + 0.05 * sin(step / 144D + phase))
            * (base + morning * exp(-pow(hour - 8, 2) / 18) + evening * exp(-pow(hour - 19, 2) / 14))
        + 0.03 * sin(step / 3D + phase)
    ))"""


def readings(spark):
    profiles = spark.createDataFrame(PROFILES, "source string, level double, base double, morning double, evening double, phase double")
    steps = spark.range(21 * 48).select(F.col("id").alias("step"), F.expr("timestamp'2023-01-01' + make_dt_interval(0, 0, 30 * id)").alias("time"))
    timed = steps.withColumn("hour", F.expr("(step % 48) / 2D")).join(F.broadcast(profiles))
    return timed.select(
        "time", F.upper(F.substring_index("source", "_", 1)).alias("meter_id"), F.round(F.expr(KWH), 8).alias("kwh"),
        F.lit(False).alias("is_anomaly"), "source",
    )


def series(spark, source):
    """Times and values of one source, in order."""
    rows = readings(spark).filter(F.col("source") == source).orderBy("time").collect()
    return [r["time"] for r in rows], [r["kwh"] for r in rows]
