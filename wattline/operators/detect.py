"""Anomaly detectors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.text import severity
from wattline.operators.series import SERIES_BLOCK, index_series, matched
from wattline.operators.windows import rolling_median_mad, rolling_std, seasonal_residual


@dataclass(frozen=True)
class DetectorConfig:
    """Settings shared by the MAD detectors and the isolation detector."""

    window: int = 24
    mad_multiplier: float = 3.5
    min_abs_deviation: float = 0.0
    min_rows_isolation: int = 100
    contamination: float = 0.01


def robust_score(df: DataFrame, group, value: str, window: int = 24, block: int = SERIES_BLOCK) -> DataFrame:
    """Deviation from the rolling median and its ratio to the MAD (null during warm-up).

    Both are threshold-free, so a sweep over thresholds needs this only once.
    """
    stats = rolling_median_mad(df, group, value, window, block)
    deviation = F.abs(F.col(value) - F.col("rolling_median"))
    spread = F.when(F.col("rolling_mad") > 0, F.col("rolling_mad")).otherwise(F.lit(1e-9))
    return stats.withColumn("deviation", deviation).withColumn("robust_z", deviation / spread)


def exceeds(multiplier: Column | float, min_dev: float) -> Column:
    """Flag rule on the columns of :func:`robust_score`."""
    limit = multiplier if isinstance(multiplier, Column) else F.lit(float(multiplier))
    return F.coalesce((F.col("robust_z") > limit) & (F.col("deviation") >= min_dev), F.lit(False))


def mad_flags(
    df: DataFrame, group, value: str = "kwh", cfg: DetectorConfig = DetectorConfig(), block: int = SERIES_BLOCK
) -> DataFrame:
    """``flag`` where a value lies far from the median of the previous window."""
    scored = robust_score(df, group, value, cfg.window, block)
    return scored.withColumn("flag", exceeds(cfg.mad_multiplier, cfg.min_abs_deviation))


def seasonal_flags(
    df: DataFrame, group: str, cfg: DetectorConfig = DetectorConfig(), block: int = SERIES_BLOCK
) -> DataFrame:
    """MAD flags on seasonal residuals; nothing before the first season or in series shorter than two windows."""
    residuals = seasonal_residual(df, group, cfg.window)
    scored = mad_flags(residuals, group, "residual", cfg, block)
    allowed = (F.col("pos") >= F.col("season_steps")) & (F.col("n") >= 2 * cfg.window)
    return scored.withColumn("flag", F.col("flag") & allowed)


def actual_vs_forecast(readings: DataFrame, predictions: DataFrame) -> DataFrame:
    """Readings with the prediction for the same meter and time."""
    return readings.join(predictions.select("meter_id", "time", "kwh_pred"), ["meter_id", "time"]).select(
        "time",
        "meter_id",
        F.col("kwh").alias("kwh_actual"),
        F.col("kwh_pred").alias("kwh_expected"),
        F.abs(F.col("kwh") - F.col("kwh_pred")).alias("residual"),
    )


def residual_zscore(
    readings: DataFrame,
    predictions: DataFrame,
    lo: datetime | None = None,
    threshold: float = 3.0,
    rows: int = 96,
    history: bool = False,
    calendar_bound: bool = False,
    block: int = SERIES_BLOCK,
) -> DataFrame:
    """Residuals far above their rolling deviation, as anomaly events.

    By default the rolling window only sees rows from ``lo`` on; ``history=True`` lets it reach back further
    and applies the time bound afterwards.  ``z_score`` and the difference in kWh are separate columns.
    """
    bound = F.lit(True) if lo is None else F.col("time") >= F.lit(lo).cast("timestamp")
    joined = actual_vs_forecast(readings if history else readings.filter(bound), predictions)
    order = ("time", "kwh_actual", "kwh_expected")
    scored = rolling_std(index_series(joined, "meter_id", order, calendar_bound), "meter_id", "residual", rows, block)
    scored = scored.withColumn("z_score", F.col("residual") / (F.col("rolling_std") + F.lit(1e-8)))
    if history:
        scored = scored.filter(bound)
    return scored.filter(F.col("z_score") > threshold).select(
        "meter_id",
        F.col("time").alias("reading_time"),
        "kwh_actual",
        "kwh_expected",
        (F.col("kwh_actual") - F.col("kwh_expected")).alias("deviation"),
        "z_score",
        severity(F.col("z_score"), threshold).alias("severity"),
    )


def attach_forecast(readings: DataFrame, forecasts: DataFrame, group: str) -> DataFrame:
    """Each reading with the forecast of the smallest horizon step for its group and time, or null."""
    best = forecasts.groupBy(F.col("group_key").alias(group), "time").agg(
        F.min(F.struct("horizon_step", "fold", "forecast", "model_type")).alias("_best")
    )
    best = best.select(
        group,
        "time",
        F.col("_best.forecast").alias("forecast"),
        F.col("_best.horizon_step").alias("horizon_step"),
        F.col("_best.model_type").alias("model_type"),
    )
    return matched(readings, best, [group, "time"], "left").withColumn("covered", F.col("forecast").isNotNull())


def forecast_residual_scores(
    readings: DataFrame,
    forecasts: DataFrame,
    group: str,
    window: int = 24,
    order: Sequence[str] = ("time", "meter_id"),
    calendar_bound: bool = False,
    block: int = SERIES_BLOCK,
) -> DataFrame:
    """Robust scores of the forecast residuals.

    Only covered rows form the series (``pos`` and ``n`` count them); rows without a forecast are kept
    with null positions and scores.
    """
    attached = attach_forecast(readings.drop("pos", "n"), forecasts, group)
    attached = attached.withColumn("residual", F.col("kwh") - F.col("forecast"))
    covered = index_series(attached.filter("covered"), group, order, calendar_bound)
    scored = robust_score(covered, group, "residual", window, block)
    return scored.unionByName(attached.filter("NOT covered"), allowMissingColumns=True)


def forecast_residual_flags(
    readings: DataFrame, forecasts: DataFrame, group: str, cfg: DetectorConfig = DetectorConfig(), **how: object
) -> DataFrame:
    """MAD flags on forecast residuals; rows without a forecast are never flagged."""
    scored = forecast_residual_scores(readings, forecasts, group, cfg.window, **how)
    return scored.withColumn("flag", exceeds(cfg.mad_multiplier, cfg.min_abs_deviation))


def detect(
    df: DataFrame,
    group: str,
    cfg: DetectorConfig = DetectorConfig(),
    preserve: bool = False,
    isolation: bool = True,
    block: int = SERIES_BLOCK,
) -> DataFrame:
    """Seasonal flags joined with isolation flags, written to ``is_anomaly`` (old labels kept with ``preserve``)."""
    found = seasonal_flags(df, group, cfg, block)
    if isolation:
        from wattline.operators.isolation import isolation_flags

        isolated = isolation_flags(df, group, cfg, block=block).select(group, "pos", F.col("flag").alias("_isolated"))
        found = matched(found, isolated, [group, "pos"]).withColumn("flag", F.col("flag") | F.col("_isolated"))
        found = found.drop("_isolated")
    kept = F.coalesce("is_anomaly", F.lit(False)) if preserve else F.lit(False)
    return found.withColumn("is_anomaly", kept | F.col("flag"))


def detection_report(flagged: DataFrame, group: str) -> DataFrame:
    """Samples and detections per group."""
    return flagged.groupBy(group).agg(F.count(F.lit(1)).alias("samples"), F.count_if("flag").alias("detected"))
