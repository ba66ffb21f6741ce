"""Window operators over indexed series (see :mod:`wattline.operators.series`)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.time import calendar_features
from wattline.operators.series import SERIES_BLOCK, cadence, matched, rolling, shifted
from wattline.session import sized


def rolling_std(df: DataFrame, group, value: str, rows: int = 96, block: int = SERIES_BLOCK) -> DataFrame:
    """Sample standard deviation of the current and the ``rows - 1`` previous values."""
    frame = {"rolling_std": lambda w: F.stddev_samp(value).over(w.rowsBetween(-(rows - 1), 0))}
    return rolling(df, group, rows - 1, frame, block)


def _middle(sorted_values: Column, size: int) -> Column:
    half = size // 2
    if size % 2:
        return sorted_values[half]
    return (sorted_values[half - 1] + sorted_values[half]) / 2


def rolling_median_mad(
    df: DataFrame, group, value: str, window: int = 24, block: int = SERIES_BLOCK
) -> DataFrame:
    """Median and MAD of the ``window`` previous values, null until that many exist."""
    frame = {"_past": lambda w: F.collect_list(value).over(w.rowsBetween(-window, -1))}
    framed = rolling(df, group, window, frame, block)
    full = F.col("pos") >= window
    framed = framed.withColumn("_past", F.when(full, F.array_sort("_past")))
    framed = framed.withColumn("rolling_median", _middle(F.col("_past"), window))
    deviations = F.array_sort(F.transform("_past", lambda v: F.abs(v - F.col("rolling_median"))))
    return framed.withColumn("rolling_mad", _middle(deviations, window)).drop("_past")


def seasons(df: DataFrame, group: str, window: int) -> DataFrame:
    """Per group: cadence, samples per day and the seasonal lag (a week when the series is long enough, else a day)."""
    sizes = df.groupBy(group).agg(F.max("n").alias("_n"))
    steps = matched(cadence(df, group, 60), sizes, group)
    daily = F.greatest(F.lit(1), F.floor(F.lit(1440) / F.col("cadence_minutes"))).cast("long")
    steps = steps.withColumn("daily_steps", daily)
    weekly = F.col("daily_steps") * 7
    lag = F.when(F.col("_n") >= weekly + window, weekly).otherwise(F.col("daily_steps"))
    return steps.withColumn("season_steps", lag).drop("_n")


def seasonal_residual(df: DataFrame, group: str, window: int = 24, value: str = "kwh") -> DataFrame:
    """Value minus the value one season earlier by position; 0 before the first season."""
    stepped = matched(df, sized(seasons(df, group, window)), group)
    past = shifted(stepped, group, F.col("season_steps"), {"_past": value})
    residual = F.when(F.col("pos") >= F.col("season_steps"), F.col(value) - F.col("_past")).otherwise(F.lit(0.0))
    return past.withColumn("residual", residual).drop("_past")


def lag_features(
    df: DataFrame, group, daily_steps: int, max_lag: int, value: str = "kwh", block: int = SERIES_BLOCK
) -> DataFrame:
    """Lags 1, 2, one day, two days and ``max_lag``; means of the last day and of the last six values; calendar."""
    lags = {"lag_1": 1, "lag_2": 2, "lag_day": daily_steps, "lag_2day": 2 * daily_steps, "lag_max": max_lag}
    exprs = {name: (lambda w, s=s: F.lag(value, s).over(w)) for name, s in lags.items()}
    exprs["mean_day"] = lambda w: F.avg(value).over(w.rowsBetween(-daily_steps, -1))
    exprs["mean_6"] = lambda w: F.avg(value).over(w.rowsBetween(-6, -1))
    back = max(2 * daily_steps, max_lag, 6)
    out = rolling(df, group, back, exprs, max(block, 4 * back)).filter(F.col("pos") >= back)
    return out.withColumns(calendar_features(F.col("time")))


def sequence_windows(
    df: DataFrame, group, window: int, horizon: int = 0, value: str = "kwh", block: int = SERIES_BLOCK
) -> DataFrame:
    """One row per full window: ``inputs`` (``window`` values) and, with a horizon, ``targets`` after them.

    The row kept is the one at the window's last position.
    """
    size = window + horizon
    frame = {"_all": lambda w: F.collect_list(value).over(w.rowsBetween(-(size - 1), 0))}
    out = rolling(df, group, size - 1, frame, block).filter(F.size("_all") == size)
    out = out.withColumn("inputs", F.slice("_all", 1, window))
    if horizon:
        out = out.withColumn("targets", F.slice("_all", window + 1, horizon))
    return out.drop("_all")


def adaptive_window(df: DataFrame, group: str, base: int = 96, value: str = "kwh") -> DataFrame:
    """Look-back per group: longer when the last 96 values vary more than the whole series, shorter when less."""
    recent = F.when(F.col("pos") >= F.col("n") - 96, F.col(value))
    stats = df.groupBy(group).agg(
        F.stddev_pop(recent).alias("recent_std"), F.stddev_pop(value).alias("global_std")
    )
    ratio = F.col("recent_std") / (F.col("global_std") + F.lit(1e-8))
    size = (
        F.when(ratio > 1.5, F.lit(min(base * 2, 288))).when(ratio < 0.5, F.lit(max(base // 2, 48))).otherwise(base)
    )
    return stats.select(group, "recent_std", "global_std", size.cast("int").alias("window"))


def _with_stats(df: DataFrame, group, aggregates: Sequence[Column]) -> DataFrame:
    keys = [group] if isinstance(group, str) else list(group)
    return matched(df, sized(df.groupBy(*keys).agg(*aggregates)), keys)


def minmax_scale(df: DataFrame, group, value: str = "kwh") -> DataFrame:
    """``scaled`` in 0..1 per group; a constant series scales to 0."""
    both = _with_stats(df, group, [F.min(value).alias("_lo"), F.max(value).alias("_hi")])
    spread = F.col("_hi") - F.col("_lo")
    scaled = (F.col(value) - F.col("_lo")) / F.when(spread == 0, F.lit(1.0)).otherwise(spread)
    return both.withColumn("scaled", scaled).drop("_lo", "_hi")


def znorm(df: DataFrame, group, value: str = "kwh") -> DataFrame:
    """``z`` with the population standard deviation of the group, which counts as 1 when it is 0."""
    both = _with_stats(df, group, [F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_std")])
    std = F.when(F.col("_std") == 0, F.lit(1.0)).otherwise(F.col("_std"))
    return both.withColumn("z", (F.col(value) - F.col("_mean")) / std).drop("_mean", "_std")


def fourier_terms(ts: Column, daily_order: int = 4, weekly_order: int = 3) -> list[Column]:
    """Sine and cosine terms of the day and of the week."""
    day = F.unix_timestamp(ts) / 86_400.0 * (2 * math.pi)
    terms = []
    for period, order in ((1, daily_order), (7, weekly_order)):
        for k in range(1, order + 1):
            angle = day * (k / period)
            terms += [F.sin(angle), F.cos(angle)]
    return terms

