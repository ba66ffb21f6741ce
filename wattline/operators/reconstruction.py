"""Reconstruction-error detector: a linear autoencoder (principal components) on sequence windows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.operators.blockwise import as_matrix, per_row, score_blocks, sliding, summed_products
from wattline.operators.quantiles import median_mad
from wattline.operators.series import SERIES_BLOCK, matched, with_context
from wattline.session import settled, sized

WINDOW = 48
COMPONENTS = 6


def _normalised(df: DataFrame, scale: DataFrame, group: str, value: str) -> DataFrame:
    z = (F.col(value) - F.col("_mean")) / F.col("_std")
    return matched(df, scale, group).select(group, "pos", "n", z.alias("z"))


def fit_components(
    rows: DataFrame, group: str, window: int = WINDOW, components: int = COMPONENTS, min_windows: int = 8
) -> DataFrame:
    """Mean window and leading components per group from normalised blocks; groups with few windows are dropped."""

    def windows(pdf: pd.DataFrame) -> np.ndarray:
        x = sliding(pdf.sort_values("pos")["z"].to_numpy(dtype=float), window)
        return np.hstack([np.ones((len(x), 1)), x])

    def leading(products: np.ndarray) -> tuple:
        count = products[0, 0]
        if count < min_windows:
            return None, None
        mean = products[0, 1:] / count
        covariance = products[1:, 1:] / count - np.outer(mean, mean)
        _, vectors = np.linalg.eigh(covariance)
        return mean, vectors[:, -components:].T.ravel()

    numbers = T.ArrayType(T.DoubleType())
    models = per_row(as_matrix(summed_products(rows, [group], windows)), {"mean": numbers, "basis": numbers}, leading)
    return models.filter("mean IS NOT NULL")


def window_errors(rows: DataFrame, models: DataFrame, group: str, window: int, block: int) -> DataFrame:
    """Mean absolute reconstruction error of the window ending at each position (0 before the first full one)."""

    def errors(data: pd.DataFrame, model: pd.Series) -> np.ndarray:
        x = sliding(data["z"].to_numpy(dtype=float), window)
        centred = x - np.asarray(model["mean"])
        basis = np.asarray(model["basis"]).reshape(-1, window)
        found = np.abs(centred - centred @ basis.T @ basis).mean(axis=1)
        return np.concatenate([np.zeros(len(data) - len(found)), found])

    return score_blocks(rows, models, group, errors, block)


def reconstruction_flags(
    clean: DataFrame,
    injected: DataFrame,
    group: str,
    window: int = WINDOW,
    components: int = COMPONENTS,
    multiplier: float = 4.0,
    value: str = "kwh",
    block: int = SERIES_BLOCK,
) -> DataFrame:
    """Flags on ``injected`` where the reconstruction error exceeds what the clean series shows.

    Both inputs are indexed series.  Values are normalised with the clean mean and deviation, the threshold
    is the median of the clean errors plus ``multiplier`` times their MAD, and a flag sits at a window's end.
    """
    scale = clean.groupBy(group).agg(F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_std"))
    scale = scale.withColumn("_std", F.when(F.col("_std") == 0, F.lit(1.0)).otherwise(F.col("_std")))
    scale = sized(scale)
    back = window - 1
    clean_rows = with_context(_normalised(clean, scale, group, value), back, block)
    models = settled(fit_components(clean_rows, group, window, components), "components")
    full = F.col("pos") >= back
    train = settled(window_errors(clean_rows, models, group, window, block).filter(full), "errors")
    limits = median_mad(train, group, "score")
    limit = F.col("median") + multiplier * F.greatest("mad", F.lit(1e-9))
    limits = sized(limits.select(group, limit.alias("threshold"), F.col("n_values").alias("train_windows")))
    rows = with_context(_normalised(injected, scale, group, value), back, block)
    scored = matched(window_errors(rows, models, group, window, block), limits, group)
    # Groups too short for a model, or absent from the clean series, keep their rows: score 0, no flag.
    out = matched(injected, scored, [group, "pos"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    return out.withColumn("flag", F.coalesce(full & (F.col("score") > F.col("threshold")), F.lit(False)))
