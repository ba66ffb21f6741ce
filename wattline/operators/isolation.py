"""Isolation scores of single values.

Every tree draws its own rows from the whole group by a hash; with one feature the trees' mean depth is a step
function of the value.  So a group's forest is grown from at most about ``TREES * TREE_SAMPLE`` rows, stored as edges
and depths, and every row is scored block by block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.operators.blockwise import score_blocks
from wattline.operators.detect import DetectorConfig
from wattline.operators.quantiles import exact_quantiles
from wattline.operators.series import SERIES_BLOCK, matched, with_context
from wattline.session import settled, sized

TREES = 100
TREE_SAMPLE = 256


def expected_depth(size: int) -> float:
    """Mean depth of an unsuccessful search in a binary search tree of ``size`` values."""
    if size <= 1:
        return 0.0
    if size == 2:
        return 1.0
    return 2.0 * (np.log(size - 1.0) + np.euler_gamma) - 2.0 * (size - 1.0) / size


def _grow(values: np.ndarray, rng: np.random.Generator, limit: int) -> tuple[list[float], list[float]]:
    """Cut points of one tree from left to right and the depths of the intervals between them."""
    cuts: list[float] = []
    depths: list[float] = []
    stack = [(values, 0)]
    while stack:
        item = stack.pop()
        if isinstance(item, float):
            cuts.append(item)
            continue
        part, depth = item
        if depth >= limit or len(part) <= 1 or part[0] == part[-1]:
            depths.append(depth + expected_depth(len(part)))
            continue
        cut = float(rng.uniform(part[0], part[-1]))
        at = int(np.searchsorted(part, cut, side="right"))
        # Right side first, so that intervals come out in order of value.
        stack.append((part[at:], depth + 1))
        stack.append(cut)
        stack.append((part[:at], depth + 1))
    return cuts, depths


def grow_forest(samples: list[np.ndarray], seed: int, size: int = TREE_SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Edges and mean depths of a forest: ``depths[k]`` holds between ``edges[k - 1]`` and ``edges[k]``.

    One tree per sample, which has about ``size`` values.
    """
    rng = np.random.default_rng(seed)
    limit = int(np.ceil(np.log2(max(size, 2))))
    start = 0.0
    edges: list[float] = []
    steps: list[float] = []
    for sample in samples:
        cuts, depths = _grow(np.sort(sample), rng, limit)
        start += depths[0]
        edges.extend(cuts)
        steps.extend(np.diff(depths))
    order = np.argsort(edges, kind="stable")
    totals = start + np.concatenate([[0.0], np.cumsum(np.asarray(steps)[order])])
    return np.asarray(edges)[order], totals / len(samples)


def isolation_scores(df: DataFrame, group: str, value: str = "kwh", seed: int = 42, block: int = SERIES_BLOCK) -> DataFrame:
    """``(group, pos, score)`` of an indexed series; higher is more isolated."""
    # A row enters a tree when the tree's hash of it falls into a share of about TREE_SAMPLE rows of its group.
    key = F.xxhash64(F.col(group).cast("string"), "pos", F.lit(seed))
    drawn = F.filter(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda tree: F.pmod(F.xxhash64(key, tree), F.col("n")) < TREE_SAMPLE)
    sample = df.select(group, F.col(value).alias("value"), "n", "pos", F.explode(drawn).alias("tree"))
    schema = T.StructType(
        [
            df.schema[group],
            T.StructField("edges", T.ArrayType(T.DoubleType())),
            T.StructField("depths", T.ArrayType(T.DoubleType())),
            T.StructField("unit", T.DoubleType()),
        ]
    )

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        samples = [part["value"].to_numpy(dtype=float) for _, part in pdf.sort_values(["tree", "pos"]).groupby("tree")]
        size = int(min(TREE_SAMPLE, pdf["n"].iloc[0]))
        edges, depths = grow_forest(samples, seed, size)
        unit = expected_depth(size)
        return pd.DataFrame({group: [pdf[group].iloc[0]], "edges": [edges], "depths": [depths], "unit": [unit]})

    forests = sample.groupBy(group).applyInPandas(fit, schema)

    def score(data: pd.DataFrame, forest: pd.Series) -> np.ndarray:
        at = np.searchsorted(np.asarray(forest["edges"]), data["value"].to_numpy(dtype=float), side="left")
        return np.power(2.0, -np.asarray(forest["depths"])[at] / max(forest["unit"], 1e-9))

    rows = with_context(df.select(group, "pos", "n", F.col(value).alias("value")), 0, block)
    return score_blocks(rows, forests, group, score, block)


def isolation_flags(
    df: DataFrame,
    group: str,
    cfg: DetectorConfig = DetectorConfig(),
    value: str = "kwh",
    seed: int = 42,
    block: int = SERIES_BLOCK,
) -> DataFrame:
    """``flag`` on the most isolated share of each group with enough rows; nothing in shorter groups."""
    long_enough = df.filter(F.col("n") >= cfg.min_rows_isolation)
    scores = settled(isolation_scores(long_enough, group, value, seed, block), "isolation")
    cut = sized(exact_quantiles(scores, group, "score", {"cut": 1.0 - cfg.contamination}).drop("n_values"))
    flagged = matched(scores, cut, group).select(group, "pos", (F.col("score") > F.col("cut")).alias("flag"), "score")
    out = matched(df, flagged, [group, "pos"], "left")
    return out.withColumn("flag", F.coalesce("flag", F.lit(False)))
