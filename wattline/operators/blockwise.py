"""Array work on blocks of a series: sums of products and scoring against per-group models.

Spark partitions by ``(group, _block)``, so a task only ever holds one block of a group; numpy works inside.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.operators.series import SERIES_BLOCK, block_of, matched


def summed_products(df: DataFrame, keys: Sequence[str], rows_of: Callable[[pd.DataFrame], np.ndarray]) -> DataFrame:
    """Statistics ``Z'Z`` per key in long form ``(keys, i, v)``, ``i`` numbering the flattened matrix.

    ``rows_of`` turns one block of ``df`` (which has a ``_block`` column) into the matrix ``Z``.  The long
    form is additive: results of disjoint rows are combined by :func:`merge_statistics`.
    """
    keys = list(keys)
    fields = [df.schema[k] for k in keys] + [T.StructField("i", T.IntegerType()), T.StructField("v", T.DoubleType())]

    def partial(pdf: pd.DataFrame) -> pd.DataFrame:
        z = rows_of(pdf)
        flat = (z.T @ z).ravel() if len(z) else np.empty(0)
        out = pd.DataFrame({"i": np.arange(len(flat), dtype="int32"), "v": flat})
        for at, key in enumerate(keys):
            out.insert(at, key, pdf[key].iloc[0])
        return out

    parts = df.groupBy(*keys, "_block").applyInPandas(partial, T.StructType(fields))
    return parts.groupBy(*keys, "i").agg(F.sum("v").alias("v"))


def merge_statistics(first: DataFrame, second: DataFrame) -> DataFrame:
    """Statistics over the rows of both inputs."""
    keys = [name for name in first.columns if name not in ("i", "v")]
    return first.unionByName(second).groupBy(*keys, "i").agg(F.sum("v").alias("v"))


def as_matrix(statistics: DataFrame) -> DataFrame:
    """One row per key with the flattened matrix as ``products`` (its size is fixed by the model)."""
    keys = [name for name in statistics.columns if name not in ("i", "v")]
    cells = F.array_sort(F.collect_list(F.struct("i", "v")))
    return statistics.groupBy(*keys).agg(F.transform(cells, lambda c: c["v"]).alias("products"))


def per_row(df: DataFrame, columns: dict[str, T.DataType], fit: Callable[[np.ndarray], tuple]) -> DataFrame:
    """Replace ``products`` by model columns computed from each row's square matrix."""
    kept = [field for field in df.schema.fields if field.name != "products"]
    schema = T.StructType(kept + [T.StructField(name, kind) for name, kind in columns.items()])

    def convert(batches):
        for pdf in batches:
            results = []
            for flat in pdf["products"]:
                size = int(round(len(flat) ** 0.5))
                results.append(fit(np.asarray(flat, dtype=float).reshape(size, size)))
            out = pdf.drop(columns="products")
            for at, name in enumerate(columns):
                out[name] = pd.Series([result[at] for result in results], index=pdf.index, dtype=object)
            yield out

    return df.mapInPandas(convert, schema)


def score_blocks(
    rows: DataFrame,
    models: DataFrame,
    group: str,
    score: Callable[[pd.DataFrame, pd.Series], np.ndarray],
    block: int = SERIES_BLOCK,
) -> DataFrame:
    """``(group, pos, score)`` of all rows that are not context, each block scored with its group's model.

    ``rows`` carries ``_block`` and ``_context``; ``models`` has one row per group and is repeated once per
    block, never per row.  Groups without a model are left out.
    """
    sizes = rows.groupBy(group).agg(F.max("pos").alias("_last"))
    blocks = F.sequence(F.lit(0).cast("long"), block_of(F.col("_last"), block))
    spread = matched(models, sizes, group).withColumn("_block", F.explode(blocks)).drop("_last")
    schema = T.StructType(
        [rows.schema[group], T.StructField("pos", T.LongType()), T.StructField("score", T.DoubleType())]
    )

    def apply(data: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if data.empty or model.empty:
            return pd.DataFrame({group: pd.Series(dtype=object), "pos": pd.Series(dtype="int64"), "score": pd.Series(dtype=float)})
        data = data.sort_values("pos")
        values = score(data, model.iloc[0])
        own = ~data["_context"].to_numpy()
        return pd.DataFrame({group: data[group][own], "pos": data["pos"][own], "score": np.asarray(values)[own]})

    return (
        rows.groupBy(group, "_block").cogroup(spread.groupBy(group, "_block")).applyInPandas(apply, schema)
    )


def sliding(values: np.ndarray, size: int) -> np.ndarray:
    """All runs of ``size`` consecutive values as rows."""
    if len(values) < size:
        return np.empty((0, size))
    return np.lib.stride_tricks.sliding_window_view(values, size)
