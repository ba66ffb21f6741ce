"""Quality by importance resampling of hashed n-grams.

Two generative models are counted over all documents: word uni- and bigrams hashed to ``BUCKETS`` buckets, once in the
target texts and once in the raw texts. A document's log weight is the sum over its grams of the log ratio of the two
models. Adding Gumbel noise and keeping the largest sums draws without replacement in proportion to the weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import annotated, schema, share
from wattline.session import settled

BUCKETS = 10_000
#: Share of the documents to draw.
DRAWN = 0.8
SEED = 7
#: Added to every count of both models.
SMOOTHING = 1.0
#: Bins of one narrowing pass for the k-th largest key; with so few rows left in a bin, they are sorted.
BINS, FEW = 1024, 4096


def buckets(text: str) -> np.ndarray:
    """The bucket of each word and each pair of neighbouring words, lower case."""
    words = text.lower().encode("utf-8", "surrogatepass").split()
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((np.concatenate([one, two]) >> np.uint64(32)) % np.uint64(BUCKETS)).astype(np.int64)


def models(docs: DataFrame, target: Column, text: str) -> np.ndarray:
    """Counts of the raw and of the target model over all documents: one row per task and bucket is added up."""
    rows = docs.select(F.coalesce(target, F.lit(False)).alias("t"), F.col(text).alias("x"))

    def counted(batches):
        sums = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for wanted, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if value:
                    found = np.bincount(buckets(value), minlength=BUCKETS)
                    sums[0] += found
                    if wanted:
                        sums[1] += found
        yield pa.RecordBatch.from_arrays([pa.array(range(BUCKETS), pa.int32()), *map(pa.array, sums)], ["b", "raw", "wanted"])

    sums = rows.mapInArrow(counted, "b int, raw bigint, wanted bigint").groupBy("b").agg(F.sum("raw"), F.sum("wanted"))
    out = np.zeros((2, BUCKETS))
    for b, raw, wanted in sums.collect():  # BUCKETS rows
        out[:, b] = raw, wanted
    return out


def ratios(counts: np.ndarray) -> np.ndarray:
    """Log ratio of the target to the raw model by bucket; 0 everywhere if there is no target text."""
    if not counts[1].any():
        return np.zeros(BUCKETS)
    smooth = counts + SMOOTHING
    raw, wanted = smooth / smooth.sum(axis=1, keepdims=True)
    return np.log(wanted / raw)


def kth_largest(df: DataFrame, key: str, k: int) -> float | None:
    """The k-th largest value of ``key`` (finite doubles), exactly: counts by bin narrow the range pass by pass."""
    n, low, high = df.agg(F.count(key), F.min(key), F.max(key)).first()
    if not n or k <= 0:
        return None
    k = min(k, n)
    while True:
        inside = df.filter(F.col(key).between(low, high))
        above = df.filter(F.col(key) > high).count()
        here = inside.count()
        width = (high - low) / BINS
        if here <= FEW or not low + width > low:  # few rows, or few distinct values
            return _within(inside, key, k - above)
        bin_of = F.least(F.floor((F.col(key) - low) / width), F.lit(BINS - 1)).alias("bin")
        found = inside.groupBy(bin_of).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
        for _, count, lo, hi in sorted(found.collect(), reverse=True):  # BINS rows
            above += count
            if above >= k:
                low, high = lo, hi
                break


def _within(inside: DataFrame, key: str, k: int) -> float:
    """The k-th largest of rows with few distinct values."""
    for value, count in sorted(inside.groupBy(key).count().collect(), reverse=True):
        k -= count
        if k <= 0:
            return value
    raise ValueError("k is larger than the number of rows")


def resampled(
    docs: DataFrame, target: Column, text: str = "text", id_col: str = "doc_id", drawn: float = DRAWN, seed: int = SEED
) -> DataFrame:
    """``id_col``, the log weight, the Gumbel key and ``kept``: the ``drawn`` share of rows with the largest keys.

    ``target`` tells the rows of the target text; null counts as raw only. Null and empty texts have log weight 0.
    Noise depends on the id, the text and the seed, so repeated rows share one key; rows tied at the border are all
    kept. Without target texts all weights are 0, and the draw is uniform. An empty table gives no rows.
    """
    spark = docs.sparkSession
    weight = spark.sparkContext.broadcast(ratios(models(docs, target, text)))

    def start():
        own = weight.value
        return lambda texts: [[float(own[buckets(t)].sum()) if t else 0.0 for t in texts]]

    noise = share(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text}`")) + F.lit(2.0**-54)
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), (-F.log(-F.log(noise))).alias("gumbel_noise"), F.col(f"`{text}`").alias("text"))
    keyed = annotated(rows, "text", [id_col, "gumbel_noise"], schema("log_weight double"), start)
    keyed = settled(keyed.select(id_col, "log_weight", (F.col("log_weight") + F.col("gumbel_noise")).alias("gumbel_key")), "keys")
    border = kth_largest(keyed, "gumbel_key", round(drawn * keyed.count()))
    return keyed.withColumn("kept", F.col("gumbel_key") >= F.lit(float("inf") if border is None else border))
