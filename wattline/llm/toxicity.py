"""Toxicity by a classifier chain.

Categories are predicted one after another by logistic models over binary features; each model also sees the
probabilities of the categories before it. In training those come from models fitted on other folds, so that later
models meet earlier probabilities as uncertain as they will be on new texts.

Features are the words (lower case) and word beginnings that tell a category's positives from its negatives most
clearly in the training sample. Each category has an equal part of ``FEATURES``, so that one that many features tell
leaves room for the others. Labelled rows are sampled: about ``SAMPLE`` per combination of categories; weights
restore the true shares. Models are fitted on the driver from that bounded sample.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import annotated, schema, share, stratified
from wattline.session import settled

SAMPLE = 1500
FEATURES, LEAST = 600, 5
FOLDS = 3
BEGINNINGS = (3, 4, 5, 6)
RIDGE = 1.0
#: Probability from which a category counts as found.
FOUND = 0.5

WORDS = re.compile(r"[^\W\d_]+")


def features(text: str) -> set[str]:
    """Words, and beginnings shared by two or more different words."""
    words = set(WORDS.findall(text.lower()))
    begun = Counter(w[:n] + "-" for w in words for n in BEGINNINGS if len(w) > n)
    return words | {b for b, n in begun.items() if n > 1}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE, rounds: int = 30) -> np.ndarray:
    """Weights (the bias last) by Newton steps, halved while they do not help.

    Second-order steps find rare features' weights however many features other rows have.
    """
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-9

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(weight @ (np.logaddexp(0, z) - y * z) + 0.5 * penalty @ w**2)

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(rounds):
        p = sigmoid(x @ w)
        curve = (x.T * (weight * p * (1 - p))) @ x
        step = np.linalg.solve(curve + np.diag(penalty + 1e-9), x.T @ (weight * (p - y)) + penalty * w)
        before = now
        for _ in range(20):
            if (now := loss(w - step)) <= before:
                break
            step /= 2
        else:
            return w
        w = w - step
        if before - now <= 1e-9 * max(1.0, before):
            break
    return w


def apply_logistic(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])


class Chain:
    """One logistic model per category, each over the features and the earlier categories' probabilities."""

    def __init__(self, vocabulary: list[str], x: np.ndarray, y: np.ndarray, weight: np.ndarray, fold: np.ndarray):
        self.vocabulary = {v: k for k, v in enumerate(vocabulary)}
        self.models: list[np.ndarray] = []
        inputs = x
        for k in range(y.shape[1]):
            self.models.append(fit_logistic(inputs, y[:, k], weight))
            outside = np.zeros(len(x))
            for f in range(FOLDS):
                rest = fold != f
                if rest.any() and (~rest).any():
                    outside[~rest] = apply_logistic(fit_logistic(inputs[rest], y[rest, k], weight[rest]), inputs[~rest])
            inputs = np.hstack([inputs, outside[:, None]])

    def rows(self, texts: list) -> np.ndarray:
        x = np.zeros((len(texts), len(self.vocabulary)))
        for i, text in enumerate(texts):
            if text:
                x[i, [self.vocabulary[f] for f in features(text) & self.vocabulary.keys()]] = 1
        return x

    def predict(self, texts: list) -> np.ndarray:
        inputs = self.rows(texts)
        for w in self.models:
            inputs = np.hstack([inputs, apply_logistic(w, inputs)[:, None]])
        return inputs[:, len(self.vocabulary) :]


def sampled(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], text: str, id_col: str, most: int) -> DataFrame:
    """``id, combo, weight, fold, t``: a bounded sample of labelled texts. Ids labelled more than once take the label that
    most rows give, on a tie that the category holds; rows with a null label or text teach nothing."""
    vote = lambda c: (F.avg(c.cast("int")) >= 0.5).cast("int")
    known = labels.groupBy(F.col(id_col).alias("id")).agg(*[vote(c).alias(n) for n, c in categories.items()])
    combo = F.concat(*[F.col(n).cast("string") for n in categories]).alias("combo")
    known = known.filter(reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in categories])).select("id", combo)
    counts = known.groupBy("combo").count().withColumn("weight", F.greatest(F.col("count") / most, F.lit(1.0))).select("combo", "weight")
    picked = stratified(known, "combo", "id", most).join(F.broadcast(counts), "combo")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("t")).filter("t IS NOT NULL")
    # At most the sample's bound of short rows.
    picked = F.broadcast(picked.withColumn("fold", F.floor(share(F.lit("fold"), F.col("id")) * FOLDS).cast("int")))
    return texts.join(picked, "id")


def vocabulary_of(sample: DataFrame, n: int) -> list[str]:
    """For each category its part of ``n`` features: those with the clearest difference between positives and negatives."""

    def counted(batches):
        sums: dict[str, Counter] = {}
        for batch in batches:
            for combo, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums.setdefault(combo, Counter()).update(features(text))
        rows = [(combo, f, c) for combo, own in sums.items() for f, c in own.items()]
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(("combo", "feature", "n"), map(list, zip(*rows)), strict=True)))

    sizes = {r[0]: r[1] for r in sample.groupBy("combo").count().collect()}  # a row per combination
    each = sample.select("combo", "t").mapInArrow(counted, "combo string, feature string, n bigint")
    each = settled(each.groupBy("feature").pivot("combo", sorted(sizes)).agg(F.sum("n")).na.fill(0), "features")
    total = reduce(lambda a, b: a + b, [F.col(f"`{c}`") for c in sizes]) if sizes else F.lit(0)
    out: dict[str, None] = {}
    part = n // max(len(next(iter(sizes), "")), 1)
    for k in range(len(next(iter(sizes), ""))):
        on, off = [c for c in sizes if c[k] == "1"], [c for c in sizes if c[k] != "1"]
        if on and off:
            add = lambda cs: reduce(lambda a, b: a + b, [F.col(f"`{c}`") for c in cs]) + F.lit(0.5)
            p, q = add(on), add(off)
            a, b = sum(sizes[c] for c in on) + 1, sum(sizes[c] for c in off) + 1
            score = F.abs(F.log(p / (a - p)) - F.log(q / (b - q))) / F.sqrt(1 / p + 1 / q)
            ranked = each.filter(total >= LEAST).select("feature", score.alias("score")).orderBy(F.desc("score"), "feature").limit(part)
            out |= dict.fromkeys(r[0] for r in ranked.collect())  # n rows
    return list(out)


def fit(
    docs: DataFrame, labels: DataFrame, categories: dict[str, Column], text: str = "text", id_col: str = "doc_id", sample: int = SAMPLE
) -> Chain | None:
    """Fit a chain over ``categories`` (name to boolean column of ``labels``), in that order; None without a labelled
    text or a telling feature."""
    rows = sampled(docs, labels, categories, text, id_col, sample)
    vocabulary = vocabulary_of(rows, FEATURES)
    if not vocabulary:
        return None

    def start():
        place = {v: k for k, v in enumerate(vocabulary)}
        return lambda texts: [[sorted(place[f] for f in features(t) & place.keys()) for t in texts]]

    got = annotated(rows, "t", ["id", "combo", "weight", "fold"], schema("active array<int>"), start).toArrow().sort_by("id")
    x = np.zeros((got.num_rows, len(vocabulary)))
    for i, active in enumerate(got["active"].to_pylist()):
        x[i, active] = 1
    y = np.array([[c == "1" for c in combo] for combo in got["combo"].to_pylist()], float)
    return Chain(vocabulary, x, y, got["weight"].to_numpy(), got["fold"].to_numpy())


def predicted(
    docs: DataFrame, chain: Chain | None, categories: list[str], text: str = "text", carry: tuple[str, ...] = ("doc_id",), found: float = FOUND
) -> DataFrame:
    """``carry`` columns, a probability per category as ``p_<name>``, and ``<name>`` itself.

    One row per row. Null and empty texts have no features: their probabilities are the chain's biases, but no category
    counts as found. Without a chain all probabilities are 0. Carried columns named like a new one are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    fields = schema(", ".join([f"p_{c} double" for c in categories] + [f"{c} boolean" for c in categories]))

    def start():
        own = shared.value

        def made(texts: list) -> list[list]:
            p = own.predict(texts).T.tolist() if own else [[0.0] * len(texts)] * len(categories)
            return [*p, *([bool(v >= found and t) for v, t in zip(column, texts, strict=True)] for column in p)]

        return made

    return annotated(docs, text, list(carry), fields, start)
