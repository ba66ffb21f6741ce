"""Language identification by nearest centroids.

A text is the bag of its letter 1-, 2- and 3-grams (lower case; whatever is not a letter is one blank), hashed to ``DIMS``
dimensions, weighted by TF-IDF and scaled to length one. Each language has up to ``CENTROIDS`` centroids from spherical
k-means; the language of the most similar centroid wins. Document frequencies, centroids and limits are those of all
training texts; only the starting points of k-means come from about ``SAMPLE`` texts per language.

Similarity grows with the number of different grams, so each language has a limit for every doubling of that number: what
all but ``OUTLIERS`` of the passages of that band, cut from training texts, reach towards their own language. A text below
the limit of its language and band is rejected. Where a language has too few passages for the quantile, those of all
languages set the limit, and where these are too few, too, the limit of the band below holds.

Texts are counted, assigned to centroids and cut into passages by the workers. The driver gets sums by dimension and by
centroid, and one limit per language and band.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import SLICE, annotated, in_batches, schema, stratified
from wattline.operators.quantiles import exact_quantiles
from wattline.session import settled

DIMS = 4096
CENTROIDS = 3
SAMPLE = 600
#: Rounds of k-means over all training texts, after those over the sample; coordinates are summed in this fraction.
ROUNDS, UNIT = 2, 1 << 20
#: The share of training passages below the limit of their language and band; the number of bands.
OUTLIERS, BANDS = 0.002, 13
UNKNOWN = "und"
FIELDS = "lang_pred string, score double, rejected boolean"


@functools.cache
def letters() -> np.ndarray:
    """The code point of every letter, 0 elsewhere."""
    return np.array([i if chr(i).isalpha() else 0 for i in range(0x110000)], np.uint32)


def grams(text: str) -> np.ndarray | None:
    """Counts of the hashed letter grams, None without a letter."""
    codes = letters()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")]
    if not codes.any():
        return None
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0
    one = codes[keep]
    two = one[:-1] * np.uint32(0x01000193) + one[1:] + np.uint32(0x51ED270B)
    three = two[:-1] * np.uint32(0x01000193) + one[2:] + np.uint32(0x2545F491)
    mixed = np.concatenate([one, two, three]) * np.uint32(0x9E3779B1)
    return np.bincount(mixed >> np.uint32(20), minlength=DIMS)


def matrix(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Rows of dampened counts, and which texts have a letter."""
    rows, there = np.zeros((len(texts), DIMS), np.float32), np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        if text and (found := grams(text)) is not None:
            rows[i], there[i] = np.log1p(found), True
    return rows, there


def bands(rows: np.ndarray) -> np.ndarray:
    """How often the number of different grams of each row can be halved."""
    return np.maximum(np.frexp((rows > 0).sum(axis=1))[1] - 1, 0)


def passages(text: str) -> list[str]:
    """The text, and two passages of each doubling of the length, from the start of a word a third and two thirds in."""
    out = [text]
    for size in (1 << k for k in range(BANDS)):
        if size > len(text):
            break
        for third in (1, 2):
            start = text.rfind(" ", 0, (len(text) - size) * third // 3 + 1) + 1
            out.append(text[start : start + size])
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def clusters(rows: np.ndarray, most: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means, started from the mean and then from the row that is furthest from all chosen."""
    centres = unit(rows.mean(axis=0, keepdims=True))
    while len(centres) < min(most, len(rows)):
        centres = np.vstack([centres, rows[np.argmin((rows @ centres.T).max(axis=1))]])
    for _ in range(rounds):
        near = (rows @ centres.T).argmax(axis=1)
        centres = np.vstack([rows[near == k].mean(axis=0) if (near == k).any() else c for k, c in enumerate(centres)])
        centres = unit(centres)
    return centres


class Model:
    def __init__(self, rows: np.ndarray, labels: list[str], texts: int, frequencies: np.ndarray):
        """Starting points from ``rows``, weighted by how many of all ``texts`` have each gram."""
        order = sorted(set(labels))
        labels_at = np.array([order.index(x) for x in labels], int)
        self.idf = np.log((1 + texts) / (1 + frequencies)).astype(np.float32) + 1
        rows = unit(rows * self.idf)
        parts = [clusters(rows[labels_at == k], CENTROIDS) for k in range(len(order))]
        self.names = [name for name, part in zip(order, parts, strict=True) for _ in part]
        self.own = {name: np.flatnonzero(np.array(self.names) == name) for name in order}
        self.centres = np.vstack(parts).T.astype(np.float32)
        self.least = np.zeros((len(self.names), BANDS))

    def near(self, rows: np.ndarray) -> np.ndarray:
        return unit(rows * self.idf) @ self.centres

    def reached(self, text: str, lang: str) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """The grams of a text of a known language, their coordinates, and the similarity to the language's centroids."""
        found = grams(text) if lang in self.own else None
        if found is None:
            return None
        at = np.flatnonzero(found)
        values = unit((np.log1p(found[at]).astype(np.float32) * self.idf[at])[None])[0]
        return at, values, values @ self.centres[at][:, self.own[lang]]

    def move(self, sums: np.ndarray) -> None:
        """Each centroid to the sum of its texts, where it has any."""
        some = sums.any(axis=1)
        self.centres[:, some] = unit(sums[some].astype(float)).T.astype(np.float32)

    def limit(self, found: dict[tuple[str | None, int], tuple[int, float]]) -> None:
        """Set the limits from the passages and their quantile by language (None: all languages) and band."""
        enough = min(1 / OUTLIERS, max((n for (name, _), (n, _) in found.items() if name is None), default=0))
        for k, name in enumerate(self.names):
            for b in range(BANDS):
                known = [x for x in (found.get((name, b)), found.get((None, b))) if x and x[0] >= enough]
                self.least[k, b] = known[0][1] if known else self.least[k, b - 1] if b else 0.0

    def predict(self, texts: list) -> list[list]:
        rows, there = matrix(texts)
        near = self.near(rows)
        best, score = near.argmax(axis=1), np.clip(near.max(axis=1), 0, 1).astype(float)
        far = ~there | (score < self.least[best, bands(rows)])
        return [
            [self.names[k] if ok else UNKNOWN for k, ok in zip(best, there, strict=True)],
            [float(s) if ok else 0.0 for s, ok in zip(score, there, strict=True)],
            far.tolist(),
        ]


def held_out(id_col: str = "doc_id"):
    """The rows a model must not learn from: checksum of the id as text modulo 3 is 1 (a null id is held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def fit(train: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", sample: int = SAMPLE) -> Model | None:
    """Fit on all rows that have a language and a letter, started from about ``sample`` texts per language; None if there is none."""
    known = train.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(id_col, lang, text)
    rows = settled(stratified(known, lang, id_col, sample), "sample")

    def start():
        def made(texts: list) -> list[list]:
            counted, there = matrix(texts)
            whole = np.ascontiguousarray(counted, np.float16)
            return [[whole[i].tobytes() if ok else None for i, ok in enumerate(there)]]

        return made

    got = annotated(rows, text, [id_col, lang], schema("grams binary"), start).filter("grams IS NOT NULL").toArrow()
    if not got.num_rows:
        return None
    got = got.sort_by([(id_col, "ascending"), (lang, "ascending")])
    values = np.stack([np.frombuffer(x, np.float16) for x in got["grams"].to_pylist()]).astype(np.float32)
    pairs = known.select(F.col(lang).alias("lang"), F.col(text).alias("t"))
    model = Model(values, got[lang].to_pylist(), *frequencies(pairs))
    for _ in range(ROUNDS):
        model.move(assigned(pairs, model))
    model.limit(limits(pairs, model))
    return model


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE):
            yield from zip(*(c.to_pylist() for c in whole.slice(at, SLICE).columns), strict=True)


def frequencies(rows: DataFrame) -> tuple[int, np.ndarray]:
    """How many texts have a letter, and how many have each gram."""

    def counted(batches):
        sums = np.zeros(DIMS + 1, np.int64)
        for _, value in _pairs(batches):
            if (found := grams(value)) is not None:
                sums[:DIMS] += found > 0
                sums[DIMS] += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(DIMS + 1), pa.int32()), pa.array(sums)], ["b", "n"])

    out = np.zeros(DIMS + 1, np.int64)
    for b, n in in_batches(rows, counted, "b int, n bigint").groupBy("b").agg(F.sum("n")).collect():  # a row per gram
        out[b] = n
    return int(out[DIMS]), out[:DIMS]


def assigned(rows: DataFrame, model: Model) -> np.ndarray:
    """The sum of the texts nearest to each centroid of their own language, in whole fractions, so that no order matters."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def summed(batches):
        own = shared.value
        sums = np.zeros((len(own.names), DIMS), np.int64)
        for name, value in _pairs(batches):
            if (found := own.reached(value, name)) is not None:
                at, values, near = found
                sums[own.own[name][near.argmax()], at] += np.rint(values * UNIT).astype(np.int64)
        k, b = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(b, pa.int32()), pa.array(sums[k, b])], ["k", "b", "n"])

    out = np.zeros((len(model.names), DIMS), np.int64)
    sums = in_batches(rows, summed, "k int, b int, n bigint").groupBy("k", "b").agg(F.sum("n")).toArrow()  # the size of the model
    out[sums.column(0).to_numpy(), sums.column(1).to_numpy()] = sums.column(2).to_numpy()
    return out


def limits(rows: DataFrame, model: Model) -> dict[tuple[str | None, int], tuple[int, float]]:
    """By language (None: all languages) and band: the passages of all texts, and what all but ``OUTLIERS`` of them reach."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    fields = ["lang", "band", "near"]

    def compared(batches):
        own = shared.value
        names, at, near = [], [], []
        for name, whole in _pairs(batches):
            for passage in passages(whole):
                if (found := own.reached(passage, name)) is not None:
                    names.append(name)
                    at.append(len(found[0]).bit_length() - 1)
                    near.append(float(found[2].max()))
            if len(names) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(at, pa.int32()), pa.array(near)], fields)
                names, at, near = [], [], []
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(at, pa.int32()), pa.array(near)], fields)

    each = settled(in_batches(rows, compared, "lang string, band int, near double"), "passages")
    both = each.select("band", F.explode(F.array("lang", F.lit(None))).alias("lang"), "near")
    found = exact_quantiles(both, ["band", "lang"], "near", {"least": OUTLIERS})
    return {(r["lang"], r["band"]): (r["n_values"], r["least"]) for r in found.collect()}  # a row per language and band


def predicted(docs: DataFrame, model: Model | None, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns, the language, its similarity (0 to 1), and whether the text is too far from all of them.

    One row per row. A text that is null or has no letter is ``und`` with score 0, rejected. Ties go to the language
    that sorts first. Without a model every text is ``und``. Carried columns named like a new one are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        own = shared.value
        if own is None:
            return lambda texts: [[UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)]
        return own.predict

    return annotated(docs, text, list(carry), schema(FIELDS), start)
