"""Language-model scores by Katz backoff over word pairs.

The model. Let ``c`` be counts in the training texts, whose tokens number N. A word after a context ``v`` has the
probability ``d(c) * c / (c(v) + 1)`` if the pair was seen and ``alpha(v)`` times the word's own probability if not; a word
has ``e(c) * c / (N + 1)`` and everything unseen together the rest. ``d`` and ``e`` are Good-Turing discounts of counts up
to ``DISCOUNTED``. One more event per context is counted, so that there is always something left for unseen words. ``alpha``
makes the probabilities of all words after a context sum to 1 exactly: it is what the seen pairs leave over what their
words would have had without the context. An unseen context leaves the word's own probability.

The tables. Words are known by 64-bit hashes. Three passes over the texts count words, count pairs, and score. A task
folds about a million tokens into sorted arrays and deals them to buckets by context; the pairs of a context that is
more frequent than one token in ``HOT`` are dealt by the whole pair. Buckets grow in number with the tokens, and each is
merged in one piece. All scores are sums over tokens of logarithms rounded to ten decimals, so they do not depend on order.

What every task gets has a fixed size: the ``FREQUENT`` most frequent words and the pairs more frequent than one token in
``HEAVY``, of which there are fewer than ``HEAVY``. They only spare shuffling; all other words and pairs are met in buckets
and joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.stripes import pieces
from wattline.session import settled

DISCOUNTED = 5
FREQUENT, HOT, HEAVY = 1 << 17, 1 << 16, 1 << 18
#: Tokens that a task folds at once, and tokens of a bucket by expectation.
SLICE, BUCKET = 1 << 20, 1 << 20
#: Logarithms are counted in this fraction.
UNIT = 10_000_000_000

#: ASCII letters in lower case, the six ASCII separators as blanks, all else as it is.
WORDS = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
#: Marks that no word equals: the end of a text, the context of its first word, and the missing context of a single word.
END, START, ALONE = (xxhash.xxh3_64_intdigest(mark) for mark in (b"", b" ", b"  "))

_MIX = np.uint64(0x9E3779B97F4A7C15)


def logs(x) -> np.ndarray:
    """Decimal logarithms in units."""
    return np.rint(UNIT * np.log10(x)).astype(np.int64)


def log_column(x: Column) -> Column:
    return F.round(F.lit(float(UNIT)) * F.log10(x)).cast("bigint")


def tokens(text: bytes | None) -> np.ndarray:
    """The hashes of a text's words, then the end."""
    parts = [np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)) for found in pieces(text or b"", WORDS)]
    return np.concatenate([*parts, np.array([END], np.uint64)])


def discounts(seen: list[int]) -> np.ndarray:
    """The factor of each count up to ``DISCOUNTED`` from the numbers of things seen 1, 2, ... times.

    Where these numbers give no factor between 0 and 1, half an occurrence is taken off.
    """
    n = [0, *seen, *[0] * (DISCOUNTED + 1 - len(seen))]
    out = np.ones(DISCOUNTED + 1)
    for r in range(1, DISCOUNTED + 1):
        factor = -1.0
        if n[1] and n[r] and (DISCOUNTED + 1) * n[DISCOUNTED + 1] != n[1]:
            share = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1]
            factor = ((r + 1) * n[r + 1] / (r * n[r]) - share) / (1 - share)
        out[r] = factor if 0 < factor < 1 else (r - 0.5) / r
    return out


def discounted(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= DISCOUNTED, factors[np.minimum(counts, DISCOUNTED)], 1.0)


def discounted_column(count: Column, factors: np.ndarray) -> Column:
    out = count.cast("double")
    for r in range(1, DISCOUNTED + 1):
        out = F.when(count == r, F.lit(float(r * factors[r]))).otherwise(out)
    return out


def left_over(seen: list[int], factors: np.ndarray) -> float:
    """One event and all that the discounts took off."""
    return 1 + sum(r * (1 - factors[r]) * n for r, n in zip(range(1, DISCOUNTED + 1), seen, strict=False))


class Words:
    """The model of single words: sizes, discounts, and the counts of the most frequent words."""

    def __init__(self, size: int, distinct: int, seen: list[int], hashes: np.ndarray, counts: np.ndarray) -> None:
        self.size, self.distinct, self.factors = size, distinct, discounts(seen)
        self.unseen = left_over(seen, self.factors) / (size + 1)
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts[order]
        self.by_count = np.argsort(-self.counts, kind="stable")
        self.rank = np.empty(len(hashes), np.uint32)
        self.rank[self.by_count] = np.arange(len(hashes))
        self.weights = np.zeros(len(hashes), np.int64)

    def place(self, hashes: np.ndarray) -> np.ndarray:
        """Where the frequent words stand, -1 for others."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.factors) / (self.size + 1), self.unseen)

    def probability_column(self, count: Column) -> Column:
        seen = discounted_column(count, self.factors) / F.lit(float(self.size + 1))
        return F.when(F.coalesce(count, F.lit(0)) > 0, seen).otherwise(F.lit(float(self.unseen)))

    def base(self, counts: np.ndarray) -> np.ndarray:
        return logs((counts + 1) / (self.size + self.distinct + 1))

    def buckets(self, v: np.ndarray, w: np.ndarray, buckets: int) -> np.ndarray:
        """By context; by the pair for hot contexts, by the word for single words."""
        at = self.place(v)
        hot = (at >= 0) & (self.counts[at] * HOT > self.size)
        key = np.where(v == np.uint64(ALONE), w, np.where(hot, v * _MIX + w, v))
        return ((key * _MIX) >> np.uint64(33)).astype(np.int64) % buckets


    def code(self, hashes: np.ndarray) -> list[np.ndarray]:
        """Ranks of the frequent words, a rank beyond the last for others, and the hashes of those."""
        at = self.place(hashes)
        return [np.where(at >= 0, self.rank[at], np.uint32(len(self.rank))).astype(np.uint32), hashes[at < 0]]

    def decode(self, ranks: np.ndarray, rare: np.ndarray) -> np.ndarray:
        out = np.empty(len(ranks), np.uint64)
        known = ranks < len(self.rank)
        out[known] = self.hashes[self.by_count[ranks[known]]]
        out[~known] = rare
        return out


def packed(*columns: np.ndarray) -> bytes:
    """Columns of any lengths; first the lowest bytes of all numbers of a column, then the next, which compresses better."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() if len(c) else b"" for c in columns]
    head = np.array([[len(c), c.itemsize] for c in columns], np.int64).tobytes()
    raw = b"".join([head, *planes])
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def unpacked(blob: bytes, kinds: tuple) -> list[np.ndarray]:
    raw = pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    out, at = [], 16 * len(kinds)
    for (n, size), kind in zip(np.frombuffer(raw, np.int64, 2 * len(kinds)).reshape(-1, 2).tolist(), kinds, strict=True):
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * size
    return out


DEALT = "bucket int, first bigint, payload binary"


def dealt(bucket: np.ndarray, columns: list[np.ndarray], first: int = 0, words: Words | None = None) -> pa.RecordBatch:
    """One row per bucket with its part of all columns, packed; with ``words`` the first two columns are their hashes."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(bucket))
    blobs = []
    for a, b in zip(starts, ends, strict=True):
        own = [c[order[a:b]] for c in columns]
        blobs.append(packed(*own) if words is None else packed(*words.code(own[0]), *words.code(own[1]), *own[2:]))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[starts], pa.int32()), pa.array([first] * len(starts), pa.int64()), pa.array(blobs, pa.binary())],
        names=["bucket", "first", "payload"],
    )


def collected(table: pa.Table, kinds: tuple, words: Words) -> list[np.ndarray]:
    """Both hashes and the columns of all rows of a bucket, and the first row number of each entry."""
    parts = []
    for blob, first in zip(table["payload"].to_pylist(), table["first"].to_pylist(), strict=True):
        v, rare_v, w, rare_w, *rest = unpacked(blob, (np.uint32, np.uint64, np.uint32, np.uint64, *kinds))
        parts.append([words.decode(v, rare_v), words.decode(w, rare_w), *rest, np.full(len(v), first)])
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


def same_pairs(v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal pairs side by side, and where each pair starts in it."""
    order = np.lexsort((w, v))
    v, w = v[order], w[order]
    return order, np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (w[1:] != w[:-1])]))


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, int, list[np.ndarray]]]:
    """Rows in slices of about ``SLICE`` tokens, a longer text alone: other columns, number of the first row, tokens."""
    rows: list = []
    texts: list = []
    first = seen = held = 0
    for batch in batches:
        for *other, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = tokens(text)
            if held and held + len(own) > SLICE:
                yield rows, first, texts
                rows, texts, first, held = [], [], seen, 0
            rows.append(other)
            texts.append(own)
            held += len(own)
            seen += 1
    if texts:
        yield rows, first, texts


def word_counts(train: DataFrame) -> DataFrame:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, texts in sliced(batches):
            found, counts = np.unique(np.concatenate(texts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], names=["word", "count"])

    return train.select("text").mapInArrow(counted, "word bigint, count bigint").groupBy("word").agg(F.sum("count").alias("count"))


def words_model(counts: DataFrame, frequent: int = FREQUENT) -> Words:
    """Sizes from all counts; the ``frequent`` words that tasks know beforehand are collected."""
    of = [F.count_if(F.col("count") == r) for r in range(1, DISCOUNTED + 2)]
    size, distinct, *seen = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count(F.lit(1)), *of).first()
    top = counts.orderBy(F.desc("count"), "word").limit(frequent).toArrow()
    known = dict(zip(top["word"].to_pylist(), top["count"].to_pylist(), strict=True))
    ends = counts.filter(F.col("word") == _signed(END)).first()
    # As a context the start is as frequent as the end is as a word.
    known |= {_signed(mark): ends["count"] if ends else 0 for mark in (END, START)}
    return Words(size, distinct, seen, np.array(list(known), np.int64).view(np.uint64), np.array(list(known.values()), np.int64))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


PAIRS, ENTRIES = (np.uint32,), (np.uint32, np.uint32)


def pair_statistics(train: DataFrame, words: Words, buckets: int, heavy: int = HEAVY) -> DataFrame:
    """What the counts of pairs give, by ``kind``, settled.

    0: how many pairs (b) were seen a times; 1: per context a how many pairs were seen 1 to ``DISCOUNTED`` times (m) and
    the probability s of their frequent words; 2: pairs of a context a and a word b that is not frequent; 3: pairs seen
    (c) more often than one token in ``heavy``.
    """
    spark = train.sparkSession
    sent = spark.sparkContext.broadcast(words)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for _, _, texts in sliced(batches):
            known, place = np.unique(np.concatenate([*texts, np.array([START], np.uint64)]), return_inverse=True)
            n = len(known)
            ends = np.cumsum([len(t) for t in texts])
            w, start = place[:-1], place[-1]
            v = np.roll(w, 1)
            v[np.concatenate([[0], ends[:-1]])] = start
            pairs, counts = np.unique(v.astype(np.int64) * n + w, return_counts=True)
            v, w = known[pairs // n], known[pairs % n]
            yield dealt(model.buckets(v, w, buckets), [v, w, counts.astype(np.uint32)], words=model)

    def merge(table: pa.Table) -> pa.Table:
        model = sent.value
        v, w, c, _ = collected(table, PAIRS, model)
        order, starts = same_pairs(v, w)
        v, w, c = v[order][starts], w[order][starts], np.add.reduceat(c[order].astype(np.int64), starts)
        rows = []

        def add(kind, a, b=None, c=None, m=None, s=None):
            size = len(a)
            none = pa.nulls(size, pa.int64())
            rows.append(
                [pa.array(np.full(size, kind, np.int8)), pa.array(a), *[none if x is None else pa.array(x) for x in (b, c, *(m or [None] * DISCOUNTED))]]
                + [pa.nulls(size, pa.float64()) if s is None else pa.array(s)]
            )

        few = np.bincount(c[c <= DISCOUNTED + 1], minlength=DISCOUNTED + 2)[1:]
        add(0, np.arange(1, DISCOUNTED + 2), few.astype(np.int64))
        at = model.place(w)
        chance = np.where(at >= 0, model.probability(model.counts[at]), 0.0)
        context = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        m = [np.add.reduceat((c == r).astype(np.int64), context) for r in range(1, DISCOUNTED + 1)]
        add(1, v[context].view(np.int64), m=m, s=np.add.reduceat(chance, context))
        rare = at < 0
        add(2, v[rare].view(np.int64), w[rare].view(np.int64))
        many = c * heavy > model.size
        add(3, v[many].view(np.int64), w[many].view(np.int64), c[many])
        columns = [pa.chunked_array(parts) for parts in zip(*rows, strict=True)]
        return pa.table(columns, names=["kind", "a", "b", "c", *[f"m{r}" for r in range(1, DISCOUNTED + 1)], "s"])

    fields = ", ".join(["kind tinyint, a bigint, b bigint, c bigint", *[f"m{r} bigint" for r in range(1, DISCOUNTED + 1)], "s double"])
    rows = train.select("text").mapInArrow(fold, DEALT)
    return settled(rows.groupBy("bucket").applyInArrow(merge, fields), "pairs")


def backoff_weights(statistics: DataFrame, counts: DataFrame, words: Words, factors: np.ndarray) -> DataFrame:
    """``(word, weight)``: log of alpha(v) * (c(v) + 1) for every context, in units."""
    m = [f"m{r}" for r in range(1, DISCOUNTED + 1)]
    rare = statistics.filter("kind = 2").join(counts, F.col("b") == F.col("word"))
    rare = rare.groupBy("a").agg(F.sum(words.probability_column(F.col("count"))).alias("s"))
    known = statistics.filter("kind = 1").select("a", *m, "s")
    both = known.unionByName(rare, allowMissingColumns=True).groupBy("a").agg(*[F.sum(x).alias(x) for x in (*m, "s")])
    left = F.lit(1.0)
    for r, name in enumerate(m, 1):
        left = left + F.lit(float(r * (1 - factors[r]))) * F.col(name)
    # What is not seen has at least the share of unseen words; the bound only guards against rounding.
    free = F.greatest(F.lit(1.0) - F.col("s"), F.lit(float(words.unseen)))
    return settled(both.select(F.col("a").alias("word"), log_column(left / free).alias("weight")), "weights")


def partial_scores(docs: DataFrame, words: Words, factors: np.ndarray, heavy: pa.Table, buckets: int) -> DataFrame:
    """Parts of the documents' sums, settled.

    Role 0: the sums of a slice's documents from one bucket, packed; 1: a slice's documents with what needs no bucket; 2 and
    3: a context and a word (key) that are not frequent and how often (n) they occur in unseen pairs of a document (row).
    """
    sent = docs.sparkSession.sparkContext.broadcast((words, factors, _by_mix(heavy)))
    numbered = docs.select("id", "held", "text")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        model, d, (mixed, heavy_v, heavy_w, heavy_c) = sent.value
        task = TaskContext.get().partitionId() << 33
        for rows, first, texts in sliced(batches):
            known, place = np.unique(np.concatenate([*texts, np.array([START], np.uint64)]), return_inverse=True)
            n, many = len(known), len(texts)
            sizes = np.array([len(t) for t in texts], np.int64)
            begins = np.cumsum(sizes) - sizes
            w, start = place[:-1].astype(np.int64), int(place[-1])
            v = np.roll(w, 1)
            v[begins] = start
            doc = np.repeat(np.arange(many), sizes)
            # Single words: the frequent ones are known, the others go to their bucket.
            at = model.place(known)
            counts = np.where(at >= 0, model.counts[at], 0)
            follows = np.where((at >= 0) & (known != np.uint64(END)), -logs(counts + 1), 0)
            base = np.add.reduceat(np.where(at >= 0, model.base(counts), 0)[w], begins)
            found = np.add.reduceat((counts > 0).astype(np.int64)[w], begins)
            score = np.add.reduceat(follows[w], begins) + follows[start]
            single, times = np.unique(w[at[w] < 0] * many + doc[at[w] < 0], return_counts=True)
            # Pairs: the heavy ones are known.
            pair, often = np.unique((v * n + w) * many + doc, return_counts=True)
            owner, pair = pair % many, pair // many
            pv, pw = known[pair // n], known[pair % n]
            here = np.minimum(np.searchsorted(mixed, pv * _MIX + pw), max(len(mixed) - 1, 0))
            is_heavy = (heavy_v[here] == pv) & (heavy_w[here] == pw) if len(mixed) else np.zeros(len(pv), bool)
            gain = logs(discounted(heavy_c[here[is_heavy]], d)) * often[is_heavy]
            np.add.at(score, owner[is_heavy], gain)
            rest = ~is_heavy
            marked = np.array([not held for _, held in rows], np.uint32)
            ev = np.concatenate([pv[rest], np.full(len(single), ALONE, np.uint64)])
            ew = np.concatenate([pw[rest], known[single // many]])
            en = np.concatenate([often[rest], times]).astype(np.uint32)
            eo = np.concatenate([owner[rest], single % many])
            row = task + first
            yield dealt(model.buckets(ev, ew, buckets), [ev, ew, en, (eo * 2 + marked[eo]).astype(np.uint32)], row, model)
            ids = np.array([i or 0 for i, _ in rows], np.int64)
            flags = np.array([2 * (i is None) + bool(held) for i, held in rows], np.int64)
            yield dealt(np.full(many, -1 - row % buckets), [ids, flags, sizes, score, base, found], row)

    def merge(table: pa.Table) -> pa.Table:
        model, d, _ = sent.value
        if table["bucket"][0].as_py() < 0:
            return _parts(1, first=table["first"].combine_chunks(), payload=table["payload"].combine_chunks())
        v, w, n, owner, first = collected(table, ENTRIES, model)
        n, row, train = n.astype(np.int64), first + (owner >> 1), (owner & 1).astype(np.int64)
        order, starts = same_pairs(v, w)
        counts = np.empty(len(v), np.int64)
        counts[order] = np.repeat(np.add.reduceat((n * train)[order], starts), np.diff(np.append(starts, len(v))))
        alone, seen = v == np.uint64(ALONE), counts > 0
        pv, pw = model.place(v), model.place(w)
        unseen = ~alone & ~seen
        score = np.where(alone, -logs(counts + 1), np.where(seen, logs(discounted(np.maximum(counts, 1), d)), 0))
        score += np.where(unseen & (pv >= 0), model.weights[pv], 0)
        score += np.where(unseen & (pw >= 0), logs(model.probability(model.counts[pw])), 0)
        base, found = np.where(alone, model.base(counts), 0), (alone & seen).astype(np.int64)
        by_row = np.argsort(row, kind="stable")
        begins = np.flatnonzero(np.concatenate([[True], np.diff(row[by_row]) != 0]))
        sums = [np.add.reduceat((x * n)[by_row], begins) for x in (score, base, found)]
        # One row per slice of the texts with the sums of its documents, so that their number does not multiply.
        rows, slices = row[by_row][begins], first[by_row][begins]
        cuts = np.flatnonzero(np.concatenate([[True], slices[1:] != slices[:-1]]))
        blobs = [
            packed((rows[a:z] - slices[a]).astype(np.uint32), *[x[a:z] for x in sums])
            for a, z in zip(cuts, np.append(cuts[1:], len(rows)), strict=True)
        ]
        parts = [_parts(0, first=pa.array(slices[cuts]), payload=pa.array(blobs, pa.binary()))]
        for role, missing, key in ((2, unseen & (pv < 0), v), (3, unseen & (pw < 0), w)):
            parts.append(_parts(role, row=pa.array(row[missing]), key=pa.array(key[missing].view(np.int64)), n=pa.array(n[missing])))
        return pa.concat_tables(parts)

    parts = numbered.mapInArrow(fold, DEALT).groupBy("bucket").applyInArrow(merge, PARTS)
    return settled(parts, "parts")


PARTS = "role tinyint, first bigint, payload binary, row bigint, key bigint, n bigint"


def _parts(role: int, **columns: pa.Array) -> pa.Table:
    size = len(next(iter(columns.values())))
    kinds = {"first": pa.int64(), "payload": pa.binary(), "row": pa.int64(), "key": pa.int64(), "n": pa.int64()}
    rest = {name: columns[name].cast(kind) if name in columns else pa.nulls(size, kind) for name, kind in kinds.items()}
    return pa.table({"role": pa.array(np.full(size, role, np.int8)), **rest})


def added_up(parts: DataFrame) -> DataFrame:
    """``(row, id, held, n_tokens, n_known, base, score)``: the documents of a slice with the sums from all buckets."""

    def add(table: pa.Table) -> pa.Table:
        roles, blobs = table["role"].to_pylist(), table["payload"].to_pylist()
        ids, flags, sizes, *sums = unpacked(blobs[roles.index(1)], (np.int64,) * 6)
        sums = [x.copy() for x in sums]
        for role, blob in zip(roles, blobs, strict=True):
            if role == 0:
                place, *more = unpacked(blob, (np.uint32, np.int64, np.int64, np.int64))
                for x, y in zip(sums, more, strict=True):
                    x[place] += y  # every document once a bucket
        score, base, found = sums
        row = table["first"][0].as_py() + np.arange(len(ids))
        columns = [row, pa.array(ids, mask=flags >= 2), flags % 2 == 1, sizes, found, base, score]
        return pa.table(list(map(pa.array, columns)), names=["row", "id", "held", "n_tokens", "n_known", "base", "score"])

    fields = "row bigint, id bigint, held boolean, n_tokens bigint, n_known bigint, base bigint, score bigint"
    return parts.filter("role < 2").select("role", "first", "payload").groupBy("first").applyInArrow(add, fields)


def _by_mix(heavy: pa.Table) -> tuple[np.ndarray, ...]:
    v, w = (heavy[c].to_numpy().view(np.uint64) for c in "ab")
    mixed = v * _MIX + w
    order = np.argsort(mixed)
    return mixed[order], v[order], w[order], heavy["c"].to_numpy()[order]


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that the model does not learn from; those without an id count as the id ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), F.lit(7)) == 2


def scored(
    docs: DataFrame, held: Column | None = None, text: str = "text", id_col: str = "doc_id", frequent: int = FREQUENT, heavy: int = HEAVY
) -> DataFrame:
    """Every row's ``base_score`` and ``score``, with the numbers of its tokens, known tokens and all training tokens.

    Rows where ``held`` holds are scored but not learned from. A null or empty text is its end alone. Repeated rows are
    learned from and scored each. Without training rows every word has probability 1. Other columns are ignored. An empty
    table gives no rows. Rows are numbered by their place in a scan, which must be repeatable, as it is for files.
    """
    held = held_out(id_col) if held is None else F.coalesce(held, F.lit(False))
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), held.alias("held"), F.col(f"`{text}`").cast("binary").alias("text"))
    train = rows.filter(~F.col("held"))
    counts = settled(word_counts(train), "words")
    words = words_model(counts, frequent)
    buckets = words.size // BUCKET + 1
    statistics = pair_statistics(train, words, buckets, heavy)
    seen = dict(statistics.filter("kind = 0").groupBy("a").agg(F.sum("b")).collect())
    factors = discounts([seen.get(r, 0) for r in range(1, DISCOUNTED + 2)])
    weights = backoff_weights(statistics, counts, words, factors)
    known = docs.sparkSession.createDataFrame(pa.table({"known": words.hashes.view(np.int64)}))  # FREQUENT rows
    for word, weight in weights.join(F.broadcast(known), F.col("word") == F.col("known")).select("word", "weight").collect():
        words.weights[np.searchsorted(words.hashes, np.uint64(word % (1 << 64)))] = weight
    parts = partial_scores(rows, words, factors, statistics.filter("kind = 3").select("a", "b", "c").toArrow(), buckets)

    zero = F.lit(0).cast("bigint")
    contexts = parts.filter("role = 2").join(weights, F.col("key") == F.col("word"), "left")
    contexts = contexts.select("row", (F.col("n") * F.coalesce("weight", zero)).alias("score"))
    single = parts.filter("role = 3").join(counts, F.col("key") == F.col("word"), "left")
    single = single.select("row", (F.col("n") * log_column(words.probability_column(F.col("count")))).alias("score"))
    every = added_up(parts).unionByName(contexts, True).unionByName(single, True)
    added = every.groupBy("row").agg(
        F.max("id").alias("id"), F.max("held").alias("held"), F.max("n_tokens").alias("n_tokens"),
        *[F.sum(c).alias(c) for c in ("n_known", "base", "score")],
    )
    return added.select(
        F.col("id").alias(id_col),
        F.col("held").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(words.size).cast("bigint").alias("train_tokens"),
        (F.col("base") / F.lit(float(UNIT))).alias("base_score"),
        (F.col("score") / F.lit(float(UNIT))).alias("score"),
    )


def oracle() -> str:
    """DuckDB SQL for ``scored`` over ``documents``; the checksum is computed bit by bit."""
    codes = "list_transform(string_split(d, ''), lambda x: ascii(x)::BIGINT)"
    bits = "list_reduce([xor(r, x)] || range(8), lambda a, i: xor(a >> 1, (a & 1) * 3988292384))"
    crc = f"xor(list_reduce([4294967295] || {codes}, lambda r, x: {bits}), 4294967295)"
    top = DISCOUNTED + 1

    def factors(table: str) -> str:
        numbers = ", ".join(f"count(*) FILTER (c = {r})::DOUBLE AS n{r}" for r in range(1, top + 1))
        cases = " ".join(
            f"WHEN {r} THEN CASE WHEN n1 > 0 AND n{r} > 0 AND {top} * n{top} <> n1 THEN ({r + 1} * n{r + 1} / ({r} * n{r}) - {top} * n{top} / n1)"
            f" / (1 - {top} * n{top} / n1) END"
            for r in range(1, top)
        )
        return (
            f"SELECT r, CASE WHEN f > 0 AND f < 1 THEN f ELSE (r - 0.5::DOUBLE) / r END AS f, k FROM ("
            f"SELECT r, CASE r {cases} END AS f, CASE r {' '.join(f'WHEN {r} THEN n{r}' for r in range(1, top))} END AS k"
            f" FROM (SELECT {numbers} FROM {table}), (SELECT unnest(range(1, {top})) AS r))"
        )

    log = f"round({UNIT}::DOUBLE * log10({{}}))::BIGINT"
    return rf"""
    WITH docs AS (
      SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS text,
        (CASE WHEN d = '' THEN 0 ELSE {crc} END) % 7 = 2 AS held
      FROM (SELECT *, coalesce(doc_id::VARCHAR, '') AS d FROM documents)
    ), listed AS (
      SELECT doc, held, list_concat(['<'], regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), [' ']) AS t
      FROM docs
    ), pairs AS (
      SELECT doc, held, CASE WHEN i = 1 THEN '' ELSE t[i] END AS v, t[i + 1] AS w
      FROM (SELECT *, unnest(range(1, len(t))) AS i FROM listed)
    ), words AS (SELECT w, count(*) AS c FROM pairs WHERE NOT held GROUP BY w),
    seen AS (SELECT v, w, count(*) AS c FROM pairs WHERE NOT held GROUP BY v, w),
    size AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM words),
    e AS ({factors("words")}), d AS ({factors("seen")}),
    rest AS (SELECT (1 + (SELECT sum(r * (1 - f) * k) FROM e)) / (n + 1) AS unseen FROM size),
    single AS (SELECT w, c, c * coalesce(f, 1) / (n + 1) AS p FROM words LEFT JOIN e ON r = c, size),
    contexts AS (
      SELECT v, {log.format("(1 + coalesce(sum(r * (1 - f)), 0)) / greatest(1 - sum(p), any_value(unseen))")} AS weight
      FROM seen s JOIN single USING (w) LEFT JOIN d ON r = s.c, rest GROUP BY v
    ), totals AS (SELECT v, sum(c) AS c FROM seen GROUP BY v),
    scores AS (
      SELECT p.doc, count(*) AS n_tokens, count(g.c) AS n_known,
        sum({log.format("(coalesce(g.c, 0) + 1) / (n + size.v + 1)::DOUBLE")})::BIGINT AS base,
        sum(CASE WHEN s.c > 0 THEN {log.format("s.c * coalesce(f, 1)")} ELSE coalesce(weight, 0) + {log.format("coalesce(g.p, unseen)")} END
          - {log.format("coalesce(t.c, 0) + 1")})::BIGINT AS score
      FROM pairs p LEFT JOIN single g USING (w) LEFT JOIN seen s ON s.v = p.v AND s.w = p.w LEFT JOIN d ON r = s.c
        LEFT JOIN contexts x ON x.v = p.v LEFT JOIN totals t ON t.v = p.v, size, rest
      GROUP BY p.doc
    )
    SELECT doc_id, held AS held_out, n_tokens, n_known, n AS train_tokens, base / {UNIT}::DOUBLE AS base_score, score / {UNIT}::DOUBLE AS score
    FROM docs JOIN scores USING (doc), size
    """
