"""Katz scores, lexical search and source divergence against plain Python, on tables with nulls, ties and repeats."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wattline.llm import katz, max_sketch, stripes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Extra columns named like columns that the operators make.
DOCS = "doc_id bigint, text string, lang string, source string, score double, row bigint, held boolean, word string, term string, rank int"


def made(rows):
    return [(*row, 0.5, 7, True, "w", "t", 3) for row in rows]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = "the of house river Walk thought straße été 7 x9 über".split() + [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choices(words, [30 / (i + 1) for i in range(len(words))], k=rng.randint(1, 80))) for _ in range(70)]
    texts = [f"{t} only{i} here{i} only{i}" if is_held(i) else t for i, t in enumerate(texts)]
    out = [(i, t, rng.choice(["en", "de"]), rng.choice(["a", "b", "c"])) for i, t in enumerate(texts)]
    out += [(100, texts[0], "en", "a"), (100, texts[0], "en", "a"), (100, texts[1], None, "a"), (None, texts[2], "en", None)]
    out += [
        (101, None, "en", "a"), (102, "", None, None), (103, " \t\n", "fr", "only"), (104, "THE the\x0bthe\xa0the,the.x", "en", "empty"),
        (None, None, None, None), (105, "the of " * 30_000, "en", "b"), (106, "y" * 300_000 + " the", "de", "c"), (107, "\x00 \x00", "fr", "d"),
        (108, "é" * 600_000 + "\n" + "of house " * 70_000, "de", "c"),
    ]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(made(rows), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def stored(spark, df, folder):
    df.write.parquet(str(folder))
    return spark.read.parquet(str(folder))


class Katz:
    """The model by dictionaries."""

    def __init__(self, texts):
        lines = [[None, *self.words(t)] for t in texts]
        self.one = Counter(w for line in lines for w in line[1:])
        self.two = Counter(p for line in lines for p in zip(line, line[1:]))
        self.total = Counter()
        self.after = defaultdict(list)
        for (v, w), c in self.two.items():
            self.total[v] += c
            self.after[v].append(w)
        self.n = sum(self.one.values())
        self.e, self.d = (katz.discounts([Counter(t.values())[r] for r in range(1, 7)]) for t in (self.one, self.two))

    @staticmethod
    def words(text):
        return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [" "]

    def single(self, w):
        def seen(c):
            return c * (self.e[c] if c <= 5 else 1) / (self.n + 1)

        return seen(self.one[w]) if w in self.one else 1 - sum(seen(c) for c in self.one.values())

    def after_context(self, v, w):
        c = self.two[v, w]
        return c * (self.d[c] if c <= 5 else 1) / (self.total[v] + 1)

    def probability(self, v, w):
        if self.two[v, w]:
            return self.after_context(v, w)
        if not self.total[v]:
            return self.single(w)
        left = 1 - sum(self.after_context(v, x) for x in self.after[v])
        return left / (1 - sum(map(self.single, self.after[v]))) * self.single(w)

    def scores(self, text):
        line = [None, *self.words(text)]
        base = sum(math.log10((self.one[w] + 1) / (self.n + len(self.one) + 1)) for w in line[1:])
        cache = {p: math.log10(self.probability(*p)) for p in set(zip(line, line[1:]))}
        return len(line) - 1, sum(self.one[w] > 0 for w in line[1:]), base, sum(cache[p] for p in zip(line, line[1:]))


def is_held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


@pytest.mark.parametrize(("frequent", "heavy", "bucket"), [(1 << 17, 1 << 18, 1 << 20), (2, 1, 64), (5, 20, 1000)])
def test_katz_scores_equal_dictionaries(spark, docs, rows, tmp_path, monkeypatch, frequent, heavy, bucket):
    monkeypatch.setattr(katz, "BUCKET", bucket)
    model = Katz([row[1] for row in rows if not is_held(row[0])])
    want = sorted(((row[0], is_held(row[0]), *model.scores(row[1])) for row in rows), key=repr)
    found = katz.scored(stored(spark, docs, tmp_path / "docs"), frequent=frequent, heavy=heavy)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.base_score, r.score) for r in found.collect()), key=repr)
    assert {r.train_tokens for r in found.select("train_tokens").distinct().collect()} == {model.n}
    assert len(got) == len(rows)
    by_key = lambda r: (repr(r[0]), r[2], round(r[4], 3))
    for a, b in zip(sorted(got, key=by_key), sorted(want, key=by_key), strict=True):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-7, abs=1e-7)
    assert any(a[3] < a[2] for a in got)


def test_katz_probabilities_sum_to_one(rows):
    model = Katz([row[1] for row in rows[:40]])
    for v in [None, "the", "w3", "never", *list(model.one)[:10]]:
        assert sum(model.probability(v, w) for w in [*model.one, "never"]) == pytest.approx(1, abs=1e-12)


def test_katz_without_training_rows(spark, docs, none):
    assert katz.scored(none).collect() == []
    out = katz.scored(docs, F.lit(True)).collect()
    assert {(r.train_tokens, r.n_known, r.base_score, r.score) for r in out} == {(0, 0, 0.0, 0.0)}


def search_by_hand(rows, items, k):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    held = [(row[0], Counter(terms(row[1]))) for row in rows]
    n, size = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        found = []
        for doc, c in held:
            m = 50 + 50 * c.total() * n // size
            own = [t for t in set(terms(text)) if t in c]
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own)
            if score > 0:
                found.append((-score, -math.inf if doc is None else doc, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(sorted(found, key=lambda f: f[:2])[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [
    (0, "The River w3, w7"), (1, "straße (ÉTÉ) été 7"), (2, None), (3, ""), (4, "nowhere"), (5, "the of"), (5, "the of"), (5, "w12"),
    (None, "y" * 300_000 + " w1"), (6, " ".join(f"w{i}" for i in range(40)) + " x9 of the"),
]


@pytest.mark.parametrize(("k", "chars"), [(50, 1 << 23), (3, 1 << 23), (7, 200_000)])
def test_search_equals_scoring_everything(spark, docs, rows, monkeypatch, k, chars):
    monkeypatch.setattr(max_sketch, "QUERY_CHARS", chars)
    items = spark.createDataFrame([(i, t, 1, 2.0) for i, t in ITEMS], "item_id bigint, text string, rank int, score double")
    got = sorted((tuple(r) for r in max_sketch.search(docs, items, k).collect()), key=repr)
    assert got == search_by_hand(rows, ITEMS, k)
    assert all(rank <= k for _, rank, _, _ in got)


def test_search_bounds_are_above_the_scores():
    rng = random.Random(5)
    counts = [Counter(rng.choices([b"t%d" % i for i in range(4000)], k=rng.randint(1, 900))) for _ in range(60)]
    query = {b"t%d" % i: rng.randint(1, 9000) for i in range(300)}
    searcher = max_sketch.Searcher([query], 60, sum(c.total() for c in counts), 5, [1])
    for c in counts:
        norm = searcher.norm(c.total())
        score = sum(weight * max_sketch.impact(c[t], norm) for t, weight in query.items() if t in c)
        assert (searcher.sketch(c, norm)[searcher.used] @ searcher.weights).item() >= score
    searcher.add(list(range(60)), counts)
    best = sorted(((-e[0], e[2]) for e in searcher.best[0]))
    every = sorted((-sum(w * max_sketch.impact(c[t], searcher.norm(c.total())) for t, w in query.items() if t in c), i) for i, c in enumerate(counts))
    assert best == every[:5]


def test_search_of_empty_tables(spark, docs, none):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert max_sketch.search(none, items).collect() == []
    assert max_sketch.search(docs, items.limit(0)).collect() == []


def divergences_by_hand(rows, keep):
    held, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        held[lang, source].update(terms)
        df[lang].update(set(terms))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= keep]

        def shares(counts, kept=kept):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p = {s: shares(held[lang, s]) for s in sources}
        q = shares(sum((held[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if held[lang, s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, i) for i, (v, o) in enumerate(sorted(pairs, key=lambda x: (x[0], x[1].encode())), 1)]
            out += [(lang, s, "term", t.decode(), -v, i) for i, (v, t) in enumerate(sorted(terms)[:50], 1)]
    return sorted(out)


@pytest.mark.parametrize(("keep", "block"), [(3, 1024), (30, 1024), (1, 2), (10_000, 1024)])
def test_divergences_equal_dictionaries(docs, rows, keep, block):
    got = sorted(tuple(r) for r in stripes.divergences(docs, keep=keep, block=block).collect())
    assert got == divergences_by_hand(rows, keep)


def test_divergences_of_an_empty_table(none):
    assert stripes.divergences(none).collect() == []


def test_shares_hold_beyond_64_bits(spark):
    import numpy as np

    count, size, kept = 123_456_789_012_345, 987_654_321_098_765, 1_000_003
    want = 1 + 10**9 * (count + 5) // (size + 5 * kept)
    frame = spark.createDataFrame([(count, size, kept)], "c bigint, n bigint, k bigint")
    assert frame.select(stripes.parts_per_billion(F.col("c"), F.col("n"), F.col("k"))).first()[0] == want
    assert stripes._shares(np.array([[count]]), np.array([size + 5 * kept]))[0, 0] == want


def test_pieces_cut_only_at_separators(monkeypatch):
    text = b"ab,cd" * 5 + b" " + b"x" * 50 + b" end"
    whole = text.translate(stripes.LETTERS).split()
    for size in (1, 2, 3, 7, 1000):
        monkeypatch.setattr(stripes, "PIECE", size)
        assert [t for part in stripes.pieces(text, stripes.LETTERS) for t in part] == whole
