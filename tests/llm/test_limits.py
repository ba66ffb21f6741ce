"""Limits learned from the data: planted texts that must go, beside clean ones that must stay."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from wattline.llm import language, quality, queries

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SOUNDS = {
    "en": "the and ing tion er es re th wh ha of nd on ly ou".split(),
    "de": "sch ein ung er en ich die der zu ver keit ü ach st pf".split(),
}
POLISH = "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem".split()
FINNISH = "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto".split()


def word(rng, lang):
    return "".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 4)))


def invented(rng, n, lang):
    return " ".join(word(rng, lang) for _ in range(n))


def letters(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 10))) for _ in range(n))


def test_foreign_texts_and_gibberish_are_rejected_at_every_length(spark):
    rng, lengths = random.Random(21), (6, 20, 100, 1500)
    train = [(i, invented(rng, rng.choice([1, 2, 5, 30, 200, 800]), lang), lang, "s", 1) for i in range(300) for lang in SOUNDS]
    clean = [invented(rng, n, lang) for n in (1, 2, *lengths) for lang in SOUNDS for _ in range(20)]
    alien = [" ".join(rng.choice(words) for _ in range(n)) for n in lengths for words in (POLISH, FINNISH) for _ in range(5)]
    alien += [letters(rng, n) for n in lengths for _ in range(5)]
    model = language.fit(spark.createDataFrame(train, DOCS))
    test = spark.createDataFrame([(i, t, None, "s", 1) for i, t in enumerate(clean + alien)], DOCS)
    rejected = {r["doc_id"] for r in language.predicted(test, model).filter("rejected").collect()}
    assert set(range(len(clean), len(clean) + len(alien))) <= rejected
    assert len(rejected & set(range(len(clean)))) <= 2


def test_all_training_texts_set_the_model(spark):
    """A sample of two texts per language must only start the search, whatever the others are."""
    rng = random.Random(23)
    langs = sorted(SOUNDS)
    rows = [(i, invented(rng, rng.choice([3, 30, 100]), lang), lang, "s", 1) for i, lang in enumerate(langs * 60)]
    train = spark.createDataFrame([*rows, (-1, "123", langs[0], "s", 1), (-2, None, langs[0], "s", 1), (-3, "word", None, "s", 1)], DOCS)
    model = language.fit(train, sample=2)
    known, there = language.matrix([r[1] for r in rows])
    assert there.all()
    want = np.log((1 + len(rows)) / (1 + (known > 0).sum(axis=0))) + 1
    assert np.allclose(model.idf, want)
    pieces = [(r[2], p) for r in rows for p in language.passages(r[1]) if language.grams(p) is not None]
    counted, _ = language.matrix([p for _, p in pieces])
    near, bands = model.near(counted), language.bands(counted)
    best = [near[i, model.own[lang]].max() for i, (lang, _) in enumerate(pieces)]
    pairs = train.filter("text IS NOT NULL AND lang IS NOT NULL").select("lang", F.col("text").alias("t"))
    got = language.limits(pairs, model)
    for (lang, band), (n, least) in got.items():
        values = [x for x, (name, _), b in zip(best, pieces, bands, strict=True) if b == band and lang in (None, name)]
        assert n == len(values) and abs(least - np.quantile(values, language.OUTLIERS)) < 1e-5
    assert {(None, b) for b in bands.tolist()} <= got.keys()
    sums = language.assigned(pairs, model)
    whole = [sums[model.own[lang]].sum(axis=0) for lang in langs]
    weighted = language.unit(known * model.idf)
    for lang, total in zip(langs, whole, strict=True):
        own = weighted[[r[2] == lang for r in rows]].sum(axis=0)
        assert np.allclose(total / language.UNIT, own, atol=1e-3)


def test_texts_without_common_words_and_menus_are_not_kept(spark):
    """Fixed limits kept every text without a single common word, however long; menus differ from prose in nothing else."""
    rng = random.Random(22)

    def prose(n, lang, common=0.4):
        return " ".join(rng.choice(quality.COMMON[lang]) if rng.random() < common else word(rng, lang) + rng.choice("xyz") for _ in range(n))

    def menu(n, lang):
        return " | ".join(word(rng, lang) + rng.choice("xyz") for _ in range(n))

    lengths = (200, 400, 900)
    clean = [(prose(n + rng.randint(0, 50), lang), lang) for n in lengths for lang in SOUNDS for _ in range(70)]
    clean += [(prose(1500, "en"), "en"), (prose(160, "de"), None), (prose(60, "en"), "en")]
    bad = [(prose(n, lang, 0), lang) for n in lengths for lang in SOUNDS for _ in range(5)]
    bad += [(menu(n, lang), lang) for n in lengths for lang in SOUNDS for _ in range(5)]
    bad += [(letters(rng, n), "en") for n in lengths]
    table = spark.createDataFrame([(i, t, lang, "s", 1) for i, (t, lang) in enumerate(clean + bad)], DOCS)
    got = quality.ruled(table)
    assert got.filter("base_failed").count() == 0
    assert got.filter("words_distance > 0.5 OR chars_distance > 0.3").count() == 0  # the fixed limits
    kept = {r["doc_id"] for r in got.filter(F.col("kept")).collect()}
    assert [t for i, (t, _) in enumerate(bad, len(clean)) if i in kept] == []
    assert len(set(range(len(clean))) - kept) <= 3


def test_histograms_equal_plain_counts(spark):
    """Common words side by side, apart by other blanks, within other words, and in capitals; symbols; letters beyond ASCII."""
    texts = [
        "the the  THE\tthe the other a a is isis #a |& $*%< >& über ÜBER für FÜR ſ",
        " \t\n", "", None, "für\x0bfür\x0cla la", "# # ## a#the the", "el él más MÁS él", "😀 the 😀the",
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: r for r in quality.measured(docs, "text", ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        split = re.findall("[^\x20\x09-\x0d]+", text or "")
        low = [w.lower() for w in split]
        assert got[i]["words"][:-1] == [low.count(w) for w in quality.VOCABULARY]
        assert got[i]["words"][-1] == len(split) - sum(w in quality.VOCABULARY for w in low)
        assert got[i]["word_chars"] == sum(map(len, split))
        assert got[i]["n_symbols"] == sum(c in quality.SYMBOLS for c in text or "")
    plan = quality.measured(docs, "text", ["doc_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "array_remove" not in plan and "translate" not in plan  # they took a third of the time


def test_texts_are_dealt_once_however_few_the_labels(spark, tmp_path, monkeypatch):
    """Few good ids were broadcast, more of them shuffled the texts: what a small table took told nothing about a large one."""
    docs = spark.createDataFrame([(i % 30, f"text {i}", "en", "s", 1) for i in range(40)] + [(None, "text", "en", "s", 1)], DOCS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.range(20).selectExpr("id AS doc_id", "int(id % 10 = 0) AS quality", "0 AS toxic")
    labels.union(labels).write.parquet(str(tmp_path / "labels.parquet"))
    seen = []
    monkeypatch.setattr(queries.importance, "resampled", lambda marked, target: seen.append((marked, target)))
    queries.op3_importance(spark, str(tmp_path))
    marked, target = seen[0]
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    assert plan(marked.select(target, "text")).count("SortMergeJoin") == 1
    assert "Join" not in plan(marked.select("doc_id", "text"))
    assert marked.count() == 41 and sorted(r["doc_id"] for r in marked.filter(target).collect()) == [0, 0, 10]
