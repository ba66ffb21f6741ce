"""A category that a few words tell beside one that thousands tell; labels that vote; files in the order of their numbers."""

import random

from pyspark.sql import functions as F

from wattline.llm import token_files, toxicity

DOCS = "doc_id bigint, text string"


def test_each_category_has_its_own_features(spark):
    rng = random.Random(3)
    categories = {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    name = lambda i: "".join(chr(97 + (i // 26**k) % 26) for k in range(3))
    junk = [f"{name(i)}junk" for i in range(3000)]
    insults = [f"{c}insult" for c in "abcdefghij"]
    docs, labels = [], []
    for i in range(1200):
        low, bad = i % 3 == 0, i % 10 == 1
        words = [f"{name(rng.randrange(400))}plain" for _ in range(60)] + rng.sample(junk, 400 if low else 0) + rng.sample(insults, 3 if bad else 0)
        docs.append((i, " ".join(words)))
        # Three votes a document: one in ten is wrong, most are right.
        labels += [(i, int(low == (rng.random() < 0.1)), int(bad != (rng.random() < 0.1))) for _ in range(3)]
    table, given = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    chain = toxicity.fit(table, given.filter("doc_id < 800"), categories)
    assert set(insults) <= chain.vocabulary.keys() and len(chain.vocabulary) > toxicity.FEATURES / 2
    got = toxicity.predicted(table.filter("doc_id >= 800"), chain, list(categories)).collect()
    clean = sorted(r["p_toxic"] for r in got if r["doc_id"] % 10 != 1)
    limit = clean[int(0.95 * len(clean))]  # one false alarm in twenty
    toxic = [r["p_toxic"] > limit for r in got if r["doc_id"] % 10 == 1]
    assert sum(toxic) >= 0.9 * len(toxic) and limit < toxicity.FOUND


def test_files_are_ordered_by_number():
    names = ["part-100000-a-c000.zlib.orc", "part-10001-a-c000.zlib.orc", "part-99999-a-c000.zlib.orc", "part-00002-a-c000.zlib.orc"]
    assert [token_files.file_number(n) for n in sorted(names, key=token_files.file_number)] == [2, 10001, 99999, 100000]
