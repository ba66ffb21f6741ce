"""The training-data operators against brute force, on small tables with nulls, ties, repeats and very long texts."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattline.llm import bpe, chosen_path, decontaminate, importance, language, pii, quality, queries, token_files, toxicity, warc
from wattline.llm.components import components

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
BLANKS = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n, lang="en"):
    words = {"en": "the of and to in that house river walking thought", "de": "der die und nicht ein haus schlüssel straße grün"}[lang].split()
    return " ".join(rng.choice(words) + rng.choice(["", "s", "x", "ly"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    base = [prose(rng, 120) for _ in range(6)]
    out = [(i, t, "en", "s", len(t)) for i, t in enumerate(base)]
    for i, t in enumerate(base[:3]):
        words = t.split()
        words[50] = "changed"
        out += [(10 + i, t, "en", "s", len(t)), (20 + i, " ".join(words), "en", "s", len(t))]
    out += [(30 + i, prose(rng, 150, "de"), "de", None, None) for i in range(6)]
    out += [
        (40, None, "en", "s", None), (41, "", None, "s", 0), (42, " \t\n", "de", None, 3), (43, "one", "en", "s", 3),
        (43, "one", "en", "s", 3), (44, "one two", "xx", "s", 7), (None, base[5], "en", "s", 1), (None, None, None, None, None),
        (45, "a" * 300_000, "en", "s", 1), (46, " " * 250_000 + "x  y\n\n z", "en", "s", 1), (47, "7 " * 60_000, "en", "s", 1),
        (48, "mail a.b@c.example.org, 1.2.3.4 or 999.1.1.1, +1 (743) 555-3824; 4785 3805 9239 1139 café 𝄞 x@y.zz", "en", "s", 1),
        (49, base[0].upper() + " NAÏVE É", "en", "s", 1),
    ]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df):
    return {(r["doc_id"], i): r for i, r in enumerate(df.collect())}


def as_set(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_byte_bpe_is_the_plain_encoding(docs, none, rows):
    with open(queries.RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("plain", pat_str=queries.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in rows:
        ids, raw = plain.encode_ordinary(r[1] or ""), (r[1] or "").encode()
        want[r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(raw).hexdigest()] += 1
    got = bpe.round_trip(docs, queries.RANKS, queries.PATTERN)
    assert as_set(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert bpe.round_trip(none, queries.RANKS, queries.PATTERN).count() == 0
    back = bpe.decoded(bpe.encoded(docs, queries.RANKS, queries.PATTERN), queries.RANKS, queries.PATTERN)
    assert as_set(back, "doc_id", "decoded") == Counter((r[0], (r[1] or "").encode()) for r in rows)


def test_cutting_long_texts_keeps_the_ids():
    own = bpe.codec(queries.RANKS, queries.PATTERN)
    rng = random.Random(1)
    for _ in range(60):
        text = "".join(rng.choice(["ab", "é", "1", "  ", " ", "\n", "'s", "'", "!", "don't ", "𝄞", "7a"]) for _ in range(200))
        assert own.encode(text, size=rng.randint(1, 40)) == own.encoding.encode_ordinary(text)
    runs = "x" + " " * 1_500_000 + "y"  # overflows the engine when matched in one go
    assert own.decode(own.encode(runs)) == runs.encode()


def test_orc_tokens_are_the_library_ids(spark, docs, none, rows):
    library = Tokenizer.from_file(queries.VOCABULARY)
    library.encode_special_tokens = True
    want, at = Counter(), 0
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, token_files.END]
        want[r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        at += len(ids)
    assert as_set(token_files.round_trip(docs, queries.VOCABULARY), "doc_id", "start", "n_tokens", "ids_crc32") == want
    assert token_files.round_trip(none, queries.VOCABULARY).count() == 0


def test_orc_files_have_bloom_filters_and_prune(spark, docs, tmp_path):
    token_files.write(docs, queries.VOCABULARY, str(tmp_path / "t"))
    assert [r["n_tokens"] for r in token_files.lookup(spark, str(tmp_path / "t"), [44]).collect()] == [3]
    plan = token_files.lookup(spark, str(tmp_path / "t"), [44])._jdf.queryExecution().toString()
    assert re.search(r"PushedFilters: \[.*doc_id", plan)


def shingled(text, k):
    words = (text or "").encode().lower().split()
    return set(zip(*(words[i:] for i in range(k)))) if len(words) >= k else ({tuple(words)} if words else set())


def linked(rows, k, percent):
    """Component by brute force; rows with an id only."""
    rows = [r for r in rows if r[0] is not None]
    sets, root = [shingled(r[1], k) for r in rows], {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = sorted((find(rows[i][0]), find(rows[j][0])))
                root[y] = x
    return Counter((r[0], len(s), find(r[0]), find(r[0]) == r[0]) for r, s in zip(rows, sets, strict=True))


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, docs, none, rows, k, percent):
    got = chosen_path.near_duplicates(docs, k=k, percent=percent)
    assert as_set(got.filter("doc_id IS NOT NULL"), "doc_id", "n_shingles", "component_id", "kept") == linked(rows, k, percent)
    free = as_set(got.filter("doc_id IS NULL"), "n_shingles", "component_id", "kept")
    assert free == Counter({(0, None, True): 1, (len(shingled(rows[5][1], k)), 5, False): 1})
    assert chosen_path.near_duplicates(none).count() == 0


def test_large_families_keep_their_links(spark):
    """Families larger than a leaf, whose members differ from their base and more so from one another."""
    rng, rows = random.Random(9), []
    for family in range(3):
        base = prose(rng, 150).split()
        base = [f"{w}{family}{i % 50}" for i, w in enumerate(base)]
        for member in range(40):
            words = list(base)
            for place in rng.sample(range(150), rng.choice([1, 2, 4, 7])):
                words[place] = f"new{rng.random()}"
            rows.append((len(rows), " ".join(words), "en", "s", 1))
    rng.shuffle(rows)
    got = chosen_path.near_duplicates(spark.createDataFrame(rows, DOCS), k=3, percent=85, leaf=8)
    assert as_set(got, "doc_id", "n_shingles", "component_id", "kept") == linked(rows, 3, 85)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(60, 50), (50, 55), (70, 70), (None, 3)] + [(100, i) for i in range(101, 130)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 50 for i in (50, 55, 60)}, **{i: 100 for i in range(100, 130)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_tiles():
    assert decontaminate.tiles([1, 2, 3, 4, 5, 6], [4, 5, 6, -1, 1, 2, 3], 3) == [(3, 0, 4), (3, 3, 0)]
    assert decontaminate.tiles([1, 2, 3, 4], [9, 1, 2, 3, 4, 9], 2) == [(4, 0, 1)]
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(25))] for _ in range(2))
        found, used_a, used_b = decontaminate.tiles(a, b, 2), set(), set()
        for n, i, j in found:
            assert n >= 2 and a[i : i + n] == b[j : j + n]
            assert not used_a & set(range(i, i + n)) and not used_b & set(range(j, j + n))
            used_a |= set(range(i, i + n))
            used_b |= set(range(j, j + n))
        longest = max((n for i in range(len(a)) for j in range(len(b)) for n in range(len(a) + 1) if n and a[i : i + n] == b[j : j + n] and i + n <= len(a)), default=0)
        assert (found[0][0] if found else 0) == (longest if longest >= 2 else 0)
        left_a = [x if i not in used_a else -1 - i for i, x in enumerate(a)]
        left_b = [x if i not in used_b else -100 - i for i, x in enumerate(b)]
        assert not set(zip(left_a, left_a[1:])) & set(zip(left_b, left_b[1:]))


def test_decontamination(spark, docs, none):
    item = "Some question about seven rivers and nine hills that nobody asked before today"
    w = item.lower().split()
    texts = ["start " + item.upper() + "! end", "x " + " ".join(w[7:] + ["y"] + w[:7]) + " z", " ".join(w[:5]) + " else", None, "", "unrelated"]
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS).withColumn("Coverage", F.lit("clash"))
    bench = spark.createDataFrame([(7, item), (7, item), (3, "too short"), (None, item), (9, None), (8, item)], "item_id bigint, text string")
    want = Counter({(0, 7, 1.0, True): 1, (1, 7, 1.0, True): 1, (2, 7, 5 / 13, False): 1, **{(i, None, 0.0, False): 1 for i in (3, 4, 5)}})
    for block in (decontaminate.BLOCK, 30):
        got = decontaminate.scored(table, bench, carry=("doc_id", "Coverage"), block=block)
        assert as_set(got, "doc_id", "item_id", "coverage", "contaminated") == want
    assert decontaminate.scored(docs, bench.limit(0)).filter("contaminated OR coverage > 0").count() == 0
    assert decontaminate.scored(none, bench).count() == 0


def test_language(spark, docs, none, rows):
    rng = random.Random(2)
    train = spark.createDataFrame([(i, prose(rng, 60, x), x, "s", 1) for i in range(80) for x in ("de", "en")], DOCS)
    model = language.fit(train)
    got = language.predicted(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(x[1] for x in rows if x[0] == r["doc_id"])
        assert 0 <= r["score"] <= 1
        if r["doc_id"] is not None and r["doc_id"] < 40:
            assert r["lang_pred"] == ("de" if r["doc_id"] >= 30 else "en") and not r["rejected"]
        if r["doc_id"] is not None and not any(c.isalpha() for c in text or ""):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
    assert language.fit(none) is None
    assert {r["lang_pred"] for r in language.predicted(docs, None).collect()} == {"und"}
    assert language.predicted(none, model).count() == 0


def test_held_out_rows_are_a_third_by_checksum(docs):
    for r in docs.select("doc_id", language.held_out().alias("out")).collect():
        assert r["out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


def test_quality_base_counts(docs, none, rows):
    want = Counter()
    for i, text, *_ in rows:
        words = BLANKS.findall(text or "")
        windows = list(zip(words, words[1:], words[2:]))
        seen = Counter(windows)
        repeated = {p + d for p, g in enumerate(windows) if seen[g] > 1 for d in range(3)}
        lines = [x for x in (text or "").split("\n") if BLANKS.search(x)]
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        symbols = sum((text or "").count(c) for c in "#*$%&|<>")
        want[i, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed] += 1
    got = quality.ruled(docs)
    assert as_set(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want
    assert got.filter("base_failed AND kept").count() == 0
    assert quality.ruled(none).count() == 0


def test_quality_distance(spark):
    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    mean = [(x + y) / 2 for x, y in zip(p, q)]
    entropy = lambda x: -sum(v * np.log2(v) for v in x if v)
    df = spark.createDataFrame([(p,)], "p array<double>").select(quality.distance(F.col("p"), q))
    assert df.first()[0] == pytest.approx((entropy(mean) - (entropy(p) + entropy(q)) / 2) ** 0.5)


def test_quality_is_native(docs):
    assert not re.search("Python|Pandas|Arrow", quality.ruled(docs)._jdf.queryExecution().toString())


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    def passes(kind, value):
        digits = [int(c) for c in value if c in "0123456789"]
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return {
            "email": True, "ip": all(int(x) <= 255 for x in value.split(".")) if kind == "ip" else None,
            "card": 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0, "phone": 9 <= len(digits) <= 15,
        }[kind]

    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text) if passes(k, m.group())]


def test_personal_data_base_spans(spark, docs, none, rows):
    rng = random.Random(11)
    parts = ["a@b.co", "_x@y.org", "@", ".", "1.2.3.4", "5.6.7.8.9", "0300.1.2.3", "4785 3805 9239 1139", "4111-1111-1111-1111", " ", "é", "𝄞", "+1 (743) 555-3824", "+12", "12", "-", "%", "a.b-c"]
    random_rows = [(100 + i, "".join(rng.choice(parts) for _ in range(12)), None, None, None) for i in range(150)]
    long_rows = [(300, ".a" * 20_000 + "@b" + ".c" * 20_000, None, None, None), (301, "1 " * 20_000, None, None, None), (302, "x1.2.3.4 " * 400, None, None, None)]
    got = pii.personal_data(docs.union(spark.createDataFrame(random_rows + long_rows, DOCS)))
    want = Counter()
    for i, text, *_ in rows + random_rows + long_rows:
        spans = base_spans(text or "")
        want[(i, *(sum(s.startswith(k + ":") for s in spans) for k in PLAIN), hashlib.sha256(",".join(spans).encode()).hexdigest())] += 1
    assert as_set(got, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == want
    texts = {i: text for i, text, *_ in rows + random_rows + long_rows if i is not None}
    for r in got.filter("doc_id IS NOT NULL").collect():
        assert set(base_spans(texts[r["doc_id"]] or "")) <= set(filter(None, r["spans"].split(",")))
    assert pii.personal_data(none).count() == 0


def test_personal_data_adds_and_masks(spark):
    secret = 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'
    texts = [f"call me {i}@mail{i}.example.com at 10.0.{i}.7 or +1 (743) 555-38{i:02d}" for i in range(10, 40)] + ["my key: " + secret, None, "plain"]
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)
    spans = {r["doc_id"]: r["spans"] for r in pii.personal_data(table).collect()}
    assert spans[30] == f"secret:8:{8 + len(secret)}" and spans[31] == spans[32] == ""
    masked = {r["doc_id"]: r["text"] for r in pii.masked(table).collect()}
    assert masked[0] == "call me <EMAIL> at <IP> or <PHONE>" and masked[30] == "my key: <SECRET>"
    assert masked[31] is None and masked[32] == "plain"


def test_reliabilities_find_the_better_labeler():
    rng, counts = random.Random(4), Counter()
    for _ in range(4000):
        truth = rng.random() < 0.6
        counts[tuple((1 if truth else -1) * (1 if rng.random() < right else -1) for right in (0.95, 0.8, 0.6))] += 1
    prior, tables = pii.reliabilities(sorted(counts.items()), rounds=200)
    assert prior == pytest.approx(0.6, abs=0.05)
    assert [t[0][2] for t in tables] == pytest.approx([0.95, 0.8, 0.6], abs=0.06)


def test_warc_round_trip(spark):
    big = "é" * 600
    pages = [(1, "u1", big), (2, "u 2\n", big), (3, None, big), (3, "u3", big), (4, "u4", "small"), (5, "u5", "small"), (6, "u6", None), (7, "u7", "x" * 5_000_000), (None, "u", big), (8, "u", "\r\n\r\nWARC/1.1\r\n" * 100)]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("digest", F.lit("clash")).repartition(3)
    want = Counter()
    for i, _, html in pages:
        raw = (html or "").encode()
        copies = [x[0] for x in pages if x[2] == html and x[0] is not None]
        refers = max(copies) if len(raw) >= 1000 and copies and max(copies) != i else None
        want[i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if refers else "response", refers] += 1
    assert as_set(warc.archived(table), "id", "payload_bytes", "digest", "kind", "refers") == want
    assert warc.archived(table.limit(0)).count() == 0


def test_warc_normaliser_reads_any_members(tmp_path):
    import gzip
    import io

    made = [warc.record("response", i, "u", b"z" * i, "d", i, None) for i in (0, 5, 70_000)]
    for data in (gzip.compress(b"".join(made)), b"".join(map(gzip.compress, made))):
        assert list(warc.records(io.BytesIO(data), step=1000)) == made
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(gzip.compress(made[2])[:-20])))


def test_importance(spark, docs, none):
    rng = random.Random(6)
    table = spark.createDataFrame([(i, prose(rng, 50) if i % 2 else "### " * 50, "en", "s", i % 2) for i in range(200)], DOCS)
    got = importance.resampled(table, F.col("n_chars") == 1, drawn=0.5).toPandas()
    assert got["kept"].sum() == 100 and got.loc[got["doc_id"] % 2 == 1, "kept"].all()
    keys = importance.resampled(docs, F.lit(None).cast("boolean")).toPandas()
    assert len(keys) == docs.count() and (keys["log_weight"] == 0).all()
    assert importance.resampled(none, F.lit(True)).count() == 0
    assert importance.resampled(docs, F.lit(True), id_col="doc_id").filter("kept").count() >= round(0.8 * docs.count())


def test_kth_largest(spark):
    rng = random.Random(8)
    values = [rng.choice([rng.gauss(0, 1), 0.5, 1e9 * rng.random()]) for _ in range(9000)]
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    for k in (1, 2, 4000, 8999, 9000):
        assert importance.kth_largest(df, "x", k) == sorted(values, reverse=True)[k - 1]
    assert importance.kth_largest(df.limit(0), "x", 3) is None


def test_toxicity_chain(spark, docs, none):
    rng, texts, labels = random.Random(12), [], []
    for i in range(400):
        bad, low = i % 4 == 0, i % 5 == 0
        words = prose(rng, 80).split() + ["idiot", "scum"] * bad + ["spam", "click"] * low
        rng.shuffle(words)
        texts.append((i, " ".join(words), "en", "s", 1))
        labels += [(i, int(not low), int(bad))] * (1 + i % 2)
    table = spark.createDataFrame(texts, DOCS)
    given = spark.createDataFrame([*labels, (None, 1, 1), (5000, None, 1)], "doc_id bigint, quality int, toxic int")
    categories = {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    train = table.filter("doc_id < 300")
    chain = toxicity.fit(train, given.filter("doc_id < 300 OR doc_id IS NULL"), categories)
    assert [len(w) for w in chain.models] == [len(chain.vocabulary) + 1, len(chain.vocabulary) + 2]
    got = toxicity.predicted(table.filter("doc_id >= 300"), chain, list(categories)).collect()
    assert sum(r["toxic"] == (r["doc_id"] % 4 == 0) for r in got) >= 98
    assert sum(r["low_quality"] == (r["doc_id"] % 5 == 0) for r in got) >= 98
    blank = toxicity.predicted(docs, chain, list(categories))
    assert blank.count() == docs.count() and blank.filter("doc_id IN (40, 41) AND toxic").count() == 0
    assert toxicity.fit(none, given, categories) is None
    assert toxicity.predicted(none, chain, list(categories)).count() == 0


def test_pipeline_stages(spark, docs, none, tmp_path):
    bench = spark.createDataFrame([(1, "never seen words of a benchmark item here")], "item_id bigint, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.withColumn("n_chars", F.col("n_chars")).write.parquet(str(tmp_path / "documents.parquet"))
    now, state = docs, None
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0, name
        state = stage(spark, now, str(tmp_path))
        if name != "token_ids":
            assert state.columns == docs.columns, name
            now = state
    kept = {r[0] for r in state.select("doc_id").collect()}
    assert kept >= {3, 4, 5} and not kept & {10, 11, 12, 20, 21, 22, 40, 41, 42}
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert as_set(run, "doc_id", "ids_sha256") == as_set(state, "doc_id", "ids_sha256")


def test_tokenizer_files_are_not_in_the_repository():
    assert queries.RANKS.startswith(public_tokenizers.__path__[0])
