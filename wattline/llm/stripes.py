"""How the sources of a language differ in their words, from in-mapper stripes.

Every task folds whole documents into stripes, one per language and term: the number of documents that hold the term and
its occurrences by source. A task spills its stripes whenever it has folded ``SPILL`` terms, and the spilled stripes are
merged by key. Each (language, term) arrives once per spill, however frequent it is, and the merge keeps one cell per source.

Merged stripes of terms in fewer than ``KEEP`` documents go. The others give divergences directly: each source's smoothed
share of a term is an integer in billionths, computed by long division, so all values are exact at any size.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.session import settled, sized

#: Documents of the language that must hold a term, occurrences added to each term, ranks of terms that are returned.
KEEP, PRIOR, SHOWN = 30, 5, 50
#: Terms folded by a task before it spills.
SPILL = 1 << 21
#: Bytes of a text whose terms are held at once.
PIECE = 1 << 20
#: Stripes compared at once, and sources whose differences to all others a task sums up.
STRIPES, SOURCES = 512, 1024

#: ASCII letters in lower case; other ASCII characters separate terms, all others belong to them.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def pieces(text: bytes, table: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in lists of bounded size; ``table`` maps separators to blanks."""
    at = 0
    while at < len(text):
        part = text[at : at + PIECE].translate(table)
        end = len(part) if at + PIECE >= len(text) else part.rfind(b" ") + 1
        while not end:  # one term longer than the piece
            more = text[at + len(part) : at + len(part) + PIECE].translate(table)
            end = len(part) + more.find(b" ") + 1 if b" " in more else 0
            part += more
            end = end or (len(part) if at + len(part) >= len(text) else 0)
        yield part[:end].split()
        at += end


def _spilled(held: dict) -> Iterator[pa.RecordBatch]:
    for lang, (seen, by_source) in held.items():
        place = {term: i for i, term in enumerate(seen)}
        sources = list(by_source)
        term_of = np.concatenate([np.fromiter(map(place.__getitem__, c), np.int64, len(c)) for c in by_source.values()])
        source_of = np.repeat(np.arange(len(sources)), [len(c) for c in by_source.values()])
        counts = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in by_source.values()])
        order = np.argsort(term_of, kind="stable")
        borders = np.concatenate([[0], np.cumsum(np.bincount(term_of, minlength=len(place)))]).astype(np.int32)
        names = pa.array(sources, pa.string()).take(pa.array(source_of[order]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(place), pa.string()),
                pa.array(list(place), pa.binary()).cast(pa.string()),
                pa.array(list(seen.values()), pa.int64()),
                pa.ListArray.from_arrays(pa.array(borders), names),
                pa.ListArray.from_arrays(pa.array(borders), pa.array(counts[order])),
            ],
            names=["lang", "term", "df", "sources", "counts"],
        )


def stripes(named: DataFrame) -> DataFrame:
    """``(lang, term, df, sources, counts)`` of ``(lang, source, text)`` rows, one row per spill, language and term."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                here: set = set()
                for found in pieces(text or b"", LETTERS):
                    if not found:
                        continue
                    seen, by_source = held.setdefault(lang, (Counter(), defaultdict(Counter)))
                    seen.update(set(found) - here)
                    here.update(found)
                    by_source[source].update(found)
                    size += len(found)
                if size >= SPILL:
                    yield from _spilled(held)
                    held.clear()
                    size = 0
        yield from _spilled(held)

    fields = "lang string, term string, df bigint, sources array<string>, counts array<bigint>"
    return named.select("lang", "source", F.col("text").cast("binary")).mapInArrow(fold, fields)


def merged(spilled: DataFrame, keep: int = KEEP) -> DataFrame:
    """One stripe per language and kept term: its cells ``(source, count)``, added up by key without another shuffle."""
    by_key = spilled.repartition("lang", "term")
    cells = by_key.select("lang", "term", "df", F.posexplode(F.arrays_zip("sources", "counts")).alias("at", "cell"))
    added = cells.groupBy("lang", "term", F.col("cell.sources").alias("source")).agg(
        F.sum("cell.counts").alias("count"), F.sum(F.when(F.col("at") == 0, F.col("df")).otherwise(0)).alias("df")
    )
    whole = added.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.collect_list(F.struct("source", "count")).alias("cells"))
    return whole.filter(F.col("df") >= keep).select("lang", "term", "cells")


def parts_per_billion(count: Column, size: Column, kept: Column) -> Column:
    """1 + floor(1e9 * (count + 5) / (size + 5 * kept)) in 64-bit integers: long division by thousands."""
    total = size + PRIOR * kept
    rest, out = count + PRIOR, F.lit(0).cast("long")
    for _ in range(3):
        out = out * 1000 + F.call_function("div", rest * 1000, total)
        rest = (rest * 1000) % total
    return out + 1


def _shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    rest, out = counts + PRIOR, np.zeros_like(counts)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest %= total
    return out + 1


def pair_sums(kept: DataFrame, groups: DataFrame, width: int = SOURCES) -> DataFrame:
    """``(lang, source, item, value)`` for all sources of a language and each other one: the shares' distance.

    The result has a row per ordered pair of sources, so the sources themselves are few beside it: every task gets them,
    and sums up the distances of ``width`` sources at a time to all others.
    """
    langs: dict = {}
    for lang, source, size, terms in groups.collect():
        names, sizes, _ = langs.setdefault(lang, ([], [], terms))
        names.append(source)
        sizes.append(size)
    sent = kept.sparkSession.sparkContext.broadcast(
        {lang: (names, {s: i for i, s in enumerate(names)}, np.array(sizes, np.int64) + PRIOR * terms) for lang, (names, sizes, terms) in langs.items()}
    )
    blocks = {lang: -(-len(names) // width) for lang, (names, _, _) in langs.items()}
    most = max(blocks.values(), default=1)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        sums: dict = {}
        for whole in batches:
            for at in range(0, whole.num_rows, STRIPES):
                rows = defaultdict(list)
                for lang, block, cells in zip(*(c.to_pylist() for c in whole.slice(at, STRIPES).columns), strict=True):
                    rows[lang, block].append(cells)
                for (lang, block), many in rows.items():
                    names, place, total = known[lang]
                    first = block * width
                    if first >= len(names):
                        continue
                    added = sums.setdefault((lang, block), np.zeros((min(width, len(names) - first), len(names)), np.int64))
                    many = [cells for cells in many if cells is not None]
                    counts = np.zeros((len(many), len(names)), np.int64)
                    for i, cells in enumerate(many):
                        for cell in cells:
                            counts[i, place[cell["source"]]] = cell["count"]
                    if many:
                        shares = _shares(counts, total)
                        for i in range(len(added)):
                            added[i] += np.abs(shares - shares[:, first + i : first + i + 1]).sum(axis=0)
        for (lang, block), added in sums.items():
            names = known[lang][0]
            for i, row in enumerate(added):
                mine = names[block * width + i]
                others = [j for j in range(len(names)) if names[j] != mine]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(others), pa.string()), pa.array([mine] * len(others), pa.string()),
                        pa.array([names[j] for j in others], pa.string()), pa.array(row[others], pa.int64()),
                    ],
                    names=["lang", "source", "item", "value"],
                )

    block = F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("block")
    # A stripe without cells for every language, so that pairs of a language without kept terms appear, with value 0.
    nothing = groups.select("lang").distinct().select("lang", F.lit(None).cast(kept.schema["cells"].dataType).alias("cells"))
    rows = kept.select("lang", "cells").unionByName(nothing).select("lang", block, "cells")
    sums = rows.mapInArrow(summed, "lang string, source string, item string, value bigint")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def distinctive(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for each source's terms whose share is above the language's, by how much."""
    whole = groups.groupBy("lang").agg(F.sum("size").alias("lang_size"))
    sizes = sized(groups.join(whole, "lang"))
    total = F.aggregate("cells", F.lit(0).cast("long"), lambda a, c: a + c["count"])
    cells = kept.select("lang", F.col("term").alias("item"), total.alias("total"), F.inline("cells"))
    found = cells.join(sizes, ["lang", "source"])
    own = parts_per_billion(F.col("count"), F.col("size"), F.col("kept"))
    all_of = parts_per_billion(F.col("total"), F.col("lang_size"), F.col("kept"))
    return found.select("lang", "source", "item", (own - all_of).alias("value")).filter("value > 0")


def ranked(values: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = values.withColumn("rank", F.row_number().over(order))
    if most is not None:
        out = out.filter(F.col("rank") <= most)
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def divergences(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", keep: int = KEEP, block: int = SOURCES
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how far each source is from the others and which terms set it apart.

    Part ``pair`` has a row for every other source of the language, part ``term`` the ``SHOWN`` terms furthest above the
    language's share. Null texts, languages and sources count as ''. Sources without terms are compared too; a language
    without kept terms has distances 0, one with a single source no pairs. Repeated rows count as often as they occur.
    Other columns are ignored. An empty table gives no rows.
    """
    named = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))))
    kept = settled(merged(stripes(named), keep), "stripes")
    sizes = kept.select("lang", F.inline("cells")).groupBy("lang", "source").agg(F.sum("count").alias("size"))
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    groups = named.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(terms, "lang", "left")
    zero = F.lit(0).cast("long")
    groups = sized(groups.select("lang", "source", F.coalesce("size", zero).alias("size"), F.coalesce("kept", zero).alias("kept")))
    return ranked(pair_sums(kept, groups, block), "pair").unionByName(ranked(distinctive(kept, groups), "term", SHOWN))


def oracle(keep: int = KEEP) -> str:
    """DuckDB SQL for ``divergences`` over ``documents``."""
    share = "1 + (1000000000::HUGEINT * ({count} + 5)) // ({size} + 5 * kept)"
    return rf"""
    WITH named AS (
      SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
      FROM documents
    ), words AS (
      SELECT doc, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM named
    ), keeps AS (
      SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= {keep}
    ), kept_of AS (SELECT lang, count(*) AS kept FROM keeps GROUP BY lang),
    cells AS (
      SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS n FROM words w JOIN keeps USING (lang, term) GROUP BY ALL
    ), groups AS (
      SELECT g.lang, g.source, coalesce(s.size, 0)::HUGEINT AS size, coalesce(k.kept, 0)::HUGEINT AS kept
      FROM (SELECT DISTINCT lang, source FROM named) g
      LEFT JOIN (SELECT lang, source, sum(n) AS size FROM cells GROUP BY ALL) s USING (lang, source)
      LEFT JOIN kept_of k USING (lang)
    ), grid AS (
      SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n, {share.format(count="coalesce(c.n, 0)", size="g.size")} AS p
      FROM groups g JOIN keeps t USING (lang) LEFT JOIN cells c USING (lang, source, term)
    ), whole AS (
      SELECT lang, term, {share.format(count="sum(n)", size="any_value(s.size)").replace("kept", "any_value(kept)")} AS q
      FROM cells JOIN (SELECT lang, sum(size) AS size, any_value(kept) AS kept FROM groups GROUP BY lang) s USING (lang)
      GROUP BY lang, term
    ), pairs AS (
      SELECT a.lang, a.source, b.source AS item, coalesce(v.value, 0) AS value
      FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN (
        SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
        FROM grid x JOIN grid y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
      ) v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
    ), found AS (
      SELECT lang, source, 'pair' AS part, item, value FROM pairs
      UNION ALL
      SELECT lang, source, 'term', term, p - q FROM grid JOIN whole USING (lang, term) WHERE n > 0 AND p > q
    ), placed AS (
      SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
    )
    SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
    FROM placed WHERE part = 'pair' OR rank <= {SHOWN}
    """
