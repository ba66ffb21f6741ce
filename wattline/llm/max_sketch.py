"""Ranked lexical search with hashed max-sketches.

A term's impact in a document is the part of its score that does not depend on the query. A document's impacts are folded
into ``WIDTH`` coordinates: each term is hashed to one, and a coordinate keeps the largest impact that falls on it. For a
query, the weights of its terms times the document's coordinates at their places are summed to an upper bound of the
score, for a batch of documents and a block of queries in one matrix product. Documents are then scored exactly in
descending order of the bound, until the bound falls below the lowest score that may still be returned.

That lowest score starts from the best documents of a small sample, which can only be worse than the best of all, and
rises with the best ones a task has found itself. Tasks give back their best documents, at most ``k`` a query.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import share
from wattline.llm.stripes import pieces
from wattline.session import settled

WIDTH = 4096
#: Documents whose sketches are held at once; their texts end a batch earlier when they are long.
BATCH, BATCH_BYTES = 512, 1 << 24
#: Share of the documents that gives the first lower limits.
SAMPLE = 1 / 64
#: Characters of queries handled in one pass over the documents.
QUERY_CHARS = 1 << 23

#: ASCII letters in lower case and digits; other ASCII characters separate terms, all others belong to them.
TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c > 127 else 32 for c in range(256))


def term_counts(text: bytes | None) -> Counter:
    out: Counter = Counter()
    for found in pieces(text or b"", TERMS):
        out.update(found)
    return out


def statistics(texts: DataFrame, vocabulary: frozenset) -> tuple[int, int, dict]:
    """Documents with a term, terms of all documents with repeats, and the documents that hold each term of the vocabulary."""
    sent = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, held, filled, terms = sent.value, Counter(), 0, 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                here: set = set()
                size = 0
                for found in pieces(text or b"", TERMS):
                    size += len(found)
                    here.update(wanted.intersection(found))
                filled += size > 0
                terms += size
                held.update(here)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *held], pa.binary()), pa.array([filled, *held.values()], pa.int64()), pa.array([terms, *[0] * len(held)], pa.int64())],
            names=["term", "docs", "terms"],
        )

    rows = texts.select("text").mapInArrow(counted, "term binary, docs bigint, terms bigint")
    found = rows.groupBy("term").agg(F.sum("docs"), F.sum("terms")).collect()  # the vocabulary's size
    held = {bytes(term): docs for term, docs, _ in found if term is not None}
    filled, terms = next(((docs, terms) for term, docs, terms in found if term is None), (0, 0))
    return filled, terms, held


def impact(tf: int, norm: int) -> int:
    return 1_000_000_000 * tf // (1000 * tf + 20 * norm)


class Searcher:
    """One block of queries over batches of documents inside a task."""

    def __init__(self, queries: list[dict], filled: int, terms: int, k: int, limits: list[int]) -> None:
        self.queries, self.filled, self.terms, self.k, self.limits = queries, filled, terms, k, limits
        places = {term: xxhash.xxh3_64_intdigest(term) % WIDTH for query in queries for term in query}
        used = sorted(set(places.values()))
        column = {place: i for i, place in enumerate(used)}
        self.used = np.array(used, np.int64)
        self.weights = np.zeros((len(used), len(queries)))
        for q, query in enumerate(queries):
            for term, weight in query.items():
                self.weights[column[places[term]], q] += weight
        self.best: list[list] = [[] for _ in queries]

    def norm(self, size: int) -> int:
        return 50 + 50 * size * self.filled // self.terms

    def sketch(self, counts: Counter, norm: int) -> np.ndarray:
        """The coordinatewise maxima of the document's impacts."""
        out = np.zeros(WIDTH)
        tf = np.fromiter(counts.values(), np.int64, len(counts))
        places = np.fromiter(map(xxhash.xxh3_64_intdigest, counts), np.uint64, len(counts)) % np.uint64(WIDTH)
        np.maximum.at(out, places.astype(np.int64), 1_000_000_000 * tf // (1000 * tf + 20 * norm))
        return out

    def add(self, ids: list, counts: list[Counter]) -> None:
        """Score a batch: bounds for all queries at once, then exactly in descending order of the bound."""
        kept = [(i, c) for i, c in zip(ids, counts, strict=True) if c]
        if not kept or not self.queries:
            return
        norms = [self.norm(c.total()) for _, c in kept]
        sketches = np.stack([self.sketch(c, norm) for (_, c), norm in zip(kept, norms, strict=True)])
        bounds = sketches[:, self.used] @ self.weights * (1 + 1e-9)  # above any rounding
        for q, query in enumerate(self.queries):
            best = self.best[q]
            column = bounds[:, q]
            for at in sorted(np.flatnonzero(column >= max(self.limits[q], 1)), key=lambda i: -column[i]):
                if column[at] < (best[0][0] if len(best) == self.k else self.limits[q]):
                    break
                doc, held = kept[at]
                score = sum(weight * impact(held[term], norms[at]) for term, weight in query.items() if term in held)
                if score < max(self.limits[q], 1):
                    continue
                entry = (score, math.inf if doc is None else -doc, doc)
                if len(best) < self.k:
                    heapq.heappush(best, entry)
                elif entry[:2] > best[0][:2]:
                    heapq.heapreplace(best, entry)


def best_documents(texts: DataFrame, queries: list[dict], filled: int, terms: int, k: int, limits: list[int]) -> DataFrame:
    """``(query, id, score)``: each task's best documents, at most ``k`` a query, none below the limit."""
    sent = texts.sparkSession.sparkContext.broadcast((queries, limits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, least = sent.value
        search = Searcher(own, filled, terms, k, least)
        ids: list = []
        counts: list[Counter] = []
        size = 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc)
                counts.append(term_counts(text))
                size += len(text or b"")
                if len(ids) >= BATCH or size >= BATCH_BYTES:
                    search.add(ids, counts)
                    ids, counts, size = [], [], 0
        search.add(ids, counts)
        for q, best in enumerate(search.best):
            if best:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q] * len(best), pa.int32()), pa.array([e[2] for e in best], pa.int64()), pa.array([e[0] for e in best], pa.int64())],
                    names=["query", "id", "score"],
                )

    return texts.select("id", "text").mapInArrow(run, "query int, id bigint, score bigint")


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, text: str = "text", id_col: str = "doc_id", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``(item_col, rank, id_col, score)``: the ``k`` documents with the highest scores above 0 for every item.

    Equal scores go by ascending id, a null id first. Null texts hold no term; items without a term that occurs have no
    rows. Repeated documents are ranked each, rows of ``items`` with one id and one text are one item, and rows with one
    id and different texts are ranked apart. Other columns are ignored. Empty tables give no rows.

    The queries of a block, ``QUERY_CHARS`` characters by expectation, are held by the driver and sent to every task.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    wanted = settled(items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text}`").alias("text")).distinct(), "items")
    chars = wanted.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = chars // QUERY_CHARS + 1
    out = None
    for block in range(blocks):
        mine = wanted.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()  # QUERY_CHARS by expectation
        terms_of = [(item, sorted(term_counts((t or "").encode("utf-8", "surrogatepass")))) for item, t in mine]
        filled, terms, held = statistics(texts, frozenset(term for _, own in terms_of for term in own))
        weight = {term: math.floor(1000 * math.log((2 * filled + 2) / (2 * df + 1))) for term, df in held.items()}
        queries = [{term: weight[term] for term in own if term in weight} for _, own in terms_of]
        limits = [1] * len(queries)
        sample = texts.filter(share(F.lit("first"), F.col("id")) < SAMPLE)
        lowest = ranked(best_documents(sample, queries, filled, terms, k, limits), k).filter(F.col("rank") == k)
        for row in lowest.collect():  # one row a query at most
            limits[row["query"]] = row["score"]
        found = settled(ranked(best_documents(texts, queries, filled, terms, k, limits), k), "ranked")
        names = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(terms_of)], f"query int, item {items.schema[item_col].dataType.simpleString()}")
        part = found.join(names, "query").select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
        out = part if out is None else out.unionByName(part)
    return out


def oracle(k: int = 50) -> str:
    """DuckDB SQL for ``search`` over ``documents`` and ``benchmark``."""
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    terms = rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return rf"""
    WITH words AS (
      SELECT doc, doc_id, unnest({terms.format("text")}) AS term FROM (SELECT row_number() OVER () AS doc, * FROM documents)
    ), tfs AS (SELECT doc, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
    sizes AS (SELECT doc, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc),
    totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
    weights AS (
      SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tfs, totals GROUP BY term
    ), asked AS (
      SELECT DISTINCT item, item_id, unnest({terms.format("text")}) AS term
      FROM (SELECT row_number() OVER () AS item, * FROM (SELECT DISTINCT item_id, text FROM benchmark))
    ), scores AS (
      SELECT a.item, a.item_id, t.doc, t.doc_id,
        sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 20 * (50 + (50 * s.n * o.docs) // o.terms))))::BIGINT AS score
      FROM asked a JOIN tfs t USING (term) JOIN weights w USING (term) JOIN sizes s USING (doc), totals o
      GROUP BY ALL
    ), placed AS (
      SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scores WHERE score > 0
    )
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM placed WHERE rank <= {k}
    """
