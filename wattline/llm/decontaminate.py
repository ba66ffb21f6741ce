"""Benchmark decontamination by greedy string tiling.

Texts are compared as lower-cased ``\\w+`` words. A document and a benchmark item that share a seed (``LEAST`` equal words
in a row) are tiled: the longest common unmarked runs of words are found with rolling hashes, marked, and searched
again, until no run of ``LEAST`` words is left. The share of the item's words inside tiles is its coverage, which does
not depend on the order of the passages. A document is contaminated if some item is covered to ``COVERED`` at least.

The benchmark goes to the workers in blocks of at most about ``BLOCK`` characters; every block meets every document, so
a large benchmark costs more passes, not more memory.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import annotated, schema
from wattline.session import settled

LEAST = 5
COVERED = 0.5
BLOCK = 16_000_000

WORDS = re.compile(r"\w+")
FIELDS = "item_id bigint, coverage double, contaminated boolean"

_BASE = 1_000_003
_MASK = (1 << 61) - 1


def words(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def rolling(ids: list[int], length: int) -> list[int]:
    """The Karp-Rabin hash of every run of ``length`` ids."""
    if len(ids) < length:
        return []
    top = pow(_BASE, length - 1, _MASK)
    value = 0
    for x in ids[:length]:
        value = (value * _BASE + x + 2) % _MASK
    out = [value]
    for gone, new in zip(ids, ids[length:]):
        value = ((value - (gone + 2) * top) * _BASE + new + 2) % _MASK
        out.append(value)
    return out


def common_runs(a: list[int], b: list[int], free_a: bytearray, free_b: bytearray, length: int) -> list[tuple[int, int, int]]:
    """Maximal common runs of at least ``length`` unmarked words, as (words, place in a, place in b)."""
    places = defaultdict(list)
    for i, value in enumerate(rolling(a, length)):
        if all(free_a[i : i + length]):
            places[value].append(i)
    found = []
    for j, value in enumerate(rolling(b, length)):
        if value not in places or not all(free_b[j : j + length]):
            continue
        for i in places[value]:
            if i and j and free_a[i - 1] and free_b[j - 1] and a[i - 1] == b[j - 1]:
                continue  # part of a run that began earlier
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                n += 1
            if n >= length:
                found.append((n, i, j))
    return found


def tiles(a: list[int], b: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """Greedy string tiling: non-overlapping common runs, longest first, each of ``least`` words at least.

    Negative ids are unique separators and match nothing. Ties go to the first place in ``a``, then in ``b``.
    """
    free_a = bytearray(x >= 0 for x in a)
    free_b = bytearray(x >= 0 for x in b)
    out: list[tuple[int, int, int]] = []
    length = max(least, min(len(a), len(b)) // 2)
    while True:
        found = common_runs(a, b, free_a, free_b, length)
        longest = max(found, default=(0,))[0]
        if longest > 2 * length:
            length = longest
            continue
        again = False
        for n, i, j in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if all(free_a[i : i + n]) and all(free_b[j : j + n]):
                free_a[i : i + n] = free_b[j : j + n] = bytes(n)
                out.append((n, i, j))
            else:
                again = True  # cut by a longer tile; what is left of it may still be long enough
        if not again:
            if length == least:
                return out
            length = max(least, length // 2)


class Items:
    """Seeds of a block of benchmark items."""

    def __init__(self, rows: list[tuple[int, str]], least: int):
        self.least = least
        self.vocabulary: dict[str, int] = {}
        self.ids, self.items = [], []
        number = self.vocabulary
        for item, text in rows:
            found = [number.setdefault(w, len(number)) for w in words(text)]
            if len(found) >= least:
                self.ids.append(item)
                self.items.append(found)
        owners = defaultdict(set)
        for k, found in enumerate(self.items):
            for value in self.seeds(np.array(found, np.int64)):
                owners[int(value)].add(k)
        self.owners = dict(owners)
        self.values = np.array(sorted(owners), np.uint64)

    def seeds(self, found: np.ndarray) -> np.ndarray:
        """Hash of every window of ``least`` known words, 0 where a word is unknown."""
        n = len(found) - self.least + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        value, known = np.zeros(n, np.uint64), np.ones(n, bool)
        for k in range(self.least):
            part = found[k : k + n]
            known &= part >= 0
            value = value * np.uint64(_BASE * 2 + 1) + (part + 3).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(31)
        value |= np.uint64(1)
        return np.where(known, value, np.uint64(0))

    def best(self, text: str) -> tuple[int | None, float]:
        """The item with the highest coverage (ties: the smallest id) and that coverage; (None, 0) without a seed."""
        if not len(self.values):
            return None, 0.0
        split = words(text)
        found = np.fromiter(map(self.vocabulary.get, split, repeat(-1)), np.int64, len(split))
        values = self.seeds(found)
        places = np.flatnonzero(values)
        at = np.searchsorted(self.values, values[places])
        at[at == len(self.values)] = 0
        places = places[self.values[at] == values[places]]
        shared = defaultdict(list)
        for p in places.tolist():
            for k in self.owners[int(values[p])]:
                shared[k].append(p)
        best: tuple[int | None, float] = (None, 0.0)
        for k, starts in shared.items():
            item = self.items[k]
            covered = sum(n for n, _, _ in tiles(item, self.passages(found, starts), self.least)) / len(item)
            if covered > best[1] or covered == best[1] and covered and (best[0] is None or self.ids[k] < best[0]):
                best = self.ids[k], covered
        return best

    def passages(self, found: np.ndarray, starts: list[int]) -> list[int]:
        """The words under the seeds at ``starts``: tiles cannot reach beyond them. A separator follows each passage."""
        out: list[int] = []
        end = starts[0]
        for p in starts:
            if p > end:
                out.append(-1)
            out.extend(found[max(p, end) : p + self.least].tolist())
            end = p + self.least
        return out


def blocks(benchmark: DataFrame, item: str, text: str, size: int) -> list[DataFrame]:
    """The usable items, split by a hash into tables of about ``size`` characters each."""
    texts = (
        benchmark.filter(F.col(text).isNotNull() & F.col(item).isNotNull())
        .select(F.col(item).cast("long").alias("item"), F.col(text).alias("text"))
        .dropDuplicates()
    )
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // size))
    return [texts.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) for k in range(n)]


def scored(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
    item: str = "item_id",
    item_text: str = "text",
    least: int = LEAST,
    covered: float = COVERED,
    block: int = BLOCK,
) -> DataFrame:
    """``carry`` columns, the item that covers best (null if no seed is shared), its coverage, and the verdict.

    One row per row. Null and empty texts share nothing: coverage 0, not contaminated. Items that are null or shorter
    than ``least`` words cannot be told from chance and are left out; repeated items count once. With an empty
    benchmark nothing is contaminated. Equal coverages name the smallest item id. Carried columns named like a new
    one are replaced.
    """
    spark = docs.sparkSession
    taken = {f.name for f in schema(FIELDS)}
    kept = [c for c in carry if c.lower() not in taken]
    state = docs.select(*dict.fromkeys([*kept, text]), F.lit(None).cast("long").alias("_item"), F.lit(0.0).alias("_part"))
    parts = blocks(benchmark, item, item_text, block)
    for k, part in enumerate(parts):
        shared = spark.sparkContext.broadcast(sorted((r[0], r[1]) for r in part.collect()))  # at most about one block
        last = k == len(parts) - 1
        state = _met(state, shared, text, kept if last else list(dict.fromkeys([*kept, text])), least)
        if not last:
            state = settled(state, "tiled")
    return state.select(
        *kept, F.col("_item").alias("item_id"), F.col("_part").alias("coverage"), (F.col("_part") >= covered).alias("contaminated")
    )


def _met(state: DataFrame, shared, text: str, keep: list[str], least: int) -> DataFrame:
    """``keep`` columns and the better of the best item so far and the best item of one block."""

    def start():
        own = Items(shared.value, least)

        def made(texts: list) -> list[list]:
            best = [own.best(t) if t else (None, 0.0) for t in texts]
            return [[b[0] for b in best], [b[1] for b in best]]

        return made

    new = annotated(state, text, [*keep, "_item", "_part"], schema("_new_item bigint, _new_part double"), start)
    better = (F.col("_new_part") > F.col("_part")) | (
        (F.col("_new_part") == F.col("_part")) & (F.col("_new_item") < F.coalesce("_item", F.lit((1 << 63) - 1)))
    )
    return new.select(
        *keep,
        F.when(better, F.col("_new_item")).otherwise(F.col("_item")).alias("_item"),
        F.greatest("_new_part", "_part").alias("_part"),
    )
