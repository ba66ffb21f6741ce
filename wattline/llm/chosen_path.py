"""Near-duplicate documents by a chosen-path similarity join over word shingles.

A document is the set of its distinct ``k``-word shingles, described by ``COORDINATES`` minwise tokens. Documents with
equal sets form a class at once. Each of ``TREES`` independent trees then branches the classes: a node picks one
coordinate by its own hash, and a second one with the chance that makes the expected number of branches the inverse of
the threshold; a class goes to the child named by its minwise token there. Nodes with a few classes are compared
exhaustively; larger ones branch on, down to ``DEPTH`` levels. What is then still together is a large family of copies.

Comparing takes two rounds, so that copies never make all their pairs. First every class of a node is compared with the
node's smallest class; the links found give components. Then only classes of one node that are still in different
components are compared, all of them, inside tasks that give back likely links only: small nodes by their minwise
tokens, large families by counting common shingles, where blocks of the classes outside the most frequent component
meet the node's other classes one by one. Every link is confirmed on the full shingle sets.

A pair is found if it shares a final node in some tree. ``missed`` gives the chance that it shares none, for a pair at the
threshold. With ``TREES`` trees that is 4.6e-6 at depth 2 and 2.7e-3 at depth 6 for 0.85, 1.9e-5 and 6.7e-3 for 0.80. So
classes that meet in a node that is still large at depth ``FIRST`` get as many trees as keep the chance below ``MISSED`` at
the last depth.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import annotated, in_batches, schema
from wattline.llm.components import components
from wattline.session import settled, sized

COORDINATES = 64
TREES = 10
#: Levels every class goes down before nodes are counted, and levels at which branching ends.
FIRST, DEPTH = 2, 6
#: The largest chance to miss a pair at the threshold within a large family, and the trees that may be spent on it.
MISSED, MOST = 1e-5, 1000
#: Nodes up to this size are leaves.
LEAF = 16
#: Pairs whose minwise tokens agree less than this below the threshold are not confirmed: over 4.5 standard deviations.
SKETCH = 0.22
#: Classes of a large family that are held in a task at once.
BLOCK = 1024

_RNG = np.random.default_rng(20)
_FACTORS = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words(text: str) -> list[bytes]:
    """Words between ASCII blanks, A to Z in lower case and other letters as they are."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingles(text: str, k: int) -> set[tuple[bytes, ...]]:
    """The document's set; a text of fewer than ``k`` words is one shingle, one without words none."""
    split = words(text)
    if not split:
        return set()
    if len(split) < k:
        return {tuple(split)}
    return set(zip(*(split[i:] for i in range(k))))


def hashed(text: str, k: int) -> np.ndarray:
    """Sorted 64-bit hashes of ``shingles``."""
    split = words(text)
    n = len(split)
    if not n:
        return np.zeros(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, split), np.uint64, n)
    width = min(k, n)
    value = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        value = (value ^ (value >> np.uint64(29))) * _PLACES[i] + one[i : i + len(value)]
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(32)
    return np.unique(value)


def minwise(values: np.ndarray) -> np.ndarray:
    """The minwise token of each coordinate, 32 bits."""
    least = np.full(COORDINATES, np.uint64(2**64 - 1))
    for at in range(0, len(values), 2048):
        part = values[at : at + 2048]
        np.minimum(least, (_FACTORS[:, None] * part[None, :]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def described(docs: DataFrame, text: str, id_col: str, k: int) -> DataFrame:
    """``id``, the size of the set, its digest and minwise tokens (null for empty sets)."""

    def start():
        def made(texts: list) -> list[list]:
            sets = [hashed(t, k) if t else np.zeros(0, np.uint64) for t in texts]
            return [
                [len(s) for s in sets],
                [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                pa.array([minwise(s) if len(s) else None for s in sets], pa.list_(pa.int32())),
            ]

        return made

    ids = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("t"))
    return annotated(ids, "t", ["id"], schema("n bigint, digest binary, sig array<int>"), start)


def branches(threshold: float) -> Column:
    """Children of a node row ``(key, sig)``: one coordinate always, a second one with the missing chance."""
    extra = int(1000 * (1 / threshold - 1))
    child = lambda c: F.xxhash64("key", c, F.element_at("sig", (c + 1).cast("int")))
    coordinate = lambda salt: F.pmod(F.xxhash64("key", F.lit(salt)), F.lit(COORDINATES))
    both = F.array(child(coordinate(1)), child(coordinate(2)))
    two = (F.pmod(F.xxhash64("key", F.lit(3)), F.lit(1000)) < extra) & (coordinate(1) != coordinate(2))
    return F.explode(F.when(two, both).otherwise(F.array(child(coordinate(1)))))


def missed(threshold: float, depth: int, trees: int) -> float:
    """The chance that a pair at the threshold shares no node of that depth in any tree, over the agreement of its tokens."""
    two = int(1000 * (1 / threshold - 1)) / 1000 * (1 - 1 / COORDINATES)
    out = 0.0
    for equal in range(COORDINATES + 1):
        chance = comb(COORDINATES, equal) * threshold**equal * (1 - threshold) ** (COORDINATES - equal)
        together = 1.0
        for _ in range(depth):
            one = equal / COORDINATES * together
            both = equal * max(equal - 1, 0) / (COORDINATES * (COORDINATES - 1)) * together**2
            together = (1 - two) * one + two * (2 * one - both)
        out += chance * (1 - together) ** trees
    return out


def trees_for(threshold: float, depth: int, trees: int) -> int:
    """The trees from ``trees`` on that miss a pair at the threshold with a chance of at most ``MISSED``."""
    return next((t for t in range(trees, MOST) if missed(threshold, depth, t) <= MISSED), MOST)


def nodes(classes: DataFrame, threshold: float, trees: int, leaf: int, first: int, depth: int) -> DataFrame:
    """``(key, cid, n, pivot)``: the classes of every final node of two or more, its size and its smallest class.

    Classes in a large node of level ``first`` also go down the further trees of ``trees_for``.
    """

    def grown(members: DataFrame, some: range, levels: int) -> DataFrame:
        roots = F.explode(F.array(*[F.lit(t) for t in some])).alias("tree")
        down = members.select("cid", "sig", roots).select("cid", "sig", F.xxhash64("tree").alias("key"))
        for _ in range(levels):
            down = down.select("cid", "sig", branches(threshold).alias("key"))
        return down.select("key", "cid")

    rows = grown(classes, range(trees), first)
    further = range(trees, trees_for(threshold, depth, trees))
    final = None
    for level in range(first, depth + 1):
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("cid").alias("pivot")).filter("n > 1")
        here = settled(rows.join(sizes, "key").select("key", "cid", "n", "pivot"), "nodes")
        done = here if level == depth else here.filter(F.col("n") <= leaf)
        final = done if final is None else final.union(done)
        if level == depth:
            break
        wide = here.filter(F.col("n") > leaf).select("key", "cid")
        if wide.isEmpty():
            break
        rows = wide.join(classes.select("cid", "sig"), "cid").select("cid", branches(threshold).alias("key")).select("key", "cid")
        if level == first and further:
            rows = rows.union(grown(classes.join(sized(wide.select("cid").distinct()), "cid", "left_semi"), further, first + 1))
    return final


def likely(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Distinct ``(a, b)`` whose sizes allow the threshold and whose minwise tokens do not speak against it."""
    a = classes.select(F.col("cid").alias("a"), F.col("size").alias("size_a"), F.col("sig").alias("sig_a"))
    b = classes.select(F.col("cid").alias("b"), F.col("size").alias("size_b"), F.col("sig").alias("sig_b"))
    least = int(COORDINATES * max(0.0, threshold - SKETCH))
    equal = F.aggregate(
        F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, x: total + x
    )
    return (
        pairs.distinct()
        .join(a, "a")
        .join(b, "b")
        .filter(F.least("size_a", "size_b") >= threshold * F.greatest("size_a", "size_b") - 1e-9)
        .filter(equal >= least)
        .select("a", "b")
    )


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold. Rows come sorted by ``a``, whose set is kept from row to row."""
    met = (
        pairs.join(texts.select(F.col("cid").alias("b"), F.col("t").alias("text_b")), "b")
        .join(texts.select(F.col("cid").alias("a"), F.col("t").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )

    def compared(batches):
        last, left = None, set()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                keep = []
                for text_a, text_b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                    if text_a != last:
                        last, left = text_a, shingles(text_a, k)
                    right = shingles(text_b, k)
                    both = len(left & right)
                    keep.append(100 * both >= percent * (len(left) + len(right) - both))
                yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return in_batches(met, compared, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    k: int = 5,
    percent: int = 80,
    trees: int = TREES,
    leaf: int = LEAF,
    first: int = FIRST,
    depth: int = DEPTH,
) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)``, one row per row of ``docs``.

    Linked are documents whose sets have a Jaccard similarity of at least ``percent`` / 100; components are the
    transitive closure, named by their smallest id; ``kept`` marks that document. Texts that are null or without words
    have 0 shingles, stand alone and are kept. Rows with the same id are one document to the links, whatever their
    texts, and are kept or not together. A row without an id joins the class of its equal set, if any has an id, and
    is then not kept; otherwise it is kept with a null component. An empty table gives no rows.
    """
    threshold = percent / 100
    sets = settled(described(docs, text, id_col, k), "sets")
    firsts = sets.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("id").alias("cid"))
    members = settled(
        sets.filter("digest IS NOT NULL").select("id", "n", "digest").join(sized(firsts), "digest").select("id", "n", "cid"), "members"
    )
    named = members.filter("id = cid").select("id").distinct()
    classes = sets.filter("digest IS NOT NULL").join(named, "id", "left_semi")
    classes = settled(classes.select(F.col("id").alias("cid"), F.col("n").alias("size"), "sig"), "classes")

    found = nodes(classes, threshold, trees, leaf, first, depth)
    stars = found.filter("cid != pivot").select(F.col("pivot").alias("a"), F.col("cid").alias("b"))
    stars = settled(likely(stars, classes, threshold), "pairs")

    texts = docs.select(F.col(f"`{id_col}`").alias("cid"), F.col(f"`{text}`").alias("t"))
    seen = settled(texts.join(_ids(stars), "cid", "left_semi"), "texts")
    links = settled(confirmed(stars, seen, k, percent), "links")
    roots = components(links)

    small, large = apart(found.filter("n > 2"), roots, leaf)
    rest = compared_small(small, classes, threshold).union(compared_large(large, texts, k, threshold)).distinct()
    rest = settled(rest.join(stars, ["a", "b"], "left_anti"), "pairs")
    seen = texts.join(_ids(rest), "cid", "left_semi")
    more = settled(confirmed(rest, seen, k, percent), "links")
    # Rows of one id may lie in several classes: the id itself ties them together.
    same = members.filter("id != cid").select(F.col("id").alias("a"), F.col("cid").alias("b"))
    roots = components(links.union(more).union(same))

    empty = sets.filter("digest IS NULL").select("id", "n", F.col("id").alias("cid"))
    out = members.union(empty).join(roots, F.col("cid") == F.col("node"), "left")
    component = F.coalesce("root", "cid")
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, component.isNull()).alias("kept"),
    )


def _ids(pairs: DataFrame) -> DataFrame:
    return sized(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct())


def apart(found: DataFrame, roots: DataFrame, leaf: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``(key, cid, root)`` of small nodes, and ``(key, cid, root, minor, blocks)`` of large ones, whose classes lie
    in several components. ``minor`` rows lie outside the most frequent component."""
    rows = found.select("key", "cid", "n").join(roots, F.col("cid") == F.col("node"), "left")
    rows = rows.select("key", "cid", "n", F.coalesce("root", "cid").alias("root"))
    mixed = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high").select("key")
    rows = settled(rows.join(mixed, "key"), "mixed")
    wide = rows.filter(F.col("n") > leaf)
    parts = wide.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    tops = parts.groupBy("key").agg(F.max("size").alias("size"), F.sum("size").alias("all"))
    main = parts.join(tops, ["key", "size"]).groupBy("key").agg(F.min("root").alias("main"), F.first(F.col("all") - F.col("size")).alias("minors"))
    large = wide.join(main, "key").select(
        "key", "cid", "root", (F.col("root") != F.col("main")).alias("minor"), F.ceil(F.col("minors") / BLOCK).alias("blocks")
    )
    return rows.filter(F.col("n") <= leaf).select("key", "cid", "root"), large


def compared_small(rows: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a < b`` of one small node in different components whose sizes and minwise tokens allow a link."""
    least = int(COORDINATES * max(0.0, threshold - SKETCH))
    rows = rows.join(classes.select("cid", "size", "sig"), "cid").select("key", "cid", "root", "size", "sig")
    sorted_rows = rows.repartition("key").sortWithinPartitions("key", "cid")

    def pairs(group: list[tuple]) -> list[tuple[int, int]]:
        if len(group) < 2:
            return []
        ids, roots, sizes = (np.array([g[c] for g in group]) for c in range(3))
        sigs = np.stack([g[3] for g in group])
        equal = (sigs[:, None, :] == sigs[None, :, :]).sum(axis=2)
        low, high = np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes)
        fits = (equal >= least) & (low >= threshold * high - 1e-9) & (roots[:, None] != roots[None, :]) & (ids[:, None] < ids[None, :])
        return [(int(ids[i]), int(ids[j])) for i, j in zip(*np.nonzero(fits))]

    def compare(batches):
        key, group = None, []
        for batch in batches:
            sigs = np.asarray(batch.column(4).flatten()).reshape(-1, COORDINATES)
            out = []
            for i, row in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True)):
                if row[0] != key:
                    out += pairs(group)
                    key, group = row[0], []
                group.append((*row[1:], sigs[i]))
            yield _pairs(out)
        yield _pairs(pairs(group))

    return sorted_rows.mapInArrow(compare, "a bigint, b bigint")


def compared_large(rows: DataFrame, texts: DataFrame, k: int, threshold: float) -> DataFrame:
    """Pairs ``a < b`` of one large node in different components that share enough shingles, by 32-bit hashes.

    A block of minor classes is held in a task with an index of their shingles; all classes of the node are then read
    one by one. Hash collisions can only add pairs, or lose one that is within a collision of the threshold.
    """
    ids = sized(rows.select("cid").distinct())

    def start():
        return lambda values: [[np.unique((hashed(t, k) >> np.uint64(32)).astype(np.uint32)).tobytes() if t else b"" for t in values]]

    sets = settled(annotated(texts.join(ids, "cid", "left_semi"), "t", ["cid"], schema("hashes binary"), start), "hashes")
    # Every class is read once per block (turn 1), and a minor class is held in one of them (turn 0).
    turns = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda b: F.struct(b.alias("block"), F.lit(1).alias("turn")))
    held = F.array(F.struct(F.pmod(F.xxhash64("cid"), F.col("blocks")).alias("block"), F.lit(0).alias("turn")))
    met = rows.join(sets, "cid").select("key", "cid", "root", "hashes", F.explode(F.when(F.col("minor"), F.concat(held, turns)).otherwise(turns)).alias("at"))
    dealt = met.select("key", "at.block", "at.turn", "cid", "root", "hashes")
    dealt = dealt.repartition("key", "block").sortWithinPartitions("key", "block", "turn", "cid")

    def compare(batches):
        at, index = None, None
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                out = []
                for key, block, turn, cid, root, data in zip(*(c.to_pylist() for c in whole.slice(first, 512).columns), strict=True):
                    if (key, block) != at:
                        at, index = (key, block), Index()
                    values = np.frombuffer(data, np.uint32)
                    if turn == 0:
                        index.add(cid, root, values)
                    else:
                        out += [(min(cid, other), max(cid, other)) for other in index.partners(root, values, threshold)]
                yield _pairs(out)

    return in_batches(dealt, compare, "a bigint, b bigint")


class Index:
    """Shingles of a block of classes, each with the classes that have it."""

    def __init__(self):
        self.ids, self.roots, self.sets = [], [], []
        self.values: np.ndarray | None = None

    def add(self, cid: int, root: int, values: np.ndarray) -> None:
        self.ids.append(cid)
        self.roots.append(root)
        self.sets.append(values)

    def ready(self) -> None:
        every = np.concatenate(self.sets)
        owners = np.repeat(np.arange(len(self.sets)), [len(s) for s in self.sets])
        order = np.argsort(every, kind="stable")
        self.owners = owners[order]
        self.values, self.starts = np.unique(every[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(every))
        self.sizes = np.array([len(s) for s in self.sets])
        self.at = np.array(self.roots)
        self.names = np.array(self.ids)

    def partners(self, root: int, values: np.ndarray, threshold: float) -> list[int]:
        if not self.ids:
            return []
        if self.values is None:
            self.ready()
        place = np.searchsorted(self.values, values)
        place[place == len(self.values)] = 0
        place = place[self.values[place] == values]
        starts, counts = self.starts[place], self.ends[place] - self.starts[place]
        before = np.cumsum(counts) - counts
        rows = np.repeat(starts - before, counts) + np.arange(counts.sum())
        both = np.bincount(self.owners[rows], minlength=len(self.ids))
        near = (both >= (threshold - 1e-3) * (self.sizes + len(values) - both)) & (self.at != root)
        return self.names[near].tolist()


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*rows, strict=True) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
