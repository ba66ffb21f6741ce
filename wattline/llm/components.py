"""Connected components of links by alternating star contraction; no vertex's neighbours are ever gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.session import settled


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``: root is the smallest node reachable. Nulls link nothing.

    Each round hooks every node's larger neighbours to its smallest neighbour and then its smaller ones; the edges
    end as stars around the roots. Rounds grow with the logarithm of the longest chain. Minima are aggregated before
    the shuffle, so a node that many edges share is no hot task.
    """
    edges = links.filter("a IS NOT NULL AND b IS NOT NULL AND a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = settled(edges.distinct(), "edges")
    while True:
        large = _hooked(edges.union(edges.select("b", "a")), larger=True)
        small = settled(_hooked(large, larger=False), "edges")
        changed = small.select("a", "b").exceptAll(edges.select("a", "b")).limit(1).count()
        edges = small
        if not changed:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return settled(edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots), "components")


def _hooked(pairs: DataFrame, larger: bool) -> DataFrame:
    """From each node ``a`` the edges of its larger neighbours (or all its neighbours and itself) to its minimum."""
    least = pairs.groupBy(F.col("a").alias("c")).agg(F.min("b").alias("m"))
    least = least.select("c", F.least("c", "m").alias("m"))
    met = pairs.join(least, pairs["a"] == least["c"])
    if larger:
        out = met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.filter("c > m").select(F.col("c").alias("a"), F.col("m").alias("b"))
        return out.union(own).filter("a != b").distinct()
    out = met.select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("c").alias("a"), F.col("m").alias("b"))
    return out.union(own).filter("a > b").distinct()
