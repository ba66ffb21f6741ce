"""Pairs at the threshold inside one large family share a node, and what the trees of a depth miss."""

import numpy as np
import pytest

from wattline.llm import chosen_path


def test_pairs_of_a_large_family_share_a_node(spark):
    rng, rows = np.random.default_rng(31), []
    base = rng.integers(1, 1 << 30, 64)
    for pair in range(400):
        one = base.copy()
        one[rng.choice(64, 10, replace=False)] = rng.integers(1, 1 << 30, 10)
        other = one.copy()
        other[rng.choice(64, 19, replace=False)] = rng.integers(1, 1 << 30, 19)  # a pair of 0.85 with few equal tokens
        rows += [(2 * pair, one.tolist()), (2 * pair + 1, other.tolist())]
    classes = spark.createDataFrame(rows, "cid bigint, sig array<int>")
    found = chosen_path.nodes(classes, 0.85, chosen_path.TREES, chosen_path.LEAF, chosen_path.FIRST, chosen_path.DEPTH)
    keys = [set() for _ in rows]
    for r in found.select("key", "cid").collect():
        keys[r["cid"]].add(r["key"])
    lost = sum(not keys[i] & keys[i + 1] for i in range(0, len(rows), 2))
    assert lost == 0, lost


def test_trees_keep_the_stated_chance():
    assert chosen_path.missed(0.85, 2, 10) == pytest.approx(4.6e-6, rel=0.1)
    assert chosen_path.missed(0.85, 6, 10) == pytest.approx(2.7e-3, rel=0.1)
    assert chosen_path.missed(0.80, 6, 10) == pytest.approx(6.7e-3, rel=0.1)
    for threshold in (0.8, 0.85):
        trees = chosen_path.trees_for(threshold, 6, 10)
        assert chosen_path.missed(threshold, 6, trees) <= 1e-5 < chosen_path.missed(threshold, 6, trees - 1)
