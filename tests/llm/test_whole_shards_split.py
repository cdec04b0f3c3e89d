"""Shards of fingerprints: however dense a leaf is, groups stay small and the links whole."""

import numpy as np
import pytest

from ticklore.llm import simhash_dedup as s
from ticklore.llm.graph import components


def nodes(spark, values):
    return spark.createDataFrame([(int(v),) for v in np.unique(values).view(np.int64)], "fp long").repartition(4)


def told(spark, values, bits, **sizes):
    """Each fingerprint's class, by links and by brute force."""
    values = np.unique(values)
    forest = s.Forest(len(values))
    for a in range(len(values)):
        close = np.flatnonzero(s.apart(values, values[a]) <= bits)
        forest.link(np.full(len(close), a), close)
    want = {frozenset(values[forest.roots() == r].view(np.int64).tolist()) for r in np.unique(forest.roots())}
    of = {r.node: r.component for r in components(s.close_links(nodes(spark, values), bits, **sizes)).collect()}
    got: dict = {}
    for v in values.view(np.int64).tolist():
        got.setdefault(of.get(v, v), set()).add(v)
    return {frozenset(c) for c in got.values()}, want


def cases(n):
    rng = np.random.default_rng(4)
    wide = rng.integers(0, 1 << 64, n, dtype=np.uint64)
    # All within eight bits of one point, and of each other: links abound, and balls cover the leaf.
    dense = np.bitwise_xor.reduce(np.uint64(1) << rng.integers(0, 64, (n, 4), dtype=np.uint64), axis=1)
    return {"wide": wide, "dense": dense, "both": np.concatenate([wide[: n // 2], dense[: n // 2], wide[: n // 8] ^ np.uint64(5)])}


@pytest.mark.parametrize("kind", ["wide", "dense", "both"])
def test_links(spark, kind):
    got, want = told(spark, cases(3000)[kind], 2, leaf_rows=100, shard_rows=300)
    assert got == want and len(want) > 1


@pytest.mark.parametrize("kind", ["wide", "dense"])
def test_groups(spark, kind):
    groups = s.shards(nodes(spark, cases(4000)[kind]), 2, 200, 500).groupBy("leaf", "i", "j").count().collect()
    assert max(g["count"] for g in groups) <= 600


def test_leaf_beyond_the_first_tree(spark, monkeypatch):
    """A tree from too small a sample leaves large leaves: they grow, and less is shipped than all rows to all parts."""
    monkeypatch.setattr(s, "SAMPLE", 16)
    wide = cases(6000)["wide"]
    tree = s.build(wide[:16], 1)
    assert s.inner_nodes(s.grafted(tree, {0: tree}, iter(range(9)))) >= s.inner_nodes(tree)
    placed = s.shards(nodes(spark, wide), 1, 300, 1200)
    per = placed.groupBy("leaf", "i", "j").count().collect()
    assert max(g["count"] for g in per) <= 1400 and len({g.leaf for g in per}) > 8
    assert placed.filter("member AND i = j").count() == len(wide)


def test_few(spark):
    assert s.close_links(nodes(spark, np.zeros(0, np.uint64)), 2).count() == 0
    assert {(r.u, r.v) for r in s.close_links(nodes(spark, np.array([0, 1, 1 << 40], np.uint64)), 1).collect()} <= {(1, 0), (1 << 40, 0), (0, 1), (0, 1 << 40)}
