"""Hard negatives against a plain search over all pairs: the given vectors, ties, repeated rows, large entries, odd tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklore.llm import hard_negatives as m


def brute(rows, anchors):
    """rows: (vec_id, vector of whole numbers, label)."""
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, (a, x, label) in enumerate(rows):
        if a % anchors:
            continue
        told = sorted((-dot(x, y), b, same == label, j) for j, (b, y, same) in enumerate(rows) if j != i)
        for score, b, *_ in [t for t in told if t[2]][: m.POSITIVES]:
            own = [t for t in told if not t[2] and 50 * -score <= 100 * -t[0] <= 95 * -score][: m.NEGATIVES]
            out += [(a, b, k, t[1], -score, -t[0]) for k, t in enumerate(own, 1)]
    return sorted(out)


def got(spark, rows, anchors=50, kind="double"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").withColumns({c: F.lit(c) for c in ("rid", "x", "q", "rank", "score", "a.b")})
    return sorted(map(tuple, m.mine(m.prepared(df), F.col("vec_id") % anchors == 0).collect()))


def whole(rows):
    return [(a, [int(np.floor(np.float64(c) * 256)) for c in v], k) for a, v, k in rows]


def test_small_trees(spark, monkeypatch):
    """Several trees of several levels, several blocks, and ties throughout."""
    for name, value in (("TREE_ROWS", 64), ("LEAF", 4), ("FAN", 2), ("BLOCK", 10), ("CHUNK", 3)):
        monkeypatch.setattr(m, name, value)
    rng = random.Random(3)
    rows = [(i, [rng.randint(-3, 3) / 256 for _ in range(3)], rng.randint(0, 4)) for i in range(300)]
    assert got(spark, rows, 10) == brute(whole(rows), 10)


@pytest.mark.parametrize("size", [1.0, 1e5])
def test_hot_vector_and_large_entries(spark, size):
    """A third of the rows with one vector; products beyond 2**53 are added up as whole numbers."""
    rng = random.Random(5)
    rows = [(i, [size, size / 2, -size, 0.25] if i % 3 == 0 else [rng.uniform(-size, size) for _ in range(4)], i % 3 if i % 2 else rng.randint(0, 2)) for i in range(240)]
    assert got(spark, rows, 20) == brute(whole(rows), 20)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    sound = [(0, [1.0, 1.0], 1), (2, [1.0, 0.5], 1), (2, [1.0, 0.5], 1), (3, [0.5, 0.75], 2), (4, [0.75, 0.75], 2), (50, [-1.0, 0.0], 3), (51, [-1.0, 0.0], 3), (52, [-0.75, 0.1], 4)]
    odd = [(5, None, 1), (6, [1.0, None], 1), (7, [nan, 1.0], 2), (8, [inf, 1.0], 2), (9, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (10, [1.0], 1), (11, [], 1), (12, [1e300, 1.0], 1)]
    assert got(spark, sound + odd) == brute(whole(sound), 50)
    assert got(spark, []) == [] and got(spark, sound[:1]) == [] and got(spark, sound[1:5]) == []


def test_query(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = con.execute(m.OP11_SQL)
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, m.op11(spark, sf).select(names).collect())) == sorted(want.fetchall())


def test_boxes_bound_their_rows():
    rng = np.random.default_rng(1)
    x, q = rng.integers(-50, 50, (500, 6)), rng.integers(-50, 50, (9, 6)).astype(float)
    tree = m.Tree(*m.pack([np.arange(500), np.arange(500), rng.integers(0, 3, 500), x], [0, 1, 2]))
    score = q @ tree.x.T
    for i, (a, b) in enumerate(zip(tree.edges, tree.edges[1:])):
        lo, hi = tree.bounds(q, 0, slice(i, i + 1))
        assert (lo[:, 0] <= score[:, a:b].min(axis=1)).all() and (hi[:, 0] >= score[:, a:b].max(axis=1)).all() and b - a <= m.LEAF
    assert len(tree.levels[-1][0]) == 1 and sorted(map(tuple, tree.x.tolist())) == sorted(map(tuple, x.tolist()))
