"""Whitening against dense eigenvectors and exact sums, and the eigensolver against hard spectra."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklore.llm import whitening as m

SF = "/root/testdata/sf0.001"


def brute(x, k=8):
    """x: list of whole-number vectors. deviation of each, e/trace, |whitened|."""
    n, s = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    y = np.array([[(n * a - b) / n for a, b in zip(r, s)] for r in x])
    v = y.T @ y / n
    e, w = np.linalg.eigh(v)
    e, w = e[::-1][:k], w[:, ::-1][:, :k]
    return deviation, e / np.trace(v), y @ w / np.sqrt(e)


def test_embeddings(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    x = [[int(np.floor(np.float64(c) * 1024)) + 100_000 for c in r.embedding] for r in rows]
    deviation, explained, white = brute(x)
    got = m.op12(spark, SF).toPandas().sort_values(["component", "vec_id"])
    assert len(got) == 8 * len(rows) and set(got.n) == {len(rows)} and got.identity_error.max() < 1e-10
    for k in range(8):
        own = got[got.component == k + 1]
        assert own.vec_id.tolist() == [r.vec_id for r in rows] and own.deviation.tolist() == deviation
        assert np.allclose(own.explained, explained[k], rtol=1e-10)
        sign = np.sign(own.whitened.to_numpy() @ white[:, k])
        assert np.allclose(own.whitened.to_numpy() * sign, white[:, k], atol=1e-8)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (2, [0.25, -3.0]), (2, [0.25, -3.0]), (None, [9.0, 0.125]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [-inf, 1.0]), (8, []), (9, [1.0]), (10, [1e300, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(c) for c in ("x", "n", "w", "i", "deviation", "a.b")})
    got = m.by_component(m.whiten(m.fixed_point(df))).toPandas()
    deviation, _, white = brute([[int(np.floor(c * 1024)) + 100_000 for c in v] for _, v in rows[:4]])
    assert len(got) == 8 and sorted(got.deviation) == sorted(2 * deviation)
    assert np.allclose(sorted(got.whitened.abs()), sorted(np.abs(white).ravel()), atol=1e-10)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_no_variance(spark, rows):
    assert m.by_component(m.whiten(m.fixed_point(spark.createDataFrame(rows, "vec_id long, embedding array<float>")))).count() == 0


def test_wide_values(spark):
    """A deviation that no long holds is null; the others stay exact."""
    rows = [(i, [float(i), 1e12 * (i == 0)]) for i in range(50)]
    got = m.whiten(m.fixed_point(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))).toPandas()
    assert got.deviation.isna().all() and got.identity_error.max() < 1e-6


@pytest.mark.parametrize("d", [2, 9, 40])
@pytest.mark.parametrize("kind", ["plain", "steep", "twins", "rank", "sphere"])
def test_eigenpairs(d, kind):
    rng = np.random.default_rng(d)
    e = {"plain": rng.random(d) + 0.1, "steep": 10.0 ** -np.arange(d).clip(0, 9), "twins": np.repeat(rng.random(d), 2)[:d] + 1, "rank": np.r_[1.0, np.zeros(d - 1)], "sphere": np.ones(d)}[kind]
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    v = (q * e) @ q.T
    v = (v + v.T) / 2
    got, x = m.components(v, 8)
    want = np.sort(e)[::-1][: len(got)]
    assert len(got) == min(8, int((e > 1e-12 * e.sum()).sum()))
    assert np.allclose(got, want, atol=1e-12 * e.max() * d) and np.allclose(x.T @ x, np.eye(len(got)), atol=1e-12)
    assert np.linalg.norm(v @ x - x * got) < 1e-12 * d * np.linalg.norm(v)


def test_counts():
    v = np.diag([3.0, 1.0, 2.0, 2.0, -1.0])
    d, s = m.tridiagonal(v)
    assert [m.above(d, s, c) for c in (-2, 0, 1.5, 2.5, 4)] == [5, 4, 3, 1, 0]
