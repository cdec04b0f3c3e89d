"""Embedding whitening by FEAST contour integration (operator 12).

Entries c become whole numbers x = floor(1024 * c) + 100000. Spark sums them exactly, then sums products of x less the whole part of
its mean: those are whole numbers too, so as long as a sum stays below 2**53 it is exact, and the same whichever way rows are
dealt or tasks repeated. The covariance follows without cancellation, and is all that the driver holds (dimensions squared).

The largest eigenvalues are found by intervals. Inertia (the signs of the pivots of the shifted tridiagonal form) counts the eigenvalues
above any shift, which places the lower end in a gap below the k-th. For the interval, complex shifted solves (z I - V) Q = Y at
midpoints of a circle's upper half add up to the spectral projector on a random block; Rayleigh-Ritz on its span gives pairs, whose span is
projected again until residuals are at rounding error. The pairs inside must be as many as the inertia says, else the block grows.

Each row's whitened values are x - S/n on the components, over sqrt(e). The identity error is measured on the values as
written, in a pass over all rows.

Rows whose vector is null or holds a null, NaN or infinite entry take no part; neither does a row with an entry beyond 2**42, whose x no
double holds exactly, or with another length than most vectors (of two lengths equally common, the greater). Null and
repeated ids stay as rows of their own. Components whose variance is under 1e-12 of the total cannot be scaled and
are left out: one row, or equal rows only, give no component and so no row, as does an empty table. A deviation beyond a long is null. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LIMIT = float(1 << 42)
#: Midpoints on the contour's upper half.
NODES = 16
#: Rows whose products are added up at once; whole batches are, if they are smaller.
ROWS = 4096
#: Share of the total variance below which a direction counts as constant.
NOTHING = 1e-12


def fixed_point(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and x (array of longs) of the rows that take part."""
    v = F.col(vector)
    sound = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < LIMIT, F.lit(False)))
    rows = vectors.filter(sound).select("vec_id", F.transform(v, lambda c: (F.floor(c.cast("double") * SCALE) + SHIFT).cast("long")).alias("x"))
    most = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("x") == (most["d"] if most else 0))


def _block(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows, and the exact sum of each dimension."""

    def add(batches):
        n, s = 0, None
        for b in batches:
            if b.num_rows:
                x = _block(b.column(0), len(b.column(0)[0]))
                s = x.sum(axis=0).astype(object) + (0 if s is None else s)
                n += len(x)
        if n:
            i = [-1, *range(len(s))]
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array([Decimal(int(v)) for v in (n, *s)], pa.decimal128(38, 0))], ["i", "s"])

    got = {r.i: int(r.s) for r in rows.select("x").mapInArrow(add, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()}
    return got.get(-1, 0), [got[i] for i in range(len(got) - 1)]


@dataclass(frozen=True)
class Fit:
    """Of all rows: n, the sums S, the whole parts of S/n and the rest, and V."""

    n: int
    total: list[int]
    whole: np.ndarray
    rest: np.ndarray
    cov: np.ndarray


def fit(rows: DataFrame) -> Fit | None:
    n, total = sums(rows)
    if not n:
        return None
    whole, d = np.array([s // n for s in total], np.int64), len(total)
    rest = np.array([s % n / n for s in total])
    up = np.triu_indices(d)

    def add(batches):
        g = np.zeros((d, d))
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                y = (_block(b.column(0).slice(at, ROWS), d) - whole).astype(float)
                g += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(up[0])), pa.int32()), pa.array(g[up])], ["i", "g"])

    told = rows.select("x").mapInArrow(add, "i int, g double").groupBy("i").agg(F.sum("g").alias("g")).toArrow()
    g = np.zeros((d, d))
    i = told["i"].to_numpy()
    g[up[0][i], up[1][i]] = told["g"].to_numpy()
    g = np.triu(g) + np.triu(g, 1).T
    return Fit(n, total, whole, rest, g / n - np.outer(rest, rest))


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of the same eigenvalues, by reflections."""
    a = v.astype(float).copy()
    for k in range(len(a) - 2):
        x = a[k + 1 :, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        if size := np.linalg.norm(x):
            x /= size
            a[k + 1 :] -= 2 * np.outer(x, x @ a[k + 1 :])
            a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def above(diagonal: np.ndarray, side: np.ndarray, shift: float) -> int:
    """Eigenvalues over the shift: positive pivots, by Sylvester's law of inertia."""
    tiny = np.finfo(float).eps * (np.abs(diagonal).max() + np.abs(side).max(initial=0) + np.finfo(float).tiny)
    n, pivot = 0, 1.0
    for i, a in enumerate(diagonal):
        pivot = a - shift - (side[i - 1] ** 2 / pivot if i else 0.0)
        pivot = -tiny if abs(pivot) < tiny else pivot
        n += pivot > 0
    return n


def lower_end(diagonal: np.ndarray, side: np.ndarray, k: int, top: float, floor: float) -> tuple[float, int]:
    """A shift with k eigenvalues or a few more above it, in the widest gap that lies next below the k-th; and how many are above."""

    def value(j: int) -> float:  # the j-th largest, to a part in 10**9
        lo, hi = floor, top
        while hi - lo > 1e-9 * (top - floor):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if above(diagonal, side, mid) >= j else (lo, mid)
        return lo

    most = above(diagonal, side, floor)
    if most <= k:
        return floor, most
    near = [value(j) for j in range(k, min(most, 2 * k) + 1)] + ([floor] if most <= 2 * k else [])
    at = max(range(len(near) - 1), key=lambda j: near[j] - near[j + 1])
    if near[at] - near[at + 1] < 1e-6 * (top - floor):  # as good as one eigenvalue: all of them are taken
        return floor, most
    shift = (near[at] + near[at + 1]) / 2
    return shift, above(diagonal, side, shift)


def projected(v: np.ndarray, block: np.ndarray, lo: float, hi: float) -> np.ndarray:
    """The block's part in the eigenspaces of [lo, hi]: the resolvent's integral over a circle, by midpoints."""
    centre, radius = (lo + hi) / 2, (hi - lo) / 2
    out, eye = np.zeros_like(block), np.eye(len(v))
    for j in range(NODES):
        turn = radius * np.exp(1j * np.pi * (j + 0.5) / NODES)
        out += (turn * np.linalg.solve((centre + turn) * eye - v, block.astype(complex))).real / NODES
    return out


def feast(v: np.ndarray, lo: float, hi: float, count: int, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """The `count` eigenpairs of [lo, hi], falling. A block too small to hold them all is grown; in the end it spans the whole space."""
    d, size = len(v), np.linalg.norm(v, 2)
    rng, wide = np.random.default_rng(12), min(len(v), count + max(4, count // 2))
    block = rng.standard_normal((d, wide))
    for turn in range(1, rounds + 1):
        q, _ = np.linalg.qr(projected(v, block, lo, hi))
        e, w = np.linalg.eigh(q.T @ v @ q)
        x = q @ w
        inside = np.flatnonzero((e > lo) & (e <= hi))[::-1]
        off = np.linalg.norm(v @ x[:, inside] - x[:, inside] * e[inside], axis=0).max(initial=0)
        if len(inside) == count and off <= 8 * d * np.finfo(float).eps * size:
            return e[inside], x[:, inside]
        if turn % 6 == 0:  # too few, or too slow
            wide = min(d, 2 * wide)
        block = np.hstack([x, rng.standard_normal((d, wide - x.shape[1]))]) if wide > x.shape[1] else x
    raise ArithmeticError(f"{len(inside)} of {count} eigenpairs found, residual {off:.3g}")


def components(v: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a covariance, falling, and their unit vectors as columns; fewer where the variance is nought."""
    trace = float(np.trace(v))
    if not trace > 0:
        return np.zeros(0), np.zeros((len(v), 0))
    diagonal, side = tridiagonal(v)
    pad = np.abs(np.append(side, 0)) + np.abs(np.insert(side, 0, 0))
    top = float((diagonal + pad).max()) * (1 + 1e-9) + NOTHING * trace
    lo, count = lower_end(diagonal, side, k, top, NOTHING * trace)
    e, x = feast(v, lo, top, count)
    return e[:k], x[:, :k]


def whiten(rows: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """rows: vec_id, x. vec_id, n, deviation, w (array, one entry for each component), explained (likewise), identity_error."""
    f = fit(rows)
    e, vectors = components(f.cov, k) if f else (np.zeros(0), None)
    shape = "vec_id long, deviation long, w array<double>"
    spark = rows.sparkSession
    if not len(e):
        return spark.createDataFrame([], f"{shape}, n long, explained array<double>, identity_error double")
    n, d, project = f.n, len(f.total), vectors / np.sqrt(e)
    left = np.array([s % n for s in f.total], np.int64)

    def each(batches):
        for b in batches:
            y = _block(b.column(1), d) - f.whole
            far = float(np.abs(y).max(initial=0)) * n + n
            z = n * (y if far < 2.0**62 else y.astype(object)) - left
            z = z if d * far * far < 2.0**62 else z.astype(object)
            deviation = [v if v < 1 << 63 else None for v in map(int, (z * z).sum(axis=1))]
            w = (y - f.rest) @ project
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(deviation, pa.int64()), pa.array(list(w), pa.list_(pa.float64()))], ["vec_id", "deviation", "w"])

    done = written(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(each, shape), "whitened")
    return done.withColumns({"n": F.lit(n).cast("long"), "explained": F.array(*[F.lit(float(v / np.trace(f.cov))) for v in e]), "identity_error": F.lit(identity_error(done, len(e)))})


def identity_error(done: DataFrame, k: int) -> float:
    """The largest entry, without sign, of the covariance of w less the identity: over all rows, centred first."""
    w = lambda i: F.get("w", F.lit(i))
    mean = done.agg(*[F.avg(w(i)) for i in range(k)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    both = done.agg(*[F.avg((w(i) - mean[i]) * (w(j) - mean[j])) for i, j in pairs]).first()
    return float(max(abs(v - (i == j)) for (i, j), v in zip(pairs, both)))


def by_component(done: DataFrame) -> DataFrame:
    """A row for each component, numbered from 1."""
    return done.select("*", F.posexplode("w").alias("at", "whitened")).withColumns({"component": F.col("at") + 1, "explained": F.get("explained", F.col("at"))}).drop("at")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their eight main components."""
    done = whiten(fixed_point(table(spark, sf_dir, "embeddings")))
    return by_component(done).select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
