"""Embedding whitening: centred covariance over the table, its leading eigenvectors
by tridiagonalisation, bisection and inverse iteration, and the projection.

A vector entry c becomes the integer x = floor(64 c) + 1,000,000.  One pass sums
counts and integer totals per dimension, exactly; a second adds up the products of
the centred entries (centred on the exact mean's integer and fractional part, so
that the large constant never meets a product); both leave d or d x d numbers per
task, added by Spark.  The driver holds the d x d covariance: Householder reflections
make it tridiagonal, Sturm counts bisect the leading eigenvalues all at once, inverse
iteration with reorthogonalisation inside clusters of near-equal eigenvalues gives
the vectors, which the reflections turn back.  The projection is broadcast (d x 32).

Bounds: ``d`` is the vectors' length, never a number of rows; the driver and each
task hold a few d x d matrices.

Defined cases: a null vector, and one with null, NaN or infinite entries, is left
out; so is an empty one, and one whose length isn't the table's (the length of most
of the remaining rows, the larger of tied ones); null and repeated vec_ids and equal
rows count and come back row by row; directions without variance (eigenvalues that
rounding can't tell from zero) can't be scaled to variance one and aren't components,
so d equal rows give no row at all; a deviation that does not fit a long is null; an
empty table gives an empty result; other input columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import saved

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
_EPS = np.finfo(float).eps


# ------------------------------------------------------- eigenvalue problem --
def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflectors) of a symmetric matrix; the matrix is
    Q T Q' with Q the product of I - 2 v v' over the reflectors in order."""
    a, n, reflectors = a.copy(), len(a), []
    for k in range(n - 2):
        x = a[k + 1:, k]
        v = np.zeros(n)
        v[k + 1:] = x
        v[k + 1] += np.copysign(np.linalg.norm(x), x[0])
        length = np.linalg.norm(v)
        if length > 0:
            v /= length
            p = a @ v
            w = 2 * (p - (v @ p) * v)
            a -= np.outer(v, w) + np.outer(w, v)
        reflectors.append(v)
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy(), reflectors


def sturm_count(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of eigenvalues below each of ``at``: negative pivots of T - at."""
    tiny = _EPS * max(np.abs(diag).max(), np.abs(off).max(initial=0)) ** 2 + np.finfo(float).tiny
    pivot = diag[0] - at
    count = (pivot < 0).astype(np.int64)
    for i in range(1, len(diag)):
        pivot = np.where(np.abs(pivot) < tiny, np.where(pivot < 0, -tiny, tiny), pivot)
        pivot = diag[i] - at - off[i - 1] ** 2 / pivot
        count += pivot < 0
    return count


def leading_eigenvalues(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection on Sturm counts."""
    n = len(diag)
    radius = np.abs(np.concatenate([[0], off])) + np.abs(np.concatenate([off, [0]]))
    low, high = (diag - radius).min(), (diag + radius).max()
    slack = _EPS * max(abs(low), abs(high)) * n + np.finfo(float).tiny
    want = n - 1 - np.arange(k)                     # eigenvalue of this rank from below
    lo, hi = np.full(k, low - slack), np.full(k, high + slack)
    for _ in range(128):
        mid = (lo + hi) / 2
        if ((mid <= lo) | (mid >= hi)).all():
            break
        under = sturm_count(diag, off, mid) > want
        hi, lo = np.where(under, mid, hi), np.where(under, lo, mid)
    return (lo + hi) / 2


def _solve(diag: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, floor: float) -> np.ndarray:
    """(T - shift) x = b by elimination with row exchanges; pivots of at least ``floor``."""
    n = len(diag)
    u0, u1, u2, x = diag - shift, np.append(off, 0.0), np.zeros(n), b.copy()
    for i in range(n - 1):
        below, next0, next1 = off[i], u0[i + 1], u1[i + 1]
        if abs(below) > abs(u0[i]):
            u0[i], below = below, u0[i]
            u1[i], next0 = next0, u1[i]
            u2[i], next1 = next1, 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(u0[i]) < floor:
            u0[i] = floor
        f = below / u0[i]
        u0[i + 1], u1[i + 1] = next0 - f * u1[i], next1 - f * u2[i]
        x[i + 1] -= f * x[i]
    if abs(u0[-1]) < floor:
        u0[-1] = floor
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            x[i] -= u1[i] * x[i + 1]
        if i + 2 < n:
            x[i] -= u2[i] * x[i + 2]
        x[i] /= u0[i]
    return x


def tridiagonal_vectors(diag: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Unit eigenvectors (columns) of falling ``values`` by inverse iteration; those
    of a cluster are kept orthogonal to one another in every round."""
    n, norm = len(diag), max(np.abs(diag).max(), np.abs(off).max(initial=0), np.finfo(float).tiny)
    out, first = np.zeros((n, len(values))), 0
    rng = np.random.default_rng(7)
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        shift = value
        if j > first:                               # equal shifts would give one vector again
            shift = min(value, used - 2 * _EPS * norm)
        used = shift
        x = rng.standard_normal(n)
        for _ in range(rounds):
            x = _solve(diag, off, shift, x / np.linalg.norm(x), _EPS * norm)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= out[:, first:j] @ (out[:, first:j].T @ x)
        out[:, j] = x / np.linalg.norm(x)
    return out


def eigen(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k leading eigenvalues, falling, and unit eigenvectors as columns."""
    d = len(cov)
    k = min(k, d)
    unit = np.abs(cov).max()
    if d == 1 or not unit:
        return np.full(k, unit), np.eye(d)[:, :k]
    diag, off, reflectors = tridiagonal(cov / unit)
    values = leading_eigenvalues(diag, off, k)
    vectors = tridiagonal_vectors(diag, off, values)
    for v in reversed(reflectors):
        vectors -= 2 * np.outer(v, v @ vectors)
    return values * unit, vectors


# ------------------------------------------------------------------ passes --
def _finite(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, integer vectors) of the batch's whole finite vectors, by length."""
    col = batch.column("embedding")
    size = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
    for d in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == d)
        flat = pc.list_flatten(col.take(pa.array(rows)))
        x = pc.fill_null(flat.cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False).reshape(-1, d)
        ok = np.isfinite(x).all(axis=1)
        if ok.any():
            yield rows[ok], np.floor(x[ok] * SCALE).astype(np.int64) + SHIFT


def totals(rows: DataFrame) -> tuple[int, np.ndarray]:
    """(n, S): number of remaining vectors and their integer sums per dimension."""
    def run(batches):
        sums: dict[int, list] = {}
        for b in batches:
            for at, x in _finite(b):
                have = sums.setdefault(x.shape[1], [0, 0])
                have[0] += len(at)
                have[1] = have[1] + x.sum(0)
        for d, (n, s) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array(s)], ["d", "i", "n", "s"])
    sums = saved(rows.sparkSession, rows.mapInArrow(run, "d int, i int, n long, s long").groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "vector-sums")
    best = sums.where("i = 0").orderBy(F.desc("n"), F.desc("d")).first()
    if best is None:
        return 0, np.zeros(0, np.int64)
    return best["n"], np.array([r["s"] for r in sums.where(F.col("d") == best["d"]).orderBy("i").select("s").collect()], np.int64)


def _products(rows: DataFrame, d: int, width: int, of) -> np.ndarray:
    """Sum over the vectors of the outer products of ``of(x)`` (width numbers each)."""
    def run(batches):
        total = np.zeros((width, width))
        for b in batches:
            for _, x in _finite(b):
                if x.shape[1] == d:
                    for i in range(0, len(x), 4096):
                        y = of(x[i:i + 4096])
                        total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(width), width).astype(np.int32)), pa.array(np.tile(np.arange(width), width).astype(np.int32)), pa.array(total.ravel())], ["i", "j", "v"])
    out = np.zeros((width, width))
    got = rows.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out[got.column("i").to_numpy(), got.column("j").to_numpy()] = got.column("v").to_numpy()
    return (out + out.T) / 2


class Centre:
    """The exact mean S / n as an integer part and a remainder."""

    def __init__(self, n: int, s: np.ndarray):
        self.n, self.s = n, s
        self.whole = s // n
        self.rest = (s - self.whole * n) / n

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S) squared, exact; None beyond a long."""
        far = np.abs(x - self.whole).max(initial=0) + 1
        if float(self.n) ** 2 * float(far) ** 2 * x.shape[1] < 2.0 ** 62:
            return ((self.n * (x - self.whole) - (self.s - self.whole * self.n)) ** 2).sum(1).tolist()
        gap = (x - self.whole).astype(object) * self.n - (self.s - self.whole * self.n).astype(object)
        return [v if v < 1 << 63 else None for v in (gap * gap).sum(1)]


def whitened(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = rows.sparkSession
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    vectors = rows.select("embedding")
    n, s = totals(vectors)
    if not n:
        return spark.createDataFrame([], schema)
    centre, d = Centre(n, s), len(s)
    cov = _products(vectors, d, d, centre.centred) / n
    values, axes = eigen(cov, components)
    real = values > d * _EPS * max(values[0], 0)
    values, axes = values[real], axes[:, real]
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast((axes / np.sqrt(values), centre))     # d x 32 numbers

    def project(x):
        matrix, middle = shared.value
        return middle.centred(x) @ matrix
    error = float(np.abs(_products(vectors, d, k, project) / n - np.eye(k)).max())
    explained = values / np.trace(cov)

    def run(batches):
        for b in batches:
            for at, x in _finite(b):
                if x.shape[1] != d:
                    continue
                ids = b.column("vec_id").take(pa.array(at))
                for i in range(0, len(x), 512):
                    part = x[i:i + 512]
                    m = len(part)
                    yield pa.RecordBatch.from_arrays([ids.slice(i, m).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1), m).astype(np.int32)), pa.array(np.full(m * k, n)),
                                                      pa.array([v for v in shared.value[1].deviation(part) for _ in range(k)], pa.int64()), pa.array(project(part).ravel()),
                                                      pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], [c.split()[0] for c in schema.split(", ")])
    return rows.mapInArrow(run, schema)
