import math

import numpy as np
import pytest

from shelfwise.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, label int, n long"


@pytest.mark.parametrize("seed,n", [(0, 2), (1, 3), (2, 17), (3, 64)])
def test_eigen_of_random_matrices(seed, n):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((200, n)) * np.linspace(1, 3, n)
    cov = np.cov(x.T, bias=True)
    values, vectors = wh.eigen(cov, 32)
    want = np.linalg.eigvalsh(cov)[::-1][:len(values)]
    assert len(values) == min(32, n)
    assert np.allclose(values, want, rtol=1e-12)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(cov @ vectors - vectors * values).max() < 1e-12 * want[0]


def test_clusters_and_equal_eigenvalues():
    q, _ = np.linalg.qr(np.random.default_rng(5).standard_normal((12, 12)))
    spectrum = np.array([5, 5, 5, 4, 4 - 1e-9, 4 - 2e-9, 1, 1, 1, 1e-3, 0, 0], float)
    for cov in (q @ np.diag(spectrum) @ q.T, np.diag(spectrum), np.eye(12), np.zeros((12, 12))):
        cov = (cov + cov.T) / 2
        values, vectors = wh.eigen(cov, 9)
        assert np.allclose(values, np.linalg.eigvalsh(cov)[::-1][:9], atol=1e-12)
        assert np.abs(vectors.T @ vectors - np.eye(9)).max() < 1e-10
        assert np.abs(cov @ vectors - vectors * values).max() < 1e-10


def test_sturm_counts():
    diag, off = np.array([2.0, 1.0, 3.0, -1.0]), np.array([1.0, 0.0, 2.0])
    t = np.diag(diag) + np.diag(off, 1) + np.diag(off, -1)
    have = np.linalg.eigvalsh(t)
    at = np.linspace(-5, 6, 41)
    assert wh.sturm_count(diag, off, at).tolist() == [(have < x).sum() for x in at]


def _brute(vectors, k=32):
    x = np.array([[math.floor(64 * c) + 1000000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(0)
    dev = [int(sum((n * a - b) ** 2 for a, b in zip(r, s))) for r in x]
    y = (x * n - s).astype(float) / n
    values, vecs = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[:k]
    order = [i for i in order if values[i] > 1e-9]
    return n, dev, y @ vecs[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def test_against_brute_force_with_rows_left_out(spark):
    rng = np.random.default_rng(3)
    good = [[float(np.float32(c)) for c in v] for v in rng.normal(0, 0.3, (60, 7)) * np.linspace(0.5, 2, 7)]
    good[5] = good[4]                                       # equal rows count twice
    rows = [(i if i != 8 else None, v, 1, 0) for i, v in enumerate(good)]
    rows += [(100, None, 1, 0), (101, good[0][:6] + [None], 1, 0), (102, good[0][:6] + [float("nan")], 1, 0), (103, [float("inf")] + good[0][1:], 1, 0),
             (104, [], 1, 0), (105, [1.0, 2.0], 1, 0), (4, good[9], 2, 0)]
    remaining = good + [good[9]]
    n, dev, want, explained = _brute(remaining)
    got = wh.whitened(spark.createDataFrame(rows, SCHEMA).repartition(3)).toPandas()
    assert len(got) == len(remaining) * 7 and set(got.n) == {n}
    assert not set(got.vec_id.dropna()) & set(range(100, 106))
    assert (got.identity_error < 1e-9).all() and got.identity_error.nunique() == 1
    sign = {}
    for i in (0, 4, 8, 33):
        of = got[got.vec_id.isna()] if i == 8 else got[got.vec_id == i]
        for c in range(1, 8):
            part = of[of.component == c]
            if i == 4:
                continue
            assert len(part) == 1 and part.deviation.iloc[0] == dev[i]
            w = want[i, c - 1]
            s = sign.setdefault(c, np.sign(part.whitened.iloc[0] * w))
            assert abs(part.whitened.iloc[0] * s - w) < 1e-8
            assert abs(part.explained.iloc[0] - explained[c - 1]) < 1e-12
    assert len(got[got.vec_id == 4]) == 14


def test_long_deviations_empty_tables_and_flat_directions(spark):
    assert wh.whitened(spark.createDataFrame([], SCHEMA)).count() == 0
    assert wh.whitened(spark.createDataFrame([(1, None, 0, 0)], SCHEMA)).count() == 0
    assert wh.whitened(spark.createDataFrame([(i, [1.0, 2.0], 0, 0) for i in range(4)], SCHEMA)).count() == 0
    flat = wh.whitened(spark.createDataFrame([(i, [float(i), 3.0], 0, 0) for i in range(4)], SCHEMA)).toPandas()
    assert set(flat.component) == {1} and abs(flat.whitened.pow(2).mean() - 1) < 1e-12 and abs(flat.explained.iloc[0] - 1) < 1e-12
    far = wh.Centre(3, np.array([3 << 40]))
    big = np.array([[(1 << 40) + (1 << 30)], [(1 << 40) + (1 << 29)]])
    assert far.deviation(big) == [None if (3 << 30) ** 2 >= 1 << 63 else (3 << 30) ** 2, (3 << 29) ** 2]


def test_thousand_rows_of_many_components(spark):
    rng = np.random.default_rng(9)
    v = rng.standard_normal((400, 40)).astype(np.float32)
    got = wh.whitened(spark.createDataFrame([(i, [float(c) for c in r], 0, 0) for i, r in enumerate(v)], SCHEMA)).toPandas()
    assert len(got) == 400 * 32 and (got.identity_error < 1e-9).all()
    w = got.sort_values(["vec_id", "component"]).whitened.to_numpy().reshape(400, 32)
    assert np.abs(w.T @ w / 400 - np.eye(32)).max() < 1e-9
