"""Least squares per group against NumPy."""
import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from shelfwise.operators import forecast as fc
from shelfwise.operators import linear as ln
from shelfwise.operators import pricing as pr


def _table(spark, n=400, seed=2):
    rng = np.random.default_rng(seed)
    a, b, g = rng.normal(size=n), rng.normal(2, 3, n), rng.integers(0, 3, n)
    t = 0.5 * a - 0.2 * b + rng.normal(size=n)
    y = -1.3 * t + 2 * a + 0.7 * b + rng.normal(size=n)
    return spark.createDataFrame([(int(g[i]), i, float(y[i]), float(t[i]), float(a[i]), float(b[i])) for i in range(n)], "g int, i long, y double, t double, a double, b double"), (g, y, t, a, b)


def test_coefficients_and_residuals_equal_lstsq(spark):
    df, (g, y, t, a, b) = _table(spark)
    xs = [F.lit(1.0), F.col("t"), F.col("a"), F.col("b")]
    for r in ln.solve(ln.gram(df, ["g"], xs, F.col("y")), 4).collect():
        m = g == r.g
        x = np.stack([np.ones(m.sum()), t[m], a[m], b[m]], axis=1)
        beta, rss, _, _ = np.linalg.lstsq(x, y[m], rcond=None)
        assert np.allclose(r.beta, beta, atol=1e-9) and abs(r.rss - rss[0]) < 1e-8 and r.n == m.sum()


def test_determined_regressors_get_zero(spark):
    df, (g, y, t, a, b) = _table(spark)
    xs = [F.lit(1.0), F.col("a"), F.lit(3.0), F.col("a") * 2 + 1, F.lit(0.0), F.col("b")]
    r = ln.solve(ln.gram(df, [], xs, F.col("y")), 6).first()
    beta = np.linalg.lstsq(np.stack([np.ones(len(a)), a, b], axis=1), y, rcond=None)[0]
    assert r.beta[2] == r.beta[3] == r.beta[4] == 0.0 and np.allclose([r.beta[0], r.beta[1], r.beta[5]], beta, atol=1e-8)


def _brute(y, t, w, fold, k):
    num = den = 0.0
    x = np.column_stack([np.ones(len(y)), *w])
    for f in range(k):
        inside, out = fold == f, fold != f
        fit = lambda v: np.linalg.lstsq(x[out], v[out], rcond=None)[0]  # noqa: E731,B023
        ry, rt = y[inside] - x[inside] @ fit(y), t[inside] - x[inside] @ fit(t)
        num, den = num + ry @ rt, den + rt @ rt
    return num / den


def test_two_controls_equal_brute_force_and_one_gives_todays_rows(spark):
    df, (g, y, t, a, b) = _table(spark)
    fold = np.arange(400) % 3
    for r in ln.cross_fitted(df, ["g"], "y", "t", ["a", "b"], F.col("i"), 3).collect():
        m = g == r.g
        assert abs(r.theta - _brute(y[m], t[m], [a[m], b[m]], fold[m], 3)) < 1e-9 and r.n == m.sum()
        assert abs(r.theta + 1.3) < 0.3
    one = {r.g: r.theta for r in ln.cross_fitted(df, ["g"], "y", "t", ["a"], F.col("i"), 3).collect()}
    today = {r.g: r.theta for r in pr.linear_dml(df, ["g"], "y", "t", "a", F.col("i"), k=3).collect()}
    assert one.keys() == today.keys() and all(abs(one[k] - today[k]) < 1e-9 for k in one)
    same = ln.cross_fitted(df.withColumn("c", F.lit(4.0)), ["g"], "y", "t", ["a", "c"], F.col("i"), 3).collect()
    assert all(abs(r.theta - one[r.g]) < 1e-9 for r in same)        # a constant control changes nothing


def test_joint_seasonal_fit_equals_lstsq_per_series(spark):
    rng, rows, want = np.random.default_rng(4), [], {}
    first = dt.date(2022, 2, 3)
    for key, days in (("long", 800), ("short", 20), ("one", 1)):
        ds = [first + dt.timedelta(days=i) for i in range(days) if key != "short" or (first + dt.timedelta(days=i)).weekday() != 2]
        epoch = np.array([(d - dt.date(1970, 1, 1)).days for d in ds], float)
        t = (epoch - epoch[0]) / 365.25
        y = 20 + 5 * t + np.array([d.weekday() == 5 for d in ds]) * 4 + 3 * np.sin(2 * np.pi * epoch / 365.25) + rng.normal(0, .5, len(ds))
        rows += [(key, d, float(v)) for d, v in zip(ds, y)]
        x = np.column_stack([np.ones(len(ds)), t, *[[d.weekday() == w for d in ds] for w in range(1, 7)],
                             *[f(2 * np.pi * h * epoch / 365.25) for h in (1, 2) for f in (np.sin, np.cos)]]).astype(float)
        want[key] = (x, y, np.linalg.lstsq(x, y, rcond=None)[0])
    model = fc.fit_seasonal_regression(spark.createDataFrame(rows, "k string, ds date, y double"), ["k"])
    got = {r.k: r for r in model.collect()}
    x, y, beta = want["long"]
    assert np.allclose(got["long"].beta, beta, atol=1e-6)
    assert abs(got["long"].sigma - np.sqrt(((y - x @ beta) ** 2).sum() / (len(y) - 12))) < 1e-6
    assert got["short"].beta[3] == 0.0                              # no Wednesdays: nothing to say of them
    x, y, beta = want["short"]
    assert np.std(y - x @ np.array(got["short"].beta)) < 1.0        # waves that 20 days can't tell from a trend are dropped
    ahead = fc.predict_seasonal_regression(model, ["k"], horizon=7).where("k = 'short'").collect()
    assert all(abs(r.yhat - y.mean()) < 60 for r in ahead)
    assert got["one"].beta[0] == want["one"][1][0] and got["one"].sigma == 0.0
    out = fc.predict_seasonal_regression(model, ["k"], horizon=3).where("k = 'long'").orderBy("ds").collect()
    assert [r.ds for r in out] == [rows[799][1] + dt.timedelta(days=i) for i in (1, 2, 3)] and out[0].yhat_lower < out[0].yhat < out[0].yhat_upper
