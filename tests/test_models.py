"""Segmentation outliers vs brute force, AUC ties, DML vs numpy, forecasting invariants."""
import numpy as np
from pyspark.sql import functions as F

from shelfwise.operators import churn as ch
from shelfwise.operators import forecast as fc
from shelfwise.operators import pricing as pr
from shelfwise.operators import segments as sg


def _brute_dbscan_noise(X, eps, min_samples):
    d = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    nb = (d <= eps)
    core = nb.sum(1) >= min_samples
    border = (nb & core[None, :]).any(1)
    return ~core & ~border


def test_density_outliers_match_brute_force(spark):
    rng = np.random.default_rng(7)
    X = np.vstack([rng.normal(0, 0.3, (150, 3)), rng.uniform(-4, 4, (40, 3)), np.zeros((30, 3))])
    df = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(X)], "id long, a double, b double, c double")
    got = {r.id: r.is_outlier for r in sg.density_outliers(df, "id", ["a", "b", "c"], eps=0.8, min_samples=5).collect()}
    exp = _brute_dbscan_noise(X, 0.8, 5)
    assert [got[i] for i in range(len(X))] == list(exp)


def test_segment_naming_rules(spark):
    c = spark.createDataFrame([(0.6, 0.6, 0.0), (0.0, 0.4, -0.1), (0.0, 0.0, -0.6), (0.0, -0.1, 0.6),
                               (0.0, 0.0, 1.1), (0.0, 0.0, 0.0)], "mon double, freq double, rec double")
    names = [r.n for r in c.select(sg.name_segment(F.col("rec"), F.col("freq"), F.col("mon")).alias("n")).collect()]
    assert names == ["VIP Champions", "Loyal Customers", "Recent Buyers", "At Risk", "Lost Customers",
                     "Potential Loyalists"]


def test_auc_ties_and_single_class(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1), (0.8, 0), (0.9, 1)], "s double, y int")
    a = ch.auc(df, "s", "y").collect()[0].auc
    # pairs: positives {0.4, 0.8, 0.9} vs negatives {0.1, 0.4, 0.8}: wins 1+0.5+0 + 1+1+0.5 + 1+1+1 = 7
    assert abs(a - 7 / 9) < 1e-12
    one = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert ch.auc(one, "s", "y").collect()[0].auc is None


def test_linear_dml_matches_numpy(spark):
    rng = np.random.default_rng(1)
    n = 400
    w = rng.normal(size=n)
    t = 0.5 * w + rng.normal(size=n)
    y = -1.5 * t + 2.0 * w + rng.normal(scale=0.1, size=n)
    fold = np.arange(n) % 2
    df = spark.createDataFrame([(int(i), float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(y, t, w))],
                               "id long, y double, t double, w double").withColumn("g", F.lit("g"))
    got = pr.linear_dml(df, ["g"], "y", "t", "w", F.col("id"), k=2).collect()[0].theta
    ry, rt = np.empty(n), np.empty(n)
    for f in (0, 1):
        tr, te = fold != f, fold == f
        by, ay = np.polyfit(w[tr], y[tr], 1)
        bt, at = np.polyfit(w[tr], t[tr], 1)
        ry[te] = y[te] - (ay + by * w[te])
        rt[te] = t[te] - (at + bt * w[te])
    assert abs(got - (ry @ rt) / (rt @ rt)) < 1e-9
    assert abs(got + 1.5) < 0.1


def test_seasonal_forecast_recovers_trend_and_weekday(spark):
    import datetime as dt
    d0 = dt.date(2024, 1, 1)
    trend = [("t", d0 + dt.timedelta(days=i), 10.0 + 0.5 * i) for i in range(140)]
    # weekly spike on Thursdays over 21 days starting on a Monday: Thursdays sit at
    # positions 3, 10, 17 (mean 10 = the series mean), so the trend fit sees no slope
    week = [("w", d0 + dt.timedelta(days=i), 5.0 + (3.0 if (d0 + dt.timedelta(days=i)).weekday() == 3 else 0.0))
            for i in range(21)]
    s = spark.createDataFrame(trend + week, "k string, ds date, y double")
    out = fc.forecast(s, ["k"], horizon=14).collect()
    t = sorted((r for r in out if r.k == "t"), key=lambda r: r.ds)
    assert len(t) == 14 and t[0].ds == d0 + dt.timedelta(days=140)
    for r in t:
        assert abs(r.yhat - (10.0 + 0.5 * (r.ds - d0).days)) < 1e-6
        assert abs(r.yhat_upper - r.yhat_lower) < 1e-6          # perfect fit: zero band
    w = [r for r in out if r.k == "w"]
    thu = [r.yhat for r in w if r.ds.weekday() == 3]
    other = [r.yhat for r in w if r.ds.weekday() != 3]
    assert all(abs(x - 8.0) < 1e-6 for x in thu) and all(abs(x - 5.0) < 1e-6 for x in other)


def test_chrono_split_never_random(spark):
    import datetime as dt
    s = spark.createDataFrame([("a", dt.date(2024, 1, i), float(i)) for i in range(1, 11)], "k string, ds date, y double")
    r = fc.chrono_split(s, ["k"]).orderBy("ds").collect()
    assert [x.is_train for x in r] == [True] * 8 + [False] * 2


def test_run_table_summaries(spark):
    import os
    import tempfile
    from shelfwise.operators import runs as rn
    path = os.path.join(tempfile.mkdtemp(prefix="shelfwise-runs-"), "runs")
    for i in range(7):
        rn.record_run(spark, path, "exp_a", params={"i": i}, metrics={"auc": 0.5 + i / 100, "f1": 0.1})
    rn.record_run(spark, path, "exp_b", metrics={"auc": 0.9})
    runs = spark.read.parquet(path)
    summ = {r.experiment: r.runs for r in rn.experiment_summary(runs).collect()}
    assert summ == {"exp_a": 7, "exp_b": 1}
    latest = rn.latest_runs(runs).where("experiment = 'exp_a'").collect()
    assert len(latest) == 5
    assert rn.metrics_long(runs).count() == 7 * 2 + 1


def test_retrain_challenger_records_run(spark):
    import os
    import tempfile
    from shelfwise.operators import runs as rn
    from shelfwise.sources import views as v
    base = tempfile.mkdtemp(prefix="shelfwise-retrain-")
    root = "/root/testdata/sf0.001"
    feats = ch.churn_dataset(v.customers(spark, root), v.baskets(spark, root))
    m = rn.retrain_challenger(feats, os.path.join(base, "models"), os.path.join(base, "runs")).collect()[0]
    assert m.auc is None or 0.0 <= m.auc <= 1.0
    assert os.path.isdir(m.model_path)
    assert spark.read.parquet(os.path.join(base, "runs")).count() == 1


def test_splits_and_folds_are_stratified_to_the_row(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(203)], "customer_id long, churn int")
    n = {(r.churn, r.is_train): r["count"] for r in ch.holdout(df).groupBy("churn", "is_train").count().collect()}
    assert n == {(0, True): 145, (0, False): 37, (1, True): 16, (1, False): 5}
    folds = ch.stratified_folds(df).groupBy("fold", "churn").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in folds if r.churn == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_grouped_auc_matches_single(spark):
    rows = [(g, float((7 * i + g) % 5), int((i + g) % 3 == 0)) for g in range(3) for i in range(20)]
    df = spark.createDataFrame(rows, "g int, s double, y int")
    got = {r.g: r.auc for r in ch.auc_by(df, "s", "y", ["g"]).collect()}
    for g, a in got.items():
        assert abs(a - ch.auc(df.where(F.col("g") == g), "s", "y").first().auc) < 1e-12


def test_series_need_keys(spark):
    import pytest
    s = spark.createDataFrame([(1.0,)], "y double").withColumn("ds", F.current_date())
    for call in (lambda: fc.forecast(s, []), lambda: fc.lag_windows(s, []), lambda: fc.chrono_split(s, []), lambda: fc.time_index(s, []), lambda: fc.minmax_scaled("y", [])):
        with pytest.raises(ValueError):
            call()


def test_small_categories_stay_without_estimate(spark):
    rows = [("big", i, 1.0 + i % 7, 2.0 + i % 3) for i in range(40)] + [("small", i, 1.0, 2.0) for i in range(3)]
    lines = spark.createDataFrame([(c, i, i, x, y, x, 1.0, 0.1 * (i % 4)) for c, i, x, y in rows],
                                  "category string, transaction_id long, sku_id long, log_price double, log_demand double, unit_price double, quantity double, discount double")
    r = {x.category: x for x in pr.elasticity_report(lines).collect()}
    assert r["small"].n == 3 and r["small"].ols is None and r["small"].elasticity is None and r["small"].label is None
    assert r["big"].n == 40 and r["big"].ols is not None


def test_halving_rungs_triple_and_end_without_limit():
    assert ch.halving_rungs(15, 300) == [(15, 20), (5, 60), (1, 300)]
    assert ch.halving_rungs(27, 300) == [(27, 20), (9, 60), (3, 180), (1, 300)]
    assert ch.halving_rungs(4, 10) == [(4, 10)]


def test_search_by_halving_is_no_worse_than_full_fits(spark, monkeypatch):
    import random
    rnd = random.Random(5)
    rows = []
    for i in range(900):
        x = [rnd.random() for _ in range(4)]
        rows.append((i, *x, int((x[0] > 0.6) ^ (x[1] < 0.3) if rnd.random() < 0.85 else rnd.random() < 0.5)))
    df = ch.holdout(spark.createDataFrame(rows, "customer_id long, age double, recency double, frequency double, monetary double, churn int"))
    points = [dict(p, maxIter=25 + 5 * i, maxDepth=min(p["maxDepth"], 5)) for i, p in enumerate(ch.search_space(6))]
    monkeypatch.setattr(ch, "search_space", lambda trials, seed=0: points)
    monkeypatch.setattr(ch, "HALVING_TREES", 5)
    monkeypatch.setattr(ch.halving_rungs, "__kwdefaults__", {"first": 5, "factor": 3})
    train, test = df.where("is_train"), df.where(~F.col("is_train"))
    got = ch.tune_churn(train, test, trials=6).orderBy("rank").collect()
    assert [r["rank"] for r in got] == [1, 2, 3, 4, 5, 6] and got[0].rung == 3 and sum(r.rung > 1 for r in got) == 2
    assert all(r.fitted_trees <= r.trees for r in got) and all(r.fitted_trees <= 5 for r in got if r.rung == 1)
    full = []
    for p in points:
        scored = ch.score_churn(ch.train_churn(train, params={k: v for k, v in p.items()}), test)
        full.append(ch.auc_of(scored, {"a": "churn_probability"}, "churn").first().a)
    assert got[0].auc >= max(full) - 0.02


def test_tree_importance_equals_the_models_own(spark):
    import random
    rnd = random.Random(1)
    rows = [(i, *(x := [rnd.random() for _ in range(4)]), int(x[2] + 0.3 * x[0] + 0.2 * rnd.random() > 0.8)) for i in range(400)]
    df = spark.createDataFrame(rows, "customer_id long, age double, recency double, frequency double, monetary double, churn int")
    model = ch.train_churn(df, params=dict(maxIter=6, maxDepth=4, stepSize=0.1))
    got = {r.feature: r.importance for r in ch.tree_importance(model).collect()}
    want = model.featureImportances.toArray()
    assert abs(sum(got.values()) - 1) < 1e-9
    for name, w in zip(ch.FEATURES, want):
        assert abs(got.get(name, 0.0) - w) < 1e-9
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    forest = RandomForestClassifier(labelCol="churn", numTrees=5, maxDepth=4, seed=2).fit(VectorAssembler(inputCols=list(ch.FEATURES), outputCol="features").transform(df))
    got = {r.feature: r.importance for r in ch.tree_importance(forest, per_tree=True).collect()}
    assert all(abs(got.get(n, 0.0) - w) < 1e-9 for n, w in zip(ch.FEATURES, forest.featureImportances.toArray()))


def test_nonlinear_dml_fits_cells_as_it_would_lines(spark, monkeypatch):
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    rng = np.random.default_rng(3)
    rows = [("ab"[i % 3 % 2], i, i // 7, float(t := rng.normal()), float(-0.5 * t - (i % 3 % 2) * t + rng.normal(0, 0.1)), i % 4 / 10) for i in range(600)]
    lines = spark.createDataFrame(rows, "category string, transaction_id long, sku_id long, log_price double, log_demand double, discount double")
    seen = []
    fit = GBTRegressor._fit
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, data: (seen.append(data.count()), fit(self, data))[1])
    got = {r.category: (r.nonlinear_dml, r.n) for r in pr.nonlinear_dml(lines, max_iter=4, final_iter=3).collect()}
    assert len(seen) == 5 and max(seen) <= 16           # 2 categories, 4 discounts, 2 folds
    monkeypatch.undo()
    d = lines.withColumn("_f", F.pmod(pr.line_fold(lines), F.lit(2)))
    d = StringIndexer(inputCol="category", outputCol="_cat").fit(d).transform(d)
    d = VectorAssembler(inputCols=["discount", "_cat"], outputCol="x").transform(d)
    trees = lambda label, out, n, depth: GBTRegressor(featuresCol="x", labelCol=label, predictionCol=out, maxIter=n, maxDepth=depth, seed=42)
    parts = [trees("log_price", "pt", 4, 3).fit(d.where(F.col("_f") != f)).transform(
        trees("log_demand", "py", 4, 3).fit(d.where(F.col("_f") != f)).transform(d.where(F.col("_f") == f))) for f in (0, 1)]
    res = parts[0].unionByName(parts[1]).withColumn("rt", F.expr("log_price - pt")).withColumn("ratio", F.expr("(log_demand - py) / rt")).withColumn("w", F.expr("rt * rt"))
    want = trees("ratio", "effect", 3, 2).setWeightCol("w").fit(res).transform(res).groupBy("category").agg(F.avg("effect").alias("e"), F.count(F.lit(1)).alias("n"))
    for r in want.collect():
        assert got[r.category][1] == r.n and abs(got[r.category][0] - r.e) < 1e-9


def test_churn_rows_come_from_one_aggregate_by_customer(spark, capsys):
    import datetime as dt
    from decimal import Decimal
    day = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    baskets = spark.createDataFrame([(1, day(0), 2, Decimal("3.00")), (1, day(110), 1, Decimal("2.00")), (2, day(10), 1, Decimal("1.00")), (2, day(11), None, None),
                                     (3, day(200), 5, Decimal("9.00")), (None, day(111), 1, Decimal("1.00")), (4, None, 1, Decimal("1.00"))],
                                    "customer_id long, timestamp timestamp_ntz, n_lines int, amount_sum decimal(15,2)")
    customers = spark.createDataFrame([(i, 30) for i in (1, 2, 3, 4, 5, None)], "customer_id long, age int")
    d = ch.churn_dataset(customers, baskets)                # cutoff: day 110
    d.explain()
    assert capsys.readouterr().out.count("HashAggregate(keys=[customer_id") == 2      # partial and final
    got = {r.customer_id: (r.recency, r.frequency, r.monetary, r.churn) for r in d.collect()}
    assert got == {1: (0.0, 3.0, 5.0, 1), 2: (99.0, 1.0, 1.0, 1), 3: (0.0, 0.0, 0.0, 0), 4: (0.0, 0.0, 0.0, 1), 5: (0.0, 0.0, 0.0, 1), None: (0.0, 0.0, 0.0, 1)}
