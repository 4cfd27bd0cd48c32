"""Demand forecasting (L1-L9, E5, E6, E9, H8) for every series in one job.

The seasonal forecaster is a closed-form decomposition fitted with
aggregations per series: linear trend (``regr_slope`` / ``regr_intercept`` on
the day number), weekday mean residual, month mean residual where the caller
asks for it (two years of history or more), and a band of +- z * sd(residual).  Future dates come
from ``sequence`` exploded per series -- no driver loop, no per-series model
object.  A learned lag-window regressor (GBT over all series at once) is the
second forecaster.
"""
from __future__ import annotations

import math

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window, functions as F

from .linear import dot, gram, solve

# Fixed values of the reference's forecasting setup.
HORIZON = 30            # platform forecast horizon (days)
Z_BAND = 1.2816         # 80 % interval
LOOKBACK = 28
TRAIN_FRAC = 0.8


def _day(c: str) -> Column:
    return F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("double")


def _named(keys: list[str]) -> list[str]:
    """A series without keys would be one task's; name it by a key column."""
    if not keys:
        raise ValueError("name the key columns of the series")
    return list(keys)


def fit_seasonal(series: DataFrame, keys: list[str], ds: str = "ds", y: str = "y", *, monthly: bool = False) -> DataFrame:
    """Per-series model table: keys, first and last ds, n, a, b, sigma, weekday
    effects (map) and, with ``monthly``, month effects (map).

    One exchange by series (a series holds one row a day): the trend is one
    aggregate, its residuals' sums per (weekday, month) a second, and effects
    and band follow from these at most 84 cells of a series."""
    keys = _named(keys)
    s = series.select(*keys, F.to_date(ds).alias("ds"), F.col(y).cast("double").alias("y")) \
        .withColumn("t", _day("ds")).repartition(*keys)
    trend = s.groupBy(*keys).agg(
        F.regr_slope("y", "t").alias("_b"), F.regr_intercept("y", "t").alias("_a"),
        F.avg("y").alias("_ybar"), F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"),
        F.count(F.lit(1)).alias("n"))
    trend = trend.select(*keys, "first_ds", "last_ds", "n", F.coalesce("_b", F.lit(0.0)).alias("b"),
                         F.when(F.col("_b").isNull(), F.col("_ybar")).otherwise(F.col("_a")).alias("a"))
    r = F.col("y") - (F.col("a") + F.col("b") * F.col("t"))
    cells = (s.join(trend, keys).groupBy(*keys, F.weekday("ds").alias("wd"), F.month("ds").alias("mo"))
              .agg(F.count(F.lit(1)).alias("c"), F.sum(r).alias("s1"), F.sum(r * r).alias("s2")))
    by_wd, by_mo = Window.partitionBy(*keys, "wd"), Window.partitionBy(*keys, "mo")
    cells = cells.withColumn("w_eff", F.sum("s1").over(by_wd) / F.sum("c").over(by_wd))
    month = F.sum(F.col("s1") - F.col("c") * F.col("w_eff")).over(by_mo) / F.sum("c").over(by_mo)
    cells = cells.withColumn("m_eff", month if monthly else F.lit(0.0))
    off = F.col("w_eff") + F.col("m_eff")
    model = cells.groupBy(*keys).agg(
        F.sum("c").alias("_c"), F.sum(F.col("s1") - F.col("c") * off).alias("_r1"),
        F.sum(F.col("s2") - 2 * off * F.col("s1") + F.col("c") * off * off).alias("_r2"),
        F.map_from_entries(F.collect_set(F.struct("wd", "w_eff"))).alias("w_map"),
        F.map_from_entries(F.collect_set(F.struct("mo", "m_eff"))).alias("m_map"))
    spread = (F.col("_r2") - F.col("_r1") * F.col("_r1") / F.col("_c")) / F.nullif(F.col("_c") - 1, F.lit(0))
    sigma = F.coalesce(F.sqrt(F.greatest(spread, F.lit(0.0))), F.lit(0.0))
    return trend.join(model.select(*keys, sigma.alias("sigma"), "w_map", "m_map"), keys)


def predict_seasonal(model: DataFrame, keys: list[str], *, horizon: int = HORIZON, z: float = Z_BAND,
                     start=None) -> DataFrame:
    """H8 + L2: ``horizon`` future days after each series' last date (or
    after ``start``) -> keys, ds, yhat, yhat_lower, yhat_upper."""
    first = F.date_add("last_ds", 1) if start is None else F.lit(start).cast("date")
    fut = model.select("*", F.explode(F.sequence(first, F.date_add(first, horizon - 1))).alias("ds"))
    t = _day("ds")
    yhat = (F.col("a") + F.col("b") * t + F.coalesce(F.element_at("w_map", F.weekday("ds")), F.lit(0.0))
            + F.coalesce(F.element_at("m_map", F.month("ds")), F.lit(0.0)))
    return fut.select(*keys, "ds", yhat.alias("yhat"),
                      (yhat - F.lit(z) * F.col("sigma")).alias("yhat_lower"),
                      (yhat + F.lit(z) * F.col("sigma")).alias("yhat_upper"))


def forecast(series: DataFrame, keys: list[str], *, horizon: int = HORIZON, z: float = Z_BAND,
             ds: str = "ds", y: str = "y", monthly: bool = False) -> DataFrame:
    return predict_seasonal(fit_seasonal(series, keys, ds, y, monthly=monthly), keys, horizon=horizon, z=z)


def horizon_end(fc: DataFrame, keys: list[str]) -> DataFrame:
    """The last forecast row of each series (an aggregation)."""
    return fc.groupBy(*keys).agg(F.max_by(F.struct("ds", "yhat", "yhat_lower", "yhat_upper"), "ds").alias("_r")) \
        .select(*keys, "_r.*")


def time_index(series: DataFrame, keys: list[str], ds: str = "ds") -> Column:
    """Contiguous 0..n-1 per series (window per series = its days)."""
    w = Window.partitionBy(*_named(keys)).orderBy(ds)
    return (F.row_number().over(w) - 1).alias("time_idx")


def minmax_scaled(value: str, keys: list[str]) -> Column:
    """(v - min) / (max - min) per series; constant series -> 0."""
    w = Window.partitionBy(*_named(keys))
    lo, hi = F.min(value).over(w), F.max(value).over(w)
    return F.when(hi > lo, (F.col(value) - lo) / (hi - lo)).otherwise(F.lit(0.0))


def lag_windows(series: DataFrame, keys: list[str], *, lookback: int = LOOKBACK, ds: str = "ds",
                y: str = "y") -> DataFrame:
    """E5: X = previous ``lookback`` values, y = current; rows from index
    ``lookback`` on.  Frames are ``lookback`` rows, bounded."""
    w = Window.partitionBy(*_named(keys)).orderBy(ds)
    x = F.collect_list(y).over(w.rowsBetween(-lookback, -1))
    return series.select(*keys, ds, y, x.alias("x")).where(F.size("x") == lookback)


def chrono_split(series: DataFrame, keys: list[str], *, frac: float = TRAIN_FRAC, ds: str = "ds") -> DataFrame:
    """First ``frac`` of each series (by date) is train, the rest test."""
    w = Window.partitionBy(*_named(keys)).orderBy(ds)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return series.withColumn("is_train", F.row_number().over(w) <= F.floor(n * F.lit(frac)))


def forecast_errors(actual_vs_fc: DataFrame, actual: str = "y", pred: str = "yhat",
                    keys: list[str] = ()) -> DataFrame:
    """MSE, MAE, RMSE, MAPE (%, rows with a non-zero actual)."""
    e = F.col(actual) - F.col(pred)
    g = actual_vs_fc.groupBy(*keys) if keys else actual_vs_fc
    return g.agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
                 F.sqrt(F.avg(e * e)).alias("rmse"),
                 (F.avg(F.abs(e) / F.nullif(F.abs(F.col(actual)), F.lit(0))) * 100).alias("mape"))


def backfill_actuals(stored: DataFrame, actuals: DataFrame, keys: list[str], ds: str = "ds",
                     y: str = "y") -> DataFrame:
    """Stored forecasts left-joined to later actuals with per-row MAPE
    (NULL for a zero or missing actual)."""
    a = actuals.select(*keys, F.to_date(ds).alias("ds"), F.col(y).cast("double").alias("actual"))
    j = stored.join(a, keys + ["ds"], "left")
    return j.withColumn("mape", F.abs(F.col("actual") - F.col("yhat")) / F.nullif(F.col("actual"), F.lit(0.0)) * 100)


def coverage(backfilled: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Share of actuals inside [yhat_lower, yhat_upper]."""
    inside = F.col("actual").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("double")
    g = backfilled.where(F.col("actual").isNotNull())
    g = g.groupBy(*keys) if keys else g
    return g.agg(F.avg(inside).alias("coverage"), F.count(F.lit(1)).alias("n"))


def degradation(current_mape, baseline_mape, tolerance: float = 0.15) -> Column:
    """MAPE more than ``tolerance`` worse than the baseline triggers retraining."""
    return F.col(current_mape) > F.col(baseline_mape) * (1 + tolerance)


def lag_forecaster(series: DataFrame, keys: list[str], *, lookback: int = LOOKBACK, ds: str = "ds",
                   y: str = "y", seed: int = 42, max_iter: int = 20):
    """One GBT regressor over all series: features = the previous
    ``lookback`` values + calendar flags; chronological 80/20 split per series.
    Returns (test predictions, metrics frame)."""
    win = lag_windows(series, keys, lookback=lookback, ds=ds, y=y)
    win = chrono_split(win, keys, ds=ds).withColumn("lags", array_to_vector(
        F.transform("x", lambda v: v.cast("double"))))
    d = F.to_date(ds)
    win = win.withColumn("dow", F.weekday(d).cast("double")).withColumn("mon", F.month(d).cast("double")) \
        .withColumn("label", F.col(y).cast("double"))
    va = VectorAssembler(inputCols=["lags", "dow", "mon"], outputCol="features")
    data = va.transform(win)
    model = GBTRegressor(featuresCol="features", labelCol="label", seed=seed, maxIter=max_iter,
                         maxDepth=5).fit(data.where("is_train"))
    pred = model.transform(data.where(~F.col("is_train"))).select(*keys, ds, "label", F.col("prediction").alias("yhat"))
    rmse = RegressionEvaluator(labelCol="label", predictionCol="yhat", metricName="rmse")
    metrics = forecast_errors(pred, "label", "yhat")
    return pred, metrics, rmse


# ------------------------------------------------ joint seasonal regression --
YEAR_DAYS = 365.25
HARMONICS = 2


def seasonal_design(ds: str, origin: str, harmonics: int = HARMONICS) -> list[Column]:
    """Constant, trend in years since ``origin``, six weekdays against Monday, and the
    yearly sine and cosine pairs of a day."""
    day = F.datediff(F.col(ds), F.lit("1970-01-01").cast("date"))
    angle = lambda h: day * F.lit(2 * math.pi * h / YEAR_DAYS)
    return [F.lit(1.0), F.datediff(F.col(ds), F.col(origin)) / F.lit(YEAR_DAYS),
            *[(F.weekday(ds) == d).cast("double") for d in range(1, 7)],
            *[f(angle(h)) for h in range(1, harmonics + 1) for f in (F.sin, F.cos)]]


def fit_seasonal_regression(series: DataFrame, keys: list[str], ds: str = "ds", y: str = "y", *, harmonics: int = HARMONICS) -> DataFrame:
    """L2 as one regression: trend, weekdays and yearly harmonics fitted together, so
    that none takes what belongs to another.  Per series: first and last ds, n, beta,
    sigma.  One exchange by series; the Gram matrix is one aggregate over it, solved
    in expressions (``linear``)."""
    keys = _named(keys)
    s = series.select(*keys, F.to_date(ds).alias("ds"), F.col(y).cast("double").alias("y"))
    s = s.withColumn("first_ds", F.min("ds").over(Window.partitionBy(*keys)))
    xs = seasonal_design("ds", "first_ds", harmonics)
    sums = gram(s, [*keys, "first_ds"], xs, F.col("y"), [F.max("ds").alias("last_ds")])
    model = solve(sums, len(xs))
    sigma = F.when(F.col("n") > len(xs), F.sqrt(F.col("rss") / (F.col("n") - len(xs)))).otherwise(F.lit(0.0))
    return model.select(*keys, "first_ds", "last_ds", "n", "beta", sigma.alias("sigma"))


def predict_seasonal_regression(model: DataFrame, keys: list[str], *, horizon: int = HORIZON, z: float = Z_BAND, harmonics: int = HARMONICS) -> DataFrame:
    """``horizon`` days after each series' last -> keys, ds, yhat, yhat_lower, yhat_upper."""
    fut = model.select("*", F.explode(F.sequence(F.date_add("last_ds", 1), F.date_add("last_ds", horizon))).alias("ds"))
    fut = fut.withColumn("yhat", dot("beta", seasonal_design("ds", "first_ds", harmonics)))
    return fut.select(*keys, "ds", "yhat", (F.col("yhat") - F.lit(z) * F.col("sigma")).alias("yhat_lower"), (F.col("yhat") + F.lit(z) * F.col("sigma")).alias("yhat_upper"))
