"""Price and revenue operators.

Elasticities are closed-form regressions over sufficient statistics, so one
aggregation per stage replaces the reference's per-category model loops:

* OLS log-log elasticity: ``regr_slope`` / ``regr_intercept`` / ``regr_r2``.
* Linear double ML, cross-fitted over k folds: per (group, fold) sums of
  w, y, t and their products; the out-of-fold nuisance regressions y~w and t~w
  are the group totals minus the fold's own sums, and the residual-on-residual
  slope sum(ry*rt) / sum(rt^2) is closed form in the fold's own sums, so lines
  are read once and never meet a coefficient.  Folds come from a deterministic
  expression.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import log_eps

# Fixed values of the reference's pricing logic.
DEMAND_CLIP = 0.1         # quantity clipped below at 0.1 before the log
LOG_EPS = 1e-5            # ln(x + 1e-5)
MIN_ROWS = 30             # no estimate for a category with fewer rows
MIN_PERIODS = 20          # no cross elasticity with fewer aligned periods
PROMO_LIFT = 1.25         # promotion multiplies demand by 1.25
DEFAULT_ELASTICITY = -0.5
DEFAULT_DEMAND = 100.0    # SKU without sales
SENSITIVITY = (-30, 30, 5)  # price change sweep in percent
FOLDS = 2
NUISANCE_TREES, NUISANCE_DEPTH = 80, 3
FINAL_TREES, FINAL_DEPTH = 40, 2


def unit_price(total="total_amount", qty="quantity") -> Column:
    """B2: realised unit price, NULL for zero quantity."""
    return (F.col(total) / F.nullif(F.col(qty), F.lit(0))).cast("double")


def priced_lines(txns: DataFrame, products: DataFrame) -> DataFrame:
    """Transactions joined to their category with unit price and logs."""
    t = txns.join(products.select("sku_id", "category"), "sku_id", "inner")
    return t.select(
        "transaction_id", "sku_id", "category", "timestamp", "quantity",
        F.col("discount_applied").cast("double").alias("discount"),
        unit_price().alias("unit_price"),
    ).withColumn("log_price", log_eps("unit_price", LOG_EPS)) \
     .withColumn("log_demand", log_eps(F.greatest(F.col("quantity").cast("double"), F.lit(DEMAND_CLIP)), LOG_EPS))


def ols_elasticity(lines: DataFrame, *, min_rows: int = MIN_ROWS) -> DataFrame:
    """J1 + B11: per category slope of log demand on log price, with R^2; NULL
    estimates below ``min_rows`` lines, whose number stays in ``n``."""
    enough = F.count(F.lit(1)) >= min_rows
    return lines.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"),
        F.when(enough, F.regr_slope("log_demand", "log_price")).alias("ols"),
        F.when(enough, F.regr_intercept("log_demand", "log_price")).alias("intercept"),
        F.when(enough, F.regr_r2("log_demand", "log_price")).alias("r_squared"),
        F.avg("unit_price").alias("avg_price"),
        F.avg("quantity").alias("avg_demand"))


def _slope(n, sw, sv, sww, swv):
    den = n * sww - sw * sw
    return F.when(den != 0, (n * swv - sw * sv) / den).otherwise(F.lit(0.0))


def linear_dml(df: DataFrame, keys: list[str], y: str, t: str, w: str, fold: Column, *,
               k: int = FOLDS) -> DataFrame:
    """Cross-fitted linear DML effect of ``t`` on ``y`` controlling for ``w``
    per group ``keys`` -> keys + theta, n.  Nuisance models are linear in w.
    Sums per (group, fold) are additive, so partial aggregation bounds the
    shuffle by groups x folds whatever the skew of a group."""
    base = df.select(*keys, F.col(y).alias("_y"), F.col(t).alias("_t"), F.col(w).alias("_w"),
                     F.pmod(fold, F.lit(k)).alias("_f"))
    n, sw, sy, st = F.count(F.lit(1)).cast("double"), F.sum("_w"), F.sum("_y"), F.sum("_t")
    prod = lambda a, b: F.sum(F.col(a) * F.col(b))
    sums = {"n": n, "w": sw, "y": sy, "t": st, "ww": prod("_w", "_w"), "wy": prod("_w", "_y"), "wt": prod("_w", "_t"),
            "yt": prod("_y", "_t"), "tt": prod("_t", "_t")}
    per_fold = base.groupBy(*keys, "_f").agg(*[x.alias(f"s_{k_}") for k_, x in sums.items()])
    # a group has k rows: its totals are a window over them
    group = Window.partitionBy(*keys)
    o = {x: F.sum(f"s_{x}").over(group) - F.col(f"s_{x}") for x in ("n", "w", "y", "t", "ww", "wy", "wt")}
    oof = per_fold.select("*", *[x.alias(f"o_{k_}") for k_, x in o.items()])
    c = {x: F.col(f"o_{x}") for x in o}
    by, bt = _slope(c["n"], c["w"], c["y"], c["ww"], c["wy"]), _slope(c["n"], c["w"], c["t"], c["ww"], c["wt"])
    coef = oof.select("*", by.alias("by"), bt.alias("bt")).select(
        "*", ((c["y"] - F.col("by") * c["w"]) / F.nullif(c["n"], F.lit(0.0))).alias("ay"),
        ((c["t"] - F.col("bt") * c["w"]) / F.nullif(c["n"], F.lit(0.0))).alias("at"))
    s = {x: F.col(f"s_{x}") for x in sums}
    ay, by, at, bt = (F.col(x) for x in ("ay", "by", "at", "bt"))
    # sums over the fold of (y - ay - by w)(t - at - bt w) and (t - at - bt w)^2
    ryt = (s["yt"] - at * s["y"] - bt * s["wy"] - ay * s["t"] + ay * at * s["n"] + ay * bt * s["w"]
           - by * s["wt"] + by * at * s["w"] + by * bt * s["ww"])
    rtt = s["tt"] - 2 * at * s["t"] - 2 * bt * s["wt"] + at * at * s["n"] + 2 * at * bt * s["w"] + bt * bt * s["ww"]
    return coef.groupBy(*keys).agg((F.sum(ryt) / F.nullif(F.sum(rtt), F.lit(0.0))).alias("theta"),
                                   F.sum("s_n").cast("long").alias("n"))


def line_fold(lines: DataFrame) -> Column:
    """Deterministic fold of a line: arithmetic over its ids (engine independent)."""
    return F.col("transaction_id") * F.lit(7) + F.col("sku_id") * F.lit(13)


def elasticity_label(e) -> Column:
    """|e| > 1 elastic, else inelastic."""
    c = F.col(e) if isinstance(e, str) else e
    return F.when(F.abs(c) > 1, "elastic").when(c.isNotNull(), "inelastic")


def elasticity_report(lines: DataFrame, *, min_rows: int = MIN_ROWS, k: int = FOLDS,
                      category: str | None = None, nonlinear: DataFrame | None = None) -> DataFrame:
    """Per category OLS, linear DML (confounder: the observed discount),
    nonlinear DML (NULL unless ``nonlinear``, a :func:`nonlinear_dml` result, is
    given), the best of them as ``elasticity``, R^2, average price and demand,
    label.  Estimates are NULL below ``min_rows`` lines.  Optional
    single-category filter (B9)."""
    if category is not None:
        lines = lines.where(F.col("category") == category)
    ols = ols_elasticity(lines, min_rows=min_rows)
    dml = linear_dml(lines, ["category"], "log_demand", "log_price", "discount", line_fold(lines), k=k) \
        .select("category", F.when(F.col("n") >= min_rows, F.col("theta")).alias("linear_dml"))
    r = ols.join(dml, "category", "left")
    r = (r.withColumn("nonlinear_dml", F.lit(None).cast("double")) if nonlinear is None
         else r.join(nonlinear.select("category", "nonlinear_dml"), "category", "left"))
    best = F.coalesce("nonlinear_dml", "linear_dml", "ols")
    return r.select("category", "n", "ols", "linear_dml", "nonlinear_dml", best.alias("elasticity"),
                    "r_squared", "avg_price", "avg_demand", elasticity_label(best).alias("label"))


def elasticity_kpis(report: DataFrame) -> DataFrame:
    """Mean elasticity, number of elastic categories, mean R^2."""
    return report.agg(F.avg("elasticity").alias("mean_elasticity"),
                      F.count_if(F.col("label") == "elastic").alias("elastic_count"),
                      F.avg("r_squared").alias("mean_r_squared"))


def category_periods(lines: DataFrame, *, grain: str | None = None) -> DataFrame:
    """Per (category, period) total quantity and mean unit price.  The
    period is the raw timestamp (reference) or ``date_trunc(grain, ts)``.  The
    mean is an exact DECIMAL sum divided once, so it doesn't depend on the order
    of the lines."""
    p = F.col("timestamp") if grain is None else F.date_trunc(grain, "timestamp")
    return lines.groupBy("category", p.alias("period")).agg(
        F.sum("quantity").alias("qty"),
        F.round(F.sum(F.col("unit_price").cast("decimal(24,10)")) / F.count("unit_price"), 6).cast("double").alias("price"))


def cross_elasticity(lines: DataFrame, *, grain: str | None = None, min_periods: int = MIN_PERIODS,
                     k: int = FOLDS) -> DataFrame:
    """J4/J5 + C5/C6 + B16: effect of the competitor category's log price on the
    focal category's log quantity, controlling for the focal log price, for all
    ordered category pairs; NULL below ``min_periods`` aligned periods, whose
    number stays in ``n_periods``.

    The pair rows come from one equi-join of the (category, period) aggregate
    with itself on the period: a period holds at most one row per category,
    so the join emits categories^2 rows per period -- the pair matrix is the
    result itself, bounded by the category dimension, not by transactions."""
    cp = category_periods(lines, grain=grain)
    f = cp.select(F.col("category").alias("focal"), "period",
                  log_eps("qty", LOG_EPS).alias("log_q"), log_eps("price", LOG_EPS).alias("log_fp"))
    c = cp.select(F.col("category").alias("competitor"), "period", log_eps("price", LOG_EPS).alias("log_cp"))
    pairs = f.join(c, "period").where(F.col("focal") != F.col("competitor"))
    fold = F.datediff(F.to_date("period"), F.lit("1970-01-01").cast("date"))
    d = linear_dml(pairs, ["focal", "competitor"], "log_q", "log_cp", "log_fp", fold, k=k)
    e = F.when(F.col("n") >= min_periods, F.coalesce("theta", F.lit(0.0)))
    return d.select("focal", "competitor", F.col("n").alias("n_periods"), e.alias("elasticity"),
                    cross_label(e).alias("label"))


def cross_label(e) -> Column:
    """> 0 substitute, < 0 complement, = 0 independent, NULL without an estimate."""
    return F.when(e > 0, "Substitute").when(e < 0, "Complement").when(e == 0, "Independent")


def cross_matrix(cross: DataFrame, categories: list[str]) -> DataFrame:
    """Focal x competitor matrix with a zero diagonal (explicit pivot values);
    pairs without an estimate are NULL."""
    m = cross.groupBy("focal").pivot("competitor", categories).agg(F.first("elasticity"))
    return m.select("focal", *[F.when(F.col("focal") == c, F.lit(0.0)).otherwise(F.col(f"`{c}`")).alias(c) for c in categories])


def simulate(products: DataFrame, txns: DataFrame, elasticity: DataFrame, *,
             pcts=(-10, 10), promo=(False, True)) -> DataFrame:
    """Every SKU x scenario.  new_price = p (1 + pct/100); demand scales by
    (new/p)^e and 1.25 under promotion; revenue and percentage changes.
    Scenarios are a literal array exploded per SKU row (no join)."""
    demand = txns.groupBy("sku_id").agg(F.sum("quantity").cast("double").alias("_d"))
    e = elasticity.select("category", F.col("elasticity").alias("_e"))
    base = (products.select("sku_id", "category", F.col("base_price").alias("current_price_dec"))
            .join(demand, "sku_id", "left").join(e, "category", "left"))
    scen = F.array(*[F.struct(F.lit(int(p)).alias("pct"), F.lit(bool(b)).alias("promo"))
                     for p in pcts for b in promo])
    s = base.select("*", F.explode(scen).alias("_s")).select(
        "*", F.col("_s.pct").alias("price_change_pct"), F.col("_s.promo").alias("promotion_flag"))
    return _project(s)


def _project(s: DataFrame) -> DataFrame:
    """Scenario arithmetic.  Prices stay DECIMAL (exact half-up cents); demand
    and revenue projections are irrational doubles rounded half-even."""
    p_dec = F.col("current_price_dec")
    p = p_dec.cast("double")
    d = F.coalesce(F.col("_d"), F.lit(DEFAULT_DEMAND))
    e = F.coalesce(F.col("_e"), F.lit(DEFAULT_ELASTICITY))
    ratio = F.lit(1.0) + F.col("price_change_pct") / 100
    lift = F.when(F.col("promotion_flag"), F.lit(PROMO_LIFT)).otherwise(F.lit(1.0))
    proj_d = d * F.pow(ratio, e) * lift
    cur_rev = d * p
    proj_rev = proj_d * p * ratio
    new_dec = F.round(p_dec * (F.lit(100) + F.col("price_change_pct").cast("int")) / F.lit(100), 2)
    return s.select(
        "sku_id", "price_change_pct", "promotion_flag",
        p_dec.alias("current_price"), new_dec.alias("new_price"),
        F.bround(d, 0).alias("current_demand"), F.bround(proj_d, 0).alias("projected_demand"),
        F.bround((proj_d / d - 1) * 100, 2).alias("demand_change_pct"),
        F.bround(cur_rev, 2).alias("current_revenue"), F.bround(proj_rev, 2).alias("projected_revenue"),
        F.bround((proj_rev / cur_rev - 1) * 100, 2).alias("revenue_change_pct"),
        F.bround((lift - 1) * 100, 1).alias("promotion_lift"))


def sensitivity(products: DataFrame, txns: DataFrame, elasticity: DataFrame, *,
                sweep=SENSITIVITY) -> DataFrame:
    """Projected revenue and demand for pct in -30..30 step 5, no promotion."""
    lo, hi, step = sweep
    return simulate(products, txns, elasticity, pcts=range(lo, hi + 1, step), promo=(False,)) \
        .select("sku_id", "price_change_pct", "projected_revenue", "projected_demand")


def waterfall(sim: DataFrame) -> DataFrame:
    """Price effect = projected / (1 + lift%) - current; promo effect = rest."""
    price = F.col("projected_revenue") / (F.lit(1.0) + F.col("promotion_lift") / 100) - F.col("current_revenue")
    return sim.select("sku_id", "price_change_pct", "promotion_flag", "current_revenue",
                      price.alias("price_effect"),
                      (F.col("projected_revenue") - F.col("current_revenue") - price).alias("promo_effect"),
                      "projected_revenue")


def nonlinear_dml(lines: DataFrame, *, k: int = FOLDS, max_iter: int = NUISANCE_TREES, max_depth: int = NUISANCE_DEPTH,
                  final_iter: int = FINAL_TREES, final_depth: int = FINAL_DEPTH, seed: int = 42) -> DataFrame:
    """Cross-fitted double ML with boosted-tree nuisance models and a
    boosted-tree effect model.  For each fold, GBT regressors of log demand and
    log price on (discount, category index) are fitted on the other folds; the
    final stage regresses ry / rt on the same features with weight rt^2 (the
    residual-on-residual loss) and its mean prediction over a category's lines is
    the category's effect.  One model per fold and stage covers every category
    (category is a feature), so the number of fits doesn't grow with the catalog.

    Lines with the same features and fold are one weighted row: no split divides
    them, so squared loss needs only their number, means, variance and covariance,
    and the trees are those over the lines."""
    from concurrent.futures import ThreadPoolExecutor
    from functools import reduce

    from pyspark.ml.feature import StringIndexerModel, VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    from ..session import checkpoint_dir

    checkpoint_dir(lines.sparkSession)
    n = F.count(F.lit(1))
    # a missing label stays one in its cell, for the fit to refuse
    mean = lambda c: F.when(F.count(c) == n, F.avg(c))
    d = lines.groupBy("category", "discount", F.pmod(line_fold(lines), F.lit(k)).alias("_f")).agg(
        n.alias("_n"), mean("log_demand").alias("_y"), mean("log_price").alias("_t"),
        F.var_pop("log_price").alias("_tt"), F.covar_pop("log_demand", "log_price").alias("_yt")).checkpoint(eager=True)
    # the most frequent category first, as over the lines
    by_lines = d.where("category is not null").groupBy("category").agg(F.sum("_n").alias("_n")).orderBy(F.desc("_n"), "category")
    labels = [r.category for r in by_lines.collect()]
    d = StringIndexerModel.from_labels(labels, inputCol="category", outputCol="_cat").transform(d)
    d = VectorAssembler(inputCols=["discount", "_cat"], outputCol="_x").transform(d)
    trees = lambda label, out, n, depth, weight: GBTRegressor(featuresCol="_x", labelCol=label, predictionCol=out, maxIter=n, maxDepth=depth,
                                                              maxBins=max(32, len(labels)), seed=seed, weightCol=weight)
    # the folds' fits are independent jobs, submitted concurrently
    jobs = [(f, label) for f in range(k) for label in ("_y", "_t")]
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        models = dict(zip(jobs, pool.map(lambda job: trees(job[1], f"_p{job[1]}", max_iter, max_depth, "_n").fit(d.where(F.col("_f") != job[0])), jobs)))
    parts = [models[(f, "_t")].transform(models[(f, "_y")].transform(d.where(F.col("_f") == f))) for f in range(k)]
    res = reduce(DataFrame.unionByName, parts)
    ry, rt = F.col("_y") - F.col("_p_y"), F.col("_t") - F.col("_p_t")
    # a cell's sums of rt^2 and ry * rt; their ratio is its weighted mean of ry / rt
    res = (res.withColumn("_w", F.col("_n") * (F.col("_tt") + rt * rt))
              .withColumn("_ratio", F.col("_n") * (F.col("_yt") + ry * rt) / F.nullif(F.col("_w"), F.lit(0.0))))
    final = trees("_ratio", "_effect", final_iter, final_depth, "_w").fit(res.where("_w > 0"))
    return final.transform(res).groupBy("category").agg((F.sum(F.col("_n") * F.col("_effect")) / F.sum("_n")).alias("nonlinear_dml"),
                                                        F.sum("_n").alias("n"))
