"""Least squares per group from one aggregate (L2, J2, J4): the Gram matrix of any
number of regressors is summed per group, and the normal equations are solved by
Cholesky elimination in column expressions -- no model object, no Python, a row per
group whatever the number of rows.

The first regressor is the constant.  One that the ones before it already determine, but
for a millionth of its variance (a weekday the series doesn't have, a constant control,
the yearly waves of a few days), gets coefficient 0, as an ordered elimination drops it.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

TOLERANCE = 1e-6        # share of a regressor's variance that those before it must leave
ROUNDING = 1e-12        # share of its square sum that is rounding


def _g(i: int, j: int) -> str:
    return f"_g{max(i, j)}_{min(i, j)}"


def gram(df: DataFrame, keys: list[str], xs: list[Column], y: Column, extra: list[Column] = ()) -> DataFrame:
    """keys, n, the sums of products of all regressors with each other and with ``y``,
    the square sum of ``y``, and the ``extra`` aggregates."""
    names = [f"_x{i}" for i in range(len(xs))]
    carried = df.select("*", *[x.cast("double").alias(n) for n, x in zip(names, xs)], y.cast("double").alias("_y"))
    sums = [F.sum(F.col(names[i]) * F.col(names[j])).alias(_g(i, j)) for i in range(len(xs)) for j in range(i + 1)]
    to_y = [F.sum(F.col(n) * F.col("_y")).alias(f"_c{i}") for i, n in enumerate(names)]
    return carried.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums, *to_y, F.sum(F.col("_y") * F.col("_y")).alias("_yy"), *extra)


def eliminated(rows: str, p: int) -> Column:
    """The rows of [G | right-hand sides] (array column ``rows``) after square-root-free
    Cholesky elimination of its p columns, folded over the array: a column whose pivot
    is left with no more than rounding gets a row of zeros, so its coefficient is 0 and
    the others don't see it.  Entry p + q of row i is then coefficient i of side q."""
    def column(m: Column, k: Column) -> Column:
        lead = F.get(m, k)
        pivot = F.get(lead, k)
        square, mean = F.get(F.get(F.col(rows), k), k), F.get(F.get(F.col(rows), F.lit(0)), k)
        varies = F.when(k == 0, square).otherwise(square - mean * mean / F.get(F.get(F.col(rows), F.lit(0)), F.lit(0)))
        own = (pivot > F.lit(TOLERANCE) * varies) & (pivot > F.lit(ROUNDING) * square)
        scaled = F.transform(lead, lambda e: F.when(own, e / pivot).otherwise(F.lit(0.0)))
        return F.transform(m, lambda r, i: F.when(i == k, scaled).otherwise(F.zip_with(r, scaled, lambda e, s: e - F.get(r, k) * s)))
    return F.aggregate(F.sequence(F.lit(0), F.lit(p - 1)), F.col(rows), column)


def _inner(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _side(rows: Column, at: int) -> Column:
    return F.transform(rows, lambda r: F.get(r, F.lit(at)))


def solve(sums: DataFrame, p: int) -> DataFrame:
    """``gram``'s rows with ``beta`` (array of p coefficients) and ``rss`` (residual sum
    of squares) in place of the sums."""
    keep = [c for c in sums.columns if not c.startswith(("_g", "_c", "_yy"))]
    start = F.array(*[F.array(*[F.col(_g(i, j)) for j in range(p)], F.col(f"_c{i}")) for i in range(p)])
    df = sums.select(*keep, "_yy", start.alias("_rows"))
    df = df.withColumn("beta", _side(eliminated("_rows", p), p))
    return df.select(*keep, "beta", F.greatest(F.col("_yy") - _inner(F.col("beta"), _side(F.col("_rows"), p)), F.lit(0.0)).alias("rss"))


def cross_fitted(df: DataFrame, keys: list[str], y: str, t: str, controls: list[str], fold: Column, k: int) -> DataFrame:
    """Effect of ``t`` on ``y`` given any number of controls, per group -> keys, theta, n:
    both are regressed on the controls over the other folds, and theta is the ratio of
    the residuals' sums of products.  One aggregate per (group, fold) -- the Gram matrix
    of constant and controls, their products with y and t -- gives the other folds' sums
    by subtraction and the residual sums by matrix algebra; rows are read once."""
    p = len(controls) + 1
    xs = [F.lit(1.0), *[F.col(c) for c in controls]]
    names = [f"_x{i}" for i in range(p)]
    base = df.select(*keys, F.col(y).cast("double").alias("_y"), F.col(t).cast("double").alias("_t"), *[x.cast("double").alias(n) for n, x in zip(names, xs)], F.pmod(fold, F.lit(k)).alias("_f"))
    total = lambda a, b: F.sum(F.col(a) * F.col(b))
    sums = {_g(i, j): total(names[i], names[j]) for i in range(p) for j in range(i + 1)}
    sums |= {f"_c{i}{v}": total(names[i], v) for i in range(p) for v in ("_y", "_t")} | {"_yt": total("_y", "_t"), "_tt": total("_t", "_t"), "_n": F.count(F.lit(1))}
    per_fold = base.groupBy(*keys, "_f").agg(*[s.alias(c) for c, s in sums.items()])
    # a group has k rows here: its totals are a window over them
    rest = lambda c: F.sum(c).over(Window.partitionBy(*keys)) - F.col(c)
    matrix = lambda of: F.array(*[F.array(*[of(_g(i, j)) for j in range(p)], of(f"_c{i}_y"), of(f"_c{i}_t")) for i in range(p)])
    folds = per_fold.select(*keys, "_yt", "_tt", "_n", matrix(F.col).alias("_own"), matrix(rest).alias("_rows")).withColumn("_done", eliminated("_rows", p))
    folds = folds.select(*keys, "_yt", "_tt", "_n", "_own", _side(F.col("_done"), p).alias("_by"), _side(F.col("_done"), p + 1).alias("_bt"))
    to_y, to_t = _side(F.col("_own"), p), _side(F.col("_own"), p + 1)
    # G bt: the first p entries of every own row against bt
    g_bt = F.transform("_own", lambda r: _inner(F.slice(r, 1, p), F.col("_bt")))
    r_yt = F.col("_yt") - _inner(F.col("_by"), to_t) - _inner(F.col("_bt"), to_y) + _inner(F.col("_by"), g_bt)
    r_tt = F.col("_tt") - 2 * _inner(F.col("_bt"), to_t) + _inner(F.col("_bt"), g_bt)
    parts = folds.select(*keys, "_n", r_yt.alias("_ryt"), r_tt.alias("_rtt"))
    return parts.groupBy(*keys).agg((F.sum("_ryt") / F.nullif(F.sum("_rtt"), F.lit(0.0))).alias("theta"), F.sum("_n").alias("n"))


def dot(beta: str, xs: list[Column]) -> Column:
    """Prediction of ``beta`` at the regressors ``xs``."""
    return sum((F.col(beta)[i] * x.cast("double") for i, x in enumerate(xs)), F.lit(0.0))
