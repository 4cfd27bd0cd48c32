"""Distribution drift between a reference and a current frame.

The numeric test is named by the caller, per column: the normalised Wasserstein
distance (large samples) or the two-sample K-S test (the reference's choice for
1,000 reference rows or fewer).  Both run on one ECDF frame: values of both frames are counted
per distinct value (partial aggregation), the counts get distributed running
sums, and the next distinct value comes from an equi-join on the running rank.
No step gathers a column into one task.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.prefix import running_sum
from .explore import exact_quantiles

# Fixed values of the reference's drift policy.
COLUMN_THRESHOLD = 0.1    # Wasserstein (normed) / Jensen-Shannon distance
KS_ALPHA = 0.05           # K-S p-value below this -> drift
SD_FLOOR = 0.001          # Wasserstein normalisation floor
DATASET_THRESHOLD = 0.20  # share of drifted columns (strict >)
SEVERITY_WARNING, SEVERITY_CRITICAL = 0.20, 0.40
PSI_FLOOR = 1e-4          # empty-bin share floor for PSI
KS_TERMS = 100            # terms of the Kolmogorov series

REPORT_SCHEMA = ("column string, stat_test string, score double, threshold double, detected boolean, "
                 "n_ref long, n_cur long")


def _tagged(ref: DataFrame, cur: DataFrame, column: str, cast: str | None = "double") -> DataFrame:
    x = F.col(column).cast(cast) if cast else F.col(column)
    a = ref.select(x.alias("v"), F.lit(1).alias("r"), F.lit(0).alias("c"))
    b = cur.select(x.alias("v"), F.lit(0).alias("r"), F.lit(1).alias("c"))
    return a.unionByName(b).where(F.col("v").isNotNull())


def value_counts_pair(ref: DataFrame, cur: DataFrame, column: str, cast: str | None = "double") -> DataFrame:
    """(v, c_r, c_c): occurrences of each distinct value in ref and cur."""
    return (_tagged(ref, cur, column, cast).groupBy("v")
            .agg(F.sum("r").cast("long").alias("c_r"), F.sum("c").cast("long").alias("c_c")))


def ecdf_frame(ref: DataFrame, cur: DataFrame, column: str) -> DataFrame:
    """(v, c_r, c_c, cum_r, cum_c, rank, v_next) over the union of distinct values."""
    counts = value_counts_pair(ref, cur, column).withColumn("_one", F.lit(1).cast("long"))
    cum = running_sum(counts, [F.col("v").asc()], ["c_r", "c_c", "_one"], ["cum_r", "cum_c", "rank"])
    nxt = cum.select((F.col("rank") - 1).alias("rank"), F.col("v").alias("v_next"))
    return cum.join(nxt, "rank", "left")


def ks_pvalue(d, n, m):
    """Asymptotic two-sample K-S p-value: Kolmogorov survival function at
    sqrt(n m / (n + m)) * D, as a column expression."""
    lam = F.sqrt(n * m / (n + m)) * d
    series = F.aggregate(F.sequence(F.lit(1), F.lit(KS_TERMS)), F.lit(0.0),
                         lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(F.lit(-2.0) * k * k * lam * lam))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * series)))


def value_counts_tagged(df: DataFrame, is_ref, numeric: list[str], categorical: list[str] = ()) -> DataFrame:
    """(column, v, s, c_r, c_c): occurrences of each distinct value of every
    listed column in the reference (``is_ref`` true) and current rows, from a
    single scan of ``df``.  Numeric values land in ``v`` (double), categorical
    ones in ``s`` (string).  The result holds distinct values, not rows, and
    is materialised once for the numeric and categorical tests."""
    flag = F.col(is_ref) if isinstance(is_ref, str) else is_ref
    items = [f"'{x}', CAST(`{x}` AS DOUBLE), CAST(NULL AS STRING)" for x in numeric] + \
            [f"'{x}', CAST(NULL AS DOUBLE), CAST(`{x}` AS STRING)" for x in categorical]
    long = (df.select(flag.alias("_ref"), *[F.col(x) for x in list(numeric) + list(categorical)])
              .selectExpr("_ref", f"stack({len(items)}, {', '.join(items)}) AS (column, v, s)")
              .where("v IS NOT NULL OR s IS NOT NULL"))
    counts = long.groupBy("column", "v", "s").agg(
        F.count_if("_ref").cast("long").alias("c_r"), F.count_if(~F.col("_ref")).cast("long").alias("c_c"))
    from ..session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return counts.checkpoint(eager=True)


def _numeric_from_counts(counts: DataFrame, tests: dict[str, str], *, threshold, alpha) -> DataFrame:
    unknown = set(tests.values()) - {"wasserstein", "ks"}
    if unknown:
        raise ValueError(f"unknown numeric drift tests: {sorted(unknown)}")
    counts = counts.where(F.col("v").isNotNull()).select("column", "v", "c_r", "c_c") \
        .withColumn("_one", F.lit(1).cast("long"))
    # running counts plus the next distinct value in (column, v) order, one pass
    cum = running_sum(counts, [F.col("column").asc(), F.col("v").asc()], ["c_r", "c_c", "_one"],
                      ["cum_r", "cum_c", "rank"], lead_col=["column", "v"], lead_out=["_ncol", "_vn"])
    per_col = cum.groupBy("column").agg(
        F.sum("c_r").alias("n_ref"), F.sum("c_c").alias("n_cur"),
        F.min(F.col("cum_r") - F.col("c_r")).alias("off_r"), F.min(F.col("cum_c") - F.col("c_c")).alias("off_c"),
        (F.sum(F.col("c_r") * F.col("v")) / F.sum("c_r")).alias("mean_r"))
    pc = F.broadcast(per_col)   # one row per column
    sd = (cum.join(pc, "column")
             .groupBy("column").agg(F.greatest(F.sqrt(F.sum(F.col("c_r") * (F.col("v") - F.col("mean_r")) ** 2)
                                                      / F.first("n_ref")), F.lit(SD_FLOOR)).alias("sd")))
    e = cum.withColumn("v_next", F.when(F.col("_ncol") == F.col("column"), F.col("_vn"))).join(pc, "column")
    fr = (F.col("cum_r") - F.col("off_r")) / F.col("n_ref")
    fc = (F.col("cum_c") - F.col("off_c")) / F.col("n_cur")
    stats = e.groupBy("column", "n_ref", "n_cur").agg(
        F.sum(F.abs(fr - fc) * (F.col("v_next") - F.col("v"))).alias("w1"),
        F.max(F.abs(fr - fc)).alias("ks_d")).join(F.broadcast(sd), "column")
    nr, nc = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    distance = F.col("column").isin([c for c, t in tests.items() if t == "wasserstein"])
    score = F.when(distance, F.coalesce(F.col("w1"), F.lit(0.0)) / F.col("sd")).otherwise(
        ks_pvalue(F.col("ks_d"), nr, nc))
    return stats.select(
        "column",
        F.when(distance, "wasserstein").otherwise("ks").alias("stat_test"),
        score.alias("score"),
        F.when(distance, F.lit(threshold)).otherwise(F.lit(alpha)).alias("threshold"),
        F.when(distance, score >= threshold).otherwise(score < alpha).alias("detected"),
        F.col("n_ref").cast("long").alias("n_ref"), F.col("n_cur").cast("long").alias("n_cur"))


def _categorical_from_counts(counts: DataFrame, *, threshold) -> DataFrame:
    counts = counts.where(F.col("s").isNotNull())
    tot = counts.groupBy("column").agg(F.sum("c_r").alias("n_ref"), F.sum("c_c").alias("n_cur"))
    j = counts.join(F.broadcast(tot), "column")   # one row per column
    p, q = F.col("c_r") / F.col("n_ref"), F.col("c_c") / F.col("n_cur")
    m = (p + q) / 2
    term = F.when(p > 0, p * F.ln(p / m)).otherwise(0.0) + F.when(q > 0, q * F.ln(q / m)).otherwise(0.0)
    js = j.groupBy("column", "n_ref", "n_cur").agg(F.sqrt(F.greatest(F.lit(0.0), F.sum(term) / 2)).alias("score"))
    return js.select("column", F.lit("jensenshannon").alias("stat_test"), "score",
                     F.lit(threshold).alias("threshold"), (F.col("score") >= threshold).alias("detected"),
                     F.col("n_ref").cast("long").alias("n_ref"), F.col("n_cur").cast("long").alias("n_cur"))


def _tests(numeric, test: str) -> dict[str, str]:
    """Column -> test: a dict as given, or a list of columns under one test."""
    return dict(numeric) if isinstance(numeric, dict) else {c: test for c in numeric}


def drift_report_tagged(df: DataFrame, is_ref, *, numeric: list[str] | dict[str, str], categorical: list[str] = (),
                        test: str = "wasserstein", threshold: float = COLUMN_THRESHOLD,
                        alpha: float = KS_ALPHA) -> DataFrame:
    """Per-column drift rows when reference and current rows come from one
    frame (``is_ref`` marks the reference): a single scan feeds every test."""
    tests = _tests(numeric, test)
    counts = value_counts_tagged(df, is_ref, list(tests), list(categorical))
    parts = []
    if tests:
        parts.append(_numeric_from_counts(counts, tests, threshold=threshold, alpha=alpha))
    if categorical:
        parts.append(_categorical_from_counts(counts, threshold=threshold))
    return reduce(DataFrame.unionByName, parts)


def _tag_union(ref: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    return (ref.select(*cols, F.lit(True).alias("_is_ref"))
               .unionByName(cur.select(*cols, F.lit(False).alias("_is_ref"))))


def numeric_drift_many(ref: DataFrame, cur: DataFrame, columns: list[str] | dict[str, str], *,
                       test: str = "wasserstein", threshold=COLUMN_THRESHOLD, alpha=KS_ALPHA) -> DataFrame:
    """M8/M10 for several numeric columns, each under its named test.  Values
    are counted per distinct value, and one distributed running sum in
    (column, v) order with per-column offsets (one row per column) gives every
    column's ECDFs."""
    tests = _tests(columns, test)
    counts = value_counts_tagged(_tag_union(ref, cur, list(tests)), "_is_ref", list(tests))
    return _numeric_from_counts(counts, tests, threshold=threshold, alpha=alpha)


def numeric_drift(ref: DataFrame, cur: DataFrame, column: str, **kw) -> DataFrame:
    return numeric_drift_many(ref, cur, [column], **kw)


def categorical_drift_many(ref: DataFrame, cur: DataFrame, columns: list[str], *,
                           threshold=COLUMN_THRESHOLD) -> DataFrame:
    """M9: Jensen-Shannon distance (natural log) between value shares."""
    counts = value_counts_tagged(_tag_union(ref, cur, columns), "_is_ref", [], columns)
    return _categorical_from_counts(counts, threshold=threshold)


def categorical_drift(ref: DataFrame, cur: DataFrame, column: str, **kw) -> DataFrame:
    return categorical_drift_many(ref, cur, [column], **kw)


def drift_report(ref: DataFrame, cur: DataFrame, *, numeric: list[str] | dict[str, str], categorical: list[str] = (),
                 test: str = "wasserstein", threshold: float = COLUMN_THRESHOLD) -> DataFrame:
    """Per-column drift rows: column, stat_test, score, threshold, detected."""
    cols = list(numeric) + list(categorical)
    return drift_report_tagged(_tag_union(ref, cur, cols), "_is_ref", numeric=numeric,
                               categorical=categorical, test=test, threshold=threshold)


def severity(share) -> F.Column:
    """Critical above 0.40, warning above 0.20, else ok."""
    s = F.col(share) if isinstance(share, str) else share
    return F.when(s > SEVERITY_CRITICAL, "critical").when(s > SEVERITY_WARNING, "warning").otherwise("ok")


def drift_summary(report: DataFrame, *, threshold: float = DATASET_THRESHOLD) -> DataFrame:
    """Share of drifted columns; dataset drift when share > threshold."""
    agg = report.agg(F.count(F.lit(1)).alias("total"), F.count_if("detected").alias("drifted"))
    share = F.col("drifted") / F.col("total")
    return agg.select(
        "total", "drifted", share.alias("drift_share"),
        (share > threshold).alias("dataset_drift"),
        F.when(share > threshold, "DRIFT_DETECTED").otherwise("OK").alias("status"),
        severity(share).alias("severity"),
        (share > threshold).alias("retrain_triggered"))


def confirm_drift(summary: DataFrame, *, threshold: float = DATASET_THRESHOLD) -> DataFrame:
    """The retraining job proceeds only when reported share > threshold / 2."""
    return summary.withColumn("confirmed", F.col("drift_share") > F.lit(threshold / 2))


def psi(ref: DataFrame, cur: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Population stability index over the reference's quantile bins:
    sum (c - r) ln(c / r) with empty shares floored."""
    qs = [i / bins for i in range(1, bins)]
    bounds = exact_quantiles(ref, column, qs).select(F.sort_array(F.collect_list("value"))).scalar()   # bins - 1 values
    x = F.col(column).cast("double")

    def shares(df, tag):
        b = (df.select(x.alias("x")).where(F.col("x").isNotNull()).withColumn("bounds", bounds)
               .select(F.size(F.filter("bounds", lambda v: v < F.col("x"))).alias("bin")))
        n = df.select(F.count(x)).scalar()
        return b.groupBy("bin").agg((F.count(F.lit(1)) / n).alias(tag))

    r, c = shares(ref, "r"), shares(cur, "c")
    j = r.join(c, "bin", "full")
    rr = F.greatest(F.coalesce("r", F.lit(0.0)), F.lit(PSI_FLOOR))
    cc = F.greatest(F.coalesce("c", F.lit(0.0)), F.lit(PSI_FLOOR))
    return j.agg(F.sum((cc - rr) * F.ln(cc / rr)).alias("psi")).select(F.lit(column).alias("column"), "psi")


def perturb(df: DataFrame, *, shift: dict | None = None, scale: dict | None = None) -> DataFrame:
    """Deterministic perturbation used to exercise drift (add / multiply)."""
    out = df
    for c, k in (shift or {}).items():
        out = out.withColumn(c, F.col(c) + F.lit(k))
    for c, k in (scale or {}).items():
        out = out.withColumn(c, F.col(c) * F.lit(k))
    return out
