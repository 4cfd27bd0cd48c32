"""Exploratory summaries.

Quantiles are exact (linear interpolation between order statistics, as
``quantile_cont``) but never gather a column into one buffer: values are
counted per distinct value, the counts of all columns get one distributed running
sum, and an aggregate picks the order statistics on either side of each quantile.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.prefix import running_sum

WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage of each value (NULL values excluded, as pandas)."""
    total = df.select(F.count(column)).scalar()
    return (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n"))
              .withColumn("pct", F.col("n") * F.lit(100.0) / total))


def quantile_table(df: DataFrame, columns: list[str], qs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Exact continuous quantiles of several numeric columns from one pass ->
    (column, q0, q1, ...), one row per column with a value."""
    items = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    counts = (df.selectExpr(f"stack({len(columns)}, {items}) AS (column, v)").where("v IS NOT NULL")
                .groupBy("column", "v").agg(F.count(F.lit(1)).alias("c")))
    cum = running_sum(counts, [F.col("column").asc(), F.col("v").asc()], "c", "cum")
    size = cum.groupBy("column").agg(F.sum("c").alias("n"), F.min(F.col("cum") - F.col("c")).alias("off"))   # one row per column
    ranked = cum.join(size, "column").withColumn("upto", F.col("cum") - F.col("off"))
    at = [F.lit(float(q)) * (F.col("n") - 1) for q in qs]
    holds = lambda rank: F.max(F.when((rank >= F.col("upto") - F.col("c")) & (rank < F.col("upto")), F.col("v")))
    both = ranked.groupBy("column", "n").agg(*[holds(F.floor(h)).alias(f"lo{i}") for i, h in enumerate(at)],
                                             *[holds(F.ceil(h)).alias(f"hi{i}") for i, h in enumerate(at)])
    return both.select("column", *[(F.col(f"lo{i}") + (h - F.floor(h)) * (F.col(f"hi{i}") - F.col(f"lo{i}"))).alias(f"q{i}") for i, h in enumerate(at)])


def exact_quantiles(df: DataFrame, column: str, qs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Exact continuous quantiles of ``column`` -> (q, value)."""
    rows = F.array(*[F.struct(F.lit(float(q)).alias("q"), F.col(f"q{i}").alias("value")) for i, q in enumerate(qs)])
    return quantile_table(df, [column], qs).select(F.explode(rows).alias("r")).select("r.*")


def _mean(df: DataFrame, column: str) -> Column:
    """Mean of a column; of integers and decimals an exact sum divided once, which
    doesn't depend on the order of the rows."""
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return F.avg(column)
    return F.round(F.sum(F.col(column).cast("decimal(20,4)")) / F.count(column), 6).cast("double")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column count, mean, sample std, min, 25/50/75 % (exact), max."""
    x = {c: F.col(c).cast("double") for c in columns}
    stats = df.agg(*[F.struct(F.count(c).alias("count"), _mean(df, c).alias("mean"), F.stddev_samp(x[c]).alias("std"),
                              F.min(x[c]).alias("min"), F.max(x[c]).alias("max")).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("s")) for c in columns])
    return (stats.select(F.explode(rows).alias("r")).select("r.column", "r.s.*")
            .join(quantile_table(df, columns).toDF("column", "p25", "p50", "p75"), "column", "left")
            .select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """``bins`` equal-width bins over [min, max]; the maximum falls in the
    last bin.  -> (bin, lower, upper, n)."""
    x = F.col(column).cast("double")
    lo = df.select(F.min(x)).scalar()
    hi = df.select(F.max(x)).scalar()
    width = (hi - lo) / F.lit(bins)
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((x - lo) / width), F.lit(bins - 1))).cast("int")
    return (df.where(x.isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
              .select("bin", (lo + F.col("bin") * width).alias("lower"),
                      (lo + (F.col("bin") + 1) * width).alias("upper"), "n"))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every ordered column pair in one aggregation,
    returned long as (a, b, corr)."""
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
            for a in columns for b in columns]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a in columns for b in columns)
    return wide.selectExpr(f"stack({len(columns) ** 2}, {pairs}) AS (a, b, corr)")


def weekday_means(txns: DataFrame, value: str = "quantity", ts: str = "timestamp") -> DataFrame:
    """Mean of ``value`` by weekday, index 0 = Monday, with day names."""
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return (txns.groupBy(F.weekday(ts).alias("day_index"))
                .agg(F.avg(value).alias(f"avg_{value}"))
                .withColumn("day_name", F.element_at(names, F.col("day_index") + 1)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column."""
    return df.select(column).distinct()


def top_n(df: DataFrame, order_cols: list, n: int) -> DataFrame:
    """the first ``n`` rows of a fully tie-broken order.  Spark plans
    this as TakeOrderedAndProject: a per-partition top-n, then a merge of
    n x partitions rows -- the limit is the feature."""
    return df.orderBy(*order_cols).limit(n)


def top_k_per_group(df: DataFrame, group: str, order_cols: list, k: int) -> DataFrame:
    """The first ``k`` rows per group.  The rank filter lets Spark insert a
    partial WindowGroupLimit before the shuffle, so a hot group ships at most
    k rows per map partition."""
    w = Window.partitionBy(group).orderBy(*order_cols)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def full_window_mean(series: DataFrame, value: str, order: str, rows: int = 7) -> DataFrame:
    """Moving average over the current and previous ``rows - 1`` rows,
    NULL until ``rows`` values are available.  Computed as a difference of
    distributed running sums (rank r minus rank r - rows, an equi-join on the
    rank), so the series is never gathered into one ordered partition.
    Exact for integral values; for doubles the difference of prefix sums
    carries the usual floating-point rounding of long sums."""
    base = series.withColumn("_one", F.lit(1).cast("long")) \
        .withColumn("_v", F.col(value).cast("double"))
    cum = running_sum(base, [F.col(order).asc()], ["_v", "_one"], ["_cum", "_rank"])
    back = cum.select((F.col("_rank") + rows).alias("_rank"), F.col("_cum").alias("_cum_back"))
    j = cum.join(back, "_rank", "left")
    full = F.col("_rank") >= rows
    ma = (F.col("_cum") - F.coalesce(F.col("_cum_back"), F.lit(0.0))) / rows
    return j.select(*series.columns, F.when(full, ma).alias(f"ma_{rows}"))


def pareto_share(sku_rev: DataFrame, top_frac: float = 0.2) -> DataFrame:
    """Revenue share of the top ``top_frac`` of SKUs by revenue.  Ranks are
    a distributed running count, so no single-partition window is needed."""
    ones = sku_rev.withColumn("_one", F.lit(1).cast("long"))
    ranked = running_sum(ones, [F.col("revenue").desc(), F.col("sku_id").asc()], "_one", "rank", total_out="_n")
    cutoff = F.ceil(F.col("_n") * F.lit(top_frac))
    return ranked.agg(
        F.sum(F.when(F.col("rank") <= cutoff, F.col("revenue"))).alias("_top"),
        F.sum("revenue").alias("_all"),
        F.max(cutoff).alias("top_skus"), F.count(F.lit(1)).alias("sku_count"),
    ).select("top_skus", "sku_count", (F.col("_top") / F.col("_all")).alias("top_revenue_share"))


def bucket_sample(df: DataFrame, key: str, frac: float, seed: int = 42) -> DataFrame:
    """A reproducible fraction of the rows, by hash bucket of an integer key
    (a row is in or out by its key alone, at any size and partitioning)."""
    return df.where(F.pmod(F.col(key) * 7919 + seed * 104729, F.lit(10_000)) < round(frac * 10_000))
