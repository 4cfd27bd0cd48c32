"""Windowed request/latency monitors over an event log.

Batch functions take the event frame; ``streaming_latency`` is the Structured
Streaming form with an event-time watermark.  All windows are keyed by the
series (event type = endpoint proxy), as alert rules evaluate per series.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.prefix import running_sum

# Fixed values of the reference's alert rules and metrics.
RATE_WINDOW, RATE_STEP = "5 minutes", "30 seconds"
RATE_WINDOW_S = 300
P95_LIMIT_MS, P99_LIMIT_MS = 500.0, 1000.0
ERROR_LIMIT = 0.01
DROP_FACTOR, DROP_LOOKBACK_S = 0.5, 3600
LATENCY_BUCKETS_S = (0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)


def _ts(c="ts") -> Column:
    # window() and watermarks need TIMESTAMP (the fixture stores TIMESTAMP_NTZ)
    return F.col(c).cast("timestamp")


RATE_STEP_S = 30
WINDOWS_PER_EVENT = RATE_WINDOW_S // RATE_STEP_S   # each event lies in 10 sliding windows


def _sliding_counts(events: DataFrame, keys: list[str], aggs: dict) -> DataFrame:
    """Counts over sliding 5-minute windows every 30 s, aligned like
    ``window(ts, '5 minutes', '30 seconds')``.  Events are first counted per
    30-second bucket; only the bucket rows are then expanded into the 10
    windows that contain them and summed, so the expansion is over buckets,
    not events."""
    t = F.unix_timestamp(_ts())
    bucket = F.floor(t / RATE_STEP_S)
    per_bucket = events.groupBy(*keys, bucket.alias("_bk")).agg(
        *[expr.alias(name) for name, expr in aggs.items()])
    starts = F.sequence(F.col("_bk") - (WINDOWS_PER_EVENT - 1), F.col("_bk"))
    expanded = per_bucket.select(*keys, F.explode(starts).alias("_ws"), *aggs)
    out = expanded.groupBy(*keys, "_ws").agg(*[F.sum(n).cast("long").alias(n) for n in aggs])
    start = F.timestamp_seconds(F.col("_ws") * RATE_STEP_S)
    end = F.timestamp_seconds(F.col("_ws") * RATE_STEP_S + RATE_WINDOW_S)
    return out.select(*keys, start.cast("timestamp_ntz").alias("window_start"),
                      end.cast("timestamp_ntz").alias("window_end"), *aggs)


def request_rate(events: DataFrame, *, key: str = "event_type") -> DataFrame:
    """Requests per second over trailing 5-minute windows every 30 s, from a
    series' first window to the last window of any series; idle windows have
    rate 0.  The spine of windows grows with the time span, not with the events."""
    bucket = F.floor(F.unix_timestamp(_ts()) / RATE_STEP_S)
    per = events.groupBy(key, bucket.alias("_bk")).agg(F.count(F.lit(1)).alias("n"))
    # both ends of the spine from the bucket counts, whose exchange all three readers share
    last = per.select(F.max("_bk")).scalar()
    spine = (per.groupBy(key).agg((F.min("_bk") - (WINDOWS_PER_EVENT - 1)).alias("_first"))
                .select(key, F.explode(F.sequence("_first", last)).alias("_ws"), F.lit(0).cast("long").alias("n")))
    held = per.select(key, F.explode(F.sequence(F.col("_bk") - (WINDOWS_PER_EVENT - 1), F.col("_bk"))).alias("_ws"), "n")
    out = spine.unionByName(held).groupBy(key, "_ws").agg(F.sum("n").alias("n"))
    start = F.timestamp_seconds(F.col("_ws") * RATE_STEP_S).cast("timestamp_ntz")
    end = F.timestamp_seconds(F.col("_ws") * RATE_STEP_S + RATE_WINDOW_S).cast("timestamp_ntz")
    return out.select(key, start.alias("window_start"), end.alias("window_end"), "n", (F.col("n") / F.lit(RATE_WINDOW_S)).alias("rate"))


def latency_percentiles(events: DataFrame, *, key: str = "event_type", value: str = "latency_ms") -> DataFrame:
    """Exact p50/p95/p99 per tumbling 5-minute window and SLO breach flags.
    Values are counted per distinct value, ranked by one distributed running sum
    in (series, window, value) order, and the order statistics on either side of
    a quantile picked by an aggregate -- a hot window never meets in one buffer."""
    w = F.window(_ts(), RATE_WINDOW)["start"].cast("timestamp_ntz")
    group = [key, "window_start"]
    counts = (events.select(key, w.alias("window_start"), F.col(value).cast("double").alias("_v"))
                    .groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_all"), F.count("_v").alias("_c")))
    cum = running_sum(counts, [F.col(key), F.col("window_start"), F.col("_v").asc_nulls_first()], "_c", "_cum")
    size = cum.groupBy(*group).agg(F.sum("_all").alias("n"), F.sum("_c").alias("_m"), F.min(F.col("_cum") - F.col("_c")).alias("_off"))
    ranked = cum.drop("_all").join(size, group).withColumn("_upto", F.col("_cum") - F.col("_off"))
    qs = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    at = {q: F.lit(x) * (F.col("_m") - 1) for q, x in qs.items()}
    holds = lambda rank: F.max(F.when((rank >= F.col("_upto") - F.col("_c")) & (rank < F.col("_upto")), F.col("_v")))
    stats = ranked.groupBy(*group, "n", "_m").agg(*[holds(F.floor(h)).alias(f"{q}_lo") for q, h in at.items()],
                                                  *[holds(F.ceil(h)).alias(f"{q}_hi") for q, h in at.items()])
    out = stats.select(*group, "n", *[(F.col(f"{q}_lo") + (h - F.floor(h)) * (F.col(f"{q}_hi") - F.col(f"{q}_lo"))).alias(q) for q, h in at.items()])
    return out.select("*", (F.col("p95") > P95_LIMIT_MS).alias("p95_breach"), (F.col("p99") > P99_LIMIT_MS).alias("p99_breach"))


def error_ratio(events: DataFrame, *, key: str = "event_type", flag: str = "is_error") -> DataFrame:
    """Error share per sliding 5-minute window and the > 1 % breach."""
    agg = _sliding_counts(events, [], {"errors": F.count_if(flag), "n": F.count(F.lit(1))})
    r = F.col("errors") / F.col("n")
    return agg.select("window_start", "errors", "n", r.alias("error_ratio"), (r * 100).alias("error_pct"),
                      (r > ERROR_LIMIT).alias("breach"))


def _day_buckets(df: DataFrame, time_col: str, lookback_s: int, bucket_s: int = 86400) -> DataFrame:
    """Rows tagged with their day bucket, plus copies of each day's last
    ``lookback_s`` seconds placed in the next day's bucket as context
    (``_ctx``).  A range window partitioned by bucket then sees everything it
    needs while each partition stays one day long."""
    t = F.unix_timestamp(F.col(time_col).cast("timestamp"))
    b = F.floor(t / bucket_s)
    own = df.withColumn("_b", b).withColumn("_ctx", F.lit(False))
    ctx = (df.where((b + 1) * bucket_s - t <= lookback_s)
             .withColumn("_b", b + 1).withColumn("_ctx", F.lit(True)))
    return own.unionByName(ctx)


def throughput_drop(rates: DataFrame, *, key: str = "event_type") -> DataFrame:
    """Rate below half of the average rate over the trailing hour
    (evaluations of the same series, current included; idle windows count as
    0, so a full outage drops too).  Windows are partitioned by series and day,
    with the previous hour copied in.  Sums and comparisons are exact integers;
    the average is one DECIMAL division."""
    t = F.unix_timestamp(F.col("window_start").cast("timestamp"))
    d = _day_buckets(rates, "window_start", DROP_LOOKBACK_S)
    w = Window.partitionBy(key, "_b").orderBy(t).rangeBetween(-DROP_LOOKBACK_S, 0)
    total, evaluations = F.sum("n").over(w), F.count(F.lit(1)).over(w)
    avg = F.round(total.cast("decimal(20,0)") / (evaluations * RATE_WINDOW_S).cast("decimal(12,0)"), 6)
    # n / 300 < factor * total / (300 * evaluations)
    drop = F.col("n") * evaluations < F.lit(DROP_FACTOR) * total
    return (d.select(key, "window_start", "rate", avg.alias("hour_avg_rate"), drop.alias("drop"), "_ctx")
             .where(~F.col("_ctx")).drop("_ctx"))


def sustained(flags: DataFrame, flag: str, *, key: str | None = "event_type", seconds: int = 300,
              step: int = RATE_STEP_S, time_col: str = "window_start") -> DataFrame:
    """A condition holds ``for`` a span when it was true at every evaluation
    since the span began: all seconds / step + 1 evaluations are there and true,
    so a first breach or a gap starts the span anew (partitioned by series and
    day, with the previous span copied in as context)."""
    t = F.unix_timestamp(F.col(time_col).cast("timestamp"))
    d = _day_buckets(flags, time_col, seconds)
    parts = ([key] if key else []) + ["_b"]
    w = Window.partitionBy(*parts).orderBy(t).rangeBetween(-seconds, 0)
    return (d.withColumn(f"{flag}_sustained", F.count_if(F.col(flag)).over(w) == F.lit(seconds // step + 1))
             .where(~F.col("_ctx")).drop("_ctx", "_b"))


def latency_histogram(events: DataFrame, *, value_ms: str = "latency_ms", key: str = "event_type",
                      bounds=LATENCY_BUCKETS_S) -> DataFrame:
    """Counts per fixed upper bound ``le`` (seconds), cumulative like a
    Prometheus histogram, plus the +Inf bucket."""
    s = F.col(value_ms) / 1000.0
    bucket = F.lit(None).cast("double")
    for b in reversed(bounds):
        bucket = F.when(s <= b, F.lit(float(b))).otherwise(bucket)
    counts = events.groupBy(key, F.coalesce(bucket, F.lit(float("inf"))).alias("le")).agg(
        F.count(F.lit(1)).alias("n"))
    # at most len(bounds) + 1 rows per series: the cumulative window is bounded
    w = Window.partitionBy(key).orderBy("le").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("cumulative", F.sum("n").over(w))


def normalise_endpoint(path) -> Column:
    """Path -> endpoint class for metric cardinality control (fixed values:
    the service's routes, first match wins)."""
    p = F.col(path) if isinstance(path, str) else path
    return (F.when(p.contains("/predict/") | p.startswith("/api/v1/predict"), "/api/v1/predict/*")
             .when(p.contains("/segment"), "/api/v1/segment/*")
             .when(p.contains("/revenue"), "/api/v1/revenue/*")
             .when(p.contains("/inventory"), "/api/v1/inventory/*")
             .otherwise(p))


def streaming_latency(events: DataFrame, *, watermark: str = "10 minutes", key: str = "event_type",
                      value: str = "latency_ms", accuracy: int = 10000) -> DataFrame:
    """N7 streaming: tumbling 5-minute windows closed by a watermark, with
    ``percentile_approx`` (bounded sketch state per window)."""
    e = events.withColumn("ts", _ts()).withWatermark("ts", watermark)
    return (e.groupBy(key, F.window("ts", RATE_WINDOW).alias("w"))
             .agg(F.percentile_approx(value, [0.5, 0.95, 0.99], accuracy).alias("q"),
                  F.count(F.lit(1)).alias("n"))
             .select(key, F.col("w.start").alias("window_start"), "n",
                     F.col("q")[0].alias("p50"), F.col("q")[1].alias("p95"), F.col("q")[2].alias("p99")))


# --------------------------------------------------- sliding percentiles --
KLL_K = 1024


def rank_error(k: int = KLL_K) -> float:
    """How far the rank of a returned quantile may be off, as a share of the window's
    values (99 % confidence); up to ``k`` values the sketch is exact."""
    return 2.296 / k ** 0.9723


def latency_sketches(events: DataFrame, *, key: str = "event_type", value: str = "latency_ms", k: int = KLL_K) -> DataFrame:
    """One mergeable sketch of the values per series and 30-second bucket
    (``bucket`` counts them from the epoch).  A row per bucket, whatever the number of
    events; sketches of other batches -- late data too -- join by ``merged_sketches``."""
    bucket = F.floor(F.unix_timestamp(_ts()) / RATE_STEP_S).cast("long")
    return (events.groupBy(key, bucket.alias("bucket"))
                  .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch")))


def merged_sketches(*tables: DataFrame, key: str = "event_type") -> DataFrame:
    """Sketch tables of several batches as one: equal buckets are merged."""
    stacked = reduce(DataFrame.unionByName, tables)
    return stacked.groupBy(key, "bucket").agg(F.sum("n").cast("long").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sliding_percentiles(sketches: DataFrame, *, key: str = "event_type") -> DataFrame:
    """p50/p95/p99 over trailing 5-minute windows every 30 s and the SLO flags, from
    bucket sketches merged over the ten windows each lies in; ranks are within
    ``rank_error`` of the exact ones (a value of the data, not interpolated)."""
    starts = F.sequence(F.col("bucket") - (WINDOWS_PER_EVENT - 1), F.col("bucket"))
    windows = (sketches.select(key, F.explode(starts).alias("_ws"), "n", "sketch").groupBy(key, "_ws")
                       .agg(F.sum("n").cast("long").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch")))
    at = lambda q: F.when(F.kll_sketch_get_n_double("sketch") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q)))
    out = windows.select(key, F.timestamp_seconds(F.col("_ws") * RATE_STEP_S).cast("timestamp_ntz").alias("window_start"),
                         "n", at(0.5).alias("p50"), at(0.95).alias("p95"), at(0.99).alias("p99"))
    return out.select("*", (F.col("p95") > P95_LIMIT_MS).alias("p95_breach"), (F.col("p99") > P99_LIMIT_MS).alias("p99_breach"))
