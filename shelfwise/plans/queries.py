"""Registered queries, one per operator family of the inventory."""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from ..operators import customer as cu
from ..operators.linear import cross_fitted
from ..sources import views as v
from ..sources.tables import read_table
from .catalog import finalize, register


# ---------------------------------------------------------------- customer --
@register("rfm_features")
def q_rfm(spark, root):
    r = cu.rfm(v.baskets(spark, root))
    return finalize(r.withColumn("churn", cu.churn_flag("recency")))


@register("rfm_from_lines")
def q_rfm_lines(spark, root):
    """Same RFM computed from line-grain transactions (generic producer)."""
    return finalize(cu.rfm(cu.baskets_of(v.transactions(spark, root))))


@register("rfm_lite")
def q_rfm_lite(spark, root):
    return finalize(cu.rfm_lite(v.customers(spark, root), v.baskets(spark, root)))


@register("promo_features")
def q_promo(spark, root):
    return finalize(cu.promo_features(v.baskets(spark, root)))


@register("category_features")
def q_category(spark, root):
    return finalize(cu.category_features(v.transactions(spark, root), v.products(spark, root)))


@register("customer_features")
def q_customer_features(spark, root):
    b = v.baskets(spark, root)
    t = v.transactions(spark, root)
    return finalize(cu.customer_features(
        v.customers(spark, root), cu.basket_features(b), cu.category_features(t, v.products(spark, root))))


@register("last_sku")
def q_last_sku(spark, root):
    return finalize(cu.last_sku(v.transactions(spark, root)))


@register("serving_features")
def q_serving(spark, root):
    return finalize(cu.serving_features(v.customers(spark, root), v.baskets(spark, root),
                                        v.transactions(spark, root)))


# ------------------------------------------------------------- daily / sku --
from ..operators import daily as dl  # noqa: E402
from ..operators import inventory as inv  # noqa: E402


@register("sku_daily_features")
def q_sku_daily_features(spark, root):
    return finalize(dl.timeseries_features(v.transactions(spark, root)))


@register("daily_demand")
def q_daily_demand(spark, root):
    return finalize(dl.daily_demand(v.transactions(spark, root)))


@register("platform_daily")
def q_platform_daily(spark, root):
    return finalize(dl.platform_daily(v.transactions(spark, root)))


@register("sku_demand_stats")
def q_demand_stats(spark, root):
    return finalize(inv.demand_stats(v.transactions(spark, root)))


@register("revenue_by_sku")
def q_rev_sku(spark, root):
    return finalize(inv.sku_revenue(v.transactions(spark, root)))


@register("revenue_by_category")
def q_rev_cat(spark, root):
    return finalize(inv.category_revenue(v.transactions(spark, root), v.products(spark, root)))


@register("abc_classes")
def q_abc(spark, root):
    return finalize(inv.abc_classes(v.transactions(spark, root)))


def _report(spark, root):
    return inv.inventory_report(v.products(spark, root), v.inventory(spark, root),
                                v.transactions(spark, root))


@register("inventory_report")
def q_inventory_report(spark, root):
    return finalize(_report(spark, root).withColumn("risk_band", inv.stockout_band("stockout_risk")))


@register("inventory_report_own_lead")
def q_inventory_report_lead(spark, root):
    return finalize(inv.inventory_report(v.products(spark, root), v.inventory(spark, root),
                                         v.transactions(spark, root), lead_days=None))


@register("inventory_kpis")
def q_inventory_kpis(spark, root):
    return finalize(inv.inventory_kpis(inv.inventory_report(v.products(spark, root), v.inventory(spark, root), v.transactions(spark, root), classes=False)))


@register("abc_summary")
def q_abc_summary(spark, root):
    return finalize(inv.abc_summary(inv.abc_membership(v.products(spark, root), v.transactions(spark, root))))


@register("sales_velocity")
def q_velocity(spark, root):
    return finalize(inv.sales_velocity(v.transactions(spark, root)))


@register("product_catalog")
def q_catalog(spark, root):
    return finalize(inv.product_catalog(v.products(spark, root), v.inventory(spark, root),
                                        v.transactions(spark, root))
                    .withColumn("capped_cost", inv.capped_cost()))


# ------------------------------------------------------------- exploration --
from ..operators import explore as ex  # noqa: E402


@register("value_counts_category")
def q_vc_category(spark, root):
    return finalize(ex.value_counts(v.products(spark, root), "category"))


@register("value_counts_churn")
def q_vc_churn(spark, root):
    lite = cu.rfm_lite(v.customers(spark, root), v.baskets(spark, root))
    return finalize(ex.value_counts(lite.withColumn("churn", cu.churn_flag("recency")), "churn"))


@register("describe_transactions")
def q_describe_txn(spark, root):
    return finalize(ex.describe(v.transactions(spark, root), ["quantity", "discount_applied", "total_amount"]))


@register("describe_customers")
def q_describe_cust(spark, root):
    return finalize(ex.describe(v.customers(spark, root), ["age"]))


@register("histogram_age")
def q_hist_age(spark, root):
    return finalize(ex.histogram(v.customers(spark, root), "age", 30))


@register("histogram_amount")
def q_hist_amount(spark, root):
    return finalize(ex.histogram(v.transactions(spark, root), "total_amount", 50))


@register("correlation_rfm")
def q_corr(spark, root):
    lite = cu.rfm_lite(v.customers(spark, root), v.baskets(spark, root))
    return finalize(ex.correlation_matrix(lite, ["age", "recency", "frequency", "monetary"]))


@register("weekday_quantity")
def q_weekday(spark, root):
    return finalize(ex.weekday_means(v.transactions(spark, root)))


@register("distinct_categories")
def q_distinct_cat(spark, root):
    return finalize(ex.distinct_values(v.products(spark, root), "category"))


@register("top_skus_by_revenue")
def q_top_skus(spark, root):
    rev = inv.sku_revenue(v.transactions(spark, root))
    return finalize(ex.top_n(rev, [F.col("revenue").desc(), F.col("sku_id")], 20))


@register("customer_head")
def q_customer_head(spark, root):
    lite = cu.rfm_lite(v.customers(spark, root), v.baskets(spark, root))
    return finalize(ex.top_n(lite, [F.col("customer_id")], 50))


@register("customer_sample")
def q_customer_sample(spark, root):
    """Half of the customers, by hash bucket of the id."""
    return finalize(ex.bucket_sample(v.customers(spark, root), "customer_id", 0.5))


@register("latest_days")
def q_latest_days(spark, root):
    return finalize(ex.top_n(dl.platform_daily(v.transactions(spark, root)), [F.col("ds").desc()], 30))


@register("latest_baskets_per_customer")
def q_latest_baskets(spark, root):
    b = v.baskets(spark, root).select("customer_id", "transaction_id", "timestamp", "amount_sum")
    return finalize(ex.top_k_per_group(b, "customer_id",
                                       [F.col("timestamp").desc(), F.col("transaction_id").desc()], 5))


@register("daily_sales_ma7")
def q_ma7(spark, root):
    return finalize(ex.full_window_mean(dl.platform_daily(v.transactions(spark, root)), "y", "ds", 7))


@register("pareto_share")
def q_pareto(spark, root):
    return finalize(ex.pareto_share(inv.sku_revenue(v.transactions(spark, root))))


# ------------------------------------------------------------ data quality --
from ..operators import drift as dr  # noqa: E402
from ..operators import quality as dq  # noqa: E402


def _bronze(spark, root):
    return {"customers": v.customers(spark, root), "products": v.products(spark, root),
            "transactions": v.transactions(spark, root), "inventory": v.inventory(spark, root)}


@register("dq_results")
def q_dq_results(spark, root):
    return finalize(dq.run_suites(_bronze(spark, root)))


@register("dq_table_summary")
def q_dq_summary(spark, root):
    return finalize(dq.table_summary(dq.run_suites(_bronze(spark, root))))


@register("dq_gate")
def q_dq_gate(spark, root):
    return finalize(dq.gate(dq.run_suites(_bronze(spark, root))))


@register("dq_missing_columns")
def q_dq_missing(spark, root):
    """M1's failing branch: the customer suite over the transactions, which have the
    customer's id but neither age nor region."""
    return finalize(dq.run_suite(v.transactions(spark, root), "transactions", dq.SUITES["customers"]))


@register("dataset_sizes")
def q_sizes(spark, root):
    """Rows and fields of every table."""
    return finalize(q_profile(spark, root).select("dataset", "row_count", "field_count"))


@register("dataset_profile")
def q_profile(spark, root):
    from functools import reduce
    return reduce(lambda a, b: a.unionByName(b),
                  [dq.dataset_profile(df, name) for name, df in _bronze(spark, root).items()])


# ------------------------------------------------------------------- drift --
DRIFT_SPLIT = "1998-05-01"   # reference = transactions before, current = on/after


def _drift_frames(spark, root):
    t = v.transactions(spark, root).join(v.products(spark, root).select("sku_id", "category"), "sku_id", "left")
    split = F.lit(DRIFT_SPLIT).cast("timestamp_ntz")
    return t.where(F.col("timestamp") < split), t.where(F.col("timestamp") >= split)


_DRIFT_NUM = ["quantity", "discount_applied", "total_amount"]


def _drift_base(spark, root):
    return v.transactions(spark, root).join(v.products(spark, root).select("sku_id", "category"), "sku_id", "left")


def _temporal_report(spark, root):
    # reference and current rows come from one scan, tagged by the split date
    is_ref = F.col("timestamp") < F.lit(DRIFT_SPLIT).cast("timestamp_ntz")
    return dr.drift_report_tagged(_drift_base(spark, root), is_ref, numeric=_DRIFT_NUM, categorical=["category"])


@register("drift_report_temporal")
def q_drift_temporal(spark, root):
    return finalize(_temporal_report(spark, root))


@register("drift_summary_temporal")
def q_drift_summary(spark, root):
    return finalize(dr.confirm_drift(dr.drift_summary(_temporal_report(spark, root))))


@register("drift_report_shifted")
def q_drift_shifted(spark, root):
    """The whole table against its own perturbation."""
    base = _drift_base(spark, root)
    cur = dr.perturb(base, shift={"quantity": 2}, scale={"total_amount": 1.5})
    return finalize(dr.drift_report(base, cur, numeric=_DRIFT_NUM, categorical=["category"]))


EVENT_SPLIT = "2024-01-16"   # reference = events before, current = on/after


def _event_report(spark, root, test):
    is_ref = F.col("ts") < F.lit(EVENT_SPLIT).cast("timestamp_ntz")
    return dr.drift_report_tagged(v.events(spark, root), is_ref, numeric=["latency_ms"], categorical=["event_type"], test=test)


@register("drift_report_events")
def q_drift_events(spark, root):
    return finalize(_event_report(spark, root, "wasserstein"))


@register("drift_report_events_ks")
def q_drift_events_ks(spark, root):
    return finalize(_event_report(spark, root, "ks"))


@register("psi_total_amount")
def q_psi(spark, root):
    ref, cur = _drift_frames(spark, root)
    return finalize(dr.psi(ref, cur, "total_amount"))


# ----------------------------------------------------------------- pricing --
from ..operators import pricing as pr  # noqa: E402


def _lines(spark, root):
    return pr.priced_lines(v.transactions(spark, root), v.products(spark, root))


@register("elasticity_ols")
def q_ols(spark, root):
    return finalize(pr.ols_elasticity(_lines(spark, root)))


@register("price_elasticity")
def q_elasticity(spark, root):
    return finalize(pr.elasticity_report(_lines(spark, root)))


@register("price_elasticity_two_controls")
def q_elasticity_controls(spark, root):
    """J2 with two controls: the discount and the month's place in the year."""
    lines = _lines(spark, root).withColumn("season", F.month("timestamp").cast("double"))
    out = cross_fitted(lines, ["category"], "log_demand", "log_price", ["discount", "season"], pr.line_fold(lines), pr.FOLDS)
    return finalize(out.select("category", "n", F.col("theta").alias("elasticity")))


@register("price_elasticity_focal")
def q_elasticity_focal(spark, root):
    """The report of one category -- the first by name."""
    first = v.products(spark, root).select(F.min("category")).scalar()
    lines = _lines(spark, root)
    return finalize(pr.elasticity_report(lines, category=first))


@register("elasticity_kpis")
def q_elasticity_kpis(spark, root):
    return finalize(pr.elasticity_kpis(pr.elasticity_report(_lines(spark, root))))


@register("category_periods")
def q_category_periods(spark, root):
    return finalize(pr.category_periods(_lines(spark, root)))


@register("cross_elasticity")
def q_cross(spark, root):
    return finalize(pr.cross_elasticity(_lines(spark, root)))


@register("cross_elasticity_matrix")
def q_cross_matrix(spark, root):
    # the matrix has a column per category, so their names are part of the schema
    cats = [r[0] for r in v.products(spark, root).select("category").distinct().orderBy("category").collect()]
    return finalize(pr.cross_matrix(pr.cross_elasticity(_lines(spark, root)), cats))


def _sim(spark, root, **kw):
    t = v.transactions(spark, root)
    p = v.products(spark, root)
    return pr.simulate(p, t, pr.elasticity_report(pr.priced_lines(t, p)), **kw)


@register("revenue_simulation")
def q_simulation(spark, root):
    return finalize(_sim(spark, root))


@register("price_sensitivity")
def q_sensitivity(spark, root):
    t = v.transactions(spark, root)
    p = v.products(spark, root)
    return finalize(pr.sensitivity(p, t, pr.elasticity_report(pr.priced_lines(t, p))))


@register("revenue_waterfall")
def q_waterfall(spark, root):
    return finalize(pr.waterfall(_sim(spark, root)))


# --------------------------------------------------------------- streaming --
from ..streaming import ingest as si  # noqa: E402
from ..streaming import monitors as mo  # noqa: E402


def _messages(spark, root):
    """JSON messages of the transactions, dealt evenly: parsing is the costly part
    and a table of few row groups would leave it to few tasks."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return si.damaged_messages(v.transactions(spark, root).repartition(n))


@register("event_validation")
def q_event_validation(spark, root):
    """N1-N3 on a batch of JSON messages derived from the transactions."""
    decoded = si.decode_events(_messages(spark, root))
    return finalize(decoded.select("transaction_id", "sku_id", "quantity", "total_amount", "discount_applied",
                                   F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "_extra", "_dlq_reason"))


@register("dead_letter_counts")
def q_dead_letter_counts(spark, root):
    decoded = si.decode_events(_messages(spark, root))
    return decoded.groupBy(F.coalesce("_dlq_reason", F.lit("valid")).alias("outcome")) \
        .agg(F.count(F.lit(1)).alias("n"))


@register("request_rate")
def q_request_rate(spark, root):
    return finalize(mo.request_rate(v.events(spark, root)))


@register("latency_percentiles")
def q_latency(spark, root):
    return finalize(mo.latency_percentiles(v.events(spark, root)))


@register("latency_sliding")
def q_latency_sliding(spark, root):
    """N7 over sliding windows; the events come as two batches whose sketches are merged."""
    e = v.events(spark, root)
    late = F.pmod(F.xxhash64("ts", "event_type"), F.lit(2)) == 0
    return finalize(mo.sliding_percentiles(mo.merged_sketches(mo.latency_sketches(e.where(~late)), mo.latency_sketches(e.where(late)))))


@register("error_ratio")
def q_error_ratio(spark, root):
    return finalize(mo.error_ratio(v.events(spark, root)))


@register("throughput_drop")
def q_throughput_drop(spark, root):
    return finalize(mo.throughput_drop(mo.request_rate(v.events(spark, root))))


@register("sustained_error_breach")
def q_sustained(spark, root):
    return finalize(mo.sustained(mo.error_ratio(v.events(spark, root)), "breach", key=None))


@register("latency_histogram")
def q_latency_hist(spark, root):
    return finalize(mo.latency_histogram(v.events(spark, root)))


@register("endpoint_classes")
def q_endpoints(spark, root):
    """N12 over the paths of page URLs and of requests derived from the event log."""
    paths = read_table(spark, root, "pages").select(F.try_parse_url("url", F.lit("PATH")).alias("path"))
    routes = F.array(*[F.lit(r) for r in ("/api/v1/predict/", "/api/v1/segment/", "/api/v1/revenue/", "/api/v1/inventory/", "/health/")])
    requests = read_table(spark, root, "events").select(
        F.concat(F.element_at(routes, (F.col("event_id") % 5 + 1).cast("int")), "event_type").alias("path"))
    return (requests.unionByName(paths).select(mo.normalise_endpoint("path").alias("endpoint"))
                    .groupBy("endpoint").agg(F.count(F.lit(1)).alias("n")))


@register("incremental_orders")
def q_incremental(spark, root):
    """Rows strictly after a stored mark (here the median order date)."""
    from ..sources import ingest as ig
    o = read_table(spark, root, "orders")
    mark = "1998-05-01 00:00:00"
    return finalize(ig.incremental(o, "o_orderdate", mark).groupBy(F.year("o_orderdate").alias("year"))
                    .agg(F.count(F.lit(1)).alias("n")))


# ----------------------------------------------------------- feature views --
from ..operators import feature_views as fv  # noqa: E402


@register("rfm_online_lookup")
def q_rfm_online(spark, root):
    """The 'rfm' getter -- latest transaction's quantity/discount/total per customer."""
    view = fv.transaction_features(v.transactions(spark, root))
    snap = fv.latest_snapshot(view)
    return finalize(fv.online_lookup(v.customers(spark, root), snap, "customer_id"))


@register("online_lookup_keys")
def q_online_keys(spark, root):
    """Requested ids -- twice each ordering customer's id, so some exist and some don't."""
    keys = read_table(spark, root, "orders").select((F.col("o_custkey") * 2).alias("customer_id")).distinct()
    view = fv.customer_demographics(v.customers(spark, root), v.baskets(spark, root))
    return finalize(fv.online_lookup(keys, fv.latest_snapshot(view), "customer_id"))


@register("customer_online_lookup")
def q_customer_online(spark, root):
    view = fv.customer_demographics(v.customers(spark, root), v.baskets(spark, root))
    return finalize(fv.online_lookup(v.customers(spark, root).select("customer_id"),
                                     fv.latest_snapshot(view), "customer_id"))


@register("rfm_view_snapshot")
def q_rfm_view(spark, root):
    serving = cu.serving_features(v.customers(spark, root), v.baskets(spark, root), v.transactions(spark, root))
    return finalize(fv.latest_snapshot(fv.rfm_view(serving)))


@register("point_in_time_features")
def q_pit(spark, root):
    """Every order's customer at its order date, as-of joined to the
    transaction feature view (TTL 365 days)."""
    orders = read_table(spark, root, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("as_of"))
    view = fv.transaction_features(v.transactions(spark, root))
    return finalize(fv.point_in_time(orders, view))


# ------------------------------------------------------------ segmentation --
from ..operators import segments as sg  # noqa: E402


def _seg_rfm(spark, root):
    return cu.rfm(v.baskets(spark, root), frequency_mode="rows").select(
        "customer_id", "recency", "frequency", "monetary")


@register("standardized_rfm")
def q_standardized(spark, root):
    z = sg.standardize(_seg_rfm(spark, root))
    return finalize(z.withColumn("lifetime_value", sg.lifetime_value()))


@register("segment_profile_names")
def q_profile_names(spark, root):
    """K5 rules applied to the scaled RFM centroid of each market segment."""
    z = sg.standardize(_seg_rfm(spark, root)).join(
        v.customers(spark, root).select("customer_id", "segment"), "customer_id")
    cent = z.groupBy("segment").agg(F.avg("recency_z").alias("c_rec"), F.avg("frequency_z").alias("c_freq"),
                                    F.avg("monetary_z").alias("c_mon"))
    return finalize(cent.withColumn("segment_name", sg.name_segment(F.col("c_rec"), F.col("c_freq"),
                                                                     F.col("c_mon"))))


@register("customer_segments")
def q_customer_segments(spark, root):
    return finalize(sg.segment_customers(_seg_rfm(spark, root)))


@register("segment_summary")
def q_segment_summary(spark, root):
    return finalize(sg.normalised_profile(sg.segment_summary(sg.segment_customers(_seg_rfm(spark, root)))))


@register("market_segment_profile")
def q_market_profile(spark, root):
    """D16 + D27 over the market segments."""
    rows = _seg_rfm(spark, root).join(v.customers(spark, root).select("customer_id", "segment"), "customer_id")
    return finalize(sg.normalised_profile(sg.segment_summary(rows)))


@register("density_outliers")
def q_density(spark, root):
    z = sg.scaled_table(_seg_rfm(spark, root))
    return sg.density_outliers(z, "customer_id", ["recency_z", "frequency_z", "monetary_z"])


@register("segment_silhouette")
def q_silhouette(spark, root):
    km, _ = sg.kmeans_segments(sg.scaled_table(_seg_rfm(spark, root)))
    return sg.silhouette(km)


# ------------------------------------------------------------- forecasting --
from ..operators import forecast as fc  # noqa: E402


def _sku_series(spark, root):
    return dl.sku_daily(v.transactions(spark, root)).select(
        "sku_id", F.col("date").alias("ds"), F.col("daily_qty").alias("y"))


def _platform_series(spark, root):
    return dl.platform_daily(v.transactions(spark, root)).select(F.lit("platform").alias("series"), "ds", "y")


@register("sku_forecast")
def q_sku_forecast(spark, root):
    return finalize(fc.forecast(_sku_series(spark, root), ["sku_id"], horizon=7, monthly=True))


@register("platform_forecast")
def q_platform_forecast(spark, root):
    return finalize(fc.forecast(_platform_series(spark, root), ["series"], horizon=fc.HORIZON, monthly=True))


@register("category_seasonal_regression")
def q_category_regression(spark, root):
    """L2 fitted jointly: 30 days ahead of every category's daily demand."""
    t = v.transactions(spark, root).select("sku_id", F.to_date("timestamp").alias("ds"), "quantity")
    daily = (t.join(v.products(spark, root).select("sku_id", "category"), "sku_id").groupBy("category", "ds").agg(F.sum("quantity").alias("y")))
    return finalize(fc.predict_seasonal_regression(fc.fit_seasonal_regression(daily, ["category"]), ["category"]))


@register("forecast_horizon_end")
def q_horizon_end(spark, root):
    return finalize(fc.horizon_end(fc.forecast(_sku_series(spark, root), ["sku_id"], horizon=7, monthly=True), ["sku_id"]))


@register("series_index_scaled")
def q_series_index(spark, root):
    s = _sku_series(spark, root)
    return finalize(s.select("sku_id", "ds", "y", fc.time_index(s, ["sku_id"]),
                             fc.minmax_scaled("y", ["sku_id"]).alias("y_scaled")))


@register("lag_windows")
def q_lag_windows(spark, root):
    w = fc.lag_windows(_platform_series(spark, root), ["series"], lookback=fc.LOOKBACK)
    return finalize(w.select("series", "ds", "y", F.array_join(F.transform("x", lambda e: e.cast("string")), ",")
                             .alias("x")))


@register("chrono_split")
def q_chrono(spark, root):
    return finalize(fc.chrono_split(_sku_series(spark, root), ["sku_id"]))


def _backfill(spark, root):
    s = _platform_series(spark, root)
    cutoff = F.date_sub(s.select(F.max("ds")).scalar(), fc.HORIZON)
    train = s.where(F.col("ds") <= cutoff)
    stored = fc.forecast(train, ["series"], horizon=fc.HORIZON, monthly=True)
    return fc.backfill_actuals(stored, s, ["series"])


@register("forecast_backfill")
def q_backfill(spark, root):
    return finalize(_backfill(spark, root))


@register("forecast_accuracy")
def q_accuracy(spark, root):
    b = _backfill(spark, root).where(F.col("actual").isNotNull())
    err = fc.forecast_errors(b, "actual", "yhat", keys=["series"])
    return finalize(err.join(fc.coverage(b, ["series"]), "series"))


@register("forecast_degradation")
def q_degradation(spark, root):
    """Error of the horizon's second half against its first."""
    b = _backfill(spark, root).where(F.col("actual").isNotNull())
    late = F.datediff("ds", b.select(F.min("ds")).scalar()) >= fc.HORIZON // 2
    half = b.groupBy("series").agg(F.avg(F.when(~late, F.col("mape"))).alias("baseline_mape"), F.avg(F.when(late, F.col("mape"))).alias("current_mape"))
    return finalize(half.withColumn("degraded", fc.degradation("current_mape", "baseline_mape")))


@register("lag_forecaster_metrics")
def q_lag_forecaster(spark, root):
    _, metrics, _ = fc.lag_forecaster(_sku_series(spark, root), ["sku_id"])
    return metrics


# ------------------------------------------------------------------- churn --
from ..operators import churn as ch  # noqa: E402


def _churn_data(spark, root, legacy=False):
    return ch.churn_dataset(v.customers(spark, root), v.baskets(spark, root), legacy_label=legacy)


@register("churn_training_set")
def q_churn_set(spark, root):
    return finalize(_churn_data(spark, root))


@register("churn_training_set_legacy")
def q_churn_set_legacy(spark, root):
    return finalize(_churn_data(spark, root, legacy=True))


def _churn_rows(spark, root):
    """The churn rows (one a customer), written once for fits that read them often."""
    from ..session import checkpoint_dir
    checkpoint_dir(spark)
    return _churn_data(spark, root).checkpoint(eager=True)


def _split(spark, root):
    return ch.holdout(_churn_rows(spark, root)).checkpoint(eager=True)


def _champion(d):
    return ch.train_churn(d.where("is_train"))


@register("churn_scores")
def q_churn_scores(spark, root):
    d = _split(spark, root)
    return ch.score_churn(_champion(d), d)


@register("churn_holdout_metrics")
def q_churn_metrics(spark, root):
    d = _split(spark, root)
    test = ch.score_churn(_champion(d), d.where(~F.col("is_train")))
    f1 = ch.f1_at(test, "churn_probability", "churn")
    one = f1.select(F.struct("*")).scalar()
    return ch.auc(test, "churn_probability", "churn").select("*", *[one[c].alias(c) for c in f1.columns])


@register("churn_champion_challenger")
def q_churn_cc(spark, root):
    """K15 + K17: champion (single GBT) vs a retrained weighted challenger on the test split."""
    d = _split(spark, root)
    # two independent fits, submitted concurrently
    with ThreadPoolExecutor(max_workers=2) as pool:
        champ, chall = (job.result() for job in [
            pool.submit(_champion, d),
            pool.submit(lambda: ch.train_churn(ch.class_weights(d.where("is_train")), params=ch.CHALLENGER, weighted=True))])
    test = d.where(~F.col("is_train"))
    s1 = ch.score_churn(champ, test).select("customer_id", "churn", F.col("churn_probability").alias("champion"))
    s2 = ch.score_churn(chall, test).select("customer_id", F.col("churn_probability").alias("challenger"))
    return ch.champion_decision(s1.join(s2, "customer_id"), "champion", "challenger", "churn")


@register("churn_stacking")
def q_churn_stacking(spark, root):
    """K11 + K12 on the training split."""
    oof = ch.out_of_fold(_split(spark, root).where("is_train"))
    return ch.stack_strategy(oof.checkpoint(eager=True))


@register("churn_fpr_gap")
def q_churn_fpr(spark, root):
    d = _split(spark, root)
    return ch.fpr_gap(ch.score_churn(_champion(d), d.where(~F.col("is_train"))), "churn_probability", "churn")


@register("fpr_gap_recency")
def q_fpr_recency(spark, root):
    """K23 of an arithmetic score against the time-split label."""
    scored = _churn_data(spark, root).withColumn("score", F.col("recency") / (F.col("recency") + 60.0))
    return finalize(ch.fpr_gap(scored, "score", "churn"))


@register("holdout_split")
def q_holdout(spark, root):
    """K7: rows of either class on either side of the split."""
    d = ch.holdout(_churn_rows(spark, root))
    return finalize(d.groupBy("churn", "is_train").agg(F.count(F.lit(1)).alias("n")))


@register("churn_feature_matrix")
def q_feature_matrix(spark, root):
    """B18 + H16: numeric features as a vector, read back as a feature map."""
    from pyspark.ml.functions import vector_to_array
    d = ch.feature_matrix(_churn_data(spark, root)).withColumn("x", vector_to_array("features"))
    values = ch.feature_map(list(ch.FEATURES), [F.col("x")[i] for i in range(len(ch.FEATURES))])
    return finalize(d.select("customer_id", F.explode(values).alias("feature", "value")))


@register("churn_tuning")
def q_churn_tuning(spark, root):
    d = _split(spark, root)
    return ch.tune_churn(d.where("is_train"), d.where(~F.col("is_train")))


@register("churn_attributions")
def q_churn_attr(spark, root):
    return ch.attributions(_churn_rows(spark, root))


@register("churn_tree_importance")
def q_churn_trees(spark, root):
    """Gain of every feature in the fitted trees, beside the attributions."""
    return ch.tree_importance(ch.train_churn(_churn_rows(spark, root)))


def _arithmetic_attributions(spark, root):
    """Attributions by arithmetic on the features, in place of a model's."""
    d = _churn_data(spark, root)
    parts = F.array(*[F.struct(F.lit(f).alias("feature"), (F.pmod(F.col("customer_id") * (i + 3) + F.floor(F.col(f)).cast("long"), F.lit(11)) - 5).cast("double").alias("attribution"))
                      for i, f in enumerate(ch.FEATURES)])
    return ch.ranked(d.select("customer_id", F.explode(parts).alias("e")).select("customer_id", "e.*"))


@register("attribution_ranks")
def q_attribution_ranks(spark, root):
    """E10 on arithmetic attributions."""
    return finalize(_arithmetic_attributions(spark, root))


@register("attribution_importance")
def q_attribution_importance(spark, root):
    """F4 on arithmetic attributions: the top three features."""
    return finalize(ch.global_importance(_arithmetic_attributions(spark, root), 3))


@register("risk_tiers")
def q_risk_tiers(spark, root):
    """B13 over an arithmetic score of every customer, both limits met."""
    d = _churn_data(spark, root).withColumn("p", F.pmod(F.col("customer_id") * 7, F.lit(101)) / F.lit(100.0))
    return finalize(d.select("customer_id", ch.risk_tier("p").alias("risk_segment")))


@register("published_orders")
def q_published(spark, root):
    """Orders loaded in three increments, each published with its mark (one
    repeated, so it finds nothing new; the last without a priority), read back as one."""
    import uuid

    from ..session import checkpoint_dir
    from ..sources import ingest as ig
    o = read_table(spark, root, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    base = f"{checkpoint_dir(spark)}/published-{uuid.uuid4().hex}"
    for upto in ("1995-01-01", "1995-01-01", "1997-01-01"):
        ig.load_published(o.where(F.col("o_orderdate") <= F.lit(upto).cast("date")), base, "orders", "o_orderdate")
    ig.load_published(o.drop("o_orderpriority"), base, "orders", "o_orderdate")
    return finalize(ig.read_published(spark, base, "orders").groupBy(F.year("o_orderdate").alias("year"))
                    .agg(F.count(F.lit(1)).alias("orders"), F.count("o_orderpriority").alias("with_priority"), F.sum("o_orderkey").alias("keys")))


@register("churn_global_importance")
def q_churn_importance(spark, root):
    return ch.global_importance(ch.attributions(_churn_rows(spark, root)))


def _scored_docs(spark, root):
    labels = read_table(spark, root, "labels")
    docs = read_table(spark, root, "documents").select("doc_id", "n_chars", "text")
    d = labels.join(docs, "doc_id")
    mx = d.select(F.max("n_chars")).scalar()
    return d.select("doc_id", "quality", "toxic", (F.col("n_chars") / mx).alias("score"),
                    F.size(F.split("text", "\n")).cast("double").alias("line_score"))


@register("auc_labels")
def q_auc_labels(spark, root):
    return finalize(ch.auc(_scored_docs(spark, root), "score", "quality"))


@register("f1_labels")
def q_f1_labels(spark, root):
    return finalize(ch.f1_at(_scored_docs(spark, root), "score", "quality", ch.STACK_THRESHOLD))


@register("precision_top_labels")
def q_prec_top(spark, root):
    return finalize(ch.precision_top(_scored_docs(spark, root), "score", "quality", "doc_id"))


@register("champion_challenger_labels")
def q_cc_labels(spark, root):
    return finalize(ch.champion_decision(_scored_docs(spark, root), "score", "line_score", "quality"))


@register("price_elasticity_nonlinear")
def q_nonlinear(spark, root):
    """Boosted-tree double ML next to the linear estimates."""
    lines = _lines(spark, root)
    return finalize(pr.elasticity_report(lines, nonlinear=pr.nonlinear_dml(lines)))


def _asked_skus(spark, root):
    """Every SKU of a line item, and as many that don't exist."""
    sku = read_table(spark, root, "lineitem").select(F.col("l_partkey").alias("sku_id")).distinct()
    return sku.unionByName(sku.select((-F.col("sku_id") - 1).alias("sku_id")))


@register("sku_lookup_with_defaults")
def q_sku_lookup(spark, root):
    """Known and unknown SKUs looked up in the report."""
    return finalize(inv.lookup_with_defaults(_asked_skus(spark, root), v.products(spark, root), v.inventory(spark, root), v.transactions(spark, root)))


@register("unknown_skus")
def q_unknown_skus(spark, root):
    """Asked SKUs missing from the product table (reported, never substituted)."""
    return finalize(inv.unknown_keys(_asked_skus(spark, root), v.products(spark, root)))


@register("capped_costs")
def q_capped_costs(spark, root):
    """Supplier costs between 0.4 and 1.3 of the base price; those at or above it are capped."""
    cost = (F.col("base_price") * (F.lit("0.4").cast("decimal(3,1)") + (F.col("sku_id") % 10).cast("decimal(2,0)") * F.lit("0.1").cast("decimal(2,1)"))).cast("decimal(12,2)")
    p = v.products(spark, root).withColumn("cost", cost)
    return finalize(p.select("sku_id", "base_price", "cost", inv.capped_cost("base_price", "cost").alias("capped_cost")))


@register("bucketed_feature_lookup")
def q_bucketed_lookup(spark, root):
    """The demographics view's snapshot stored in buckets of the customer,
    every order's requested id (twice the ordering customer's) looked up in it."""
    import uuid

    from ..session import checkpoint_dir
    from ..sources import bucketed as bk
    keys = read_table(spark, root, "orders").select("o_orderkey", (F.col("o_custkey") * 2).alias("customer_id"))
    view = fv.customer_demographics(v.customers(spark, root), v.baskets(spark, root))
    base = f"{checkpoint_dir(spark)}/bucketed-{uuid.uuid4().hex}"
    bk.write_bucketed(fv.latest_snapshot(view), base, "customer_demographics", "customer_id")
    return finalize(keys.join(bk.read_bucketed(spark, base, "customer_demographics"), "customer_id", "left"))
