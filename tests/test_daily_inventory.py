"""Micro-fixtures: window frames, calendar flags, inventory policy edges, ABC."""
import datetime as dt
import math
from decimal import Decimal

from pyspark.sql import functions as F

from shelfwise.functions import calendar_flags, running_sum
from shelfwise.operators import daily as dl
from shelfwise.operators import explore as ex
from shelfwise.operators import inventory as inv


def test_calendar_flags(spark):
    days = ["2024-02-29", "2024-01-07", "2024-01-08", "2024-12-24", "2024-12-25", "2023-12-31"]
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "date date")
    r = {str(x.date): x for x in df.select("date", *calendar_flags("date")).collect()}
    assert r["2024-02-29"].is_month_end == 1 and r["2024-02-29"].day_of_week == 3
    assert r["2024-01-07"].is_holiday_proxy == 1 and r["2024-01-08"].is_holiday_proxy == 0
    assert r["2024-12-24"].is_holiday_proxy == 0 and r["2024-12-25"].is_holiday_proxy == 1
    assert r["2024-01-07"].is_weekend == 1 and r["2024-01-08"].day_of_week == 0
    assert r["2023-12-31"].quarter == 4 and r["2023-12-31"].is_month_end == 1


def test_rolling_lag_rows_not_days(spark, make_txns):
    rows = [(i, 1, 1, f"2024-01-{d:02d} 00:00:00", q, 0, q) for i, (d, q) in
            enumerate([(1, 1), (2, 2), (5, 3), (9, 4)])]
    f = dl.timeseries_features(make_txns(rows)).orderBy("date").collect()
    assert [r.qty_lag_1d for r in f] == [0, 1, 2, 3]
    assert f[3].qty_roll_7d == 2.5            # 4 rows (days with sales), not 7 calendar days
    filled = dl.timeseries_features(make_txns(rows), gap_fill=True).count()
    assert filled == 9


def test_full_window_mean(spark):
    s = spark.createDataFrame([(dt.date(2024, 1, d), float(d)) for d in range(1, 8)], "ds date, y double")
    r = ex.full_window_mean(s, "y", "ds", 7).orderBy("ds").collect()
    assert all(x.ma_7 is None for x in r[:6]) and r[6].ma_7 == 4.0
    r6 = ex.full_window_mean(s.where("y < 7"), "y", "ds", 7).collect()
    assert all(x.ma_7 is None for x in r6)


def test_abc_edges(spark, make_txns):
    # revenues 70, 20, 10 -> cumulative 0.7 (A, inclusive), 0.9 (B, inclusive), 1.0 (C)
    t = make_txns([(1, 1, 1, "2024-01-01 00:00:00", 1, 0, 70), (2, 1, 2, "2024-01-01 00:00:00", 1, 0, 20),
                   (3, 1, 3, "2024-01-01 00:00:00", 1, 0, 10)])
    r = {x.sku_id: x.abc_class for x in inv.abc_classes(t).collect()}
    assert r == {1: "A", 2: "B", 3: "C"}
    # a single SKU above 70 % is not A
    t2 = make_txns([(1, 1, 1, "2024-01-01 00:00:00", 1, 0, 80), (2, 1, 2, "2024-01-01 00:00:00", 1, 0, 20)])
    assert {x.sku_id: x.abc_class for x in inv.abc_classes(t2).collect()} == {1: "B", 2: "C"}


def test_abc_bounds_keep_their_decimals(spark, make_txns):
    t = make_txns([(1, 1, 1, "2024-01-01 00:00:00", 1, 0, 72), (2, 1, 2, "2024-01-01 00:00:00", 1, 0, 28)])
    assert {x.sku_id: x.abc_class for x in inv.abc_classes(t, a="0.75").collect()} == {1: "A", 2: "C"}


def test_unknown_sku_gets_the_full_default_record(spark, make_txns):
    t = make_txns([(1, 1, 1, "2024-01-01 00:00:00", 4, 0, 40)])
    products = spark.createDataFrame([(1, "c", Decimal("10.00"), Decimal("6.00"))], "sku_id long, category string, base_price decimal(12,2), cost_price decimal(12,2)")
    inventory = spark.createDataFrame([(1, 50, 20, 5)], "sku_id long, current_stock int, reorder_point int, supplier_lead_time_days int")
    keys = spark.createDataFrame([(1,), (77,)], "sku_id long")
    r = {x.sku_id: x for x in inv.lookup_with_defaults(keys, products, inventory, t).collect()}
    safety = 1.65 * 2.0 * math.sqrt(7)
    assert r[1].current_stock == 50 and r[77].current_stock == 0
    assert r[77].recommended_reorder_qty == round(math.sqrt(2 * 5 * 365 * 50 / (10 * 0.2)))
    assert r[77].safety_stock == round(safety) and abs(r[77].reorder_point - (35 + safety)) < 1e-9
    assert (r[77].stockout_risk, r[77].days_of_supply, r[77].abc_class, r[77].dead_stock) == (1.0, 0.0, "C", True)


def test_inventory_defaults_single_day_and_dead_stock(spark, make_txns):
    t = make_txns([(1, 1, 1, "2024-01-01 00:00:00", 4, 0, 40), (2, 1, 1, "2024-01-01 00:00:00", 2, 0, 20),
                   (3, 1, 2, "2024-04-10 00:00:00", 3, 0, 30)])
    products = spark.createDataFrame([(1, "c", Decimal("10.00"), Decimal("6.00")),
                                      (2, "c", Decimal("10.00"), Decimal("6.00")),
                                      (3, "c", Decimal("10.00"), Decimal("6.00"))],
                                     "sku_id long, category string, base_price decimal(12,2), cost_price decimal(12,2)")
    inventory = spark.createDataFrame([(1, 50, 20, 5), (2, 0, 20, 5)],
                                      "sku_id long, current_stock int, reorder_point int, supplier_lead_time_days int")
    r = {x.sku_id: x for x in inv.inventory_report(products, inventory, t).collect()}
    # sku 1: one sales day -> std NULL -> 2.0; avg demand 6/1
    safety = 1.65 * 2.0 * math.sqrt(7)
    assert r[1].safety_stock == round(safety)
    assert r[1].recommended_reorder_qty == round(math.sqrt(2 * 6 * 365 * 50 / (6.0 * 0.2)))
    assert r[1].dead_stock is True             # 100 days before the latest sale
    assert r[2].dead_stock is False
    # sku 3 never sold: defaults demand 5, std 2, stock 0 (absent from inventory)
    assert r[3].current_stock == 0 and r[3].dead_stock is True and r[3].abc_class == "C"
    assert r[3].days_of_supply == 0.0 and r[3].stockout_risk == 1.0


def test_running_sum_matches_window(spark):
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("k"), F.col("id").alias("id"),
                                     (F.col("id") % 13).cast("long").alias("v"))
    out = running_sum(df, [F.col("k").desc(), F.col("id")], "v", "cum", num_partitions=7,
                      lead_col="id", lead_out="next_id")
    got = sorted((r.k, r.id, r.cum, r.next_id) for r in out.collect())
    rows = sorted(((r.k, r.id, r.v) for r in df.collect()), key=lambda x: (-x[0], x[1]))
    acc, exp = 0, []
    for n, (k, i, v) in enumerate(rows):
        acc += v
        exp.append((k, i, acc, rows[n + 1][1] if n + 1 < len(rows) else None))
    assert got == sorted(exp, key=lambda t: (t[0], t[1]))


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    vals = [float(x) for x in [5, 1, 9, 3, 3, 7, 2, 8, 8, 8, 10]]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r.q: r.value for r in ex.exact_quantiles(df, "x", (0.1, 0.25, 0.5, 0.9)).collect()}
    for q, v in got.items():
        assert abs(v - float(np.quantile(vals, q))) < 1e-12


def test_baskets_of_a_sku_day_count_without_an_aggregate_by_basket(spark, capsys):
    rows = [(1, 7, dt.datetime(2024, 1, 1, 9), 2, Decimal("3.00")), (1, 7, dt.datetime(2024, 1, 1, 9), 1, Decimal("1.50")),
            (2, 7, dt.datetime(2024, 1, 1, 8), None, None), (1, 7, dt.datetime(2024, 1, 2, 9), 4, Decimal("2.00")),
            (None, 7, dt.datetime(2024, 1, 1, 7), 1, Decimal("1.00")), (None, 7, dt.datetime(2024, 1, 1, 7), 1, Decimal("1.00"))]
    txns = spark.createDataFrame(rows, "transaction_id long, sku_id long, timestamp timestamp_ntz, quantity int, total_amount decimal(15,2)")
    got = dl.sku_daily(txns)
    assert dict(got.dtypes)["daily_revenue"] == "decimal(35,2)"
    assert [tuple(r) for r in got.orderBy("date").collect()] == [
        (7, dt.date(2024, 1, 1), 5, Decimal("6.50"), 3, dt.datetime(2024, 1, 1, 7), dt.datetime(2024, 1, 1, 9)),
        (7, dt.date(2024, 1, 2), 4, Decimal("2.00"), 1, dt.datetime(2024, 1, 2, 9), dt.datetime(2024, 1, 2, 9))]
    got.explain()
    inv.demand_stats(txns).explain()
    plans = capsys.readouterr().out
    keyed = [line for line in plans.splitlines() if "Aggregate(" in line and "transaction_id" in line.split("functions")[0]]
    assert not keyed and plans.count("Window ") == 1          # the statistics read no count
