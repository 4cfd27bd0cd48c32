"""Hand-computed micro-fixtures for the customer feature rules."""
import math

from pyspark.sql import functions as F

from shelfwise.operators import customer as cu


def test_recency_floor_of_24h_periods_and_churn_edge(spark, make_txns):
    t = make_txns([
        (1, 10, 100, "2024-04-10 00:00:00", 1, 0, 5.00),   # reference date (max)
        (2, 11, 100, "2024-01-11 00:00:00", 1, 0, 5.00),   # exactly 90 days before
        (3, 12, 100, "2024-01-10 00:00:00", 1, 0, 5.00),   # 91 days
        (4, 13, 100, "2024-04-09 00:01:00", 1, 0, 5.00),   # 23h59m before -> 0 days
    ])
    r = {row.customer_id: row for row in
         cu.rfm(cu.baskets_of(t)).withColumn("churn", cu.churn_flag("recency")).collect()}
    assert r[11].recency == 90 and r[11].churn == 0
    assert r[12].recency == 91 and r[12].churn == 1
    assert r[13].recency == 0
    assert abs(r[12].recency_decay - math.exp(-0.91)) < 1e-12


def test_frequency_modes_distinct_vs_rows(spark, make_txns):
    t = make_txns([
        (1, 10, 100, "2024-01-01 00:00:00", 2, 0.1, 9.00),
        (1, 10, 101, "2024-01-01 00:00:00", 1, 0, 3.00),
        (2, 10, 100, "2024-01-02 00:00:00", 1, 0, 4.00),
    ])
    b = cu.baskets_of(t)
    d = cu.rfm(b).collect()[0]
    rows = cu.rfm(b, frequency_mode="rows").collect()[0]
    assert d.frequency == 2 and rows.frequency == 3
    assert float(d.monetary) == 16.0 and float(d.max_basket) == 9.0
    assert abs(float(d.avg_basket) - 16.0 / 3) < 1e-6
    p = cu.promo_features(b).collect()[0]
    assert abs(float(p.avg_discount) - 0.1 / 3) < 1e-9
    assert abs(float(p.discount_txn_ratio) - 1 / 3) < 1e-9


def test_favourite_category_ties_and_nulls_and_entropy(spark, make_txns):
    t = make_txns([
        (1, 10, 1, "2024-01-01 00:00:00", 1, 0, 1.0),
        (2, 10, 2, "2024-01-01 00:00:00", 1, 0, 1.0),
        (3, 10, 3, "2024-01-01 00:00:00", 1, 0, 1.0),   # null category
        (4, 10, 2, "2024-01-01 00:00:00", 1, 0, 1.0),
        (5, 10, 1, "2024-01-01 00:00:00", 1, 0, 1.0),
    ])
    products = spark.createDataFrame([(1, "beta"), (2, "alpha"), (3, None)], "sku_id long, category string")
    r = cu.category_features(t, products).collect()[0]
    assert r.distinct_categories == 2
    assert r.favourite_category == "alpha"         # tie 2-2 -> smallest value
    expected = -2 * (0.5 * math.log2(0.5 + 1e-9))
    assert abs(r.category_entropy - expected) < 1e-12


def test_customer_without_transactions_is_filled(spark, make_txns):
    t = make_txns([(1, 10, 1, "2024-01-01 00:00:00", 1, 0, 1.0)])
    customers = spark.createDataFrame([(10, 30, "F", "A", "R"), (11, 40, "M", "B", None)],
                                      "customer_id long, age int, gender string, segment string, region string")
    products = spark.createDataFrame([(1, "x")], "sku_id long, category string")
    b = cu.baskets_of(t)
    out = {r.customer_id: r for r in cu.customer_features(
        customers, cu.rfm(b), cu.category_features(t, products), cu.promo_features(b)).collect()}
    assert out[11].recency == 0 and out[11].churn == 0 and out[11].frequency == 0
    assert out[11].favourite_category == "" and out[11].region == ""
    lite = {r.customer_id: r for r in cu.rfm_lite(customers, b).collect()}
    assert lite[11].monetary == 0 and lite[11].frequency == 0


def test_last_sku_defined_order(spark, make_txns):
    t = make_txns([
        (1, 10, 5, "2024-01-02 00:00:00", 1, 0, 1.0),
        (2, 10, 7, "2024-01-02 00:00:00", 1, 0, 1.0),   # same time, higher basket wins
        (3, 10, 9, "2024-01-01 00:00:00", 1, 0, 1.0),
    ])
    assert cu.last_sku(t).collect()[0].last_sku == 7
    assert cu.last_sku(t).where(F.col("customer_id") == 10).count() == 1
