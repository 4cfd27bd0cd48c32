"""The retail data model expressed over the driver's star schema.

transactions = lineitem joined to orders; products = part; customers = customer
with its nation; inventory is derived deterministically from part.  Every view
is a lazy DataFrame, so column pruning and filters still reach the Parquet scans.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import read_table

# Fixed values of the data model mapping (must agree with the oracle SQL).
COST_RATIO = "0.6"          # products.cost_price = base_price * 0.6
AGE_BASE, AGE_SPAN = 18, 57  # customers.age = 18 + custkey % 57
GENDER_MOD = 25              # custkey % 25: 0 -> Other, odd -> M, else F
STOCK_MUL, STOCK_MOD = 37, 500
REORDER_BASE, REORDER_MOD = 20, 80
LEAD_BASE, LEAD_MOD = 2, 12


def _line_amount(price, discount):
    """round(price * (1 - discount), 2) in DECIMAL.  (1 - discount) lies in
    [0, 1] and fits DECIMAL(3,2); keeping the product at DECIMAL(16,4) (<= 18
    digits) lets Spark use its long-backed decimal arithmetic."""
    keep = (F.lit(1) - discount).cast("decimal(3,2)")
    return F.round(price.cast("decimal(12,2)") * keep, 2)


def transactions(spark: SparkSession, root: str) -> DataFrame:
    """One row per line item: transaction_id (basket), customer_id, sku_id,
    timestamp, quantity, discount_applied DECIMAL(4,2), total_amount DECIMAL."""
    li = read_table(spark, root, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    od = read_table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    disc = F.col("l_discount").cast("decimal(4,2)")
    return (li.join(od, li.l_orderkey == od.o_orderkey, "inner")
              .select(F.col("l_orderkey").alias("transaction_id"),
                      F.col("o_custkey").alias("customer_id"),
                      F.col("l_partkey").alias("sku_id"),
                      F.col("o_orderdate").alias("timestamp"),
                      F.col("l_quantity").cast("int").alias("quantity"),
                      disc.alias("discount_applied"),
                      _line_amount(F.col("l_extendedprice"), disc).alias("total_amount")))


def baskets(spark: SparkSession, root: str) -> DataFrame:
    """Transactions pre-aggregated to one row per basket *before* the join to
    orders: the fact side of the join shrinks by the lines-per-order factor and
    the aggregate's hash partitioning on the order key is reused by the join.

    Columns match :func:`shelfwise.operators.customer.baskets_of` so every
    customer-level operator accepts either producer.
    """
    li = read_table(spark, root, "lineitem")
    disc = F.col("l_discount").cast("decimal(4,2)")
    amt = _line_amount(F.col("l_extendedprice"), disc)
    per_order = li.groupBy(F.col("l_orderkey").alias("transaction_id")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(amt).alias("amount_sum"),
        F.max(amt).alias("amount_max"),
        F.sum(F.col("l_quantity").cast("int")).alias("qty_sum"),
        F.sum(disc).alias("discount_sum"),
        F.max(disc).alias("discount_max"),
        F.count_if(disc > 0).alias("n_discounted"),
    )
    od = read_table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (per_order.join(od, per_order.transaction_id == od.o_orderkey, "inner")
                     .select("transaction_id",
                             F.col("o_custkey").alias("customer_id"),
                             F.col("o_orderdate").alias("timestamp"),
                             "n_lines", "amount_sum", "amount_max", "qty_sum",
                             "discount_sum", "discount_max", "n_discounted"))


def products(spark: SparkSession, root: str) -> DataFrame:
    base = F.col("p_retailprice").cast("decimal(12,2)")
    return read_table(spark, root, "part").select(
        F.col("p_partkey").alias("sku_id"),
        F.col("p_type").alias("category"),
        base.alias("base_price"),
        (base * F.lit(COST_RATIO).cast("decimal(2,1)")).cast("decimal(12,2)").alias("cost_price"))


def customers(spark: SparkSession, root: str) -> DataFrame:
    c = read_table(spark, root, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # nation is a fixed 25-row dimension: broadcasting it is size-safe at any scale
    n = read_table(spark, root, "nation").select("n_nationkey", "n_name")
    g = F.col("c_custkey") % GENDER_MOD
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
             .select(F.col("c_custkey").alias("customer_id"),
                     (F.lit(AGE_BASE) + F.col("c_custkey") % AGE_SPAN).cast("int").alias("age"),
                     F.when(g == 0, "Other").when(g % 2 == 1, "M").otherwise("F").alias("gender"),
                     F.col("c_mktsegment").alias("segment"),
                     F.col("n_name").alias("region")))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    k = F.col("p_partkey")
    return read_table(spark, root, "part").select(
        k.alias("sku_id"),
        ((k * STOCK_MUL) % STOCK_MOD).cast("int").alias("current_stock"),
        (F.lit(REORDER_BASE) + k % REORDER_MOD).cast("int").alias("reorder_point"),
        (F.lit(LEAD_BASE) + k % LEAD_MOD).cast("int").alias("supplier_lead_time_days"))


def events(spark: SparkSession, root: str) -> DataFrame:
    """Request/event log: ts, user_id, event_type, latency proxy and error flag."""
    return read_table(spark, root, "events").select(
        "event_id", "ts", "user_id", "event_type",
        F.col("value").alias("latency_ms"),
        (F.col("event_type") == "error").alias("is_error"))
