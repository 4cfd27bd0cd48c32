"""Inventory decisions for every SKU in one job."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import clip, elapsed_days
from ..functions.prefix import running_sum
from ..session import checkpoint_dir
from .daily import sku_daily

# Fixed values of the reference's inventory policy.
ORDER_COST = 50.0          # cost per order
HOLDING_RATE = 0.20        # yearly holding cost as a share of unit cost
Z_SCORE = 1.65             # 95 % service level
LEAD_DAYS = 7              # fixed lead time
EOQ_FALLBACK = 100         # EOQ when demand or holding cost is not positive
ABC_A, ABC_B = "0.7", "0.9"  # cumulative revenue share bounds (inclusive)
DEAD_DAYS = 90             # no sale for more than 90 days -> dead stock
DEFAULT_STOCK = 0
DEFAULT_COST = 10.0
DEFAULT_DEMAND = 5.0
DEFAULT_STD = 2.0
DEMAND_FLOOR = 0.1         # days of supply divides by max(demand, 0.1)
REORDER_FLOOR = 1          # stockout risk divides by max(reorder point, 1)
RISK_HIGH = 0.5            # high-risk SKU for the KPI tile


def demand_stats(txns: DataFrame | None, *, daily: DataFrame | None = None) -> DataFrame:
    """Per SKU -- day span + 1 between first and last sale, average daily
    demand over that span, sample std of daily sums (days with sales only,
    NULL for a single day) and the last sale time.  ``daily`` may pass an
    already computed :func:`sku_daily` table."""
    d = sku_daily(txns) if daily is None else daily
    agg = d.groupBy("sku_id").agg(
        F.min("first_ts").alias("_first"), F.max("last_ts").alias("last_sale"),
        F.sum("daily_qty").alias("total_qty"),
        F.stddev_samp("daily_qty").alias("demand_std"))
    span = elapsed_days("last_sale", "_first") + F.lit(1)
    return agg.select("sku_id", span.alias("date_range"), "total_qty",
                      (F.col("total_qty") / F.greatest(span, F.lit(1))).alias("avg_daily_demand"),
                      "demand_std", "last_sale")


def sku_revenue(txns: DataFrame) -> DataFrame:
    """Revenue per SKU (exact DECIMAL)."""
    return txns.groupBy("sku_id").agg(F.sum("total_amount").alias("revenue"))


def category_revenue(txns: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per category."""
    return (txns.select("sku_id", "total_amount")
                .join(products.select("sku_id", "category"), "sku_id", "left")
                .groupBy("category").agg(F.sum("total_amount").alias("revenue")))


def abc_classes(txns: DataFrame | None, *, a: str = ABC_A, b: str = ABC_B,
                revenue: DataFrame | None = None) -> DataFrame:
    """E4 + I6: cumulative revenue share in descending revenue order (ties by
    sku_id), inclusive; share <= a -> A, <= b -> B, else C.  The running sum is
    distributed (range partitions + broadcast offsets), never one task; the
    comparison is exact integer arithmetic on cents.  ``revenue`` may pass an
    already computed (sku_id, revenue) table."""
    rev = (sku_revenue(txns) if revenue is None else revenue) \
        .withColumn("_cents", (F.col("revenue") * 100).cast("long"))
    cum = running_sum(rev, [F.col("revenue").desc(), F.col("sku_id").asc()], "_cents", "_cum", total_out="_total")
    cumd, totd = F.col("_cum").cast("decimal(19,0)"), F.col("_total").cast("decimal(19,0)")
    share = cumd / totd
    upto = lambda bound: cumd <= totd * F.lit(bound).cast("decimal(9,8)")
    cls = F.when(upto(a), "A").when(upto(b), "B").otherwise("C")
    return cum.select("sku_id", "revenue", share.cast("double").alias("cumulative_share"),
                      cls.alias("abc_class"))


def eoq(avg_daily: Column, unit_cost: Column, *, order_cost=ORDER_COST, hold_rate=HOLDING_RATE) -> Column:
    """Economic order quantity on yearly demand; fallback when not positive."""
    annual = avg_daily * F.lit(365)
    holding = unit_cost * F.lit(hold_rate)
    return F.when((holding > 0) & (annual > 0),
                  F.sqrt(F.lit(2) * annual * F.lit(order_cost) / holding)).otherwise(F.lit(float(EOQ_FALLBACK)))


def safety_stock(demand_std: Column, *, z=Z_SCORE, lead=LEAD_DAYS) -> Column:
    """Z * sd(daily demand) * sqrt(lead time); sd NULL (single day) -> 2.0."""
    return F.lit(z) * F.coalesce(demand_std, F.lit(DEFAULT_STD)) * F.sqrt(F.lit(float(lead)))


def inventory_report(products: DataFrame, inventory: DataFrame, txns: DataFrame, *,
                     as_of=None, lead_days: int | None = LEAD_DAYS, z: float = Z_SCORE,
                     order_cost: float = ORDER_COST, hold_rate: float = HOLDING_RATE, classes: bool = True) -> DataFrame:
    """One row per SKU with reorder quantity, safety stock, reorder point,
    stockout risk, days of supply, ABC class and dead-stock flag.

    ``lead_days=None`` uses each SKU's own supplier_lead_time_days instead of
    the fixed 7 days.  ``as_of`` (default: latest transaction) replaces the
    wall clock for dead-stock ageing.  Without ``classes`` there is no ABC ranking and
    no column for it.
    """
    daily = _sku_days(txns)
    ref = daily.select(F.max("last_ts")).scalar() if as_of is None \
        else F.lit(as_of).cast("timestamp_ntz")
    base = (products.select("sku_id", "cost_price")
            .join(inventory.select("sku_id", "current_stock", "supplier_lead_time_days"), "sku_id", "left")
            .join(_sales(daily) if classes else demand_stats(None, daily=daily).withColumn("abc_class", F.lit(None).cast("string")), "sku_id", "left"))
    out = _decisions(base, ref, lead_days=lead_days, z=z, order_cost=order_cost, hold_rate=hold_rate)
    return out if classes else out.drop("abc_class")


def _sku_days(txns: DataFrame) -> DataFrame:
    """The SKU-day table (far smaller than the lines), written once: statistics,
    ABC ranking and the reference date all read it."""
    checkpoint_dir(txns.sparkSession)
    return sku_daily(txns).drop("daily_txn_count").checkpoint(eager=True)


def _sales(daily: DataFrame) -> DataFrame:
    """Demand statistics and ABC class of every sold SKU."""
    rev = daily.groupBy("sku_id").agg(F.sum("daily_revenue").alias("revenue"))
    return demand_stats(None, daily=daily).join(abc_classes(None, revenue=rev).select("sku_id", "abc_class"), "sku_id", "left")


def _decisions(base: DataFrame, ref: Column, *, lead_days: int | None = LEAD_DAYS, z: float = Z_SCORE,
               order_cost: float = ORDER_COST, hold_rate: float = HOLDING_RATE) -> DataFrame:
    """The policy over SKUs with their cost, stock and sales, each of which may
    be missing and then takes its default."""
    sold = F.col("total_qty").isNotNull()
    stock = F.coalesce(F.col("current_stock"), F.lit(DEFAULT_STOCK))
    cost = F.coalesce(F.col("cost_price").cast("double"), F.lit(DEFAULT_COST))
    avg = F.when(sold, F.col("avg_daily_demand")).otherwise(F.lit(DEFAULT_DEMAND))
    sd = F.when(sold, F.col("demand_std")).otherwise(F.lit(DEFAULT_STD))
    lead = F.lit(float(lead_days)) if lead_days is not None else F.coalesce(F.col("supplier_lead_time_days").cast("double"), F.lit(float(LEAD_DAYS)))
    safety = F.lit(z) * F.coalesce(sd, F.lit(DEFAULT_STD)) * F.sqrt(lead)
    rop = avg * lead + safety
    risk = clip(F.lit(1.0) - stock / F.greatest(rop, F.lit(float(REORDER_FLOOR))), 0.0, 1.0)
    dos = stock / F.greatest(avg, F.lit(DEMAND_FLOOR))
    dead = F.when(sold, elapsed_days(ref, F.col("last_sale")) > F.lit(DEAD_DAYS)).otherwise(F.lit(True))
    return base.select(
        "sku_id",
        stock.cast("int").alias("current_stock"),
        F.bround(eoq(avg, cost, order_cost=order_cost, hold_rate=hold_rate), 0).cast("long")
         .alias("recommended_reorder_qty"),
        F.bround(safety, 0).cast("long").alias("safety_stock"),
        rop.alias("reorder_point"),
        F.bround(risk, 4).alias("stockout_risk"),
        F.bround(dos, 1).alias("days_of_supply"),
        F.coalesce(F.col("abc_class"), F.lit("C")).alias("abc_class"),
        dead.alias("dead_stock"),
    )


def stockout_band(risk) -> Column:
    """Traffic-light band of a stockout risk."""
    r = F.col(risk) if isinstance(risk, str) else risk
    return F.when(r < 0.3, "green").when(r < 0.6, "orange").otherwise("red")


def inventory_kpis(report: DataFrame) -> DataFrame:
    """SKU count, high-risk count (> 0.5), dead-stock count, mean days of supply."""
    return report.agg(F.count(F.lit(1)).alias("sku_count"),
                      F.count_if(F.col("stockout_risk") > RISK_HIGH).alias("high_risk_count"),
                      F.count_if("dead_stock").alias("dead_stock_count"),
                      F.avg("days_of_supply").alias("avg_days_of_supply"))


def abc_membership(products: DataFrame, txns: DataFrame) -> DataFrame:
    """(sku_id, abc_class) of every product; unsold ones are C."""
    return (products.select("sku_id").join(abc_classes(txns).select("sku_id", "abc_class"), "sku_id", "left")
                    .select("sku_id", F.coalesce("abc_class", F.lit("C")).alias("abc_class")))


def abc_summary(report: DataFrame) -> DataFrame:
    """SKUs per ABC class.  Membership stays the keyed (sku_id, abc_class)
    report; a single joined string of all members would grow with the catalog."""
    return report.groupBy("abc_class").agg(F.count(F.lit(1)).alias("sku_count"),
                                            F.min("sku_id").alias("first_sku"),
                                            F.max("sku_id").alias("last_sku"))


def sales_velocity(txns: DataFrame) -> DataFrame:
    """Total quantity per SKU divided by the whole table's day span."""
    span = txns.select(elapsed_days(F.max("timestamp"), F.min("timestamp"))).scalar()
    return (txns.groupBy("sku_id").agg(F.sum("quantity").alias("_q"))
                .select("sku_id", (F.col("_q") / span).alias("velocity")))


def margin_pct(base="base_price", cost="cost_price") -> Column:
    """I8: round((base - cost) / base * 100, 2) in DECIMAL."""
    b, c = F.col(base), F.col(cost)
    return F.round((b - c) / b * F.lit(100), 2)


def capped_cost(base="base_price", cost="cost_price", ratio: str = "0.6") -> Column:
    """A cost at or above the base price is replaced by base * ratio."""
    b, c = F.col(base), F.col(cost)
    return F.when(c >= b, (b * F.lit(ratio).cast("decimal(2,1)")).cast("decimal(12,2)")).otherwise(c)


def product_catalog(products: DataFrame, inventory: DataFrame, txns: DataFrame) -> DataFrame:
    """Gold product catalog (C4, I8, I9): products left-joined to inventory with
    margin_pct and days_of_stock = stock / sales velocity (keyed by sku_id)."""
    vel = sales_velocity(txns)
    return (products.join(inventory, "sku_id", "left").join(vel, "sku_id", "left")
            .withColumn("margin_pct", margin_pct())
            .withColumn("days_of_stock", F.bround(F.col("current_stock") / F.col("velocity"), 1))
            .drop("velocity"))


def lookup_with_defaults(keys: DataFrame, products: DataFrame, inventory: DataFrame, txns: DataFrame) -> DataFrame:
    """The report of requested SKUs; an unknown SKU gets the full record that
    follows from the defaults (cost 10, stock 0, demand 5 a day, deviation 2)."""
    daily = _sku_days(txns)
    base = (keys.select("sku_id").join(products.select("sku_id", "cost_price"), "sku_id", "left")
            .join(inventory.select("sku_id", "current_stock", "supplier_lead_time_days"), "sku_id", "left")
            .join(_sales(daily), "sku_id", "left"))
    return _decisions(base, daily.select(F.max("last_ts")).scalar())


def unknown_keys(keys: DataFrame, table: DataFrame, key: str = "sku_id") -> DataFrame:
    """Requested keys that do not exist (reported instead of substituted)."""
    return keys.select(key).join(table.select(key), key, "left_anti")
