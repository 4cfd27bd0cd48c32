"""The feature-table job: bronze views -> silver customer and daily SKU
tables -> gold product catalog, each written with lineage events (A11).

Each output is a lazy DataFrame until its writer runs; the daily table is
partitioned by month so downstream readers prune by date.
"""
from __future__ import annotations

import os

from pyspark.sql import SparkSession, functions as F

from ..operators import customer as cu
from ..operators import daily as dl
from ..operators import forecast as fc
from ..operators import inventory as inv
from ..operators.lineage import write_with_lineage
from ..sources import views as v


def build_feature_tables(spark: SparkSession, root: str, out_dir: str) -> dict:
    """Write silver/customer_features, silver/daily_sku_features (by month)
    and gold/product_catalog, gold/demand_forecast under ``out_dir``; returns output row counts."""
    log = os.path.join(out_dir, "_lineage")
    b = v.baskets(spark, root)
    t = v.transactions(spark, root)
    customers = cu.customer_features(v.customers(spark, root), cu.basket_features(b),
                                     cu.category_features(t, v.products(spark, root)))
    daily = dl.timeseries_features(t).withColumn("month", F.date_format("date", "yyyy-MM"))
    # a task writes ranges of (month, sku): few files a month while it is small, and as many
    # tasks a month as its share of the rows asks for; AQE sizes the ranges by bytes
    daily = daily.repartitionByRange("month", "sku_id")
    platform = dl.platform_daily(t).select(F.lit("platform").alias("series"), "ds", "y")
    demand = fc.forecast(platform, ["series"], monthly=True).drop("series")
    catalog = inv.product_catalog(v.products(spark, root), v.inventory(spark, root), t)
    inputs = [f"{root}/{n}.parquet" for n in ("lineitem", "orders", "customer", "nation", "part")]
    out = {}
    for name, df, parts in (("silver/customer_features", customers, None),
                            ("silver/daily_sku_features", daily, ["month"]),
                            ("gold/product_catalog", catalog, None),
                            ("gold/demand_forecast", demand, None)):
        info = write_with_lineage(df, os.path.join(out_dir, name), name, inputs, log, partition_by=parts)
        out[name] = next(iter(info["row_counts"].values()))
    return out
