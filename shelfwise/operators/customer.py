"""Customer-level features: RFM (full and lite), category behaviour, promotion
behaviour, the joined silver table and the serving snapshot."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.exprs import elapsed_days

# Fixed values of the reference's feature definitions.
CHURN_DAYS = 90          # churn = recency > 90
RECENCY_DECAY = 0.01     # recency_decay = exp(-0.01 * recency)
ENTROPY_EPS = 1e-9       # -sum p * log2(p + 1e-9)
CLV_DIVISOR = 1000       # clv_score = monetary * frequency / 1000


def baskets_of(txns: DataFrame) -> DataFrame:
    """Collapse line-grain transactions to one row per (customer, basket).

    Equivalent producer to :func:`shelfwise.sources.views.baskets`; all RFM and
    promo aggregates are decomposable over baskets, so partial aggregation does
    the heavy lifting and no distinct-count expansion is needed.
    """
    d = F.col("discount_applied")
    return txns.groupBy("customer_id", "transaction_id").agg(
        F.max("timestamp").alias("timestamp"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("total_amount").alias("amount_sum"),
        F.max("total_amount").alias("amount_max"),
        F.sum("quantity").alias("qty_sum"),
        F.sum(d).alias("discount_sum"),
        F.max(d).alias("discount_max"),
        F.count_if(d > 0).alias("n_discounted"),
    )


def reference_date(baskets: DataFrame) -> Column:
    """Latest transaction time as a scalar subquery (evaluated once, then a literal)."""
    return baskets.select(F.max("timestamp")).scalar()


def _ref(baskets: DataFrame, ref) -> Column:
    if ref is None:
        return reference_date(baskets)
    return ref if isinstance(ref, Column) else F.lit(ref).cast("timestamp_ntz")


def _latest(agg: DataFrame) -> Column:
    """Latest ``_last`` of a per-customer aggregate as a scalar.  The struct keeps
    every column of the aggregate alive, so the subquery's plan is the very
    aggregate the query runs and reuses its exchange instead of a pass of its own."""
    return agg.select(F.max(F.struct("_last", *[c for c in agg.columns if c != "_last"]))).scalar()["_last"]


def rfm(baskets: DataFrame, *, ref_date=None, frequency_mode: str = "distinct") -> DataFrame:
    """Full RFM per customer (D1).  frequency = distinct baskets ("distinct") or
    line rows ("rows", D2).  recency is whole days from ``ref_date`` (default:
    latest transaction) to the customer's last transaction."""
    freq = F.count(F.lit(1)) if frequency_mode == "distinct" else F.sum("n_lines")
    agg = baskets.groupBy("customer_id").agg(
        F.max("timestamp").alias("_last"),
        freq.alias("frequency"),
        F.sum("amount_sum").alias("monetary"),
        F.sum("n_lines").alias("_lines"),
        F.max("amount_max").alias("max_basket"),
        F.sum("qty_sum").alias("total_qty"),
    )
    ref = _latest(agg) if ref_date is None else _ref(baskets, ref_date)
    rec = elapsed_days(ref, F.col("_last"))
    return agg.select(
        "customer_id",
        rec.alias("recency"),
        F.col("frequency").cast("long").alias("frequency"),
        "monetary",
        (F.col("monetary") / F.col("_lines")).alias("avg_basket"),
        "max_basket",
        F.col("total_qty").cast("long").alias("total_qty"),
        F.exp(F.lit(-RECENCY_DECAY) * rec).alias("recency_decay"),
    )


def basket_features(baskets: DataFrame, *, ref_date=None) -> DataFrame:
    """D1 + D11 fused: full RFM and promo features from ONE aggregation of the
    baskets (both are decomposable over baskets).  The reference date defaults
    to the latest basket, taken from the same per-customer aggregate."""
    agg = baskets.groupBy("customer_id").agg(
        F.max("timestamp").alias("_last"), F.count(F.lit(1)).alias("frequency"),
        F.sum("amount_sum").alias("monetary"), F.sum("n_lines").alias("_lines"),
        F.max("amount_max").alias("max_basket"), F.sum("qty_sum").alias("total_qty"),
        F.sum("discount_sum").alias("_dsum"), F.max("discount_max").alias("max_discount"),
        F.sum("n_discounted").alias("_npos"))
    ref = _latest(agg) if ref_date is None else _ref(baskets, ref_date)
    rec = elapsed_days(ref, F.col("_last"))
    return agg.select(
        "customer_id", rec.alias("recency"), F.col("frequency").cast("long").alias("frequency"), "monetary",
        (F.col("monetary") / F.col("_lines")).alias("avg_basket"), "max_basket",
        F.col("total_qty").cast("long").alias("total_qty"),
        F.exp(F.lit(-RECENCY_DECAY) * rec).alias("recency_decay"),
        (F.col("_dsum") / F.col("_lines")).alias("avg_discount"), "max_discount",
        (F.col("_npos") / F.col("_lines")).alias("discount_txn_ratio"))


def rfm_lite(customers: DataFrame, baskets: DataFrame, *, ref_date=None) -> DataFrame:
    """RFM-lite (D2): recency, frequency = line rows, monetary; every customer
    kept (left join) with missing values filled with 0."""
    r = rfm(baskets, ref_date=ref_date, frequency_mode="rows").select(
        "customer_id", "recency", "frequency", "monetary")
    return (customers.select("customer_id", "age").join(r, "customer_id", "left")
            .select("customer_id", "age",
                    F.coalesce("recency", F.lit(0).cast("long")).alias("recency"),
                    F.coalesce("frequency", F.lit(0).cast("long")).alias("frequency"),
                    F.coalesce("monetary", F.lit(0).cast("decimal(28,2)")).alias("monetary")))


def promo_features(baskets: DataFrame) -> DataFrame:
    """Discount usage per customer (D11): mean and max discount over line rows,
    share of line rows with a discount."""
    agg = baskets.groupBy("customer_id").agg(
        F.sum("discount_sum").alias("_dsum"),
        F.max("discount_max").alias("max_discount"),
        F.sum("n_discounted").alias("_npos"),
        F.sum("n_lines").alias("_n"),
    )
    return agg.select(
        "customer_id",
        (F.col("_dsum") / F.col("_n")).alias("avg_discount"),
        "max_discount",
        (F.col("_npos") / F.col("_n")).alias("discount_txn_ratio"),
    )


def category_features(txns: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct categories, favourite category (mode; ties -> smallest value) and
    Shannon entropy of the category mix per customer (D8-D10).

    Two-level aggregation: (customer, category) counts first -- partial
    aggregation collapses hot customers map-side -- then one row per customer.
    NULL categories count toward nothing (pandas ``nunique``/``value_counts``).
    """
    # products is a dimension keyed by sku_id; AQE picks broadcast only when its
    # runtime size is under the broadcast threshold, sort-merge otherwise.
    lines = txns.select("customer_id", "sku_id").join(
        products.select("sku_id", "category"), "sku_id", "left")
    per_cat = (lines.groupBy("customer_id", "category")
                    .agg(F.count(F.lit(1)).alias("n")))
    known = F.col("category").isNotNull()
    # after the (customer, category) aggregation a customer holds at most one
    # row per category, so this window partition is bounded by the dimension
    tot = F.sum(F.when(known, F.col("n"))).over(Window.partitionBy("customer_id"))
    p = F.col("n") / F.col("_tot")
    agg = (per_cat.withColumn("_tot", tot)
           .groupBy("customer_id").agg(
               F.count_if(known).alias("distinct_categories"),
               F.min(F.when(known, F.struct((-F.col("n")).alias("k"), F.col("category").alias("v"))))
                .getField("v").alias("favourite_category"),
               F.sum(F.when(known, -p * F.log2(p + F.lit(ENTROPY_EPS)))).alias("_ent")))
    return agg.select("customer_id", F.col("distinct_categories").cast("long"),
                      "favourite_category",
                      F.coalesce("_ent", F.lit(0.0)).alias("category_entropy"))


def fill_by_type(df: DataFrame, skip: tuple = ()) -> DataFrame:
    """Type-aware null fill (B4): string columns -> "", numeric columns -> 0."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in skip:
            exprs.append(c)
        elif isinstance(f.dataType, T.StringType):
            exprs.append(F.coalesce(c, F.lit("")).alias(f.name))
        elif isinstance(f.dataType, T.NumericType):
            exprs.append(F.coalesce(c, F.lit(0).cast(f.dataType)).alias(f.name))
        else:
            exprs.append(c)
    return df.select(*exprs)


def churn_flag(recency, days: int = CHURN_DAYS) -> Column:
    """1 when recency exceeds ``days``."""
    r = F.col(recency) if isinstance(recency, str) else recency
    return (r > F.lit(days)).cast("int")


def customer_features(customers: DataFrame, rfm_df: DataFrame, cat_df: DataFrame,
                      promo_df: DataFrame | None = None) -> DataFrame:
    """Silver customer table (C3): customers left-joined to RFM, category and
    promo features on customer_id, nulls filled by type, churn label added.
    Pass ``promo_df=None`` when ``rfm_df`` is :func:`basket_features` (RFM and
    promo from one aggregation).  The feature frames come out of aggregations
    hash-partitioned on customer_id, so the chained joins add no exchange on
    those sides."""
    joined = customers.join(rfm_df, "customer_id", "left").join(cat_df, "customer_id", "left")
    if promo_df is not None:
        joined = joined.join(promo_df, "customer_id", "left")
    filled = fill_by_type(joined, skip=("customer_id",))
    return filled.withColumn("churn", churn_flag("recency"))


def last_sku(txns: DataFrame) -> DataFrame:
    """The customer's most recent SKU, in a defined order (latest timestamp,
    then highest basket id, then highest sku id)."""
    return txns.groupBy("customer_id").agg(
        F.max_by("sku_id", F.struct("timestamp", "transaction_id", "sku_id")).alias("last_sku"))


def serving_features(customers: DataFrame, baskets: DataFrame, txns: DataFrame, *,
                     ref_date=None, as_of=None) -> DataFrame:
    """D3: serving snapshot = customers left-joined to RFM-lite + last SKU, with
    monetary rounded to cents, churn_risk (double), clv_score and event/created
    timestamps (``as_of``, default the reference date, instead of wall clock)."""
    ref = _ref(baskets, ref_date)
    r = rfm(baskets, ref_date=ref, frequency_mode="rows").select(
        "customer_id", "recency", "frequency", F.round("monetary", 2).alias("monetary"))
    r = (r.join(last_sku(txns), "customer_id", "left")
          .withColumn("churn_risk", churn_flag("recency").cast("double"))
          .withColumn("clv_score", F.round(F.col("monetary") * F.col("frequency") / F.lit(CLV_DIVISOR), 4)))
    data = fill_by_type(customers.join(r, "customer_id", "left"), skip=("customer_id",))
    ts = ref if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    return data.withColumn("event_timestamp", ts).withColumn("created_timestamp", ts)
