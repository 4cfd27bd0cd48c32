"""Entity-keyed feature views with a TTL.

* ``latest_snapshot``: newest row per entity inside [as_of - ttl, as_of] --
  an aggregation (``max_by``), so partial aggregation absorbs hot entities.
* ``online_lookup``: requested entity ids left-joined to a snapshot.
* ``point_in_time``: for each (entity, as_of) row, the newest feature row with
  event_ts <= as_of and as_of - event_ts <= ttl.  Implemented as a forward fill
  over the union of both inputs in (entity, time) order -- never a join of an
  entity's rows with its feature rows, whose size would be their product.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.prefix import forward_fill_rows


@dataclass
class FeatureView:
    name: str
    entity: str
    ttl_days: int
    features: list[str]
    source: DataFrame
    event_ts: str = "event_timestamp"
    created_ts: str | None = "created_timestamp"
    tie_break: tuple = ()

    def order_key(self):
        cols = [self.event_ts] + ([self.created_ts] if self.created_ts else []) + list(self.tie_break)
        return F.struct(*[F.col(c) for c in cols])


def _ttl_ok(as_of, event_ts, ttl_days: int):
    return F.timestamp_diff("SECOND", event_ts, as_of) <= F.lit(ttl_days * 86400)


def latest_snapshot(view: FeatureView, *, as_of=None) -> DataFrame:
    """Newest feature row per entity in the TTL window ending at ``as_of``
    (default: newest event time in the source)."""
    src = view.source
    ref = src.select(F.max(view.event_ts)).scalar() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    live = src.where((F.col(view.event_ts) <= ref) & _ttl_ok(ref, F.col(view.event_ts), view.ttl_days))
    payload = F.struct(*[F.col(c) for c in view.features + [view.event_ts]])
    agg = live.groupBy(view.entity).agg(F.max_by(payload, view.order_key()).alias("_p"))
    return agg.select(view.entity, *[F.col(f"_p.{c}").alias(c) for c in view.features + [view.event_ts]])


def online_lookup(entity_ids: DataFrame, snapshot: DataFrame, entity: str) -> DataFrame:
    """One row per requested id; ids without features get NULLs."""
    return entity_ids.select(entity).join(snapshot, entity, "left")


def point_in_time(entity_rows: DataFrame, view: FeatureView, *, as_of_col: str = "as_of") -> DataFrame:
    """As-of join of ``entity_rows`` (entity, as_of, ...) to the view.

    Entity rows and feature rows are unioned and ordered by (entity, time,
    feature rows first at equal time, tie-break columns); one forward-fill pass
    hands every entity row the payload of the newest feature row at or before
    it.  The TTL and same-entity checks are then plain column predicates."""
    key = view.entity
    tiebreak = ([view.created_ts] if view.created_ts else []) + list(view.tie_break)
    pay = [f"_p_{c}" for c in view.features] + ["_p_ts", "_p_key"]
    ent_cols = entity_rows.columns
    src = view.source
    # tie-break columns that are also payload are sorted on their payload copy
    extra_tb = [c for c in tiebreak if c not in view.features]
    f_side = src.select(F.col(key).alias("_k"), F.col(view.event_ts).alias("_t"), F.lit(0).alias("_tag"),
                        *[F.col(c).alias(f"_tb_{c}") for c in extra_tb],
                        *[F.col(c).alias(f"_p_{c}") for c in view.features],
                        F.col(view.event_ts).alias("_p_ts"), F.col(key).alias("_p_key"),
                        *[F.lit(None).cast(entity_rows.schema[c].dataType).alias(f"_e_{c}") for c in ent_cols])
    e_side = entity_rows.select(F.col(key).alias("_k"), F.col(as_of_col).alias("_t"), F.lit(1).alias("_tag"),
                                *[F.lit(None).cast(src.schema[c].dataType).alias(f"_tb_{c}") for c in extra_tb],
                                *[F.lit(None).cast(src.schema[c].dataType).alias(f"_p_{c}") for c in view.features],
                                F.lit(None).cast(src.schema[view.event_ts].dataType).alias("_p_ts"),
                                F.lit(None).cast(src.schema[key].dataType).alias("_p_key"),
                                *[F.col(c).alias(f"_e_{c}") for c in ent_cols])
    both = f_side.unionByName(e_side).withColumn("_is_src", F.col("_tag") == 0)
    order = [F.col("_k"), F.col("_t"), F.col("_tag")] + \
        [F.col(f"_p_{c}") if c in view.features else F.col(f"_tb_{c}") for c in tiebreak]
    filled = forward_fill_rows(both, order, "_is_src", pay)
    rows = filled.where(F.col("_tag") == 1)
    ok = (F.col("_p_key_asof") == F.col("_k")) & _ttl_ok(F.col("_t"), F.col("_p_ts_asof"), view.ttl_days)
    return rows.select(*[F.col(f"_e_{c}").alias(c) for c in ent_cols],
                       *[F.when(ok, F.col(f"_p_{c}_asof")).alias(c) for c in view.features],
                       F.when(ok, F.col("_p_ts_asof")).alias("feature_ts"))


# ---------------------------------------------------------------- the views --
def customer_demographics(customers: DataFrame, baskets: DataFrame) -> FeatureView:
    """Demographics keyed by customer; event time = first purchase (signup proxy)."""
    first = baskets.groupBy("customer_id").agg(F.min("timestamp").alias("event_timestamp"))
    src = customers.join(first, "customer_id", "left").withColumn("created_timestamp", F.col("event_timestamp"))
    return FeatureView("customer_demographics", "customer_id", 3650, ["age", "gender", "segment"], src)


def transaction_features(txns: DataFrame) -> FeatureView:
    src = txns.select("customer_id", "sku_id", "quantity", "discount_applied", "total_amount",
                      "transaction_id", F.col("timestamp").alias("event_timestamp"),
                      F.col("timestamp").alias("created_timestamp"))
    return FeatureView("transaction_features", "customer_id", 365,
                       ["sku_id", "quantity", "discount_applied", "total_amount"], src,
                       # (basket, sku) is not unique: break ties on the whole row
                       tie_break=("transaction_id", "sku_id", "quantity", "discount_applied", "total_amount"))


def rfm_view(serving: DataFrame) -> FeatureView:
    return FeatureView("rfm_features", "customer_id", 30,
                       ["recency", "frequency", "monetary", "churn_risk", "clv_score"], serving)
