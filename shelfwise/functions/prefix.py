"""Running sums and forward fills over a global total order.

A window with ``orderBy`` and no ``partitionBy`` moves every row into one task.
Here the rows are range-partitioned on the ordering keys (hot values and ties
spread by the trailing keys) and checkpointed with their range number, a window
inside each range does the local work, and the ranges' summaries -- one row
each -- get their own running sum and are joined back on the range number.
Everything is a native expression, nothing is collected, and the plan has the
same size for any number of ranges.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from ..session import checkpoint_dir

RANGE_ROWS = 1 << 17    # a task sorts one range, or the few that share its hash, however large the input

_INTEGRAL = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)


def _ranged(df: DataFrame, order_cols: list, num_partitions: int | None) -> DataFrame:
    """``df`` with its range number ``_range``.  Checkpointed: the ranges of a
    recomputed exchange could differ between the summaries and the rows."""
    checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(num_partitions, *order_cols) if num_partitions else df.repartitionByRange(*order_cols)
    return ranged.withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)


def range_count(df: DataFrame, range_rows: int = RANGE_ROWS) -> int:
    """The session's number of shuffle partitions, or more where their ranges
    would hold over ``range_rows`` rows."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // range_rows))


def running_sum(df: DataFrame, order_cols: list, value_col, out_col,
                num_partitions: int | None = None, lead_col=None, lead_out=None, total_out=None) -> DataFrame:
    """Inclusive running sums of integral or double columns in the total order
    given by ``order_cols`` (which must break all ties).  ``value_col`` and
    ``out_col`` are a name or equally long lists of names.  Returns ``df`` plus
    the output columns (long for integral inputs, double otherwise).  With
    ``lead_col`` (name or list), ``lead_out`` holds the next row's values in
    the same global order (NULL after the last row).  ``total_out`` (name or list)
    adds the sums over all rows, from the ranges' totals: no second pass."""
    vals = [value_col] if isinstance(value_col, str) else list(value_col)
    outs = [out_col] if isinstance(out_col, str) else list(out_col)
    totals = [] if total_out is None else ([total_out] if isinstance(total_out, str) else list(total_out))
    leads = [] if lead_col is None else ([lead_col] if isinstance(lead_col, str) else list(lead_col))
    louts = [] if not leads else ([lead_out] if isinstance(lead_out, str) else list(lead_out))
    zero = [F.lit(0).cast("bigint" if isinstance(df.schema[v].dataType, _INTEGRAL) else "double") for v in vals]
    num = [F.coalesce(F.col(v).cast("bigint" if isinstance(df.schema[v].dataType, _INTEGRAL) else "double"), z)
           for v, z in zip(vals, zero)]
    inside = W.partitionBy("_range").orderBy(*order_cols)
    upto = inside.rowsBetween(W.unboundedPreceding, 0)
    local = _ranged(df, order_cols, num_partitions).select(
        "*", *[F.sum(x).over(upto).alias(f"_local{j}") for j, x in enumerate(num)],
        F.row_number().over(inside).alias("_nth"),
        *[F.lead(F.struct(c)).over(inside).alias(f"_next{i}") for i, c in enumerate(leads)])
    # one row per range: the window over them is one small task
    ranges = local.groupBy("_range").agg(*[F.sum(x).alias(f"_total{j}") for j, x in enumerate(num)],
                                         *[F.min_by(F.struct(c), "_nth").alias(f"_head{i}") for i, c in enumerate(leads)])
    by_range = W.orderBy("_range")
    before = by_range.rowsBetween(W.unboundedPreceding, -1)
    every = by_range.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranges = ranges.select("_range", *[F.coalesce(F.sum(f"_total{j}").over(before), z).alias(f"_before{j}") for j, z in enumerate(zero)],
                           *[F.sum(f"_total{j}").over(every).alias(f"_all{j}") for j in range(len(totals))],
                           *[F.lead(f"_head{i}").over(by_range).alias(f"_after{i}") for i in range(len(leads))])
    out = local.join(ranges, "_range")
    return out.select(*df.columns, *[(F.col(f"_local{j}") + F.col(f"_before{j}")).alias(o) for j, o in enumerate(outs)],
                      *[F.col(f"_all{j}").alias(o) for j, o in enumerate(totals)],
                      *[F.coalesce(f"_next{i}", f"_after{i}")[c].alias(lo) for i, (c, lo) in enumerate(zip(leads, louts))])


def forward_fill_rows(df: DataFrame, order_cols: list, is_source: str, payload: list[str],
                      num_partitions: int | None = None, suffix: str = "_asof") -> DataFrame:
    """As-of carry of whole rows: every row receives the ``payload`` columns of
    the last row at or before it (global order ``order_cols``) whose boolean
    ``is_source`` is true; NULLs before the first source row.  Adds
    ``<col><suffix>`` for every payload column.  The number of ranges, and of the
    tasks over them, follows the rows (``range_count``)."""
    num_partitions = num_partitions or range_count(df)
    inside = W.partitionBy("_range").orderBy(*order_cols)
    own = F.when(F.col(is_source), F.struct(*payload))
    local = _ranged(df, order_cols, num_partitions).repartition(num_partitions, "_range").select(
        "*", F.last(own, ignorenulls=True).over(inside.rowsBetween(W.unboundedPreceding, 0)).alias("_carried"),
        F.row_number().over(inside).alias("_nth"))
    # one row per range, carried over ranges without a source row
    ranges = local.groupBy("_range").agg(F.max_by("_carried", "_nth").alias("_last"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.select("_range", F.last("_last", ignorenulls=True).over(before).alias("_earlier"))
    held = F.coalesce("_carried", "_earlier")
    return local.join(ranges, "_range", "left").select(*df.columns, *[held[c].alias(f"{c}{suffix}") for c in payload])
