"""Contiguous shards of near-equal byte size, by global prefix sums.

Rows are put in the order of doc_id over range partitions; each partition's
total is summed, the totals' running sum gives what lies before a partition,
and a window inside each partition the rest.  A row goes to the shard in whose
equal share of all bytes its middle lies, so shards are contiguous in doc_id
order and differ from an equal share by less than one row's size at each cut.
The text itself is never shuffled.  Built-in functions only.

Defined cases: a null text has size 1 and CRC zero, like an empty one; null
doc_ids come first; rows with equal doc_id (a hot id may hold a third of all)
spread over range partitions by their place in the input; an empty table gives
an empty result; other input columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from .common import saved, shuffle_parts

SHARDS = 16


def byte_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.monotonically_increasing_id().alias("tie"))
    # written once: the ranges of a recomputed exchange could differ
    rows = saved(spark, rows.repartitionByRange(shuffle_parts(spark), "doc_id", "tie").withColumn("part", F.spark_partition_id()), "sizes")
    totals = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    # one row per range partition: the running sum over them is one small task
    upto = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    every = W.orderBy("part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    totals = saved(spark, totals.select("part", F.coalesce(F.sum("bytes").over(upto), F.lit(0)).alias("bytes_before"),
                                        F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("rows_before"), F.sum("bytes").over(every).alias("total")), "totals")
    inside = W.partitionBy("part").orderBy("doc_id", "tie")
    placed = (rows.join(totals, "part")
              .withColumn("before", F.col("bytes_before") + F.sum("size").over(inside) - F.col("size"))
              .withColumn("rank", F.col("rows_before") + F.row_number().over(inside) - 1)
              .withColumn("shard", F.expr(f"cast(least({shards - 1}, (2 * before + size) * {shards} div (2 * total)) as int)")))
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(first, "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot"))
