"""Feature tables stored in buckets of their entity.

Rows are dealt to buckets by the hash that Spark's own exchange uses and sorted by
the entity within, so a lookup or a join on the entity shuffles the requests
alone; the stored side is read where it lies.  The number of buckets follows the
table's size and is a power of two, so that tables of different sizes can still
meet without an exchange (spark.sql.bucketing.coalesceBucketsInJoin).  Every version has a folder of its own, which a record names together
with its layout: readers see the old version or the new one, never a half.
"""
from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import checkpoint_dir

BUCKET_BYTES = 256 * 1024 ** 2     # rows as text, so a bucket's compressed file is smaller
MOST_BUCKETS = 1 << 16             # beyond it buckets grow; each is still read as a sorted stream
_LAYOUT = "n long, folder string, entity string, buckets int, columns string, row_count long"


def bucket_count(n_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Least power of two whose buckets hold at most ``bucket_bytes``."""
    need = max(1, -(-int(n_bytes) // int(bucket_bytes)))
    return min(MOST_BUCKETS, 1 << (need - 1).bit_length())


def text_bytes(df: DataFrame) -> tuple[int, int]:
    """(bytes of all rows as text, rows) in one aggregate."""
    size = F.octet_length(F.to_json(F.struct("*"))).cast("long")
    got = df.agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    return got["bytes"] or 0, got["rows"]


def _layouts(spark: SparkSession, root: str, table: str) -> list:
    try:
        return spark.read.schema(_LAYOUT).parquet(os.path.join(root, table, "layouts")).orderBy("n").collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def _name() -> str:
    return f"bucketed_{uuid.uuid4().hex}"


def write_bucketed(df: DataFrame, root: str, table: str, entity: str, *, bucket_bytes: int = BUCKET_BYTES) -> dict:
    """Store a new version of ``table`` under ``root`` in buckets of ``entity``
    -> {"n", "folder", "buckets", "rows"}.  ``df`` is computed once: measured and
    written from a checkpoint in the shared folder.  Rows without an entity are
    kept; an empty table has one bucket."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    rows = df.checkpoint()
    size, count = text_bytes(rows)
    buckets = bucket_count(size, bucket_bytes)
    layouts = _layouts(spark, root, table)
    n = (layouts[-1]["n"] if layouts else 0) + 1
    folder, scratch = os.path.join(root, table, "data", f"v={uuid.uuid4().hex}"), _name()
    # the exchange deals rows like the buckets do: one file a bucket
    (rows.repartition(buckets, F.col(entity)).write.format("parquet").bucketBy(buckets, entity).sortBy(entity)
     .option("path", folder).saveAsTable(scratch))
    spark.sql(f"DROP TABLE {scratch}")                 # the session's name for it; the files stay
    quoted = ((f.name.replace("`", "``"), f.dataType.simpleString()) for f in df.schema)
    columns = ", ".join(f"`{name}` {kind}" for name, kind in quoted)
    (spark.createDataFrame([(n, folder, entity, buckets, columns, count)], _LAYOUT).coalesce(1)
     .write.mode("errorifexists").parquet(os.path.join(root, table, "layouts", f"load={n:012d}")))
    return {"n": n, "folder": folder, "buckets": buckets, "rows": count}


def read_bucketed(spark: SparkSession, root: str, table: str, *, version: int | None = None) -> DataFrame:
    """The newest version (or version ``version``) with its bucketing known to the
    planner, in this or any later session."""
    layouts = [x for x in _layouts(spark, root, table) if version in (None, x["n"])]
    if not layouts:
        raise FileNotFoundError(f"{table}: no version stored under {root}")
    at, name = layouts[-1], _name()
    folder = at["folder"].replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({at['columns']}) USING parquet CLUSTERED BY (`{at['entity']}`) "
              f"SORTED BY (`{at['entity']}`) INTO {at['buckets']} BUCKETS LOCATION '{folder}'")
    return spark.table(name)
