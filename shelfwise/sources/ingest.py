"""Batch ingestion and sinks.

High-water marks live in a one-row-per-table Parquet state folder (not in
driver memory), so an incremental load survives restarts; the filter
``ts > mark`` is a plain predicate and reaches the Parquet scan.
"""
from __future__ import annotations

import json
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.quality import validate_schema  # noqa: F401  (A7 re-export)


def _with_timestamp(df: DataFrame, timestamp_col: str | None) -> DataFrame:
    """The column parsed leniently (bad values -> NULL) unless it is a timestamp already."""
    if not timestamp_col or isinstance(df.schema[timestamp_col].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df
    return df.withColumn(timestamp_col, F.try_to_timestamp(F.col(timestamp_col).cast("string")))


def ingest_csv(spark: SparkSession, path: str, *, schema: T.StructType | str | None = None,
               timestamp_col: str | None = None) -> DataFrame:
    """A1: CSV with header; explicit schema when given, else inference."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return _with_timestamp(r.csv(path), timestamp_col)


def ingest_parquet(spark: SparkSession, path: str, *, timestamp_col: str | None = None) -> DataFrame:
    """A2: Parquet scan; a text timestamp column is parsed leniently."""
    return _with_timestamp(spark.read.parquet(path), timestamp_col)


def ingest_jdbc(spark: SparkSession, url: str, query: str, *, properties: dict | None = None,
                partition_column: str | None = None, lower: int | None = None,
                upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A3: database scan by query text; with a partition column the read is
    split into ``num_partitions`` parallel range queries."""
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
              .option("lowerBound", lower).option("upperBound", upper)
              .option("numPartitions", num_partitions or 8))
    else:
        r = r.option("query", query)
    return r.load()


def ingest_event_batch(spark: SparkSession, messages: list[dict]) -> tuple[DataFrame, DataFrame]:
    """A4: a decoded batch of events (list of dicts, already in the driver),
    validated and split like the stream -> (valid rows, dead letters)."""
    from ..streaming.ingest import decode_events, split_valid
    raw = spark.createDataFrame([(json.dumps(m, default=str),) for m in messages], "value string")
    return split_valid(decode_events(raw))


# ------------------------------------------------------------ watermarks --
def _mark_path(state_dir: str, table: str) -> str:
    return os.path.join(state_dir, f"mark_{table}")


def read_mark(spark: SparkSession, state_dir: str, table: str):
    """Stored high-water mark of ``table`` or None (first load)."""
    try:
        marks = spark.read.parquet(_mark_path(state_dir, table))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":     # no state yet; any other fault must not become a full reload
            return None
        raise
    return marks.agg(F.max("mark")).first()[0]


def incremental(df: DataFrame, ts_col: str, mark) -> DataFrame:
    """Rows strictly newer than the mark (all rows on the first load)."""
    if mark is None:
        return df
    return df.where(F.col(ts_col) > F.lit(mark))


def advance_mark(spark: SparkSession, state_dir: str, table: str, loaded: DataFrame, ts_col: str) -> None:
    """Store max(ts) of what was loaded, never moving the mark backwards."""
    old = read_mark(spark, state_dir, table)
    new = loaded.agg(F.max(ts_col).alias("mark"))
    if old is not None:
        new = new.select(F.greatest(F.col("mark"), F.lit(old)).alias("mark"))
    new.write.mode("append").parquet(_mark_path(state_dir, table))


def ingest_incremental(spark: SparkSession, path: str, table: str, ts_col: str, state_dir: str,
                       *, fmt: str = "parquet", schema: T.StructType | str | None = None) -> DataFrame:
    """Load rows newer than the stored mark.  Call ``advance_mark``
    after the rows are durably written."""
    if fmt == "csv":
        df = ingest_csv(spark, path, schema=schema, timestamp_col=ts_col)
    else:
        df = ingest_parquet(spark, path, timestamp_col=ts_col)
    return incremental(df, ts_col, read_mark(spark, state_dir, table))


# ------------------------------------------------------ published versions --
# A table is a folder of data folders and one of records; a record is a single row in a
# single file that Spark's commit renames into place.  Rows and mark become visible
# together with it, and readers use only folders that a record names.
_RECORD = "n long, folder string, kind string, mark string, row_count long"


def _records(spark: SparkSession, root: str, table: str) -> list:
    """The table's records in order; one row per load, whatever the rows loaded."""
    try:
        return spark.read.schema(_RECORD).parquet(os.path.join(root, table, "records")).orderBy("n").collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def published_mark(spark: SparkSession, root: str, table: str) -> str | None:
    """The newest published record's mark (text form) or None before the first load."""
    marks = [r["mark"] for r in _records(spark, root, table) if r["mark"] is not None]
    return marks[-1] if marks else None


def publish(spark: SparkSession, root: str, table: str, n: int, folder: str, kind: str, mark: str | None, rows: int) -> None:
    """Make a written folder part of the table.  Load ``n`` exists once: a second writer
    of the same number fails instead of publishing beside the first."""
    record = spark.createDataFrame([(n, folder, kind, mark, rows)], _RECORD)
    record.coalesce(1).write.mode("errorifexists").parquet(os.path.join(root, table, "records", f"load={n:012d}"))


def load_published(source: DataFrame, root: str, table: str, ts_col: str | None = None, *, kind: str = "append") -> dict:
    """Write the rows of ``source`` newer than the table's mark and publish rows
    and mark by one record -> {"n", "folder", "mark", "rows"}.  A load that dies before
    its record leaves a folder that nothing names: the next one loads the same rows
    again, and they are there once.  ``kind="replace"`` publishes a full new version."""
    spark = source.sparkSession
    records = _records(spark, root, table)
    old = next((r["mark"] for r in reversed(records) if r["mark"] is not None), None) if kind == "append" else None
    new = source
    if ts_col is not None and old is not None:
        new = source.where(F.col(ts_col) > F.lit(old).cast(source.schema[ts_col].dataType))
    n = (records[-1]["n"] if records else 0) + 1
    folder = os.path.join(root, table, "data", f"v={uuid.uuid4().hex}")
    new.write.parquet(folder)
    wrote = spark.read.schema(source.schema).parquet(folder)
    # what was written, not what the source holds by now
    top = F.max(ts_col).cast("string") if ts_col is not None else F.lit(None).cast("string")
    got = wrote.agg(top.alias("mark"), F.count(F.lit(1)).alias("rows")).first()
    mark = got["mark"] if got["mark"] is not None else old
    publish(spark, root, table, n, folder, kind, mark, got["rows"])
    return {"n": n, "folder": folder, "mark": mark, "rows": got["rows"]}


def read_published(spark: SparkSession, root: str, table: str, *, upto: int | None = None) -> DataFrame:
    """The table as published: the newest full version and the loads since, or as it
    was after load ``upto``."""
    records = [r for r in _records(spark, root, table) if upto is None or r["n"] <= upto]
    if not records:
        raise FileNotFoundError(f"{table}: nothing published under {root}")
    first = max((i for i, r in enumerate(records) if r["kind"] == "replace"), default=0)
    return spark.read.option("mergeSchema", True).parquet(*[r["folder"] for r in records[first:]])


# ------------------------------------------------------------------ sinks --
def write_bronze(df: DataFrame, root: str, table: str, *, version: str | None = None) -> str:
    """A5: write a new versioned directory (a job never overwrites the path
    it reads from)."""
    out = os.path.join(root, table, f"v={version or uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(out)
    return out


def union_append(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """G1: union by column name; columns missing on either side become NULL."""
    return new if old is None else old.unionByName(new, allowMissingColumns=True)


def append_normalised(df: DataFrame, path: str, ts_col: str = "timestamp") -> None:
    """A10: append with lenient timestamp normalisation (bad values -> NULL);
    existing files are never rewritten; readers use ``mergeSchema``."""
    if ts_col in df.columns and not isinstance(df.schema[ts_col].dataType,
                                               (T.TimestampType, T.TimestampNTZType)):
        df = df.withColumn(ts_col, F.try_to_timestamp(F.col(ts_col).cast("string")))
    df.write.mode("append").parquet(path)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def write_silver(df: DataFrame, path: str, *, partition_by: list[str] | None = None) -> None:
    """silver/gold Parquet sinks, optionally partitioned (e.g. month)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# A13, fixed values: names and types of the six result tables.
_RESULT_COLUMNS = {
    "customer_profiles": "id int, customer_id string, age int, region string, segment string, segment_id int, "
                         "rfm_recency double, rfm_frequency double, rfm_monetary double, lifetime_value double, "
                         "churn_probability double, churn_risk_segment string, last_updated timestamp",
    "prediction_logs": "id int, prediction_type string, request_payload string, response_payload string, "
                       "model_version string, mlflow_run_id string, latency_ms double, user_id int, created_at timestamp",
    "demand_forecasts": "id int, sku_id string, store_id string, forecast_date timestamp, predicted_demand double, "
                        "confidence_lower double, confidence_upper double, actual_demand double, mape double, "
                        "created_at timestamp",
    "inventory_snapshots": "id int, sku_id string, store_id string, current_stock int, safety_stock int, "
                           "reorder_qty int, stockout_risk double, abc_class string, dead_stock boolean, "
                           "snapshot_at timestamp",
    "drift_reports": "id int, report_type string, total_features int, drifted_features int, drift_share double, "
                     "psi_score double, action_required boolean, report_path string, created_at timestamp",
    "data_quality_results": "id int, dataset_name string, total_expectations int, passed_expectations int, "
                            "dq_score double, gate_passed boolean, details string, created_at timestamp",
}
_TYPES = {"int": T.IntegerType(), "string": T.StringType(), "double": T.DoubleType(),
          "boolean": T.BooleanType(), "timestamp": T.TimestampType()}
RESULT_SCHEMAS = {name: T.StructType([T.StructField(col, _TYPES[kind]) for col, kind in (c.split() for c in cols.split(", "))])
                  for name, cols in _RESULT_COLUMNS.items()}


def to_result_schema(df: DataFrame, table: str) -> DataFrame:
    """Select-to-schema with casts; absent columns become typed NULLs."""
    cols = []
    for f in RESULT_SCHEMAS[table].fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def append_result(df: DataFrame, root: str, table: str) -> None:
    to_result_schema(df, table).write.mode("append").parquet(os.path.join(root, table))
