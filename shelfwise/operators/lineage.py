"""Lineage event log (M16): metadata rows appended to a Parquet table.

Events carry run id, event type, job, input/output dataset names and row
counts gathered with ``Observation`` on the job's own action, so lineage adds
no extra pass over the data.
"""
from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

EVENT_SCHEMA = ("run_id string, event_type string, job string, namespace string, inputs string, "
                "outputs string, row_counts string, event_time timestamp")


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by whichever action runs ``df``."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def lineage_event(spark: SparkSession, job: str, inputs: list[str], outputs: list[str], *,
                  event_type: str = "COMPLETE", run_id: str | None = None,
                  row_counts: dict | None = None, namespace: str = "shelfwise") -> DataFrame:
    row = (run_id or uuid.uuid4().hex, event_type, job, namespace, json.dumps(inputs),
           json.dumps(outputs), json.dumps(row_counts or {}, sort_keys=True),
           dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    return spark.createDataFrame([row], EVENT_SCHEMA)


def append_event(event: DataFrame, path: str) -> None:
    event.write.mode("append").parquet(path)


def write_with_lineage(df: DataFrame, path: str, job: str, inputs: list[str], log_path: str,
                       *, mode: str = "overwrite", partition_by: list[str] | None = None) -> dict:
    """Write ``df`` and append a START and a COMPLETE (or FAIL) event with the
    observed output row count."""
    spark = df.sparkSession
    run_id = uuid.uuid4().hex
    append_event(lineage_event(spark, job, inputs, [path], event_type="START", run_id=run_id), log_path)
    out, obs = observed(df, f"lineage_{run_id}")
    try:
        w = out.write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
    except Exception:
        append_event(lineage_event(spark, job, inputs, [path], event_type="FAIL", run_id=run_id), log_path)
        raise
    counts = {path: obs.get.get("rows", 0)}
    append_event(lineage_event(spark, job, inputs, [path], run_id=run_id, row_counts=counts), log_path)
    return {"run_id": run_id, "row_counts": counts}
