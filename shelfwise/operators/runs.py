"""Model-run records as a table.

Training jobs append one row per run (experiment, run id, start time, status,
params, metrics) to a Parquet run table; summaries are ordinary DataFrame
queries over it: latest k runs per experiment (top-k per group), run counts
and latest start, and the long metric table (unpivot of the metrics map).
"""
from __future__ import annotations

import datetime as dt
import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from .explore import top_k_per_group

RUN_SCHEMA = ("experiment string, run_id string, start_time timestamp, status string, "
              "params string, metrics map<string,double>")
LATEST_RUNS = 5


def record_run(spark: SparkSession, runs_path: str, experiment: str, *, params: dict | None = None,
               metrics: dict | None = None, status: str = "FINISHED", run_id: str | None = None) -> str:
    rid = run_id or uuid.uuid4().hex
    row = (experiment, rid, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), status,
           json.dumps(params or {}, sort_keys=True), {k: None if v is None else float(v) for k, v in (metrics or {}).items()})
    spark.createDataFrame([row], RUN_SCHEMA).write.mode("append").parquet(runs_path)
    return rid


def latest_runs(runs: DataFrame, k: int = LATEST_RUNS) -> DataFrame:
    """The k most recent runs of each experiment."""
    return top_k_per_group(runs, "experiment", [F.col("start_time").desc(), F.col("run_id")], k)


def experiment_summary(runs: DataFrame) -> DataFrame:
    """Runs per experiment and the latest start time."""
    return runs.groupBy("experiment").agg(F.count(F.lit(1)).alias("runs"),
                                          F.max("start_time").alias("latest_start"))


def metrics_long(runs: DataFrame) -> DataFrame:
    """One row per (run, metric)."""
    return runs.select("experiment", "run_id", "start_time",
                       F.explode("metrics").alias("metric", "value"))


def retrain_challenger(features: DataFrame, model_dir: str, runs_path: str, *,
                       experiment: str = "churn_challenger") -> DataFrame:
    """Retrain the churn challenger on the latest features, evaluate it on
    the hash holdout, save the model and record the run.  Returns the metrics
    row (auc, f1, n_pos, n_neg, run_id, model_path)."""
    from . import churn as ch
    from ..session import checkpoint_dir
    spark = features.sparkSession
    checkpoint_dir(spark)
    d = ch.holdout(features).checkpoint(eager=True)
    train = ch.class_weights(d.where("is_train"))
    model = ch.train_churn(train, params=ch.CHALLENGER, weighted=True)
    scored = ch.score_churn(model, d.where(~F.col("is_train")))
    a = ch.auc(scored, "churn_probability", "churn").collect()[0]
    f = ch.f1_at(scored, "churn_probability", "churn").collect()[0]
    rid = uuid.uuid4().hex
    path = os.path.join(model_dir, rid)
    model.write().overwrite().save(path)
    record_run(spark, runs_path, experiment, run_id=rid, params=ch.CHALLENGER,
               metrics={"auc": a.auc, "f1": f.f1}   # undefined stays NULL
              )
    return spark.createDataFrame([(a.auc, f.f1, a.n_pos, a.n_neg, rid, path)],
                                 "auc double, f1 double, n_pos long, n_neg long, run_id string, model_path string")
