"""Stream ingestion of JSON sales events with a dead-letter split.

The record contract is checked with built-in variant functions -- no Python
per row: ``try_parse_json`` decodes (failure -> dead letter with the raw
text), presence of a key is distinguished from a JSON null, and the numeric
coercions follow Python's ``int()`` / ``float()`` on the JSON value's own type
(2.7 -> 2, "3" -> 3, "2.7" -> reject for int, null -> reject).

Each micro-batch is split in ``foreachBatch`` and written to a folder keyed by
the streaming query's id (kept in its checkpoint) and the batch id with
overwrite: a batch replayed after a failure rewrites the same files instead of
duplicating rows, and another query, or a fresh checkpoint that starts at batch
0 again, never touches them.
"""
from __future__ import annotations

import os
import threading
import time

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

# The reference's stream record contract.
REQUIRED_FIELDS = ("transaction_id", "customer_id", "sku_id", "timestamp", "quantity", "total_amount")
INT_FIELDS = ("quantity",)
FLOAT_FIELDS = ("total_amount", "discount_applied")
OPTIONAL_DEFAULTS = {"discount_applied": 0.0}
MICRO_BATCH = 100          # reference micro-batch size (records)

COUNTED = ("consumed", "valid", "dlq", "undecodable")
OBSERVED = "ingest"
STOPPED = "the ingestion was stopped before this batch"

VALID_COLUMNS = ("transaction_id", "customer_id", "sku_id", "timestamp", "quantity", "total_amount",
                 "discount_applied", "_extra")


def _field(v: Column, name: str, typ: str = "variant") -> Column:
    return F.try_variant_get(v, f"$.{name}", typ)


def decode_events(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Decode and validate raw JSON text -> one row per input with the typed
    fields, ``_extra`` (unknown keys as JSON), ``_raw`` and ``_dlq_reason``
    (NULL when valid).  Works on batch and streaming frames alike.

    The text is parsed once into a VARIANT and viewed once as a map of its
    top-level keys (NULL unless it is a JSON object).  A key can be present
    with a JSON null (absent != null).  ``try_variant_get`` to BIGINT/DOUBLE
    follows Python's int()/float() on the JSON value: 2.7 -> 2, " 3 " -> 3,
    "2.7" -> NULL for an integer, null / arrays / objects -> NULL."""
    raw_s = F.col(value_col).cast("string")
    v = F.try_parse_json(raw_s)
    obj = F.try_variant_get(v, "$", "map<string,variant>")
    present = lambda c: F.map_contains_key(obj, F.lit(c))
    reason = F.when(obj.isNull(), F.lit("JSON decode error"))
    for c in REQUIRED_FIELDS:
        reason = reason.when(~present(c), F.lit(f"Missing required field: {c}"))
    for c in INT_FIELDS:
        reason = reason.when(_field(v, c, "bigint").isNull(), F.lit(f"Type cast error: {c} is not an integer"))
    for c in FLOAT_FIELDS:
        bad = _field(v, c, "double").isNull()
        if c in OPTIONAL_DEFAULTS:
            bad = present(c) & bad
        reason = reason.when(bad, F.lit(f"Type cast error: {c} is not a number"))
    known = list(REQUIRED_FIELDS) + list(OPTIONAL_DEFAULTS)
    extra = F.map_filter(obj, lambda k, _: ~k.isin(*known))
    disc = F.when(present("discount_applied"), _field(v, "discount_applied", "double")) \
        .otherwise(F.lit(OPTIONAL_DEFAULTS["discount_applied"]))
    return raw.select(
        _field(v, "transaction_id", "string").alias("transaction_id"),
        _field(v, "customer_id", "string").alias("customer_id"),
        _field(v, "sku_id", "string").alias("sku_id"),
        # lenient parse: an unparseable timestamp is valid and stored as NULL
        F.try_to_timestamp(_field(v, "timestamp", "string")).alias("timestamp"),
        _field(v, "quantity", "bigint").alias("quantity"),
        _field(v, "total_amount", "double").alias("total_amount"),
        disc.alias("discount_applied"),
        F.when(F.cardinality(extra) > 0, F.to_json(extra)).alias("_extra"),
        raw_s.alias("_raw"),
        reason.alias("_dlq_reason"),
    )


def split_valid(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, dead-letter rows with reason and processing time)."""
    valid = decoded.where(F.col("_dlq_reason").isNull()).select(*VALID_COLUMNS)
    dlq = (decoded.where(F.col("_dlq_reason").isNotNull())
                  .withColumn("_dlq_ts", F.current_timestamp()))
    return valid, dlq


def file_source(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None) -> DataFrame:
    """A9 (file variant): each line of the files under ``path`` is one message."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def kafka_source(spark: SparkSession, bootstrap_servers: str, topic: str, *,
                 starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Topic of JSON POS events (needs the Kafka connector on the classpath)."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select(F.col("value").cast("string").alias("value"))


def ingest_counts() -> list[Column]:
    """What is counted of every micro-batch while it is written."""
    reason = F.col("_dlq_reason")
    return [F.count(F.lit(1)).alias("consumed"), F.count_if(reason.isNull()).alias("valid"),
            F.count_if(reason.isNotNull()).alias("dlq"), F.count_if(reason == "JSON decode error").alias("undecodable")]


def write_batch(decoded: DataFrame, batch_id: int, bronze_path: str, dlq_path: str, metrics_path: str,
                query_id: str = "batch") -> None:
    """N2/N5 for one micro-batch.  Outputs land in ``query_id=<id>/batch_id=<n>``
    folders with overwrite, so replaying a batch is idempotent.  The counts are
    observed on the rows that the first write reads; their one-row table is part of
    the batch, so a replay rewrites it too."""
    spark = decoded.sparkSession
    seen = Observation(f"batch-{batch_id}")
    decoded = decoded.persist()          # two sinks, parsed once
    try:
        valid, dlq = split_valid(decoded.observe(seen, *ingest_counts()))[0], split_valid(decoded)[1]
        part = os.path.join(f"query_id={query_id}", f"batch_id={batch_id}")
        valid.write.mode("overwrite").parquet(os.path.join(bronze_path, part))
        dlq.write.mode("overwrite").parquet(os.path.join(dlq_path, part))
        counts = seen.get
        (spark.createDataFrame([tuple(counts[c] for c in COUNTED)], ", ".join(f"{c} long" for c in COUNTED))
              .withColumn("processed_at", F.current_timestamp())
              .write.mode("overwrite").parquet(os.path.join(metrics_path, part)))
    finally:
        decoded.unpersist()


class SessionCounters(StreamingQueryListener):
    """Counts of every batch of one query, as its progress reports the metrics
    observed on the stream; a replayed batch replaces its own entry."""

    def __init__(self) -> None:
        self.batches: dict[tuple[str, int], dict[str, int]] = {}
        self.last_rows = time.monotonic()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(OBSERVED)
        counts = {c: row[c] for c in COUNTED} if row is not None else {}
        with self.changed:
            if counts.get("consumed"):
                self.batches[(str(progress.id), progress.batchId)] = counts
                self.last_rows = time.monotonic()
            self.changed.notify_all()

    def onQueryIdle(self, event) -> None:
        with self.changed:
            self.changed.notify_all()

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.changed.notify_all()

    def totals(self) -> dict[str, int]:
        with self.changed:
            own = list(self.batches.values())
        return {c: sum(b[c] for b in own) for c in COUNTED} | {"batches": len(own)}


class _Gate:
    """Lets batches through one by one until it is shut; shutting waits for the batch
    inside to be written."""

    def __init__(self) -> None:
        self.inside, self.shut_now = threading.Lock(), False

    def __enter__(self) -> "_Gate":
        self.inside.acquire()
        if self.shut_now:               # nothing of this batch is written: it is replayed later
            self.inside.release()
            raise RuntimeError(STOPPED)
        return self

    def __exit__(self, *exc) -> None:
        self.inside.release()

    def shut(self) -> None:
        with self.inside:
            self.shut_now = True


def start_ingestion(source: DataFrame, *, bronze_path: str, dlq_path: str, metrics_path: str,
                    checkpoint: str, trigger: dict | None = None, value_col: str = "value", gate: _Gate | None = None):
    """Start the validated ingestion query.  ``trigger`` defaults to
    ``availableNow`` (drain what is there, then stop); pass
    ``{"processingTime": "1 second"}`` for a continuous poll."""
    decoded = decode_events(source, value_col).observe(OBSERVED, *ingest_counts())
    started, query_id, gate = threading.Event(), [], gate or _Gate()

    def sink(df, batch_id):
        started.wait()          # the query's id is known once start() returns
        with gate:
            write_batch(df, batch_id, bronze_path, dlq_path, metrics_path, query_id[0])

    w = decoded.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    query = w.trigger(**(trigger or {"availableNow": True})).start()
    query_id.append(query.id)
    started.set()
    return query


def ingest_within(source: DataFrame, *, max_messages: int | None = None, max_seconds: float | None = None,
                  idle_seconds: float | None = None, trigger: dict | None = None, **paths) -> dict:
    """Ingest until a budget is spent -- so many messages, so long, or so long
    without one -- then stop after the running batch is written; without a budget,
    until the query ends by itself.  Micro-batches are whole, so the last one may pass
    the message budget.  Returns the session's totals and ``stopped`` (messages,
    duration, idle or end).  The next session goes on from the checkpoint."""
    spark = source.sparkSession
    counters, gate, begun = SessionCounters(), _Gate(), time.monotonic()
    spark.streams.addListener(counters)
    try:
        query = start_ingestion(source, trigger=trigger or {"processingTime": "200 milliseconds"}, gate=gate, **paths)

        def spent() -> str | None:
            if max_messages is not None and counters.totals()["consumed"] >= max_messages:
                return "messages"
            now = time.monotonic()
            if max_seconds is not None and now - begun >= max_seconds:
                return "duration"
            status = query.status
            if status["isDataAvailable"] or status["message"].startswith("Initializing"):
                counters.last_rows = now        # a long batch is not idleness
            elif idle_seconds is not None and now - counters.last_rows >= idle_seconds:
                return "idle"
            return None if query.isActive else "end"
        while not (why := spent()):
            with counters.changed:
                counters.changed.wait(0.1)
        if query.isActive:
            gate.shut()                 # waits for the running batch
            _committed(query)
            query.stop()
        try:
            query.awaitTermination()
        except StreamingQueryException as e:
            if STOPPED not in str(e):   # the shut gate turned a batch away
                raise
        _settled(counters, query)
    finally:
        spark.streams.removeListener(counters)
    return counters.totals() | {"stopped": why}


def _committed(query, seconds: float = 10.0) -> None:
    """Wait until the written batch is in the query's progress, so that the next
    session needn't replay it (a replay would rewrite the same files)."""
    last, until = (query.lastProgress or {}).get("batchId"), time.monotonic() + seconds
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
        if (query.lastProgress or {}).get("batchId") != last:
            return
        time.sleep(0.05)


def _settled(counters: SessionCounters, query, seconds: float = 5.0) -> None:
    """Progress reaches listeners on a thread of its own: wait for the last report."""
    reported = {p["batchId"] for p in query.recentProgress if p["numInputRows"]}
    until = time.monotonic() + seconds
    while reported - {b for _, b in counters.batches} and time.monotonic() < until:
        time.sleep(0.05)


def session_stats(spark: SparkSession, metrics_path: str) -> DataFrame:
    """Consumed / valid / dlq / batches over all recorded micro-batches."""
    m = spark.read.parquet(metrics_path)
    return m.agg(F.sum("consumed").alias("consumed"), F.sum("valid").alias("valid"),
                 F.sum("dlq").alias("dlq"), F.countDistinct("query_id", "batch_id").alias("batches"))


# ---------------------------------------------------------------- fixtures --
def damaged_messages(txns: DataFrame, every: int = 20) -> DataFrame:
    """JSON messages derived from transactions in which every ``every``-th
    record (by a deterministic id expression) is damaged in one of six ways:
    missing field, JSON null, numeric string "2.7", undecodable text, bad
    timestamp (still valid), extra field (still valid)."""
    ts = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    base = txns.select(
        F.col("transaction_id").cast("string").alias("transaction_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("sku_id").cast("string").alias("sku_id"),
        ts.alias("timestamp"), "quantity",
        F.col("total_amount").cast("double").alias("total_amount"),
        F.col("discount_applied").cast("double").alias("discount_applied"),
        F.pmod(F.col("transaction_id") * 31 + F.col("sku_id"), F.lit(every)).alias("_slot"),
        # independent of the slot expression, so all six kinds occur
        F.pmod(F.floor(F.col("transaction_id") / every), F.lit(6)).alias("_kind"))
    cols = ["transaction_id", "customer_id", "sku_id", "timestamp", "quantity", "total_amount",
            "discount_applied"]

    def js(**over):
        fields = [over.pop(c).alias(c) if c in over else F.col(c) for c in cols]
        fields += [val.alias(k) for k, val in over.items()]
        return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})

    good = F.to_json(F.struct(*cols))
    missing = F.to_json(F.struct("transaction_id", "customer_id", "timestamp", "quantity", "total_amount"))
    msg = (F.when(F.col("_slot") != 0, good)
            .when(F.col("_kind") == 0, missing)
            .when(F.col("_kind") == 1, js(quantity=F.lit(None).cast("int")))
            .when(F.col("_kind") == 2, js(quantity=F.lit("2.7")))
            .when(F.col("_kind") == 3, F.concat(F.lit("{bad json "), F.col("transaction_id")))
            .when(F.col("_kind") == 4, js(timestamp=F.lit("not-a-date")))
            .otherwise(js(store=F.lit("S1"))))
    return base.select(msg.alias("value"))
