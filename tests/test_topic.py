"""The topic source over stops and restarts, ingestion budgets and observed counts."""
import json
import os
import tempfile
import threading
import time

import pytest
from pyspark.sql import functions as F

from shelfwise.streaming import ingest as si
from shelfwise.streaming import topic as tp

GOOD = {"transaction_id": "t", "customer_id": "c", "sku_id": "s", "timestamp": "2024-01-01T10:00:00", "quantity": 2, "total_amount": 1.5}


@pytest.fixture
def base():
    return tempfile.mkdtemp(prefix="shelfwise-topic-")


def _messages(a, b, bad=7):
    return [json.dumps({**GOOD, "transaction_id": f"t{i}"}) if i % bad else "{broken" for i in range(a, b)]


def _drain(spark, path, out, ckpt, starting="earliest"):
    q = (tp.topic_source(spark, path, starting_offsets=starting).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    assert q.awaitTermination(120)


def test_read_stop_restart_loses_and_repeats_nothing(spark, base):
    path, out, ckpt = (os.path.join(base, x) for x in ("topic", "out", "ckpt"))
    assert tp.append_messages(path, 0, _messages(0, 30)) == 0
    assert tp.append_messages(path, 0, _messages(30, 55)) == 30
    tp.append_messages(path, 3, ["größe", "", "x"])
    _drain(spark, path, out, ckpt)
    assert spark.read.parquet(out).count() == 58
    _drain(spark, path, out, ckpt)                      # nothing new
    assert spark.read.parquet(out).count() == 58
    tp.append_messages(path, 0, _messages(55, 60))
    tp.append_messages(path, 9, ["late partition"])     # read from its beginning
    _drain(spark, path, out, ckpt, starting="latest")   # the checkpoint counts, not the option
    got = {(r.partition, r.offset): r.value for r in spark.read.parquet(out).collect()}
    want = {(0, i): m for i, m in enumerate(_messages(0, 30) + _messages(30, 55) + _messages(55, 60))}
    want |= {(3, 0): "größe", (3, 1): "", (3, 2): "x", (9, 0): "late partition"}
    assert got == want and spark.read.parquet(out).count() == len(want)
    assert {(r.partition, r.offset): r.value for r in tp.read_topic(spark, path).collect()} == want


def test_start_positions_ranges_and_lost_segments(spark, base, monkeypatch):
    path = os.path.join(base, "topic")
    for a in (0, 10, 20):
        tp.append_messages(path, 1, _messages(a, a + 10))
    _drain(spark, path, f"{base}/o1", f"{base}/c1", json.dumps({"1": 17}))
    assert sorted(r.offset for r in spark.read.parquet(f"{base}/o1").collect()) == list(range(17, 30))
    stream = tp._Stream(path, "latest")
    assert stream.initialOffset() == stream.latestOffset() == {"1": 30}
    parts = stream.partitions({"1": 5}, {"1": 22})
    assert [[(a, b) for _, a, b, _ in p.pieces] for p in parts] == [[(5, 10), (10, 20), (20, 22)]]
    monkeypatch.setattr(tp, "TASK_ROWS", 12)
    parts = stream.partitions({"1": 5}, {"1": 22})
    assert [[(a, b) for _, a, b, _ in p.pieces] for p in parts] == [[(5, 10), (10, 20)], [(20, 22)]]
    again = [b.column("offset").to_pylist() for p in parts for b in stream.read(p)]
    assert [x for b in again for x in b] == list(range(5, 22))          # any range can be read again
    os.rename(tp.segments(path)[1][0][2], os.path.join(base, "gone"))
    with pytest.raises(ValueError, match="not in the topic"):
        stream.partitions({"1": 5}, {"1": 22})
    with pytest.raises(ValueError, match="one line"):
        tp.append_messages(path, 1, ["a\nb"])


def _paths(base):
    return {"bronze_path": f"{base}/bronze", "dlq_path": f"{base}/dlq", "metrics_path": f"{base}/metrics", "checkpoint": f"{base}/ckpt"}


def _feed(path, stop, step=5):
    n = 0
    while not stop.is_set():
        tp.append_messages(path, 0, _messages(n, n + step))
        n += step
        time.sleep(0.5)


def _check_tables(spark, base, totals):
    """Everything written once, and the same counts everywhere."""
    valid, dlq = spark.read.parquet(f"{base}/bronze"), spark.read.parquet(f"{base}/dlq")
    assert valid.select("transaction_id").distinct().count() == valid.count()
    stats = si.session_stats(spark, f"{base}/metrics").first()
    assert (stats.consumed, stats.valid, stats.dlq) == (valid.count() + dlq.count(), valid.count(), dlq.count())
    if totals:
        assert (totals["consumed"], totals["valid"], totals["dlq"], totals["batches"]) == (stats.consumed, stats.valid, stats.dlq, stats.batches)
        assert totals["undecodable"] == totals["dlq"]


def test_message_budget_then_duration_budget(spark, base):
    path, stop = f"{base}/topic", threading.Event()
    feeder = threading.Thread(target=_feed, args=(path, stop))
    feeder.start()
    try:
        got = si.ingest_within(tp.topic_source(spark, path, starting_offsets="earliest"), max_messages=25, max_seconds=90, **_paths(base))
        assert got["stopped"] == "messages" and got["consumed"] >= 25
        _check_tables(spark, base, got)
        before = got["consumed"]
        got = si.ingest_within(tp.topic_source(spark, path), max_seconds=4, **_paths(base))     # goes on from the checkpoint
        assert got["stopped"] == "duration"
        _check_tables(spark, base, None)
        assert si.session_stats(spark, f"{base}/metrics").first().consumed >= before + got["consumed"]
    finally:
        stop.set()
        feeder.join()
    rest = si.ingest_within(tp.topic_source(spark, path), idle_seconds=3, **_paths(base))
    assert rest["stopped"] == "idle"
    _check_tables(spark, base, None)
    assert spark.read.parquet(f"{base}/bronze").count() + spark.read.parquet(f"{base}/dlq").count() == tp.read_topic(spark, path).count()


def test_counts_equal_after_a_replayed_batch(spark, base):
    path = f"{base}/topic"
    tp.append_messages(path, 0, _messages(0, 40))
    counters = si.SessionCounters()
    spark.streams.addListener(counters)
    try:
        q = si.start_ingestion(tp.topic_source(spark, path, starting_offsets="earliest"), **_paths(base))
        assert q.awaitTermination(120)
        si._settled(counters, q)
        _check_tables(spark, base, counters.totals())
        # as after a crash between the batch's files and its commit
        for name in os.listdir(f"{base}/ckpt/commits"):
            os.remove(f"{base}/ckpt/commits/{name}")
        q = si.start_ingestion(tp.topic_source(spark, path, starting_offsets="earliest"), **_paths(base))
        assert q.awaitTermination(120)
        si._settled(counters, q)
        _check_tables(spark, base, counters.totals())
        assert counters.totals()["consumed"] == 40
    finally:
        spark.streams.removeListener(counters)


def test_a_shut_gate_waits_for_the_batch_inside():
    gate, order = si._Gate(), []

    def batch():
        with gate:
            order.append("in")
            time.sleep(0.3)
            order.append("out")
    t = threading.Thread(target=batch)
    t.start()
    while not order:
        time.sleep(0.01)
    gate.shut()
    order.append("shut")
    t.join()
    assert order == ["in", "out", "shut"]
    with pytest.raises(RuntimeError):
        with gate:
            pass
