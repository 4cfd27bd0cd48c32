"""Alert rules on a stream against the batch rules, over micro-batches and a restart."""
import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfwise.streaming import alerts as al
from shelfwise.streaming import monitors as mo

T0 = dt.datetime(2024, 3, 1, 23, 10)
SCHEMA = "ts timestamp_ntz, event_type string"


def _events():
    """a: steady, then silent for good; b: always there; c: comes late, drops, returns."""
    rnd, rows = random.Random(3), []
    for s in range(0, 3 * 3600, 20):
        rows.append((T0 + dt.timedelta(seconds=s + rnd.random()), "b"))
        if s < 5000:
            rows += [(T0 + dt.timedelta(seconds=s + rnd.random() * 19), "a")] * rnd.randint(1, 3)
        if 2000 < s < 6000 or s > 7600:
            rows += [(T0 + dt.timedelta(seconds=s + rnd.random() * 19), "c")] * (1 if 5000 < s < 5600 else 4)
    return sorted(rows)


def _run(spark, src, out, ckpt):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    q = (al.throughput_alerts(stream, watermark="60 seconds").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    assert q.awaitTermination(240)


def _write(spark, src, rows, name):
    rows = list(rows)
    random.Random(1).shuffle(rows)                  # any order ahead of the watermark
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(os.path.join(src, name))


@pytest.fixture
def rocksdb(spark):
    al.use_rocksdb(spark)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_stream_equals_batch_over_batches_and_a_restart(spark, rocksdb):
    base = tempfile.mkdtemp(prefix="shelfwise-alerts-")
    src, out, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    rows = _events()
    cuts = [0, len(rows) // 4, len(rows) // 2, len(rows) * 3 // 4, len(rows)]
    files = [rows[a:b] for a, b in zip(cuts, cuts[1:])]
    files[1].append((T0 - dt.timedelta(hours=5), "a"))      # far behind the watermark: dropped
    for i in range(2):
        _write(spark, src, files[i], f"f={i}")
    src_glob = src
    _run(spark, src_glob, out, ckpt)
    first = spark.read.parquet(out).count()
    assert first > 0
    for i in (2, 3):
        _write(spark, src, files[i], f"f={i}")
    _run(spark, src_glob, out, ckpt)                # a new query from the same checkpoint
    got = {(r.event_type, r.window_start): (r.n, round(r.rate, 9), round(r.hour_avg_rate, 5), r.drop, r.drop_sustained) for r in spark.read.parquet(out).collect()}
    assert len(got) == spark.read.parquet(out).count() > first

    batch = mo.request_rate(spark.createDataFrame(rows, SCHEMA))
    flags = mo.sustained(mo.throughput_drop(batch), "drop").join(batch.select("event_type", "window_start", "n"), ["event_type", "window_start"])
    end = rows[-1][0] - dt.timedelta(seconds=60 + 300)
    want = {(r.event_type, r.window_start): (r.n, round(r.rate, 9), round(float(r.hour_avg_rate), 5), r.drop, r.drop_sustained)
            for r in flags.where(F.col("window_start") <= F.lit(end).cast("timestamp_ntz")).collect()}
    assert {k: v for k, v in got.items() if k in want} == want
    assert len(got) - len(want) <= 3                # the last window of each series may end on the watermark
    silent = [v for (k, w), v in sorted(got.items()) if k == "a" and w > T0 + dt.timedelta(seconds=5400)]
    assert silent and all(v[0] == 0 for v in silent) and any(v[4] for v in silent)


@pytest.mark.parametrize("held", [1, 3])
def test_spans_need_every_evaluation(held):
    s = al._Series(None)
    for b, n in ((0, 100), (1, 100)):
        s.add(b, n)
    out = list(s.evaluate(30 * 40 + 300, held))
    run = 0
    for _, n, total, made, drop, sustained in out:
        assert drop == (n * made < 0.5 * total)
        run = run + 1 if drop else 0
        assert sustained == (run >= held)
    assert out[0][0] == -9 and not s.buckets and len(s.recent) <= al.LOOKBACK
