"""Alert rules on a running stream (N6, N9, N10): one state per series, driven by
event-time timers.

``throughput_alerts`` gives, for every series and every 30 seconds, what the batch
rules give: requests in the trailing five minutes, the average rate over the trailing
hour, whether the rate fell below half of it, and whether that held at every
evaluation of a whole span.  An evaluation is made when the watermark passes its end,
by a timer that each evaluation sets anew -- so a series that has gone silent goes on
being evaluated at rate 0, and a span elapses without new events, as long as any
series moves the watermark.

A series' state is bounded: the counts of its 30-second buckets that later windows
can still reach, the last hour's window counts and the length of the current breach.
Events behind the watermark are dropped; events in any order ahead of it count.
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

from .monitors import DROP_FACTOR, DROP_LOOKBACK_S, RATE_STEP_S, RATE_WINDOW_S, WINDOWS_PER_EVENT

LOOKBACK = DROP_LOOKBACK_S // RATE_STEP_S + 1       # evaluations of a trailing hour
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE = "next long, breach int, buckets array<struct<b:long,n:long>>, recent array<long>"
_OUT = "{key} string, window_start timestamp, n long, rate double, hour_avg_rate double, drop boolean, drop_sustained boolean"


class _Series:
    """Window counts of one series, evaluation by evaluation."""

    def __init__(self, state):
        self.next, self.breach = (state[0], state[1]) if state else (None, 0)
        self.buckets = {r[0]: r[1] for r in state[2]} if state else {}
        self.recent = list(state[3]) if state else []

    def add(self, bucket: int, n: int) -> None:
        self.buckets[bucket] = self.buckets.get(bucket, 0) + n
        first = bucket - WINDOWS_PER_EVENT + 1      # the series' first window holds its first event last
        if self.next is None or not self.recent and first < self.next:
            self.next = first

    def due(self) -> int:
        """End of the next window, in seconds."""
        return self.next * RATE_STEP_S + RATE_WINDOW_S

    def evaluate(self, until: float, held: int) -> Iterator[tuple]:
        """(window start, n, hour total, evaluations, drop, sustained) of every window
        that ended by ``until`` (seconds)."""
        while self.due() <= until:
            w = self.next
            n = sum(self.buckets.get(b, 0) for b in range(w, w + WINDOWS_PER_EVENT))
            self.recent = [*self.recent[-(LOOKBACK - 1):], n]
            total, made = sum(self.recent), len(self.recent)
            drop = n * made < DROP_FACTOR * total
            self.breach = min(self.breach + 1, held) if drop else 0
            yield w, n, total, made, drop, self.breach >= held
            self.buckets.pop(w, None)               # no later window holds it
            self.next = w + 1

    def row(self) -> tuple:
        return self.next, self.breach, sorted(self.buckets.items()), self.recent


class ThroughputProcessor(StatefulProcessor):
    """Keeps ``_Series`` per key; evaluates on timers only."""

    def __init__(self, key: str, seconds: int):
        self.key, self.held = key, seconds // RATE_STEP_S + 1

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("series", _STATE)

    def _read(self) -> _Series:
        return _Series(self.state.get() if self.state.exists() else None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        series, passed = self._read(), timerValues.getCurrentWatermarkInMs() * 1000
        for part in rows:
            at = part["ts"].astype("datetime64[us]").astype("int64")
            # Spark holds late rows against the watermark of a batch ago
            for bucket, n in (at[at >= passed] // 1_000_000 // RATE_STEP_S).value_counts().items():
                series.add(int(bucket), int(n))
        if series.next is None:
            return iter(())
        self.state.update(series.row())
        self.handle.registerTimer(series.due() * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        series = self._read()
        made = list(series.evaluate(timerValues.getCurrentWatermarkInMs() / 1000, self.held))
        self.state.update(series.row())
        self.handle.registerTimer(series.due() * 1000)
        if made:
            w, n, total, count, drop, held = zip(*made)
            yield pd.DataFrame({self.key: [key[0]] * len(made), "window_start": pd.to_datetime([x * RATE_STEP_S for x in w], unit="s"), "n": n, "rate": [x / RATE_WINDOW_S for x in n],
                                "hour_avg_rate": [round(t / (c * RATE_WINDOW_S), 6) for t, c in zip(total, count)], "drop": drop, "drop_sustained": held})

    def close(self) -> None:
        pass


def throughput_alerts(events: DataFrame, *, key: str = "event_type", seconds: int = 300, watermark: str = "0 seconds") -> DataFrame:
    """N6 + N9 + N10 on a stream of events (``ts``, ``key``): one row per series and
    30-second evaluation, emitted once the watermark passes the window's end.  The
    session's state store must be RocksDB (``use_rocksdb``)."""
    timed = events.select(F.col(key).cast("string").alias(key), F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", watermark)
    return timed.groupBy(key).transformWithStateInPandas(ThroughputProcessor(key, seconds), _OUT.format(key=key), "append", "EventTime")


def use_rocksdb(spark: SparkSession) -> None:
    """Timers need a state store with several column families."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)
