"""A message topic as a Python data source -- partitions, offsets, start position
and replay, without a connector or a port.

A topic is a folder every executor can reach.  ``<partition>/<first offset>-<count>.jsonl``
holds ``count`` messages, one a line, and is never changed after it was put in place
(a rename), so any offset range can be read again: a micro-batch replayed after a
failure gets the same rows.  The reader's offset is a number per partition; ranges are
read by the executors, in tasks of ``TASK_ROWS`` messages or one segment part at least.

``startingOffsets`` is ``earliest``, ``latest`` or a JSON map of partition to offset
(partitions not named start at their beginning).  It counts until a query's first batch
is committed -- give the same position when that batch is run again; a partition that
appears later is read from its beginning.  Asking for
an offset whose segment is gone is an error, never a silent gap.
"""
from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "segment_topic"
SCHEMA = "partition int, offset long, value string"
ROWS_PER_BATCH = 4096
TASK_ROWS = 100_000
_SEGMENT = re.compile(r"^(\d{20})-(\d+)\.jsonl$")


def segments(path: str) -> dict[int, list[tuple[int, int, str]]]:
    """Partition -> (first offset, end offset, file) in order, from names alone."""
    out: dict[int, list] = {}
    for part in os.listdir(path) if os.path.isdir(path) else ():
        if part.isdigit():
            found = [(m, f) for f in os.listdir(os.path.join(path, part)) if (m := _SEGMENT.match(f))]
            out[int(part)] = sorted((int(m[1]), int(m[1]) + int(m[2]), os.path.join(path, part, f)) for m, f in found)
    return out


def append_messages(path: str, partition: int, messages: list[str]) -> int:
    """Write one segment (one writer per partition); returns its first offset."""
    if any("\n" in m for m in messages):
        raise ValueError("a message is one line")
    folder = os.path.join(path, str(partition))
    os.makedirs(folder, exist_ok=True)
    have = segments(path).get(partition, [])
    first = have[-1][1] if have else 0
    if messages:
        hidden = os.path.join(folder, f".{uuid.uuid4().hex}")
        with open(hidden, "w", encoding="utf-8", newline="\n") as f:
            f.write("".join(m + "\n" for m in messages))
        os.rename(hidden, os.path.join(folder, f"{first:020d}-{len(messages)}.jsonl"))
    return first


class SegmentRun(InputPartition):
    """Successive offset ranges of one partition's segments: (offset of the segment's
    first line, first, end, file)."""

    def __init__(self, partition: int, pieces: list[tuple[int, int, int, str]]):
        self.partition, self.pieces = partition, pieces

    @property
    def rows(self) -> int:
        return sum(end - first for _, first, end, _ in self.pieces)


def _rows(run: SegmentRun) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, str]] = []

    def batch() -> pa.RecordBatch:
        offsets, values = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array([run.partition] * len(held), pa.int32()), pa.array(offsets, pa.int64()), pa.array(values, pa.string())], ["partition", "offset", "value"])
    for base, first, end, file in run.pieces:
        with open(file, encoding="utf-8", newline="\n") as f:
            for offset, line in enumerate(f, base):
                if offset >= end:
                    break
                if offset >= first:
                    held.append((offset, line.rstrip("\n")))
                    if len(held) == ROWS_PER_BATCH:
                        yield batch()
                        held.clear()
    if held:
        yield batch()


def _runs(path: str, start: dict[int, int], end: dict[int, int]) -> list[SegmentRun]:
    have, out = segments(path), []
    for partition, stop in sorted(end.items()):
        at, run = start.get(partition, 0), SegmentRun(partition, [])
        for base, last, file in have.get(partition, []):
            if base <= at < min(last, stop):
                if run.rows >= TASK_ROWS:
                    out.append(run)
                    run = SegmentRun(partition, [])
                run.pieces.append((base, at, min(last, stop), file))
                at = min(last, stop)
        if at < stop:
            raise ValueError(f"partition {partition}: offsets {at} to {stop - 1} are not in the topic any more")
        if run.pieces:
            out.append(run)
    return out


class _Stream(DataSourceStreamReader):
    def __init__(self, path: str, starting: str):
        self.path, self.starting = path, starting

    def _ends(self) -> dict[int, int]:
        return {p: s[-1][1] for p, s in segments(self.path).items() if s}

    def initialOffset(self) -> dict:
        if self.starting == "latest":
            return _named(self._ends())
        return {} if self.starting == "earliest" else _named({int(k): int(v) for k, v in json.loads(self.starting).items()})

    def latestOffset(self) -> dict:
        return _named(self._ends())

    def partitions(self, start: dict, end: dict) -> list[SegmentRun]:
        return _runs(self.path, _numbered(start), _numbered(end))

    def read(self, partition: SegmentRun) -> Iterator[pa.RecordBatch]:
        return _rows(partition)

    def commit(self, end: dict) -> None:
        pass                        # segments stay: another query may read them


class _Batch(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[SegmentRun]:
        found = segments(self.path)
        return _runs(self.path, {p: s[0][0] for p, s in found.items() if s}, {p: s[-1][1] for p, s in found.items() if s})

    def read(self, partition: SegmentRun) -> Iterator[pa.RecordBatch]:
        return _rows(partition) if partition is not None else iter(())


def _named(offsets: dict[int, int]) -> dict:
    return {str(k): v for k, v in sorted(offsets.items())}      # JSON keys are text


def _numbered(offsets: dict) -> dict[int, int]:
    return {int(k): int(v) for k, v in offsets.items()}


class SegmentTopic(DataSource):
    """``spark.readStream.format("segment_topic").option("path", ...)``"""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self.options["path"], self.options.get("startingOffsets", "latest"))

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self.options["path"])


def topic_source(spark: SparkSession, path: str, *, starting_offsets: str = "latest"):
    """The topic under ``path`` as a stream of (partition, offset, value)."""
    spark.dataSource.register(SegmentTopic)
    return spark.readStream.format(NAME).option("path", path).option("startingOffsets", starting_offsets).load()


def read_topic(spark: SparkSession, path: str):
    """All messages of a topic, as a batch."""
    spark.dataSource.register(SegmentTopic)
    return spark.read.format(NAME).option("path", path).load()
