"""Which hashed features of a text do other texts share?  Found without sending
the features' owners around.

Texts are gathered into chunks of about ``chunk_bytes`` by hash (one exchange,
which every later step over the texts reads again).  A chunk announces each of
its features once, as a 24-bit signature in the feature's bucket, so a feature
that a third of all texts have is one entry a chunk; a bucket answers every
chunk with the signatures that some other chunk announced too.  Two features
with one signature in one bucket only make the answer larger than needed.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import U64, shuffle_parts

CHUNK_BYTES = 4 << 20


class TextChunks:
    def __init__(self, docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, by_id: bool = False):
        """``docs`` has doc_id and text.  Rows with equal doc_id are spread over
        chunks, or with ``by_id`` kept in one, which ``chunk_of`` then names."""
        self.parts = shuffle_parts(docs.sparkSession)
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.count = self.buckets = max(2 * self.parts, math.ceil(size / chunk_bytes))
        chunk = self.chunk_of("doc_id") if by_id else F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(self.count))
        self.texts = (docs.select(chunk.alias("chunk"), F.struct(*docs.columns).alias("row"))
                      .repartition(self.parts, "chunk").groupBy("chunk").agg(F.collect_list("row").alias("rows")))

    def chunk_of(self, doc_id: str):
        return F.pmod(F.xxhash64(doc_id), F.lit(self.count))

    def answered(self, answers: DataFrame, *cols: str) -> DataFrame:
        """chunk, rows and the list of its answers (null without any)."""
        lists = answers.groupBy(F.col("chunk").alias("to")).agg(F.collect_list(F.struct(*cols)).alias("answers"))
        return self.texts.join(lists.hint("shuffle_hash"), F.col("chunk") == F.col("to"), "left").select("chunk", "rows", "answers")

    def shared(self, features, heavy: int | None = None) -> DataFrame:
        """chunk, bucket, sigs, hot: what other chunks hold too of ``features(rows)``,
        a function of a chunk's rows to feature hashes, and what is given more
        than ``heavy`` times over all chunks."""
        buckets = self.buckets

        def announce(batches):
            for chunk, rows, _ in chunks(batches):
                keys, times = np.unique(features(rows), return_counts=True)
                bucket, sig = split(keys, buckets)
                times = np.minimum(times, 65535).astype(np.uint16)
                yield by_bucket(chunk, bucket, {"sigs": lambda g: planes(sig[g]), "times": lambda g: b"" if heavy is None else planes(times[g])})
        told = self.texts.mapInArrow(announce, "chunk long, bucket long, sigs binary, times binary")
        return told.groupBy("bucket").applyInArrow(_shared(heavy), "chunk long, bucket long, sigs binary, hot binary")


def _shared(heavy: int | None):
    def run(t: pa.Table) -> pa.Table:
        given = [unplanes([x], np.uint32) for x in t.column("sigs").to_pylist()]
        parts = [np.unique(x) for x in given]
        every, holders = np.unique(np.concatenate(parts), return_counts=True)
        hot = every[:0]
        if heavy is not None:
            total = np.bincount(np.searchsorted(every, np.concatenate(given)), unplanes(t.column("times").to_pylist(), np.uint16), len(every))
            hot = every[total > heavy]
        sigs = every[holders > 1]
        return pa.table({"chunk": t.column("chunk"), "bucket": t.column("bucket"),
                         **{c: pa.array([planes(p[found(x, p)[0]]) for p in parts], pa.binary()) for c, x in (("sigs", sigs), ("hot", hot))}})
    return run


def chunks(batches):
    """(chunk, rows as a struct array, answers) of each chunk in Arrow batches."""
    for b in batches:
        for r in range(b.num_rows):
            answers = b.column("answers")[r].as_py() or [] if "answers" in b.schema.names else []
            yield b.column("chunk")[r].as_py(), b.column("rows").slice(r, 1).flatten(), answers


def split(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, 24-bit signature within it) of feature hashes."""
    return (h >> U64(32)) % U64(buckets), (h & U64(0xFFFFFF)).astype(np.uint32)


def told(answers: list[dict], h: np.ndarray, buckets: int, column: str) -> np.ndarray:
    """Which features the answers name in ``column``."""
    bucket, sig = split(h, buckets)
    known = np.sort(np.concatenate([unplanes([a[column]], np.uint32).astype(U64) | U64(a["bucket"] << 32) for a in answers] or [np.zeros(0, U64)]))
    return found(known, sig.astype(U64) | bucket << U64(32))[0]


def repeated(h: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which features two texts or more (``owner``, ascending) have."""
    order = np.argsort(h, kind="stable")
    a, r = h[order], owner[order]
    new = np.append(True, a[1:] != a[:-1])[:len(a)]
    first = np.flatnonzero(new)
    out = np.zeros(len(h), bool)
    if len(h):
        out[order] = (r[first] != r[np.append(first[1:], len(a)) - 1])[np.cumsum(new) - 1]
    return out


def wanted(answers: list[dict], h: np.ndarray, buckets: int, owner: np.ndarray) -> np.ndarray:
    """Which features other chunks share, or two of the chunk's own texts (``owner``, ascending)."""
    return told(answers, h, buckets, "sigs") | repeated(h, owner)


def found(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is among, where) of keys in a sorted array."""
    at = np.minimum(np.searchsorted(sorted_keys, keys), max(0, len(sorted_keys) - 1))
    return (sorted_keys[at] == keys if len(sorted_keys) else np.zeros(len(keys), bool)), at


def blob(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def unblob(parts, dtype) -> np.ndarray:
    return np.concatenate([np.frombuffer(p, dtype) for p in parts] or [np.zeros(0, dtype)])


def planes(x: np.ndarray) -> bytes:
    """Like ``blob``, first bytes first: equal high bytes compress away."""
    return blob(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T)


def unplanes(parts, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.concatenate([np.ascontiguousarray(np.frombuffer(p, np.uint8).reshape(size, -1).T).view(dtype).ravel() for p in parts] or [np.zeros(0, dtype)])


def by_bucket(chunk: int, bucket: np.ndarray, columns: dict) -> pa.RecordBatch:
    """One row per bucket; ``columns`` are functions of the indexes that fall in it."""
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])) if len(order) else []
    groups = np.split(order, cut[1:]) if len(order) else []
    return pa.RecordBatch.from_arrays([pa.array([chunk] * len(groups), pa.int64()), pa.array([int(bucket[g[0]]) for g in groups], pa.int64()),
                                       *[pa.array([f(g) for g in groups], pa.binary()) for f in columns.values()]], ["chunk", "bucket", *columns])
