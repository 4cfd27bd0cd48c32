"""Document fingerprints: improbable-feature digests in chained Bloom filters.

Every window of ``WINDOW`` bytes gets the Shannon entropy of its bytes and from
it a rank: windows whose entropy is far from what text usually has (``TYPICAL``
of the most a window can have) are rarer and come first; constant windows never
do.  A window that is the first of lowest rank in ``POPULAR`` or more of the
runs of ``WINDOW`` windows around it is selected.  Selected windows are hashed
into a chain of 2048-bit Bloom filters, five bits each, a new filter after
``PER_FILTER``.  Texts too short for a run of windows also insert all their
windows of eight bytes (or the whole text, if shorter still).  The rank depends
on the window alone, so equal texts have equal digests in any corpus and an edit
moves only features within two windows of it.

Two digests are compared filter by filter: shared bits, less those expected by
chance, over the bits of the emptier filter less the same; each filter of the
shorter digest takes its best partner in the other, and the mean is the
likeness (0 to 1).  Two empty digests are alike, an empty and another are not.

Neighbours in doc_id order come from one range exchange: the bounds are
quantiles, each range also receives a copy of the following range's first row,
and a task reads its range in order.  Defined cases: a null text is empty; rows
with a null doc_id come first and rows with equal ids in the order of their
text's hash; a lone document is its own neighbour; an empty table gives an empty
result; other input columns are ignored.
"""
from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import U64, mix, quantiles, range_bucket, raw_bytes, saved, shuffle_parts, sliding_min

WINDOW = 32
POPULAR = 8
PER_FILTER = 128
FILTER_BITS = 2048
HASHES = 5
TYPICAL = 0.7
RUN_BYTES = 1 << 19
_SHORT = 8
_UNIT = 1 << 20                                   # entropies are exact sums of whole units
_NLOGN = np.array([0] + [round(c * np.log2(c) * _UNIT) for c in range(1, WINDOW + 1)], np.int64)
_MAX = int(_NLOGN[WINDOW])


# the sum's change when a byte leaves that has c equals left, or enters to c equals
_LEAVE = _NLOGN[:-1] - _NLOGN[1:]
_ENTER = -_LEAVE


def _deficits(data: np.ndarray) -> np.ndarray:
    """Sum of c log c over the byte counts c of every window: its entropy is
    (_MAX - sum) / WINDOW.  Moving a window by a byte changes two counts, and
    those are numbers of equal bytes close ahead and behind."""
    n = len(data)
    ahead, behind = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for step in range(1, WINDOW):
        same = (data[step:] == data[:-step]).view(np.uint8)
        ahead[:-step] += same
        behind[step:] += same
    out = np.empty(n - WINDOW + 1, np.int64)
    out[0] = _NLOGN[np.bincount(data[:WINDOW])].sum()
    # the window [i, i + WINDOW) loses byte i, then gains byte i + WINDOW
    out[1:] = _LEAVE[ahead[:n - WINDOW]]
    out[1:] += _ENTER[behind[WINDOW:]]
    return np.cumsum(out, out=out)


def _hash(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    rows = np.ascontiguousarray(data[at[:, None] + np.arange(size)]).view("<u8")
    h = np.full(len(at), size, U64)
    for j in range(rows.shape[1]):
        h = mix(h * U64(0x9E3779B97F4A7C15) + rows[:, j])
    return h


_NEVER = 2000 << 32
_RANK = (1000 - np.abs(np.arange(1001) - round(1000 * TYPICAL))).astype(np.int64) << 32
_RANK[:100] = _NEVER


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of the selected features, in order of position."""
    texts, hashes = [], []
    size = np.diff(off)
    n = len(data)
    if n >= 2 * WINDOW:
        level = (1000 - _deficits(data) * (1000 / _MAX)).astype(np.int32)     # entropy in thousandths of the most
        key = _RANK[level] + np.arange(len(level))            # ties: the first
        low = sliding_min(key, WINDOW)
        within = np.ones(len(low), bool)                      # runs of windows within one text
        for end in off[1:-1].tolist():
            within[max(0, end - 2 * WINDOW + 2):end] = False
        times = np.bincount(low[within] & 0xFFFFFFFF, minlength=len(key))
        at = np.flatnonzero(times >= POPULAR)
        at = at[key[at] < _NEVER]
        hashes.append(_hash(data, at, WINDOW))
        texts.append(np.searchsorted(off, at, "right") - 1)
    for t in np.flatnonzero((size > 0) & (size < 4 * WINDOW)):
        own = data[off[t]:off[t + 1]]
        if len(own) < _SHORT:
            own = np.concatenate([own, np.zeros(_SHORT - len(own), np.uint8)])
        h = _hash(own, np.arange(len(own) - _SHORT + 1), _SHORT)
        hashes.append(h)
        texts.append(np.full(len(h), t))
    if not hashes:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    text, h = np.concatenate(texts), np.concatenate(hashes)
    order = np.argsort(text, kind="stable")
    return text[order], h[order]


class Digest:
    """Chained filters: (filters, FILTER_BITS / 8) bytes and elements of each."""

    def __init__(self, h: np.ndarray):
        _, first = np.unique(h, return_index=True)            # a feature enters once
        h = h[np.sort(first)]
        k = -(-len(h) // PER_FILTER)
        bits = np.zeros((k, FILTER_BITS), bool)
        chain = np.arange(len(h)) // PER_FILTER
        for j in range(HASHES):
            bits[chain, ((h >> U64(11 * j)) & U64(FILTER_BITS - 1)).astype(np.int64)] = True
        self.filters = np.packbits(bits, axis=1)
        self.count = np.bincount(chain, minlength=k)

    def text(self) -> str:
        return "" if not len(self.count) else f"{int(self.count[-1])}:" + base64.b64encode(self.filters.tobytes()).decode()


_ONES = np.array([bin(i).count("1") for i in range(256)], np.int64)


def likeness(a: Digest, b: Digest) -> float:
    if len(a.count) > len(b.count):
        a, b = b, a
    if not len(a.count):
        return float(not len(b.count))
    if len(a.count) == len(b.count) and (a.filters == b.filters).all():
        return 1.0
    left, right = _ONES[a.filters].sum(1), _ONES[b.filters].sum(1)
    total = 0.0
    for i in range(len(a.count)):
        shared = _ONES[a.filters[i] & b.filters].sum(1)
        chance = left[i] * right / FILTER_BITS
        least = np.minimum(left[i], right)
        total += max(0.0, float(((shared - chance) / np.maximum(least - chance, 1e-9)).max()))
    return min(1.0, total / len(a.count))


def digests(texts: list[bytes]) -> list[Digest]:
    """Digests of texts, computed over runs of them side by side."""
    out, i = [], 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= RUN_BYTES):
            size += len(texts[j])
            j += 1
        data = np.frombuffer(b"".join(texts[i:j]), np.uint8)
        off = np.append(0, np.cumsum([len(t) for t in texts[i:j]])).astype(np.int64)
        text, h = features(data, off)
        cut = np.searchsorted(text, np.arange(j - i + 1))
        out.extend(Digest(h[cut[k]:cut[k + 1]]) for k in range(j - i))
        i = j
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every row."""
    def run(batches):
        for b in batches:
            data, off = raw_bytes(b.column("text"))
            raw = data.tobytes()
            got = digests([raw[s:e] for s, e in zip(off[:-1], off[1:])])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([d.text() for d in got], pa.string())], ["doc_id", "fingerprint"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame) -> DataFrame:
    """(part, doc_id, text, tail): ranges of rows in doc_id order, each ended by
    a copy (tail) of the row that follows it, the last by the first row."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = shuffle_parts(spark)
    # more ranges than tasks, so that a task's several ranges even out
    part = F.when(F.col("doc_id").isNull(), 0).otherwise(range_bucket(F.col("doc_id"), quantiles(rows, "doc_id", 4 * parts)))
    rows = rows.withColumn("part", part)
    # first row of every range: found by id alone, then read with its text (equal ids: by hash of the text)
    heads = rows.groupBy("part").agg(F.min("doc_id").alias("low"), F.count_if(F.col("doc_id").isNull()).alias("nulls"))
    by_part = W.orderBy("part")                   # one row per range
    heads = saved(spark, heads.select(F.col("part").alias("at"), F.when(F.col("nulls") == 0, F.col("low")).alias("low"),
                                      F.coalesce(F.lag("part").over(by_part), F.max("part").over(by_part.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("before")), "heads")
    copies = (rows.join(heads, (F.col("part") == F.col("at")) & F.col("doc_id").eqNullSafe(F.col("low")))
              .groupBy(F.col("before").alias("part")).agg(F.min(F.struct(F.xxhash64("text").alias("tie"), "doc_id", "text")).alias("m"))
              .select("part", "m.doc_id", "m.text", F.lit(True).alias("tail")))
    both = rows.select("part", "doc_id", "text", F.lit(False).alias("tail")).unionByName(copies)
    return both.repartition(parts, "part").sortWithinPartitions("part", "tail", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many first ones of the next text."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def compared(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def solve(held):
        """All but the last of successive rows; a tail is only read as the next."""
        texts = [t for _, _, t, _ in held]
        own = digests([t.encode() for t in texts])
        use = [i for i in range(len(held) - 1) if not held[i][3]]
        new = [edited(texts[i], texts[i + 1]).encode() for i in use]
        rows = []
        for i, raw, e in zip(use, new, digests(new)):
            rows.append((held[i][1], len(texts[i]), hashlib.sha256(raw).hexdigest(), own[i].text(), e.text(), likeness(own[i], e), likeness(own[i], own[i + 1])))
        if rows:
            cols = list(zip(*rows))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            for row in zip(b.column("part").to_pylist(), b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("tail").to_pylist()):
                held.append(row)
                size += len(row[2])
                if size > 4 * RUN_BYTES and len(held) > 1:
                    yield from solve(held)
                    held, size = held[-1:], len(row[2])
        yield from solve(held)
    return with_next(docs).mapInArrow(run, schema)
