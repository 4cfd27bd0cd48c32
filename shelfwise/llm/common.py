"""Shared helpers of the training-data operators.

Texts reach Python tasks as Arrow string columns.  ``slices`` cuts a column
into runs of whole rows of about ``limit`` bytes, so that the byte-level numpy
arrays of one run stay small however many rows an Arrow batch carries (a
single longer text is a run of its own).  Null texts count as empty.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.session import checkpoint_dir

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a small intermediate table to the shared checkpoint folder and
    read it back: later passes neither recompute it nor depend on the executors
    that made it."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_column(col: pa.Array) -> pa.Array:
    """The column as large_string without nulls."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return pc.fill_null(col.cast(pa.large_string()), "")


def raw_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column: row i is data[off[i]:off[i + 1]]."""
    col = text_column(col)
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(col: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of successive runs of whole rows."""
    data, off = raw_bytes(col)
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the word."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_MUL, _INV = U64(0x9E3779B97F4A7C15), U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))
_pow: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow.get("up", ())) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        for name, base in (("up", _MUL), ("down", _INV)):
            f = np.full(size, base, U64)
            f[0] = 1
            _pow[name] = np.multiply.accumulate(f)
    return _pow["up"][:n], _pow["down"][:n]


ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True
WORD_BYTE = np.zeros(256, bool)          # letters, digits and every non-ASCII byte
WORD_BYTE[128:] = True
for _a, _b in (("0", "9"), ("A", "Z"), ("a", "z")):
    WORD_BYTE[ord(_a):ord(_b) + 1] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """Words of a run of texts: start and end byte, text index, hash."""

    def __init__(self, data: np.ndarray, off: np.ndarray, in_word: np.ndarray = WORD_BYTE, hashes: bool = True):
        n = len(data)
        self.data, self.off = data, off
        w = in_word[data]
        first = np.zeros(n + 1, bool)
        first[off] = True
        begin = w.copy()
        begin[1:] &= ~w[:-1] | first[1:n]
        last = w.copy()
        last[:-1] &= ~w[1:] | first[1:n]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(last) + 1
        self.text = np.searchsorted(off, self.start, "right") - 1
        self.hash = self.span_hash(self.start, self.end) if hashes else None

    def prefix(self) -> np.ndarray:
        up, _ = _powers(len(self.data) + 1)
        c = np.zeros(len(self.data) + 1, U64)
        np.cumsum(_BYTE[LOWER[self.data]] * up[:-1], out=c[1:])
        return c

    def span_hash(self, start: np.ndarray, end: np.ndarray, c: np.ndarray | None = None) -> np.ndarray:
        """Hash of the lower-cased bytes [start, end), equal wherever they stand."""
        c = self.prefix() if c is None else c
        down = _powers(len(self.data) + 1)[1]
        return mix((c[end] - c[start]) * down[start] + (end - start).astype(U64))

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of first word, hash) of every k-word shingle within a text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        h = np.zeros(n, U64)
        for j in range(k):
            h = h * _MUL + self.hash[j:j + n]
        at = np.flatnonzero(self.text[:n] == self.text[k - 1:k - 1 + n])
        return at, mix(h[at])


def sliding_min(key: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive entries (length n - w + 1)."""
    n, have, m = len(key), 1, key
    if n < w:
        return key[:0]
    while have < w:
        step = min(have, w - have)
        m = np.minimum(m[:len(m) - step], m[step:])
        have += step
    return m


def crc_mod(col: str, n: int):
    """Remainder of crc32 of the id as text (null: of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))), F.lit(n))


def quantiles(df: DataFrame, col: str, n: int) -> list:
    """At most n - 1 increasing bounds that cut the rows into n even ranges."""
    if n < 2:
        return []
    at = [i / n for i in range(1, n)]
    got = df.agg(F.percentile_approx(col, at, max(10_000, 20 * n))).first()[0]
    return sorted(set(got or []))


def range_bucket(value, bounds: list):
    """Number of bounds at or below the value: found among every root-th bound
    first, then in the run that follows it."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    runs = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    below = lambda array: F.size(F.filter(array, lambda x: x <= value))
    run = F.greatest(below(F.lit([r[0] for r in runs])), F.lit(1))
    return (run - 1) * step + below(F.element_at(F.array(*[F.lit(r) for r in runs]), run))
