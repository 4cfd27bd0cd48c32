"""Best-fit decreasing packing of token sequences.

``pieces`` tokenizes whole texts, appends id 0 and cuts only documents longer
than ``capacity``.  ``packed`` places pieces of length 1 to ``capacity`` by
best-fit decreasing.  Best fit depends on the lengths alone, and there are at
most ``capacity`` of them, so the driver sees one count per length, never a
document: it places whole runs of equal lengths, finding the tightest open bin
class with a segment tree over the remaining capacities in logarithmic time.
The result is a list of runs (length, ranks, first bin, pieces per bin, offset).
A visited class loses at least half of its remaining capacity, so there are at
most 11 runs for each of at most 3 x 2048 classes, under 4 MB in all whatever
the number of documents; every piece finds its place from its rank among the
pieces of its length.  Ranks come from per-bucket counts and their prefix sums,
so equally long pieces (the hot length is ``capacity``) never meet in one task.

Defined cases: a null or empty text is the single id 0; repeated rows are packed
each; a null doc_id is kept; an empty table gives an empty result; other input
columns are ignored.
"""
from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import saved, shuffle_parts, slices, text_column

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
CACHE_WORDS = 400_000
_loaded: dict[str, tuple] = {}


def _tokenizer(name: str):
    """(tokenizer, its word model, ids of words seen so far) of this worker."""
    if name not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer
        path = name if os.path.isabs(name) else public_tokenizers.path(name)
        tok = Tokenizer.from_file(path)
        _loaded[name] = tok, tok.model, {}
    return _loaded[name]


# byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHAR = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def _latin(word: str) -> bool:
    return word.isalpha() and (word.isascii() or max(word) < "\u0100")


def _encode(tok, model, words: list[str]) -> list[bytes]:
    """Ids of words.  A run of Latin letters is one word to the tokenizer, so its
    bytes, lower-cased, go to the model directly."""
    out = [np.array([t.id for t in model.tokenize(w.lower().encode().decode("latin-1").translate(_BYTE_CHAR))], "<u4").tobytes() if _latin(w) else None for w in words]
    rest = [i for i, x in enumerate(out) if x is None]
    for i, e in zip(rest, tok.encode_batch([words[i] for i in rest], add_special_tokens=False)):
        out[i] = np.array(e.ids, "<u4").tobytes()
    return out


_TAIL = ".,;:!?*#&%$|()"                          # never joined to a letter before it
_SLICE = 4 << 20


def token_ids(col: pa.Array, name: str = TOKENIZER) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of a column of texts.

    The vocabulary's normaliser lower-cases, and neither it nor its splitter ever
    joins across a blank or a letter and the punctuation after it; so a text's
    ids are those of its blank-separated words in turn, and of a word's letters
    and closing punctuation.  Each distinct word is encoded once while it is in
    the worker's bounded cache.
    """
    tok, model, cache = _tokenizer(name)
    if not pc.any(pc.match_substring(col, "<|")).as_py():      # special tokens are told apart by case
        col = pc.ascii_lower(col)
    for blank in "\n\t\r":
        col = pc.replace_substring(col, blank, " ")
    lists = pc.split_pattern(col, " ")
    words = lists.flatten().dictionary_encode()
    distinct = words.dictionary
    cores = pc.utf8_rtrim(distinct, _TAIL).to_numpy(zero_copy_only=False).tolist()
    distinct = distinct.to_numpy(zero_copy_only=False).tolist()
    ends = [w[len(c):] if len(c) < len(w) and _latin(c) else "" for w, c in zip(distinct, cores)]
    cores = [c if e else w for w, c, e in zip(distinct, cores, ends)]
    if len(cache) + len(cores) > CACHE_WORDS:
        cache.clear()
    new = [w for w in {*cores, *ends} if w not in cache]
    cache.update(zip(new, _encode(tok, model, new)))
    ids = [cache[c] + cache[e] if e else cache[c] for c, e in zip(cores, ends)]
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    table, first = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size
    index = words.indices.to_numpy()
    n = size[index]
    upto = np.append(0, np.cumsum(n))
    at = np.repeat(first[index] - upto[:-1], n) + np.arange(upto[-1])
    off = lists.offsets.to_numpy()
    return table[at], upto[off - off[0]]


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and with
    ``with_ids`` the ids themselves (little-endian 32-bit words)."""
    def run(batches):
        for b in batches:
            col, doc = text_column(b.column("text")), b.column("doc_id").to_pylist()
            for i, j, _, _ in slices(col, _SLICE):
                ids, off = token_ids(col.slice(i, j - i), tokenizer)
                rows = []
                for d, s, e in zip(doc[i:j], off[:-1].tolist(), off[1:].tolist()):
                    own = ids[s:e].tobytes() + b"\0\0\0\0"
                    for k, at in enumerate(range(0, len(own), 4 * capacity)):
                        part = own[at:at + 4 * capacity]
                        rows.append((d, k, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
                cols = list(zip(*rows))
                arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:5])]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array(cols[5], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)
        _tokenizer(tokenizer)[-1].clear()        # workers live on and serve other stages
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, _PIECE + (", ids binary" if with_ids else ""))


class CapacityTree:
    """Segment tree over remaining capacities 0..n: how many open classes each has."""

    def __init__(self, n: int):
        self.leaf = 1 << n.bit_length()
        self.any = [0] * (2 * self.leaf)

    def add(self, capacity: int, change: int) -> None:
        i = self.leaf + capacity
        while i:
            self.any[i] += change
            i >>= 1

    def tightest(self, need: int) -> int:
        """Smallest open capacity of at least ``need``, or -1."""
        i = self.leaf + need
        if self.any[i]:
            return need
        while i > 1:
            if not i & 1 and self.any[i + 1]:    # a right sibling holds larger capacities
                i += 1
                while i < self.leaf:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.leaf
            i >>= 1
        return -1


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts per length: runs (length, first rank, end
    rank, first bin, pieces per bin, offset).  Placing a piece in the tightest
    bin leaves that bin the tightest while another of its length fits, so a
    class of equal bins fills bin by bin."""
    tree, open_bins, runs, bins = CapacityTree(capacity), {}, [], 0

    def push(left: int, first: int, count: int) -> None:
        if left and count:
            open_bins.setdefault(left, []).append((first, count))
            tree.add(left, 1)

    for length in sorted(counts, reverse=True):
        rank, end = 0, counts[length]
        while rank < end:
            left = tree.tightest(length)
            per = (left if left >= 0 else capacity) // length
            if left < 0:
                left, first, have = capacity, bins, -(-(end - rank) // per)
                bins += have
            else:
                first, have = open_bins[left].pop()
                tree.add(left, -1)
            full = min(have, (end - rank) // per)
            if full:
                runs.append((length, rank, rank + full * per, first, per, capacity - left))
                rank += full * per
                push(left - per * length, first, full)
            rest = end - rank
            if rest and full < have:
                runs.append((length, rank, end, first + full, rest, capacity - left))
                rank = end
                push(left - rest * length, first + full, 1)
                full += 1
            push(left, first + full, have - full)
    return runs


def packed(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` (with doc_id, piece, length) plus sequence_id and offset."""
    spark = rows.sparkSession
    own = saved(spark, rows.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shuffle_parts(spark)))), "pieces")
    tally = saved(spark, own.groupBy("_b", "length").count(), "piece-counts")
    counts = {r.length: r.n for r in tally.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    if counts and not 0 < min(counts) <= max(counts) <= capacity:
        raise ValueError(f"lengths must be within 1 and {capacity}")
    runs = np.array(sorted(plan(counts, capacity)), np.int64).reshape(-1, 6)
    prefix = tally.select("_b", "length", (F.sum("count").over(W.partitionBy("length").orderBy("_b")) - F.col("count")).alias("_before"))
    # the prefix sums grow with the buckets: shuffled, however small their file looks
    ranked = (own.join(prefix.hint("merge"), ["_b", "length"])
              .withColumn("_rank", F.col("_before") + F.row_number().over(W.partitionBy("_b", "length").orderBy("doc_id", "piece")) - 1)
              .select(*rows.columns, "_rank"))
    span = int(runs[:, 2].max()) + 1 if len(runs) else 1
    key = runs[:, 0] * span + runs[:, 1]
    names = rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", sequence_id long, offset long"

    def run(batches):
        for b in batches:
            length, rank = (b.column(c).to_numpy() for c in ("length", "_rank"))
            r = runs[np.searchsorted(key, length * span + rank, "right") - 1]
            nth = rank - r[:, 1]
            arrays = [b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(r[:, 3] + nth // r[:, 4]), pa.array(r[:, 5] + nth % r[:, 4] * length)], [*names, "sequence_id", "offset"])
    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    return packed(pieces(docs, capacity, tokenizer, with_ids), capacity)
