"""Benchmark decontamination: size-partitioned MinHash containment search.

A benchmark item is inside a document when at least ``threshold`` of its
distinct word shingles (five words; an item of fewer words is one shingle of
its own length) occur in the document.  The search:

1. Every document's shingles are reduced to those that some item has.  This
   leaves all intersections as they are and makes a long document as small as
   its share of benchmark text.  The item vocabulary is broadcast only while it
   is within ``broadcast_rows`` hashes; a larger one is joined by shuffle.
2. Documents with equal reduced sets form one class (a passage that a third of
   all documents hold is searched once) and classes are partitioned by size,
   items likewise, by powers of two.
3. For a pair of size partitions the containment threshold becomes the least
   Jaccard similarity it can have, and so many one-row MinHash bands are used
   that a qualifying pair is missed with probability ``miss`` at most.
4. Candidates are verified by exact shingle containment.

Words are runs of ASCII letters and digits and of non-ASCII characters, ASCII
lower-cased.  Defined cases: null and empty texts and items without words match
nothing; rows with equal doc_id are judged one by one; repeated items give one
hit per item_id; empty tables give empty results; other columns are ignored.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import U64, Words, mix, saved, slices

WORDS = 5
THRESHOLD = 0.8
MISS = 1e-9
BROADCAST_ROWS = 1 << 20
_SETS = "array<bigint>"


def _sets(text: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of each text: (texts, offsets, hashes)."""
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    text, h = text[keep], h[keep]
    own, first = np.unique(text, return_index=True)
    return own, np.append(first, len(h)), h


def _list(off: np.ndarray, h: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(h.view(np.int64)))


def item_sets(items: DataFrame, words: int = WORDS) -> DataFrame:
    """item_id, words (shingle length), grams (distinct shingle hashes)."""
    def run(batches):
        for b in batches:
            for i, j, data, off in slices(b.column("text")):
                w = Words(data, off)
                count = np.bincount(w.text, minlength=j - i)
                for k in range(1, words + 1):
                    mine = np.flatnonzero(count >= words if k == words else count == k)
                    at, h = w.grams(k)
                    at = w.text[at]
                    sel = np.isin(at, mine)
                    own, o, g = _sets(at[sel], h[sel])
                    yield pa.RecordBatch.from_arrays([b.column("item_id").cast(pa.int64()).take(pa.array(i + own)), pa.array(np.full(len(own), k, np.int32)), _list(o, g)], ["item_id", "words", "grams"])
    return items.select("item_id", "text").mapInArrow(run, f"item_id long, words int, grams {_SETS}")


def _doc_sets(docs: DataFrame, sizes: list[int], vocabulary: np.ndarray | None) -> DataFrame:
    """doc_id, text_key, grams: each document's distinct shingles of the given
    word counts, only those of the vocabulary where one is given."""
    bits = None
    if vocabulary is not None:
        bits = np.zeros(1 << 22, bool)
        bits[(vocabulary >> U64(42)).astype(np.int64)] = True

    def run(batches):
        for b in batches:
            for i, j, data, off in slices(b.column("text")):
                w = Words(data, off)
                text, hashes = [], []
                for k in sizes:
                    at, h = w.grams(k)
                    if bits is not None:
                        maybe = np.flatnonzero(bits[(h >> U64(42)).astype(np.int64)])
                        maybe = maybe[np.isin(h[maybe], vocabulary)]
                        at, h = at[maybe], h[maybe]
                    text.append(w.text[at])
                    hashes.append(h)
                own, o, g = _sets(np.concatenate(text), np.concatenate(hashes))
                own = pa.array(i + own)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()).take(own), b.column("text_key").take(own), _list(o, g)], ["doc_id", "text_key", "grams"])
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"))
    return keyed.mapInArrow(run, f"doc_id long, text_key long, grams {_SETS}")


def bands(item_low: int, doc_high: int, threshold: float, miss: float) -> int:
    """One-row bands so that a pair of these size partitions at the threshold
    is missed with probability ``miss`` at most."""
    s = threshold * item_low / (item_low + doc_high - threshold * item_low)
    return 1 if s >= 1 else math.ceil(math.log(miss) / math.log1p(-s))


def minhashes(h: np.ndarray, n: int) -> np.ndarray:
    """Minimum of the set under n hash functions."""
    out = np.empty(n, U64)
    step = max(1, (1 << 16) // len(h))
    for a in range(0, n, step):
        seed = mix(np.arange(a + 1, min(n, a + step) + 1, dtype=U64))
        out[a:a + step] = mix(h[None, :] ^ seed[:, None]).min(1)
    return out


def _banded(sets: DataFrame, key: str, plan) -> DataFrame:
    """(key, part, band, least) of every set; ``plan(size)`` lists (part, bands)."""
    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                h = b.column("grams")[r].values.to_numpy(zero_copy_only=False).view(U64)
                parts = plan(len(h))
                if not parts:
                    continue
                sig = minhashes(h, max(n for _, n in parts)).view(np.int64)
                out = [[], [], []]
                for p, n in parts:
                    out[0].append(np.full(n, p, np.int32))
                    out[1].append(np.arange(n, dtype=np.int32))
                    out[2].append(sig[:n])
                part, band, least = map(np.concatenate, out)
                own = pa.array([b.column(key)[r].as_py()] * len(part), b.column(key).type)
                yield pa.RecordBatch.from_arrays([own, pa.array(part), pa.array(band), pa.array(least)], [key, "part", "band", "least"])
    return sets.select(key, "grams").mapInArrow(run, f"{key} string, part int, band int, least long")


def _class(grams: str):
    """Name of a set of shingles: equal sets are searched once."""
    return F.sha2(F.concat_ws(",", F.col(grams).cast("array<string>")), 256)


def contained(docs: DataFrame, items: DataFrame, words: int = WORDS, threshold: float = THRESHOLD,
              miss: float = MISS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, text_key (xxhash64 of the text), item_id, containment of every hit."""
    spark = docs.sparkSession
    bench = saved(spark, item_sets(items, words), "items")
    sizes = [r.words for r in bench.select("words").distinct().collect()]
    vocab = bench.select(F.explode("grams").alias("gram")).distinct()
    n = vocab.count()
    if n <= broadcast_rows:
        found = _doc_sets(docs, sizes or [words], np.sort(vocab.toArrow().column("gram").to_numpy().astype(np.int64).view(U64)))
    else:
        rows = _doc_sets(docs, sizes, None).select("doc_id", "text_key", F.explode("grams").alias("gram"))
        found = (rows.join(vocab, "gram", "left_semi").groupBy("doc_id", "text_key")
                 .agg(F.array_sort(F.collect_set("gram")).alias("grams")))
    found = saved(spark, found.withColumn("class", _class("grams")), "benchmark-sets")
    classes = found.groupBy("class").agg(F.first("grams").alias("grams"))

    high = found.agg(F.max(F.size("grams"))).first()[0] or 0
    item_parts = sorted({int(math.log2(r.n)) for r in bench.select(F.size("grams").alias("n")).distinct().collect()})

    def doc_plan(size: int) -> list[tuple[int, int]]:
        top = (1 << size.bit_length()) - 1
        return [(p, bands(1 << p, top, threshold, miss)) for p in item_parts if size >= threshold * (1 << p)]

    most = {p: bands(1 << p, (1 << high.bit_length()) - 1, threshold, miss) for p in item_parts if high >= threshold * (1 << p)}

    def item_plan(size: int) -> list[tuple[int, int]]:
        p = size.bit_length() - 1
        return [(p, most[p])] if p in most else []

    bench = bench.withColumn("item_class", _class("grams"))
    texts = bench.groupBy("item_class").agg(F.first("grams").alias("grams"))
    sides = _banded(classes, "class", doc_plan), _banded(texts, "item_class", item_plan)
    pairs = sides[0].join(sides[1], ["part", "band", "least"]).select("class", "item_class").distinct()
    share = F.size(F.array_intersect("grams", "item_grams")) / F.size("item_grams")
    hits = (pairs.join(classes, "class").join(texts.withColumnRenamed("grams", "item_grams"), "item_class")
            .select("class", "item_class", share.alias("containment")).where(F.col("containment") >= threshold))
    named = hits.join(bench.select("item_class", "item_id").distinct(), "item_class")
    return found.join(named, "class").select("doc_id", "text_key", "item_id", "containment").distinct()


def decontaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    hit = contained(docs, items, **options).select(F.col("doc_id").alias("_hit_id"), F.col("text_key").alias("_hit_key")).distinct()
    same = docs["doc_id"].eqNullSafe(hit["_hit_id"]) & (F.xxhash64(docs["text"]) == hit["_hit_key"])
    return docs.join(hit, same, "left_anti")
