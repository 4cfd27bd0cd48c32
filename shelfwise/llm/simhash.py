"""SimHash near-duplicates with a Gray-order hierarchical Hamming index.

``fingerprints`` gives each text a 64-bit SimHash of its word shingles (XXH64,
seed 42; a bit is set when over half of the shingle hashes have it; no words:
zero).  ``components`` links fingerprints at ``max_bits`` or fewer differing
bits and returns each document's smallest reachable doc_id.

The index: equal fingerprints collapse first (a map-side aggregate, so a third
of all rows being copies costs one row).  Two fingerprints within three bits
agree on two of five bit blocks at least, so the distinct ones are dealt by the
ten pairs of blocks; a bucket past ``bucket_rows`` is dealt again by blocks of
its remaining bits (of ``max_bits + 1`` blocks one agrees), which splits hot
buckets and still loses no link.  Inside a bucket the fingerprints are sorted
by Gray rank and a tree is laid over them whose nodes hold the bits all members
share; a node is left as soon as the accumulated difference to a query passes
``max_bits``.  A bucket emits a spanning link per member, never its pairs, and
min-label rounds with pointer jumping join the buckets' links into components.

Defined cases: null and empty texts have fingerprint zero and link like any
other; repeated rows of one doc_id come back as often as they came in; a null
doc_id has its fingerprint but never names a component while an id is there; one
row of a component is kept, whatever ids its rows share; an empty table gives an empty result; other input columns are ignored.
"""
from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import ASCII_SPACE, U64, saved, text_column

SHINGLE = 3
MAX_BITS = 3
BUCKET_ROWS = 4096
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    words = text.translate(_LOWER).split()      # bytes.split: x20 and x09-x0D
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    k = min(k, len(words))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], 42) for a, b in
                  zip(start[:len(words) - k + 1].tolist(), end[k - 1:].tolist())], U64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i:i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h)).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a signed long) and the ``carried``
    columns of type long."""
    def run(batches):
        for b in batches:
            text = text_column(b.column("text"))
            fp = [fingerprint(t.encode(), shingle) for at in range(0, len(text), 256) for t in text.slice(at, 256).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(np.array(fp, U64).view(np.int64)), *[b.column(c) for c in carried]], ["doc_id", "fp", *carried])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carried)
    return rows.mapInArrow(run, ", ".join(["doc_id long, fp long", *[f"{c} long" for c in carried]]))


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of a word in the reflected Gray order: prefix xor of its bits."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> U64(s))
    return x


class HammingTree:
    """Static tree over fingerprints in Gray order; every node holds the bits
    that all its members share (``mask``) and their values (``bits``)."""

    def __init__(self, fps: np.ndarray, fan: int = 8):
        self.fan = fan
        self.fps = fps[np.argsort(gray_rank(fps), kind="stable")]
        mask, bits = np.full(len(fps), ~U64(0)), self.fps
        self.levels = [(mask, bits)]
        while len(bits) > fan:
            cut = np.arange(0, len(bits), fan)
            both = np.bitwise_and.reduceat(bits, cut)
            none = ~np.bitwise_or.reduceat(bits, cut)
            mask = np.bitwise_and.reduceat(mask, cut) & (both | none)
            bits = both & mask
            self.levels.append((mask, bits))

    def search(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(query index, member index) of every pair within ``limit`` bits."""
        mask, bits = self.levels[-1]
        q = np.repeat(np.arange(len(queries)), len(bits))
        node = np.tile(np.arange(len(bits)), len(queries))
        for depth in range(len(self.levels) - 1, -1, -1):
            mask, bits = self.levels[depth]
            near = popcount((queries[q] ^ bits[node]) & mask[node]) <= limit
            q, node = q[near], node[near]
            if depth:
                child = node[:, None] * self.fan + np.arange(self.fan)
                ok = child < len(self.levels[depth - 1][1])
                q, node = np.repeat(q, self.fan)[ok.ravel()], child[ok]
        return q, node


def _spanning(fps: np.ndarray, limit: int, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """A link from every linked fingerprint to its local component's smallest."""
    tree = HammingTree(fps)
    own = tree.fps
    parent = np.arange(len(own))
    for i in range(0, len(own), block):
        q, m = tree.search(own[i:i + block], limit)
        q = q + i
        keep = q < m
        q, m = q[keep], m[keep]
        while len(q):                           # hook roots, then halve paths, until both ends agree
            a, b = parent[q], parent[m]
            apart = a != b
            if not apart.any():
                break
            q, m, a, b = q[apart], m[apart], a[apart], b[apart]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
    child = np.flatnonzero(parent != np.arange(len(own)))
    return own[child], own[parent[child]]


def _blocks(bits: list[int], n: int) -> list[int]:
    """n masks that part the given bit positions."""
    return [sum(1 << b for b in bits[i * len(bits) // n:(i + 1) * len(bits) // n]) for i in range(n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bucketed(fps: DataFrame, max_bits: int, bucket_rows: int) -> DataFrame:
    """(mask, key, fp): every pair within max_bits shares a bucket."""
    blocks = _blocks(list(range(64)), max_bits + 2)
    masks = [a | b for a, b in combinations(blocks, 2)]
    dealt = fps.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    dealt = dealt.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
    out = None
    for level in range(3):
        sizes = dealt.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        sized = dealt.join(sizes, ["mask", "key"])
        if level == 2:
            return out.unionByName(sized.drop("n"))
        small = sized.where(F.col("n") <= bucket_rows).drop("n")
        out = small if out is None else out.unionByName(small)
        finer = {}
        for m in masks:
            rest = [b for b in range(64) if not m >> b & 1]
            finer[m] = [m | x for x in _blocks(rest, max_bits + 1)] if len(rest) > max_bits else [m]
        split = F.create_map(*[x for m, fs in finer.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(f)) for f in fs]))])
        dealt = (sized.where(F.col("n") > bucket_rows)
                 .select("fp", F.explode(split[F.col("mask")]).alias("mask"))
                 .withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))))
        masks = sorted({f for fs in finer.values() for f in fs})
    return out


def links(fps: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): spanning links of the distinct fingerprints in ``fps.fp``."""
    def run(batches):
        """Sorted rows of whole buckets; small buckets share one call overhead."""
        held = None
        for b in batches:
            b = pa.Table.from_batches([b])
            held = b if held is None else pa.concat_tables([held, b])
            mask, key = (held.column(c).to_numpy() for c in ("mask", "key"))
            cut = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            if len(cut):
                yield from solve(held.column("fp").to_numpy()[:cut[-1]], cut)
                held = held.slice(cut[-1]).combine_chunks()
        if held is not None:
            fp = held.column("fp").to_numpy()
            yield from solve(fp, np.array([len(fp)]))

    def solve(fp, ends):
        fp = fp.view(U64)
        start = np.concatenate([[0], ends[:-1]])
        size = ends - start
        out_a, out_b = [], []
        two = start[size == 2]                  # most buckets are pairs: one vector pass
        near = popcount(fp[two] ^ fp[two + 1]) <= max_bits
        out_a.append(fp[two[near]])
        out_b.append(fp[two[near] + 1])
        for s, e in zip(start[size > 2].tolist(), ends[size > 2].tolist()):
            a, b = _spanning(fp[s:e], max_bits)
            out_a.append(a)
            out_b.append(b)
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    dealt = _bucketed(fps.select("fp"), max_bits, bucket_rows)
    return (dealt.repartition("mask", "key").sortWithinPartitions("mask", "key")
            .select("mask", "key", "fp").mapInArrow(run, "a long, b long").distinct())


def min_labels(spark: SparkSession, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(v, label): smallest start label reachable over undirected ``edges`` (a, b)
    for every linked node; ``nodes`` is (v, label).  Each round takes the least
    neighbour label (map-side aggregated, so a hub costs one row a task) and then
    follows labels to the labels of their owners.  No two nodes may start with one
    label, since a label names its owner."""
    both = saved(spark, edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    ends = both.select(F.col("a").alias("v")).distinct()
    state = saved(spark, nodes.join(ends, "v").select("v", "label"), "labels")
    while True:
        seen = both.join(state.withColumnRenamed("v", "b"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("seen"))
        step = state.join(seen, "v", "left").select("v", F.col("label").alias("old"), F.least("label", "seen").alias("label"))
        # the label's owner: the node whose start label it is; take that node's label of this round
        owner = nodes.select(F.col("label").alias("at"), F.col("v").alias("owner"))
        via = (state.select(F.col("v").alias("owner"), F.col("label").alias("far")).join(owner, "owner").select("at", "far"))
        moved = (step.join(via, step.label == via["at"], "left")
                 .select("v", "old", F.least("label", "far").alias("label")))
        moved = saved(spark, moved, "labels")
        state = moved.select("v", "label")
        if moved.where("old <> label").isEmpty():
            return state


def _labelled(own: DataFrame, max_bits: int, bucket_rows: int) -> DataFrame:
    """(fp, label): for every distinct ``own.fp`` the smallest (none, id, v) of its
    component: whether the fingerprint has no doc_id, its smallest one, itself.
    The last makes labels of null and of repeated ids differ."""
    spark = own.sparkSession
    least = F.min("doc_id")
    label = F.struct(least.isNull().alias("none"), F.coalesce(least, F.lit(0).cast("long")).alias("id"), F.col("v"))
    nodes = saved(spark, own.groupBy(F.col("fp").alias("v")).agg(label.alias("label")), "distinct-simhash")
    labels = min_labels(spark, nodes, links(nodes.select(F.col("v").alias("fp")), max_bits, bucket_rows))
    return nodes.join(labels.withColumnRenamed("label", "far"), "v", "left").select(F.col("v").alias("fp"), F.least("label", "far").alias("label"))


def components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, fp, component_id for every row of ``docs``."""
    own = saved(docs.sparkSession, fingerprints(docs, shingle), "simhash")
    named = _labelled(own, max_bits, bucket_rows).select("fp", F.when(~F.col("label.none"), F.col("label.id")).alias("component_id"))
    return own.join(named, "fp").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row of every component of ``docs``: the one of the smallest doc_id (null
    ids last), of several such the smallest hash of the text, then the first row.  Rows
    go, not ids: another text of a dropped row's id stays, equal rows leave one.  Rows are
    named by their place in ``docs``, which must read alike twice (a stored table)."""
    spark, names = docs.sparkSession, docs.columns
    placed = docs.withColumn("_row", F.monotonically_increasing_id())
    own = saved(spark, fingerprints(placed.withColumn("_hash", F.xxhash64(F.col("text").cast("string"))), shingle, ("_hash", "_row")), "simhash")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_hash", "_row"))
    named = _labelled(own, max_bits, bucket_rows)
    # copies meet in a map-side minimum, then one row per fingerprint meets its component's
    best = own.groupBy("fp").agg(least.alias("best")).join(named, "fp").groupBy("label").agg(F.min("best").alias("best"))
    return placed.join(best.select(F.col("best._row").alias("_row")), "_row", "left_semi").select(*names)
