"""Merkle manifest of a table: 8-ary digest trees per language, stored as aligned
blocks in van Emde Boas layout.

A row's leaf is the SHA-256 of its fields (``-`` for null, else byte count, ``:``,
value).  Leaves of one language stand in doc_id order; while there is more than
one node, every eight consecutive ones become their digest.  The languages' sub-
roots (null first, then bytewise) give the root the same way.

The tree is cut into aligned subtrees of ``height`` levels below their root.  A
block holds its nodes in van Emde Boas order: the top half of its levels first,
then the subtrees below it one after another, each stored by the same rule;
``address`` is that arithmetic, and building and sibling lookup both go by it.
The block roots are the leaves of the next layer of blocks, until one is left.
So a block is all a task ever holds (4,096 leaves by default), however many rows
a language has.  Going down again, every block gets its path to the root (slot
and siblings of each level above) from the block over it and adds its own levels.

Positions come from one exchange by (language, doc_id): row numbers inside a range
partition plus the counts of the partitions before it.  Leaf digests are built-in
functions in the scan; texts are neither shuffled nor sent to Python.

Defined cases: a null doc_id precedes all others; rows of one language and doc_id
stand in leaf order, equal rows next to each other (a leaf each); null and empty
texts differ (``-`` and ``0:``); an empty table gives an empty result; other input
columns are ignored.
"""
from __future__ import annotations

from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import saved, shuffle_parts

FAN = 8
HEIGHT = 4
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NODES = "key string, block long, n long, count int, nodes binary, root binary"
_PATH = "array<struct<slot:int,siblings:binary>>"


# ------------------------------------------------------------------ layout --
def tree_size(levels: int) -> int:
    return (FAN ** levels - 1) // (FAN - 1)


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Van Emde Boas place of nodes ``index`` of a depth in a complete tree of
    ``levels`` levels of nodes (the root has depth 0)."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(depth, index, top)
    below, width = levels - top, FAN ** (depth - top)
    return tree_size(top) + index // width * tree_size(below) + address(depth - top, index % width, below)


@lru_cache(maxsize=64)
def _level(depth: int, levels: int) -> np.ndarray:
    """Places of a whole level (read only)."""
    return address(depth, np.arange(FAN ** depth, dtype=np.int64), levels)


_HEX = np.frombuffer(b"".join(b"%02x" % b for b in range(256)), np.uint8).reshape(256, 2)


def _hex(digests: np.ndarray) -> bytes:
    return _HEX[digests].tobytes()


class Block:
    """An aligned subtree: ``levels`` levels of nodes, ``count`` of its lowest
    ones present, all digests in one array in van Emde Boas order."""

    def __init__(self, nodes: np.ndarray, count: int, levels: int):
        self.nodes, self.count, self.levels = nodes, count, levels

    def width(self, depth: int) -> int:
        """Number of nodes present at a depth."""
        below = FAN ** (self.levels - 1 - depth)
        return -(-self.count // below)

    def at(self, depth: int, first: int = 0, end: int | None = None) -> np.ndarray:
        return self.nodes[_level(depth, self.levels)[first:self.width(depth) if end is None else end]]

    @classmethod
    def build(cls, leaves: np.ndarray, height: int) -> "Block":
        """From the digests of the lowest level (count x 32 bytes)."""
        levels, count = height + 1, len(leaves)
        self = cls(np.zeros((0, 32), np.uint8), count, levels)
        last = max(int(_level(d, levels)[:self.width(d)].max()) for d in range(levels))
        self.nodes = np.zeros((last + 1, 32), np.uint8)
        self.nodes[_level(height, levels)[:count]] = leaves
        for depth in range(height - 1, -1, -1):
            text, run = _hex(self.at(depth + 1)), FAN * 64
            made = b"".join(sha256(text[i:i + run]).digest() for i in range(0, len(text), run))
            self.nodes[_level(depth, levels)[:self.width(depth)]] = np.frombuffer(made, np.uint8).reshape(-1, 32)
        return self

    @property
    def root(self) -> bytes:
        return self.nodes[_level(0, self.levels)[0]].tobytes()

    def paths(self) -> list[list[tuple[int, bytes]]]:
        """For every lowest node, bottom up: its slot in its run and the run's
        other digests."""
        out = [[] for _ in range(self.count)]
        for depth in range(self.levels - 1, 0, -1):
            step, width = FAN ** (self.levels - 1 - depth), self.width(depth)
            text = self.at(depth).tobytes()
            siblings = []
            for i in range(width):
                a, e = i // FAN * FAN, min(i // FAN * FAN + FAN, width)
                siblings.append((i - a, text[a * 32:i * 32] + text[i * 32 + 32:e * 32]))
            for leaf in range(self.count):
                out[leaf].append(siblings[leaf // step])
        return out


def folded(digest: bytes, path: list[tuple[int, bytes]]) -> bytes:
    """The root that a leaf's digest and its path lead to."""
    for slot, siblings in path:
        digest = sha256((siblings[:slot * 32] + digest + siblings[slot * 32:]).hex().encode()).digest()
    return digest


# ------------------------------------------------------------------ leaves --
def _field(col) -> F.Column:
    s = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """(key, doc_id, leaf, altered): the language's sort key, the row's digest and,
    where the row is tampered with, the digest of the tampered row."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    digest = lambda t: F.unhex(F.sha2(F.concat(*[_field(c) for c in (doc_id, F.col("source"), F.col("lang"), F.col("n_chars").cast("long"), t)]).cast("binary"), 256))
    touched = F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 0
    lang = F.col("lang").cast("string")
    return docs.select(F.coalesce(F.concat(F.lit("="), lang), F.lit("-")).alias("key"), doc_id.alias("doc_id"), digest(text).alias("leaf"),
                       F.when(touched, digest(F.translate(text, _UPPER, _UPPER.lower()))).alias("altered"))


def positions(spark: SparkSession, rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` plus pos (place within the key, from 0) and n (rows of the key), in
    the order of ``order``.  Ties go by place in the input, so that many equal rows
    still spread over ranges."""
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    by = ["key", *order, "tie"]
    # written: the ranges of a recomputed exchange could differ
    ranged = saved(spark, rows.repartitionByRange(shuffle_parts(spark), *by).withColumn("part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("part", "key").agg(F.count("*").alias("here"))
    # a row per range and key: keys of one range don't lie in another but at its ends
    upto = W.partitionBy("key").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("part", "key", F.coalesce(F.sum("here").over(upto), F.lit(0)).alias("before"), F.sum("here").over(W.partitionBy("key")).alias("n"))
    inside = W.partitionBy("part", "key").orderBy(*order, "tie")
    return ranged.join(counts, ["part", "key"]).withColumn("pos", F.col("before") + F.row_number().over(inside) - 1).drop("part", "before", "tie")


# ------------------------------------------------------------------ blocks --
def _height(n: int) -> int:
    """Levels above the leaves of a tree over n leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // FAN), h + 1
    return h


def _digests(col: pa.Array) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, 32)


def _built(rows: DataFrame, layer: int, height: int, carried: bool) -> DataFrame:
    """A row per block of ``height`` levels over rows (key, pos, n, digest): its
    nodes and, for the lowest layer, the rows' ids and altered digests in order."""
    schema = _NODES + (", ids array<long>, altered array<binary>" if carried else "")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        n, count = table.column("n")[0].as_py(), table.num_rows
        block = Block.build(_digests(table.column("digest")), min(height, max(0, _height(n) - layer * height)))
        out = {"key": pa.array([table.column("key")[0].as_py()], pa.string()), "block": pa.array([table.column("block")[0].as_py()], pa.int64()),
               "n": pa.array([n], pa.int64()), "count": pa.array([count], pa.int32()), "nodes": pa.array([block.nodes.tobytes()], pa.binary()), "root": pa.array([block.root], pa.binary())}
        if carried:
            out["ids"] = pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64()))
            out["altered"] = pa.array([table.column("altered").to_pylist()], pa.list_(pa.binary()))
        return pa.table(out)
    blocked = rows.withColumn("block", F.floor(F.col("pos") / FAN ** height).cast("long"))
    return blocked.groupBy("key", "block").applyInArrow(run, schema)


class Forest:
    """Block tables of the trees of all keys, lowest layer first."""

    def __init__(self, spark: SparkSession, rows: DataFrame, height: int, carried: bool):
        self.spark, self.height, self.layers = spark, height, []
        most = rows.agg(F.max("n")).first()[0] or 0
        while True:
            layer = len(self.layers)
            made = saved(spark, _built(rows, layer, height, carried and not layer), f"blocks-{layer}")
            self.layers.append(made)
            if most <= self._reach(layer):
                break
            rows = made.where(F.col("n") > self._reach(layer)).select("key", F.col("block").alias("pos"), "n", F.col("root").alias("digest"))

    def _reach(self, layer: int) -> int:
        """Leaves of one tree that layers up to this one cover."""
        return FAN ** (self.height * (layer + 1))

    def roots(self) -> DataFrame:
        """(key, root) of every tree."""
        tops = [made.where((F.col("n") <= self._reach(i)) & (F.col("n") > (self._reach(i - 1) if i else 0))).select("key", "root") for i, made in enumerate(self.layers)]
        out = tops[0]
        for more in tops[1:]:
            out = out.unionByName(more)
        return out

    def pathed(self, tops: DataFrame) -> DataFrame:
        """The lowest layer's blocks with ``path``, the way from the block's root up;
        ``tops`` (key, path, subroot, root) is the way from a tree's root up.  All go
        down block by block: a join by key would put a language in one task."""
        height, given = self.height, None
        for i in range(len(self.layers) - 1, -1, -1):
            blocks = self.layers[i]
            own = blocks.where(F.col("n") <= self._reach(i)).select("key", "block").join(tops, "key")
            given = own if given is None else own.unionByName(given)
            blocks = blocks.drop("root").join(given, ["key", "block"])
            if not i:
                return blocks
            given = saved(self.spark, _handed(blocks, i, height), f"paths-{i}")


def _path(value) -> list[tuple[int, bytes]]:
    return [(p["slot"], p["siblings"]) for p in value]


def _stored(row: dict, layer: int, height: int) -> Block:
    levels = min(height, max(0, _height(row["n"]) - layer * height)) + 1
    return Block(np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32), row["count"], levels)


def _handed(blocks: DataFrame, layer: int, height: int) -> DataFrame:
    """(key, block, path, subroot, root) of the blocks below: own siblings, then the
    block's path."""
    typ = pa.schema([("key", pa.string()), ("block", pa.int64()), ("path", pa.list_(pa.struct([("slot", pa.int32()), ("siblings", pa.binary())]))),
                     ("subroot", pa.binary()), ("root", pa.binary())])

    def run(batches):
        for b in batches:
            for at in range(b.num_rows):
                row = b.slice(at, 1).to_pylist()[0]
                above, first = _path(row["path"]), row["block"] * FAN ** height
                paths = _stored(row, layer, height).paths()
                for i in range(0, len(paths), 512):
                    yield pa.RecordBatch.from_pylist([{"key": row["key"], "block": first + i + j, "path": [{"slot": s, "siblings": x} for s, x in p + above],
                                                       "subroot": row["subroot"], "root": row["root"]} for j, p in enumerate(paths[i:i + 512])], typ)
    return blocks.select("key", "block", "n", "count", "nodes", "path", "subroot", "root").mapInArrow(run, f"key string, block long, path {_PATH}, subroot binary, root binary")


def manifest(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row."""
    spark = docs.sparkSession
    # the scan's digests are written: the range exchange reads its input twice
    rows = positions(spark, saved(spark, leaves(docs), "leaves"), ["doc_id", "leaf"])
    forest = Forest(spark, rows.withColumnRenamed("leaf", "digest"), height, True)
    subroots = saved(spark, forest.roots(), "subroots")
    # one tree over the languages' subroots, in key order
    tops = positions(spark, subroots.select(F.lit("").alias("key"), F.col("key").alias("lang"), F.col("root").alias("digest")), ["lang"])
    tops = saved(spark, tops, "tops")
    crown = Forest(spark, tops, height, False)
    ends = crown.roots().select("key", F.expr(f"cast(array() as {_PATH})").alias("path"), F.col("root").alias("subroot"), "root")
    above = _handed(crown.pathed(ends), 0, height).select(F.col("block").alias("pos"), "path", "root")
    above = above.join(tops.select("pos", F.col("lang").alias("key"), F.col("digest").alias("subroot")), "pos").select("key", "path", "subroot", "root")
    blocks = forest.pathed(saved(spark, above, "crown-paths"))

    def run(batches):
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
        for b in batches:
            for at in range(b.num_rows):
                row = b.slice(at, 1).to_pylist()[0]
                block, above = _stored(row, 0, height), _path(row["path"])
                tail = b"".join(s for _, s in above).hex().encode()
                own, paths = block.at(block.levels - 1), block.paths()
                for i in range(0, block.count, 1024):
                    part = range(i, min(i + 1024, block.count))
                    leaf = [own[j].tobytes() for j in part]
                    proof = [sha256(b"".join(s for _, s in paths[j]).hex().encode() + tail).hexdigest() for j in part]
                    root = [folded(row["altered"][j] or d, paths[j] + above).hex() for j, d in zip(part, leaf)]
                    yield pa.RecordBatch.from_arrays([pa.array(row["ids"][i:i + len(part)], pa.int64()), pa.array([d.hex() for d in leaf]), pa.array([row["subroot"].hex()] * len(part)),
                                                      pa.array([row["root"].hex()] * len(part)), pa.array(proof), pa.array(root)], names)
    out = blocks.select("n", "count", "nodes", "ids", "altered", "path", "subroot", "root").mapInArrow(
        run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
