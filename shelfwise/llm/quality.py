"""Quality classifier: a linear-chain CRF labels every line good or bad.

A line's features are shares of byte classes, word statistics and repetition
flags of the line itself and of the lines before and after it; the chain's
forward-backward marginals, weighted by line length, average to the document's
quality.  Lines are trained with their document's label.

The fit uses a bounded sample of labelled documents: the ``sample`` documents
with the smallest hash of their id among those the caller's condition admits,
texts of ``max_bytes`` at most.  Nothing else is limited: scoring reads every
whole text.

Defined cases: blank lines are skipped; a null or empty text (or one without any
line) scores the share of label 1 in the sample; without any labelled text every
score is 0.5; null labels are ignored and a document with several labels has the
smallest; rows are scored one by one, repeated or not; other columns are ignored.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ASCII_SPACE, WORD_BYTE, Words, saved, slices
from .crf import Adam, Chain

SAMPLE = 3000
MAX_BYTES = 20_000
STEPS = 150
THRESHOLD = 0.3

_CLASSES = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t\r", ".", ",", "!", "?", "*", "#", "|", "&", "%", "$", "@", ":;", "/\\", "-_", "=<>", "(){}[]", "'\"`", "+~^"]
_CLASS = np.full(256, len(_CLASSES), np.int64)       # other ASCII
_CLASS[128:] = len(_CLASSES) + 1
for _i, _c in enumerate(_CLASSES):
    _CLASS[[ord(x) for x in _c]] = _i
_N = len(_CLASSES) + 2
_IN_LINE = np.ones(256, bool)
_IN_LINE[10] = False
_STOP = np.zeros(256, bool)
_STOP[[ord(x) for x in ".!?:"]] = True
WIDTH = _N + 12


def _share(of: np.ndarray, total: np.ndarray) -> np.ndarray:
    return of / np.maximum(total, 1)


def _fresh(*keys: np.ndarray) -> np.ndarray:
    """False where a row of keys was seen before (in order of position)."""
    order = np.lexsort(keys[::-1])
    same = np.ones(len(order), bool)
    same[:1] = False
    for k in keys:
        same[1:] &= k[order][1:] == k[order][:-1]
    out = np.ones(len(order), bool)
    out[order[same]] = False
    return out


def line_features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, text index, bytes) of every line that isn't blank."""
    lines = Words(data, off, _IN_LINE, hashes=False)
    n = len(lines.start)
    if not n:
        return np.zeros((0, WIDTH), np.float32), lines.text, lines.end - lines.start
    size = lines.end - lines.start
    prefix = lines.prefix()
    of = np.repeat(np.arange(n), size)
    counts = np.bincount(of * _N + _CLASS[data[_IN_LINE[data]]], minlength=n * _N).reshape(n, _N)
    w = Words(data, off, ~ASCII_SPACE, hashes=False)
    at = np.searchsorted(lines.start, w.start, "right") - 1
    h = w.span_hash(w.start, w.end, prefix)
    words = np.bincount(at, minlength=n)
    by = lambda flag: _share(np.bincount(at[flag], minlength=n), words)
    first, last = data[w.start], data[w.end - 1]
    upper = (first >= 65) & (first <= 90)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (at[1:] == at[:-1])
    cols = [np.sqrt(_share(counts, size[:, None])),
            np.stack([np.log1p(size) / 5, np.log1p(words) / 4, _share(size, words) / 10, by(upper), by(~WORD_BYTE[last]), by((last == 46) | (last == 44)),
                      by(again), by(_fresh(at, h)), _STOP[data[lines.end - 1]], (data[lines.start] >= 65) & (data[lines.start] <= 90),
                      ~_fresh(lines.text, lines.span_hash(lines.start, lines.end, prefix)), words <= 3], axis=1)]
    keep = words > 0
    return np.concatenate(cols, axis=1)[keep].astype(np.float32), lines.text[keep], size[keep]


def _firsts(text: np.ndarray) -> np.ndarray:
    out = np.ones(len(text), bool)
    out[1:] = text[1:] != text[:-1]
    return out


def _beside(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Own, previous and next line's features and a constant."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    inner = np.flatnonzero(~first)
    before[inner], after[inner - 1] = x[inner - 1], x[inner]
    return np.concatenate([x, before, after, np.ones((len(x), 1), x.dtype)], axis=1)


@dataclass
class LineModel:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    chain: Chain
    prior: float

    def scores(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        x, text, size = line_features(data, off)
        n = len(off) - 1
        first = _firsts(text)
        p = self.chain.marginals(_beside((x - self.mean) / self.scale, first) @ self.weight, first) if len(x) else np.zeros(0)
        total = np.bincount(text, size, n)
        return np.where(total > 0, np.bincount(text, size * p, n) / np.maximum(total, 1), self.prior)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, admitted, limit: int, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(text, label) of at most ``limit`` admitted documents, by hash of the id."""
    spark = docs.sparkSession
    ids = (labels.where(F.col(label).isin(0, 1) & admitted).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
           .agg(F.min(label).cast("int").alias("label")))
    text = F.col("text").cast("string")
    small = docs.where(F.octet_length(text) <= max_bytes).select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # twice the bound of ids by hash, so that long texts leave enough; the texts are read for these alone
    ids = saved(spark, ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * limit), "sample-ids")
    return small.join(ids, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).select("text", "label")


def fit(sample: DataFrame, steps: int = STEPS) -> LineModel:
    got = sample.toArrow()
    label = got.column("label").to_numpy().astype(np.int64)
    xs, texts, n = [], [], 0
    for i, j, data, off in slices(got.column("text").combine_chunks() if got.num_rows else pa.array([], pa.string())):
        x, text, _ = line_features(data, off)
        xs.append(x)
        texts.append(text + i)
    prior = float(label.mean()) if len(label) else 0.5
    x = np.concatenate(xs) if xs else np.zeros((0, WIDTH), np.float32)
    text = np.concatenate(texts) if texts else np.zeros(0, np.int64)
    model = LineModel(np.zeros(WIDTH, np.float32), np.ones(WIDTH, np.float32), np.zeros(3 * WIDTH + 1, np.float32), Chain(), prior)
    if not len(x):
        return model
    model.mean, model.scale = x.mean(0), x.std(0) + np.float32(0.05)
    first = _firsts(text)
    z, y = _beside((x - model.mean) / model.scale, first), label[text]
    adam = Adam(0.05)
    for t in range(1, steps + 1):
        adam.t = t
        by_score, by_trans, by_start = model.chain.gradient(z @ model.weight, first, y)
        model.weight = adam.step("w", model.weight, z.T @ by_score.astype(np.float32) / len(z) - 1e-3 * model.weight).astype(np.float32)
        model.chain.trans = adam.step("t", model.chain.trans, by_trans / len(z) - 1e-3 * model.chain.trans)
        model.chain.start = float(adam.step("s", model.chain.start, by_start / len(z) - 1e-3 * model.chain.start))
    return model


def scored(docs: DataFrame, model: LineModel) -> DataFrame:
    """doc_id, score for every row."""
    def run(batches):
        for b in batches:
            for i, j, data, off in slices(b.column("text")):
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), pa.array(model.scores(data, off).clip(0, 1))], ["doc_id", "score"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def kept(docs: DataFrame, model: LineModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``."""
    names = docs.columns

    def run(batches):
        for b in batches:
            for i, j, data, off in slices(b.column(names.index("text"))):     # small output batches
                yield b.slice(i, j - i).filter(pa.array(model.scores(data, off) >= threshold))
    return docs.mapInArrow(run, docs.schema)
