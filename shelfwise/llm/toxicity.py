"""Toxicity: a linear-chain CRF tags toxic spans of tokens.

Tokens are words (ASCII letters and digits, non-ASCII characters), ASCII
lower-cased; a token's features are its hash and the hashes of its prefixes of
3 to 10 bytes.  Labels mark documents, so token labels are derived first: a
feature is offending when the sample's toxic documents hold it far more often
than its clean ones (log likelihood ratio past ``evidence``, four fifths of its
documents toxic), and a token of a toxic document is labelled 1 when one of its
features is.  The chain is trained on these tokens; forward-backward marginals
give the offending spans (runs of tokens past one half) and, through a logistic
fit of the largest marginal's log odds and the expected number of toxic tokens,
the document's score.

The fit uses a bounded sample of labelled documents (``sample`` of each label,
the smallest hashes of the id among those the caller's condition admits, texts
of ``max_bytes`` at most); scoring reads every whole text.

Defined cases: null, empty and wordless texts have no span and the score of a
text whose largest marginal is zero; without labelled texts of both kinds every
score is the share of toxic ones (0.5 without any); null labels are ignored and
a document with several labels has the smallest; rows are scored one by one,
repeated or not; other columns are ignored.
"""
from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import U64, Words, mix, slices
from .crf import Adam, Chain
from .quality import _firsts, labelled_sample

SAMPLE = 1000
MAX_BYTES = 20_000
STEPS = 40
EVIDENCE = 10.0
THRESHOLD = 0.3
BITS = 20
PREFIXES = range(3, 11)
_FLOOR = 1e-6
_SPANS = "array<struct<begin:int,end:int>>"


def token_features(w: Words) -> np.ndarray:
    """(features, tokens) table rows; the last row stands for an absent feature."""
    prefix, none = w.prefix(), 1 << BITS
    rows = [(w.span_hash(w.start, w.end, prefix) >> U64(64 - BITS)).astype(np.int32)]
    for k in PREFIXES:
        there = np.flatnonzero(w.end - w.start > k)
        row = np.full(len(w.start), none, np.int32)
        h = w.span_hash(w.start[there], w.start[there] + k, prefix)
        row[there] = (mix(h + U64(k)) >> U64(64 - BITS)).astype(np.int32)
        rows.append(row)
    return np.stack(rows)


@dataclass
class TokenModel:
    weight: np.ndarray = field(default_factory=lambda: np.zeros((1 << BITS) + 1, np.float32))
    bias: float = 0.0
    chain: Chain = field(default_factory=Chain)
    calibration: np.ndarray = field(default_factory=lambda: np.zeros(3))

    def marginals(self, w: Words) -> np.ndarray:
        score = np.full(len(w.start), self.bias)
        for row in token_features(w):
            score += self.weight[row]
        return self.chain.marginals(score, _firsts(w.text))

    def inputs(self, w: Words, p: np.ndarray) -> np.ndarray:
        """Per text: log odds of the largest marginal, log of the expected toxic tokens past one half."""
        n = len(w.off) - 1
        top = np.full(n, _FLOOR)
        np.maximum.at(top, w.text, np.clip(p, _FLOOR, 1 - _FLOOR))
        return np.stack([np.log(top / (1 - top)), np.log1p(np.bincount(w.text, p * (p > 0.5), n)), np.ones(n)], axis=1)

    def scores(self, w: Words, p: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.inputs(w, p) @ self.calibration, -_CLIP, _CLIP)))


_CLIP = 30.0


def sample(docs: DataFrame, labels: DataFrame, admitted, label: str = "toxic", limit: int = SAMPLE, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(text, label): up to ``limit`` toxic and twice as many clean documents."""
    toxic = labelled_sample(docs, labels, label, admitted & (F.col(label) == 1), limit, max_bytes)
    return toxic.unionByName(labelled_sample(docs, labels, label, admitted & (F.col(label) == 0), 2 * limit, max_bytes))


def label_counts(labels: DataFrame, admitted, label: str = "toxic") -> tuple[int, int]:
    """Admitted clean and toxic labels: the balance that the sample doesn't keep."""
    got = {r[0]: r["count"] for r in labels.where(F.col(label).isin(0, 1) & admitted).groupBy(F.col(label).cast("int")).count().collect()}
    return got.get(0, 0), got.get(1, 0)


def _evidence(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    n, p = toxic + clean, n_toxic / (n_toxic + n_clean)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = toxic * np.log(toxic / (n * p)) + np.where(clean > 0, clean * np.log(clean / (n * (1 - p))), 0.0)
    return np.where((n > 0) & (toxic >= 0.8 * n), gain, 0.0)


def fit(rows: DataFrame, counts: tuple[int, int] | None = None, steps: int = STEPS, evidence: float = EVIDENCE) -> TokenModel:
    """Model of a sample; ``counts`` (clean, toxic) of all labels weight the score's fit."""
    got = rows.toArrow()
    label = got.column("label").to_numpy().astype(np.int64)
    model = TokenModel()
    n_toxic = int(label.sum())
    if not len(label) or n_toxic in (0, len(label)):
        share = np.clip(n_toxic / len(label) if len(label) else 0.5, _FLOOR, 1 - _FLOOR)
        model.calibration = np.array([0.0, 0.0, np.log(share / (1 - share))])
        return model
    parts = [(i, Words(data, off)) for i, j, data, off in slices(got.column("text").combine_chunks())]
    feats = np.concatenate([token_features(w) for _, w in parts], axis=1)
    text = np.concatenate([w.text + i for i, w in parts])
    seen = np.zeros((2, (1 << BITS) + 1))                  # documents of either label that hold a feature
    for row in feats:
        own = np.unique(text.astype(np.int64) << 32 | row)    # one feature kind at a time
        seen += np.stack([np.bincount((own & 0xFFFFFFFF)[label[own >> 32] == y], minlength=seen.shape[1]) for y in (0, 1)])
    offending = _evidence(seen[1], seen[0], n_toxic, len(label) - n_toxic) >= evidence
    offending[-1] = False
    y = (offending[feats].any(0) & (label[text] == 1)).astype(np.int64)
    first, adam = _firsts(text), Adam(0.3)
    used = np.zeros((1 << BITS) + 1, bool)
    used[feats] = True
    ids = np.flatnonzero(used)
    place = (np.cumsum(used) - 1).astype(np.int32)
    for row in feats:                                       # from here on rows of the used part of the table
        row[:] = place[row]
    at = feats
    weight, present = np.zeros(len(ids)), (ids != 1 << BITS).astype(float)
    for t in range(1, steps + 1):
        adam.t = t
        score = np.full(len(y), model.bias)
        for row in at:
            score += weight[row]
        by_score, by_trans, by_start = model.chain.gradient(score, first, y)
        grad = sum(np.bincount(row, by_score, len(ids)) for row in at)
        weight = adam.step("w", weight, (grad - 0.05 * weight) * present) * present
        model.bias = float(adam.step("b", model.bias, by_score.sum()))
        model.chain.trans = adam.step("t", model.chain.trans, by_trans - 0.1 * model.chain.trans)
        model.chain.start = float(adam.step("s", model.chain.start, by_start))
    model.weight[ids] = weight
    model.weight[-1] = 0
    x = np.concatenate([model.inputs(w, model.marginals(w)) for _, w in parts])
    clean, toxic = counts if counts and min(counts) else (len(label) - n_toxic, n_toxic)
    weight = np.where(label == 0, clean / toxic * n_toxic / (len(label) - n_toxic), 1.0)
    scale, beta = np.array([5.0, 1.0, 1.0]), np.zeros(3)
    for _ in range(25):                                     # Newton steps of a ridge logistic fit
        p = 1 / (1 + np.exp(-np.clip(x / scale @ beta, -_CLIP, _CLIP)))
        curve = (x / scale).T * (weight * p * (1 - p)) @ (x / scale) + np.eye(3) * 0.1
        beta = beta + np.linalg.solve(curve, (x / scale).T @ (weight * (label - p)) - 0.1 * beta)
    model.calibration = beta / scale
    return model


def scored(docs: DataFrame, model: TokenModel) -> DataFrame:
    """doc_id, score, spans (byte offsets of offending runs of tokens) of every row."""
    def run(batches):
        for b in batches:
            for i, j, data, off in slices(b.column("text")):
                w = Words(data, off)
                p = model.marginals(w)
                bad = p > 0.5
                begin = bad & (~np.append(False, bad[:-1]) | _firsts(w.text))
                end = bad & (~np.append(bad[1:], False) | np.append(_firsts(w.text)[1:], True))
                begin, end = np.flatnonzero(begin), np.flatnonzero(end)
                base = off[w.text[begin]]
                ends = np.append(0, np.cumsum(np.bincount(w.text[begin], minlength=j - i)))
                spans = pa.StructArray.from_arrays([pa.array((w.start[begin] - base).astype(np.int32)), pa.array((w.end[end] - base).astype(np.int32))], ["begin", "end"])
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), pa.array(model.scores(w, p)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), spans)], ["doc_id", "score", "spans"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id long, score double, spans {_SPANS}")
