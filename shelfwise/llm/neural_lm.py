"""Log-bilinear language model trained by noise-contrastive estimation.

The context's two words add up to a vector, q = R[w1] C1 + R[w2] C2, and a symbol
follows with log weight q . T[w] + b[w].  Symbols are the ``SYMBOLS`` most frequent
words, the end of the text, and ``CLASSES`` classes of all other words by their last
bytes; inside a class a word has its smoothed share of the class's count, with one
further type for all words of the class that training lacks.  So the model's
probabilities add up to one over all texts.

Training reads every admitted text once, in ``ROUNDS`` rounds over parts of the rows.
In a round every task learns on its own rows from the same start (numpy, AdaGrad,
batches against shared noise from the unigram distribution, whose logarithms the
biases start with) and hands on its parameters, which are averaged by tokens learned;
a task holds the parameters and one block of tokens.  Scoring normalises: contexts of
a block of tokens are made distinct, and batched matrix products give the log weight
of all symbols after each.

Counts cover every admitted text and every word.  The ``DICTIONARY`` most frequent
words' counts go to the tasks (a bound, cut at a count so that ties stay together);
all other words meet their counts by a join on the word, which no word there fills:
one that is not among the first 131,072 has less than one in 131,072 of all tokens.

Defined cases: null and empty texts are the end alone; without any admitted text all
probabilities are one (score zero); rows are scored one by one, null and repeated
doc_ids too; other input columns are ignored.
"""
from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import saved, text_column

SYMBOLS = 1024
CLASSES = 256
DICTIONARY = 1 << 17
SMOOTH = 0.1
WIDTH = 32
NOISE = 64
BATCH = 1024
RATE = 0.1
ROUNDS = (1, 3, 4)              # eighths of the rows
BLOCK = 1 << 21                 # tokens normalised together
_HELD = 250_000                 # words a task counts before it hands them on
_CHUNK = 4096                   # parameters a row
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
END = b""                       # no word is empty


def words(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()           # bytes.split: x20 and x09-x0D


def _texts(col: pa.Array, at: int, n: int = 64) -> list[bytes]:
    return col.slice(at, n).cast(pa.large_binary()).to_pylist()


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


# ------------------------------------------------------------------ counts --
def token_counts(texts: DataFrame) -> DataFrame:
    """(word, c) of every token of ``texts.text``; the empty word is the end."""
    def run(batches):
        seen: Counter = Counter()

        def handed():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "c"])
        for b in batches:
            text = text_column(b.column("text"))
            seen[END] += len(text)
            for at in range(0, len(text), 64):
                for t in _texts(text, at):
                    seen.update(words(t))
                if len(seen) > _HELD:
                    yield handed()
                    seen.clear()
        if seen:
            yield handed()
    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What every task knows of the counts."""
    tokens: int                         # N
    types: int                          # V
    known: dict[bytes, int]             # counts of the dictionary's words
    symbols: dict[bytes, int]
    class_count: np.ndarray             # tokens and types of the classes' words
    class_types: np.ndarray

    @property
    def size(self) -> int:
        return len(self.symbols) + CLASSES

    def masses(self) -> np.ndarray:
        """Smoothed counts of the symbols, then of the classes."""
        of = [self.known[w] + SMOOTH for w in self.symbols]
        return np.concatenate([of, self.class_count + SMOOTH * (self.class_types + 1)])

    def base_total(self) -> float:
        return self.tokens + SMOOTH * (self.types + 1)


def vocabulary(counts: DataFrame, symbols: int = SYMBOLS, dictionary: int = DICTIONARY) -> Vocabulary:
    last = F.substring("word", -3, 3)
    classes = counts.where(F.octet_length("word") > 0).groupBy(F.pmod(F.crc32(last), F.lit(CLASSES)).cast("int").alias("k")).agg(F.sum("c").alias("c"), F.count("*").alias("v"))
    count, types = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in classes.collect():                     # at most CLASSES rows
        count[r["k"]], types[r["k"]] = r["c"], r["v"]
    # the least count at which the words of this count or more still fit the dictionary
    at, n = 1 << 62, 0
    for r in counts.groupBy("c").agg(F.count("*").alias("v")).orderBy(F.desc("c")).limit(dictionary + 1).collect():
        n += r["v"]
        if n > dictionary:
            break
        at = r["c"]
    got = counts.where(F.col("c") >= at).toArrow()  # at most ``dictionary`` rows
    known = dict(zip(got.column("word").to_pylist(), got.column("c").to_pylist()))
    ends = counts.where(F.octet_length("word") == 0).select("c").first()
    ends = ends[0] if ends else 0
    common = sorted((w for w in known if w != END), key=lambda w: (-known[w], w))[:symbols - 1]
    for w in common:
        count[word_class(w)] -= known[w]
        types[word_class(w)] -= 1
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    known[END] = ends
    return Vocabulary(total[0], total[1], known, {w: i for i, w in enumerate([END, *common])}, count, types)


# ------------------------------------------------------------------ tokens --
def coded(docs: DataFrame, held_out, vocab) -> DataFrame:
    """row, doc_id, held_out, n_tokens, ids (symbols as unsigned 16-bit numbers), base
    and form (log10 of the unigram and of the within-class probabilities, as far as
    they follow from the dictionary), known (tokens found in it) and tail (all other
    words and how often)."""
    schema = "doc_id long, held_out boolean, n_tokens long, ids binary, base double, form double, known long, tail array<struct<word:binary,n:int>>"
    tail_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))

    def run(batches):
        v: Vocabulary = vocab.value
        place, first = {w: i for i, w in enumerate(v.known)}, len(v.symbols)
        inside = np.log10(v.class_count + SMOOTH * (v.class_types + 1)) if v.tokens else np.zeros(CLASSES)
        total = np.log10(v.base_total()) if v.tokens else 0.0
        # by place in the dictionary: symbol, log10 of the smoothed count, log10 of the share of the class
        symbol = np.array([v.symbols[w] if w in v.symbols else first + word_class(w) for w in v.known], np.int64)
        own = np.log10(np.array(list(v.known.values()), float) + SMOOTH) if v.tokens else np.zeros(len(symbol))
        share = np.where(symbol < first, 0.0, own - inside[np.maximum(symbol - first, 0)])
        for b in batches:
            text = text_column(b.column("text"))
            for at in range(0, len(text), 64):
                rows = []
                for t in _texts(text, at):
                    ws = words(t)
                    ws.append(END)
                    ids = np.array([place.get(w, -1) for w in ws], np.int64)
                    out = np.flatnonzero(ids < 0)
                    found = ids[ids >= 0] if len(out) else ids
                    tail = Counter([ws[i] for i in out.tolist()])
                    codes = symbol[ids]
                    base, form = own[found].sum(), share[found].sum()
                    if len(out):                    # the words' own logs come with their counts
                        codes[out] = [first + word_class(ws[i]) for i in out.tolist()]
                        form -= inside[codes[out] - first].sum()
                    rows.append((len(ws), codes.astype("<u2").tobytes(), float(base - len(ws) * total), float(form), len(found) if v.tokens else 0,
                                 [{"word": w, "n": n} for w, n in tail.items()] if v.tokens else []))
                m = len(rows)
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(at, m), b.column("held_out").slice(at, m), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()),
                                                  pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64()), pa.array(cols[4], pa.int64()), pa.array(cols[5], tail_type)],
                                                 ["doc_id", "held_out", "n_tokens", "ids", "base", "form", "known", "tail"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())


def _contexts(texts: list[bytes], begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbol, the one before, the one before that, end of each text) of coded texts."""
    w = np.frombuffer(b"".join(texts), "<u2").astype(np.int32)
    end = np.cumsum([len(t) // 2 for t in texts])
    start = np.concatenate([[0], end[:-1]])
    one, two = np.roll(w, 1), np.roll(w, 2)
    one[start] = begin
    two[start] = begin
    two[start[end - start > 1] + 1] = begin
    return w, one, two, end


def _blocks(batches, limit: int):
    """(rows before, coded texts) of about ``limit`` tokens."""
    held, n = [], 0
    for b in batches:
        for t in b.column("ids").to_pylist():
            held.append(t)
            n += len(t) // 2
            if n >= limit:
                yield held
                held, n = [], 0
    if held:
        yield held


# ------------------------------------------------------------------- model --
class LogBilinear:
    """R (one row more, the place before a text), C1 over C2, and T with b as last column."""

    def __init__(self, size: int, width: int = WIDTH):
        self.shapes = {"r": (size + 1, width), "c": (2 * width, width), "t": (size, width + 1)}
        for name, shape in self.shapes.items():
            setattr(self, name, np.zeros(shape, np.float32))

    @classmethod
    def start(cls, mass: np.ndarray) -> "LogBilinear":
        self, rng = cls(len(mass)), np.random.default_rng(11)
        self.r[:] = rng.normal(0, 0.1, self.r.shape)
        self.t[:] = rng.normal(0, 0.1, self.t.shape)
        self.t[:, -1] = np.log(mass / mass.sum())
        self.c[:] = np.concatenate([np.eye(self.c.shape[1]), 0.5 * np.eye(self.c.shape[1])])
        return self

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.shapes])

    def filled(self, flat: np.ndarray) -> "LogBilinear":
        at = 0
        for name, shape in self.shapes.items():
            size = int(np.prod(shape))
            getattr(self, name)[:] = flat[at:at + size].reshape(shape)
            at += size
        return self

    def context(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        d = self.c.shape[1]
        return self.r[one] @ self.c[:d] + self.r[two] @ self.c[d:]

    def log_probs(self, w: np.ndarray, one: np.ndarray, two: np.ndarray, rows: int = 256) -> np.ndarray:
        """Natural log probability of every symbol after its context, normalised over
        all symbols: one batched product per distinct contexts."""
        code = one.astype(np.int64) * len(self.r) + two
        order = np.argsort(code, kind="stable")
        own = code[order]
        fresh = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        out = np.zeros(len(w))
        for i in range(0, len(fresh), rows):
            at = fresh[i:i + rows]
            stop = fresh[i + rows] if i + rows < len(fresh) else len(own)
            lead = order[at]
            logits = self.context(one[lead], two[lead]) @ self.t[:, :-1].T
            logits += self.t[:, -1]
            logits -= logits.max(axis=1, keepdims=True)
            which = np.repeat(np.arange(len(at)), np.diff(np.append(at, stop)))
            tokens = order[at[0]:stop]
            own_logit = logits[which, w[tokens]]
            share = np.log(np.exp(logits, out=logits).sum(axis=1))
            out[tokens] = own_logit - share[which]
        return out


class _AdaGrad:
    def __init__(self, model: LogBilinear, rate: float):
        self.model, self.rate = model, rate
        self.square = {n: np.ones(s, np.float32) for n, s in model.shapes.items()}

    def rows(self, name: str, at: np.ndarray, grad: np.ndarray) -> None:
        """Step on the rows ``at`` (repeated ones add up)."""
        order = np.argsort(at.astype(np.uint16), kind="stable")
        own = at[order]
        cut = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        grad, own = np.add.reduceat(grad.take(order, 0), cut, axis=0), own[cut]
        square = self.square[name]
        square[own] += grad * grad
        getattr(self.model, name)[own] -= self.rate * grad / np.sqrt(square[own])

    def whole(self, name: str, grad: np.ndarray) -> None:
        self.square[name] += grad * grad
        getattr(self.model, name)[:] -= self.rate * grad / np.sqrt(self.square[name])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def learn(model: LogBilinear, noise: np.ndarray, blocks, rng: np.random.Generator, rate: float = RATE) -> int:
    """One pass of noise-contrastive estimation over blocks of coded texts; returns
    the number of tokens.  Every batch is told from ``NOISE`` shared noise symbols."""
    step, seen, d = _AdaGrad(model, rate), 0, model.c.shape[1]
    upto, offset = np.cumsum(noise), np.log(NOISE * noise).astype(np.float32)
    for texts in blocks:
        w, one, two, _ = _contexts(texts, len(noise))
        mixed = rng.permutation(len(w))
        for i in range(0, len(w), BATCH):
            at = mixed[i:i + BATCH]
            y, a, b = w[at], one[at], two[at]
            fake = np.minimum(np.searchsorted(upto, rng.random(NOISE), "right"), len(noise) - 1)
            ra, rb = model.r.take(a, 0), model.r.take(b, 0)
            q = ra @ model.c[:d] + rb @ model.c[d:]
            ty, tf = model.t.take(y, 0), model.t.take(fake, 0)
            real = _sigmoid(np.einsum("ij,ij->i", q, ty[:, :-1]) + ty[:, -1] - offset[y])[:, None] - 1
            wrong = _sigmoid(q @ tf[:, :-1].T + (tf[:, -1] - offset[fake]))
            by_q = real * ty[:, :-1] + wrong @ tf[:, :-1]
            by_c = np.concatenate([ra.T @ by_q, rb.T @ by_q])
            to_t = np.empty((len(y) + NOISE, d + 1), np.float32)
            np.multiply(real, q, out=to_t[:len(y), :d])
            np.matmul(wrong.T, q, out=to_t[len(y):, :d])
            to_t[:len(y), d], to_t[len(y):, d] = real[:, 0], wrong.sum(0)
            to_r = np.concatenate([by_q @ model.c[:d].T, by_q @ model.c[d:].T])
            step.rows("t", np.concatenate([y, fake]), to_t)
            step.rows("r", np.concatenate([a, b]), to_r)
            step.whole("c", by_c)
        seen += len(w)
    return seen


def _averaged(parts: DataFrame, size: int) -> np.ndarray | None:
    """Mean of the tasks' parameters by weight; chunks meet in one task each."""
    def run(batches):
        sums: dict[int, list] = {}
        for b in batches:
            for r in b.to_pylist():
                have = sums.setdefault(r["chunk"], [0.0, 0.0])
                have[0] += r["weight"]
                have[1] = have[1] + r["weight"] * np.frombuffer(r["v"], np.float32).astype(float)
        for chunk, (weight, v) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([(v / weight).astype(np.float32).tobytes()], pa.binary())], ["chunk", "v"])
    got = parts.repartition("chunk").mapInArrow(run, "chunk int, v binary").collect()      # the model itself
    if not got:
        return None
    flat = b"".join(r["v"] for r in sorted(got, key=lambda r: r["chunk"]))
    return np.frombuffer(flat, np.float32)[:size]


def trained(rows: DataFrame, vocab: Vocabulary, rounds: tuple[int, ...] = ROUNDS) -> LogBilinear:
    """The model after every text of ``rows`` (row, ids) was learned once."""
    spark = rows.sparkSession
    mass = vocab.masses()
    model, noise, first = LogBilinear.start(mass), mass / mass.sum(), 0
    slot = F.pmod(F.xxhash64("row"), F.lit(sum(rounds)))
    for r, share in enumerate(rounds):
        start = spark.sparkContext.broadcast(model.flat())

        def run(batches, start=start, r=r):
            own = LogBilinear(len(noise)).filled(start.value)
            n = learn(own, noise, _blocks(batches, BLOCK // 8), np.random.default_rng([r, TaskContext.get().partitionId()]))
            flat = own.flat()
            for c in range(0, len(flat) if n else 0, _CHUNK):
                yield pa.RecordBatch.from_arrays([pa.array([c // _CHUNK], pa.int32()), pa.array([float(n)]), pa.array([flat[c:c + _CHUNK].tobytes()], pa.binary())], ["chunk", "weight", "v"])
        part = rows.where((slot >= first) & (slot < first + share)).select("ids")
        flat = _averaged(part.mapInArrow(run, "chunk int, weight double, v binary"), len(model.flat()))
        if flat is not None:
            model = LogBilinear(len(noise)).filled(flat)
        first += share
    return model


def scored(docs: DataFrame, held_out, symbols: int = SYMBOLS, dictionary: int = DICTIONARY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every
    row; rows where ``held_out`` holds are not learned from."""
    spark = docs.sparkSession
    counts = saved(spark, token_counts(docs.where(~held_out).select(F.col("text").cast("string").alias("text"))), "token-counts")
    vocab = vocabulary(counts, symbols, dictionary)
    shared = spark.sparkContext.broadcast(vocab)            # dictionary and classes
    rows = saved(spark, coded(docs, held_out, shared), "coded-texts")
    model = spark.sparkContext.broadcast(trained(rows.where(~F.col("held_out")).select("row", "ids"), vocab) if vocab.tokens else None)

    def run(batches):
        net, names = model.value, ["row", "doc_id", "held_out", "n_tokens", "known", "base", "score"]
        for b in batches:
            # runs of whole rows of about BLOCK tokens
            size = np.cumsum(b.column("n_tokens").to_numpy())
            i = 0
            while i < b.num_rows:
                j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + BLOCK, "right")))
                part = b.slice(i, j - i)
                total = part.column("form").to_numpy()
                if net is not None:
                    w, one, two, end = _contexts(part.column("ids").to_pylist(), len(net.t))
                    upto = np.concatenate([[0.0], np.cumsum(net.log_probs(w, one, two))])
                    total = total + np.diff(upto[np.concatenate([[0], end])]) / np.log(10)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in names[:-1]] + [pa.array(total)], names)
                i = j
    heads = rows.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "form", "ids").mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double")
    tail = rows.select("row", F.explode("tail").alias("t")).select("row", F.col("t.word").alias("word"), F.col("t.n").alias("n"))
    # words outside the dictionary: their counts by the word; absent ones are unknown
    found = (tail.join(counts, "word", "left")
             .groupBy("row").agg(F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(SMOOTH))).alias("own"),
                                 F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("found")))
    out = heads.join(found, "row", "left")
    own = F.coalesce("own", F.lit(0.0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(vocab.tokens).cast("long").alias("train_tokens"),
                      (F.col("base") + own).alias("base_score"), (F.col("score") + own).alias("score"))
