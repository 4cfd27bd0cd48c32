"""Suffix-array dedup: cut every byte covered by a string of ``length`` bytes
that also starts in a document with a smaller doc_id, keeping first copies.

A bucket's suffixes are sorted, to a depth of ``length`` bytes, and get the
common prefix with their neighbour.  The longest previous factor of a suffix is
the longest prefix that a suffix of a smaller document shares; the previous and
the next smaller position (the nearest suffixes of smaller documents on either
side) have it, and the least common prefix on the way there is its length.  A
string has an earlier match where its suffix's factor reaches ``length``.

Strings are dealt out by their minimizer, the seed of ``seed`` bytes with the
least hash within the string: equal strings have the same one at the same place.
Successive strings of a text that share a minimizer form one piece of at most
2 * length - seed bytes, so the pieces are a fraction of all suffixes.

1. Texts are gathered into chunks, which learn which of their minimizers other
   chunks hold too (rendezvous.py).
2. For these, and those that two of its own texts hold, the chunk sends each
   distinct piece once with the smallest document that has it; so a passage or
   copy that a third of all documents hold is one row a chunk.  A bucket sorts
   the suffixes of pieces with one minimizer and answers which strings have a
   smaller document elsewhere.  Around a minimizer that over ``heavy`` distinct
   pieces hold, each has other neighbours (a common short line, the edges of a
   common long one): there the strings themselves are dealt, by their hash, once
   a chunk with the smallest and the largest document that has them.
3. The chunk marks those strings in that smallest document, all strings of the
   piece in its other documents, and cuts what they cover.

All three read one exchange of the texts.  Defined cases: a null text is empty;
a null doc_id counts as larger than any other and is left null; rows with equal
doc_id don't match each other; shorter texts than ``length`` stay whole; an
empty table gives an empty result.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import _BYTE, _MUL, U64, Words, mix, sliding_min, slices
from .rendezvous import CHUNK_BYTES, TextChunks, blob, by_bucket, chunks, found, planes, split, told, unblob, unplanes, wanted

LENGTH = 50
SEED = 20
HEAVY = 2000
_LAST = (1 << 63) - 1
_PLACE = U64((1 << 24) - 1)
_BLOCK = 1 << 22
REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def seed_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes from every position, doubling the span."""
    h, span, out, done = _BYTE[data], 1, None, 0
    while True:
        if k & span:
            if out is None:
                out, done = h, span
            else:
                n = min(len(out), len(h) - done)
                out, done = out[:n] * _MUL + h[done:done + n], done + span
        if done == k:
            return mix(out)
        h = h[:-span] * (_MUL + U64(2 * span)) + h[span:]
        span *= 2


class Pieces:
    """Pieces of a run of texts: start, strings (how many begin in it), place of
    the minimizer, its hash, and the text's index."""

    def __init__(self, data: np.ndarray, off: np.ndarray, length: int, seed: int):
        self.data, self.off, self.length = data, off, length
        self.width = 2 * length - seed
        n = len(data) - length + 1
        parts = [self._block(a, min(n, a + _BLOCK), length, seed) for a in range(0, max(n, 0), _BLOCK)]
        self.start, self.strings, self.place, self.hash = (np.concatenate(x) if parts else np.zeros(0, t) for x, t in
                                                           zip(zip(*parts) if parts else [()] * 4, (np.int64, np.int64, np.int64, U64)))
        self.text = np.searchsorted(off, self.start, "right") - 1

    def _block(self, a: int, b: int, length: int, seed: int):
        h = seed_hashes(self.data[a:b + length - 1], seed)
        low = sliding_min((h & ~_PLACE) | np.arange(len(h), dtype=U64), length - seed + 1)[:b - a]
        whole = np.ones(b - a, bool)
        for end in self.off[1:].tolist():
            if a < end < b + length:
                whole[max(0, end - length + 1 - a):max(0, end - a)] = False
        at = np.flatnonzero(whole)
        place = (low[at] & _PLACE).astype(np.int64)
        cut = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(at) else np.zeros(0, np.int64)
        return at[cut] + a, np.diff(np.append(cut, len(at))), place[cut] + a, h[place[cut]]

    def bytes(self, which: np.ndarray | slice = slice(None)) -> np.ndarray:
        """(pieces, width) bytes, zeros after the end."""
        padded = np.concatenate([self.data, np.zeros(self.width, np.uint8)])
        return _cleared(np.lib.stride_tricks.sliding_window_view(padded, self.width)[self.start[which]], self.strings[which] + self.length - 1)


def _cleared(rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    rows = rows if rows.flags.writeable else rows.copy()
    rows[np.arange(rows.shape[1]) >= size[:, None]] = 0
    return rows


def _names(rows: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """64-bit name of each piece's bytes."""
    width = -(-rows.shape[1] // 8) * 8
    if width != rows.shape[1]:
        rows = np.concatenate([rows, np.zeros((len(rows), width - rows.shape[1]), np.uint8)], axis=1)
    words = np.ascontiguousarray(rows).view("<u8")
    h = strings.astype(U64)
    for j in range(words.shape[1]):
        h = mix(h * _MUL + words[:, j])
    return h


def _least(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, inverse, least value of each)."""
    keys, inverse = np.unique(key, return_inverse=True)
    least = np.full(len(keys), _LAST)
    np.minimum.at(least, inverse, value)
    return keys, inverse, least


def _scanned(common: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """``_toward_smaller`` by one scan with a stack of smaller documents."""
    out, stack = [], []
    for d, least in zip(doc.tolist(), common.tolist()):
        while stack and stack[-1][0] >= d:
            least = min(least, stack.pop()[1])
        out.append(least if stack else 0)
        stack.append((d, out[-1]))
    return np.array(out, np.int64)


def _toward_smaller(common: np.ndarray, doc: np.ndarray, steps: int = 32) -> np.ndarray:
    """What every suffix has in common with the previous one of a smaller
    document (0: none), where ``common`` is that with the suffix before it.
    All step at once past documents that aren't smaller: what the one before
    stepped past isn't smaller either.  Few need more than some steps; where
    any does, the scan takes over, so that no order costs more than that."""
    before, least = np.arange(len(doc)) - 1, common.copy()
    least[:1] = 0
    todo = np.flatnonzero(least > 0)
    for _ in range(steps):
        todo = todo[doc[before[todo]] >= doc[todo]]
        if not len(todo):
            return least
        via = before[todo]
        least[todo], before[todo] = np.minimum(least[todo], least[via]), before[via]
        todo = todo[least[todo] > 0]
    return _scanned(common, doc)


def previous_factors(common: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Longest previous factor of every suffix: the longest prefix that one of a
    smaller document shares.  Of these the previous and the next in suffix order
    have most in common with it."""
    back = np.append(0, common[:0:-1])                 # the same array read from the end
    return np.maximum(_toward_smaller(common, doc), _toward_smaller(back, doc[::-1])[::-1]) if len(doc) else common


def suffix_order(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, bytes in common with the one before in that order) of equally long rows."""
    n, length = text.shape
    keys = np.zeros((n, -(-length // 8) * 8), np.uint8)
    keys[:, :length] = text
    keys = keys.view(">u8").astype(U64)
    order = np.lexsort(keys.T[::-1])
    keys = keys[order]
    differ = keys[1:] ^ keys[:-1]
    word = (differ != 0).argmax(1)
    rest = differ[np.arange(len(word)), word]
    common = np.zeros(n, np.int64)
    common[1:] = 8 * word
    for bit in range(8, 64, 8):
        common[1:] += rest < U64(1) << U64(bit)        # zero bytes before the first that differs
    common[1:][rest == 0] = length
    return order, common


def earlier(rows: np.ndarray, strings: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """(pieces, most strings) whether a piece of a smaller document has the string:
    the longest previous factor of its suffix reaches ``length``."""
    most = rows.shape[1] - length + 1
    piece, at = np.nonzero(np.arange(most) < strings[:, None])
    order, common = suffix_order(np.lib.stride_tricks.sliding_window_view(rows, length, axis=1)[piece, at])
    piece, at = piece[order], at[order]
    out = np.zeros((len(rows), most), bool)
    out[piece, at] = previous_factors(common, doc[piece]) >= length
    return out


def strings_of(p: Pieces, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, place in the run, 64-bit name) of every string of some pieces."""
    n = p.strings[which]
    piece = np.repeat(which, n)
    begin = p.start[piece] + np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
    name = np.empty(len(begin), U64)
    for a in range(0, len(begin), 1 << 16):
        part = begin[a:a + (1 << 16)]
        name[a:a + (1 << 16)] = _names(np.lib.stride_tricks.sliding_window_view(p.data, p.length)[part], np.zeros(len(part), np.int64))
    return piece, begin, name


class Chunk:
    """A chunk's texts as runs of pieces."""

    def __init__(self, rows: pa.StructArray, length: int, seed: int):
        ids = rows.field("doc_id")
        self.rows, self.length = rows, length
        self.doc = ids.cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)
        self.runs = [(i, Pieces(data, off, length, seed)) for i, j, data, off in slices(rows.field("text"))]

    def hashes(self) -> np.ndarray:
        return np.concatenate([p.hash for _, p in self.runs] or [np.zeros(0, U64)])

    def distinct(self) -> np.ndarray:
        """The minimizer's hash of every distinct piece."""
        h = self.hashes()
        _, inverse, times = np.unique(h, return_inverse=True, return_counts=True)
        many, at, names = times[inverse] > 1, 0, []
        for _, p in self.runs:
            sel = np.flatnonzero(many[at:at + len(p.start)])
            names.append(_names(p.bytes(sel), p.strings[sel]))
            at += len(p.start)
        _, first = np.unique(np.concatenate(names or [np.zeros(0, U64)]), return_index=True)
        return np.append(h[~many], h[many][first])

    def texts(self) -> np.ndarray:
        return np.concatenate([p.text + i for i, p in self.runs] or [np.zeros(0, np.int64)])


def _send(buckets: int, length: int, seed: int):
    def one(chunk, rows, answers):
        c = Chunk(rows, length, seed)
        h = c.hashes()
        bucket, _ = split(h, buckets)
        hot = told(answers, h, buckets, "hot")
        send = wanted(answers, h, buckets, c.texts()) & ~hot
        at, out, single = 0, [], []
        for i, p in c.runs:
            sel = np.flatnonzero(send[at:at + len(p.start)])
            out.append((p.bytes(sel), p.strings[sel], p.place[sel] - p.start[sel], c.doc[i + p.text[sel]], bucket[at + sel]))
            piece, _, name = strings_of(p, np.flatnonzero(hot[at:at + len(p.start)]))
            single.append((name, c.doc[i + p.text[piece]], p.hash[piece]))
            at += len(p.start)
        rows, strings, place, doc, bucket = map(np.concatenate, zip(*out))
        names, inverse, least = _least(_names(rows, strings), doc)
        first = np.zeros(len(names), np.int64)
        first[inverse[::-1]] = np.arange(len(inverse))[::-1]
        rows, strings, place, bucket = rows[first], strings[first], place[first], bucket[first]
        live = np.arange(rows.shape[1]) < (strings + length - 1)[:, None]
        name, doc, seeds = map(np.concatenate, zip(*single))
        name, inverse, low = _least(name, doc)
        high, seed_of = np.full(len(name), -_LAST - 1), np.zeros(len(name), U64)
        np.maximum.at(high, inverse, doc)
        seed_of[inverse] = seeds
        n = len(bucket)                                # first the pieces, then the strings on their own
        own = lambda f: lambda g: f(g[g < n])
        alone = lambda x: lambda g: planes(x[g[g >= n] - n])
        return by_bucket(chunk, np.append(bucket, split(name, buckets)[0]), {
            "bytes": own(lambda g: rows[g][live[g]].tobytes()), "strings": own(lambda g: blob(strings[g].astype(np.uint8))),
            "places": own(lambda g: blob(place[g].astype(np.uint8))), "docs": own(lambda g: blob(least[g])),
            "names": alone(name), "leasts": alone(low), "mosts": alone(high ^ low), "seeds": alone(seed_of.astype(np.uint32))})

    def run(batches):
        for x in chunks(batches):
            yield one(*x)
    return run


def _answer(length: int, seed: int):
    width = 2 * length - seed

    def run(t: pa.Table) -> pa.Table:
        strings = [np.frombuffer(x, np.uint8).astype(np.int64) for x in t.column("strings").to_pylist()]
        ends = np.cumsum([len(x) for x in strings])
        strings = np.concatenate(strings)
        place = unblob(t.column("places").to_pylist(), np.uint8).astype(np.int64)
        doc = unblob(t.column("docs").to_pylist(), np.int64)
        data = np.concatenate([unblob(t.column("bytes").to_pylist(), np.uint8), np.zeros(width, np.uint8)])
        size = strings + length - 1
        start = np.cumsum(size) - size
        rows = _cleared(np.lib.stride_tricks.sliding_window_view(data, width)[start], size)
        seeds = _names(np.lib.stride_tricks.sliding_window_view(data, seed)[start + place], np.zeros(len(start), np.int64))
        name = _names(rows, strings)
        names, inverse, least = _least(name, doc)
        first = np.zeros(len(names), np.int64)
        first[inverse] = np.arange(len(inverse))
        own_seed = seeds[first]
        _, by_seed, times = np.unique(own_seed, return_inverse=True, return_counts=True)
        had = np.zeros((len(names), length - seed + 1), bool)
        # pieces that differ but share a minimizer may share strings: sort their suffixes,
        # whole minimizers at a time
        several = np.flatnonzero(times[by_seed] > 1)
        several = several[np.argsort(by_seed[several], kind="stable")]
        edge = np.flatnonzero(np.append(True, np.diff(by_seed[several]) != 0)) if len(several) else np.zeros(0, np.int64)
        a = 0
        while a < len(several):
            later = edge[edge >= a + 20_000]
            b = int(later[0]) if len(later) else len(several)
            g = first[several[a:b]]
            had[several[a:b]] = earlier(rows[g], strings[g], least[several[a:b]], length)
            a = b
        # a piece's strings are cut in all its documents, or in all but the smallest
        mask, power = np.empty(len(doc), U64), U64(1) << np.arange(had.shape[1], dtype=U64)
        for a in range(0, len(doc), 1 << 14):
            part = slice(a, a + (1 << 14))
            bits = (had[inverse[part]] | (least[inverse[part]] < doc[part])[:, None]) & (np.arange(had.shape[1]) < strings[part, None])
            mask[part] = bits @ power
        out = []
        for a, b in zip(np.append(0, ends[:-1]), ends):
            hit = a + np.flatnonzero(mask[a:b])
            out.append((blob(name[hit]), blob(mask[hit])))
        # strings on their own: cut in the documents after the least of all chunks
        cols = {k: [unplanes([x], kind) for x in t.column(k).to_pylist()] for k, kind in (("names", U64), ("leasts", np.int64), ("mosts", np.int64), ("seeds", np.uint32))}
        ends = np.cumsum([len(x) for x in cols["names"]])
        name, least, most, of = (np.concatenate(x) for x in cols.values())
        _, inverse, low = _least(name, least)
        low, cut = low[inverse], []
        for a, b in zip(np.append(0, ends[:-1]), ends):
            hit = a + np.flatnonzero((most ^ least)[a:b] > low[a:b])
            cut.append((planes(name[hit]), planes(low[hit]), planes(np.unique(of[hit]))))
        given = [(chunk, x + y) for chunk, x, y in zip(t.column("chunk").to_pylist(), out, cut) if any(x + y)]
        rows = [x for _, x in given]
        return pa.table({"chunk": pa.array([chunk for chunk, _ in given], pa.int64()), **{k: pa.array([x[j] for x in rows], pa.binary()) for j, k in enumerate(("names", "masks", "strings", "lows", "seeds"))}})
    return run


def _covered(c: Chunk, answers):
    """(first row, run of texts, whether each byte is cut), run by run."""
    length = c.length
    every = np.concatenate([_names(p.bytes(), p.strings) for _, p in c.runs] or [np.zeros(0, U64)])
    doc = np.concatenate([c.doc[i + p.text] for i, p in c.runs] or [np.zeros(0, np.int64)])
    _, inverse, least = _least(every, doc)
    later = doc > least[inverse]
    key, mask = unblob([a["names"] for a in answers], U64), unblob([a["masks"] for a in answers], U64)
    order = np.argsort(key)
    key, mask = key[order], mask[order]
    string, low = unplanes([a["strings"] for a in answers], U64), unplanes([a["lows"] for a in answers], np.int64)
    order = np.argsort(string)
    string, low = string[order], low[order]
    hot = np.unique(unplanes([a["seeds"] for a in answers], np.uint32))
    at = 0
    for i, p in c.runs:
        part = slice(at, at + len(p.start))
        at += len(p.start)
        known, where = found(key, every[part])
        own = np.zeros(len(p.start), U64)
        own[known] = mask[where[known]]
        own[later[part]] = ~U64(0)
        hit = np.flatnonzero(own)
        most = int(p.strings.max()) if len(p.strings) else 0
        k = np.arange(most)
        piece, at_string = np.nonzero((own[hit][:, None] >> k.astype(U64) & U64(1)).astype(bool) & (k < p.strings[hit][:, None]))
        step = np.zeros(len(p.data) + length + 1, np.int32)
        begins = p.start[hit[piece]] + at_string
        step[begins] += 1                              # every string begins once
        step[begins + length] -= 1
        piece, begin, name = strings_of(p, np.flatnonzero(found(hot, p.hash.astype(np.uint32))[0]))
        known, where = found(string, name)
        after = np.flatnonzero(known)
        begins = begin[after[c.doc[i + p.text[piece[after]]] > low[where[after]]]]
        step[begins] += 1                              # and once more around a heavy minimizer
        step[begins + length] -= 1
        yield i, p, np.cumsum(step[:len(p.data)]) > 0


def _report(length: int, seed: int):
    def run(batches):
        for _, rows, answers in chunks(batches):
            for i, p, cut in _covered(Chunk(rows, length, seed), answers):
                n = len(p.off) - 1
                total = np.append(0, np.cumsum(cut))[p.off]
                spans = np.bincount(Words(cut.view(np.uint8), p.off, _ONE, hashes=False).text, minlength=n)
                kept, at = p.data[~cut].tobytes(), p.off - total
                sha = [hashlib.sha256(kept[x:y]).hexdigest() for x, y in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([rows.field("doc_id").slice(i, n).cast(pa.int64()), pa.array(np.diff(p.off)), pa.array(np.diff(total)), pa.array(spans.astype(np.int64)), pa.array(sha)],
                                                 ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


_ONE = np.zeros(256, bool)
_ONE[1] = True


def _rows(length: int, seed: int, names: list[str]):
    def run(batches):
        for _, rows, answers in chunks(batches):
            for i, p, cut in _covered(Chunk(rows, length, seed), answers):
                n = len(p.off) - 1
                kept, at = p.data[~cut].tobytes(), p.off - np.append(0, np.cumsum(cut))[p.off]
                cols = {k: rows.field(k).slice(i, n) for k in names}
                # a character that a cut divides goes whole
                text = [None if none else kept[x:y].decode("utf-8", "ignore") for x, y, none in zip(at[:-1], at[1:], cols["text"].is_null().to_pylist())]
                cols["text"] = pa.array(text, pa.string())
                if "n_chars" in cols:
                    cols["n_chars"] = pa.array([None if t is None else len(t) for t in text], cols["n_chars"].type)
                yield pa.RecordBatch.from_arrays([cols[k] for k in names], names)
    return run


def _run(docs: DataFrame, finish, schema: str, length: int, seed: int, chunk_bytes: int, heavy: int) -> DataFrame:
    texts = TextChunks(docs, chunk_bytes)
    shared = texts.shared(lambda rows: Chunk(rows, length, seed).distinct(), heavy)
    sent = (texts.answered(shared, "bucket", "sigs", "hot")
            .mapInArrow(_send(texts.buckets, length, seed), "chunk long, bucket long, bytes binary, strings binary, places binary, docs binary, names binary, leasts binary, mosts binary, seeds binary"))
    judged = sent.groupBy("bucket").applyInArrow(_answer(length, seed), "chunk long, names binary, masks binary, strings binary, lows binary, seeds binary")
    return texts.answered(judged, "names", "masks", "strings", "lows", "seeds").mapInArrow(finish, schema)


def report(docs: DataFrame, length: int = LENGTH, seed: int = SEED, chunk_bytes: int = CHUNK_BYTES, heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _run(rows, _report(length, seed), REPORT, length, seed, chunk_bytes, heavy)


def removed(docs: DataFrame, length: int = LENGTH, seed: int = SEED, chunk_bytes: int = CHUNK_BYTES, heavy: int = HEAVY) -> DataFrame:
    """Every row of ``docs`` with the rest of its text (and n_chars, where there
    is one, counted anew); a character that a cut divides goes whole."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return _run(docs, _rows(length, seed, docs.columns), schema, length, seed, chunk_bytes, heavy)
