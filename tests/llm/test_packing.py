"""Packing against the tokenizer on whole texts and a bin-by-bin best fit."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from shelfwise.llm import packing as pk
from shelfwise.llm.common import table
from shelfwise.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def encode(text):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return tok.encode(text or "", add_special_tokens=False).ids + [0]


def best_fit(lengths, capacity):
    left = []
    for n in sorted(lengths, reverse=True):
        fit = [(c, i) for i, c in enumerate(left) if c >= n]
        if fit:
            left[min(fit)[1]] -= n
        else:
            left.append(capacity - n)
    return left


def check(rows, texts, capacity):
    by = defaultdict(list)
    bins = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    assert set(by) == set(texts)
    for d, own in by.items():
        ids = encode(texts[d])
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        cuts = [ids[i:i + capacity] for i in range(0, len(ids), capacity)]
        assert [(r.start, r.length, r.ids_crc32) for r in own] == [
            (i * capacity, len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for i, c in enumerate(cuts)]
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0] + [n for _, n in own])[:-1].tolist()
        assert sum(n for _, n in own) <= capacity
    assert len(bins) == len(best_fit([r.length for r in rows], capacity))


def test_whole_table(spark):
    rows = QUERIES["op8_best_fit_packing"](spark, SF).collect()
    check(rows, {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}, 2048)


def test_odd_texts(spark, make_docs):
    texts = [None, "", "a", "it's we'll I'M don't.", "x<|endoftext|>y <|startoftext|>", "tab\there\r\nthere\x0bvt\x85nel nbsp ls",
             "ΟΔΟΣ ΣΑΣ Σ. é ́x", "9876 a1b2 ...!?", "word " * 9000, "İSTANBUL ǅ", "x" * 20_000, "end. (end), end!? 'end'"]
    for cap in (2048, 7):
        check(pk.pack_documents(make_docs(texts), cap).collect(), dict(enumerate(texts)), cap)


def test_plan_is_best_fit_decreasing():
    rnd = random.Random(2)
    for _ in range(200):
        cap = rnd.choice([5, 16, 50, 100])
        lengths = [rnd.randint(1, cap) for _ in range(rnd.randint(1, 120))]
        runs = pk.plan(Counter(lengths), cap)
        fill = Counter()
        for n, a, b, first, per, off in runs:
            for r in range(b - a):
                assert fill[first + r // per] == off + r % per * n
                fill[first + r // per] += n
        assert sorted(cap - f for f in fill.values()) == sorted(best_fit(lengths, cap))
        assert max(fill.values()) <= cap


def test_hot_length_empty_and_clashing_columns(spark, make_docs):
    assert pk.pack_documents(make_docs([])).count() == 0
    docs = make_docs(["same words"] * 500, [None] * 3 + [1] * 3 + list(range(6, 500))).selectExpr("*", "1 as length", "2 as offset", "3 as _b")
    rows = pk.pack_documents(docs, 8).collect()
    assert len(rows) == 500 and len({(r.sequence_id, r.offset) for r in rows}) == 500


def test_ids_come_with_the_pieces(spark, make_docs):
    row = pk.pieces(make_docs(["to be or not"]), with_ids=True).first()
    assert np.frombuffer(bytes(row.ids), "<u4").tolist() == encode("to be or not")
