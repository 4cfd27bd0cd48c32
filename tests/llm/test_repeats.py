"""Removal of repeated strings against brute force over every 50-byte window."""
import hashlib
import random

import numpy as np
import pyarrow as pa

from shelfwise.llm import rendezvous as rdv, repeats as rp
from shelfwise.llm.common import table
from shelfwise.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(docs, length=50):
    """(doc_id, text) -> n_bytes, n_removed, n_spans, sha256 and kept bytes."""
    raw = [(float("inf") if d is None else d, (t or "").encode()) for d, t in docs]
    first = {}
    for d, b in raw:
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            if first.get(s, float("inf")) >= d:
                first[s] = d
    out = []
    for (d, b), (own, _) in zip(raw, docs):
        cut = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < d:
                cut[i:i + length] = True
        kept = bytes(x for x, c in zip(b, cut) if not c)
        spans = int((cut[:-1] & ~np.append(False, cut[:-2])).sum()) if len(b) else 0
        out.append((own, len(b), int(cut.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    want = brute(docs)
    assert sum(w[2] for w in want) > 0
    assert rows(QUERIES["op4_suffix_array_dedup"](spark, SF)) == want


def test_shifted_and_overlapping_repeats(spark, make_docs):
    rnd = random.Random(7)
    prose = lambda n: "".join(rnd.choice("abcdé \n") for _ in range(n))
    pool = [prose(rnd.choice([40, 49, 50, 51, 80, 300])) for _ in range(12)]
    texts = ["".join(rnd.choice(pool)[rnd.randrange(30):] if rnd.random() < 0.6 else prose(rnd.randrange(90)) for _ in range(rnd.randrange(9))) for _ in range(120)]
    ids = rnd.sample(range(-500, 500), len(texts))
    docs = list(zip(ids, texts))
    frame = make_docs(texts, ids)
    for chunk in (8 << 20, 2000):
        assert rows(rp.report(frame, chunk_bytes=chunk)) == brute(docs)
    assert rows(rp.report(frame, length=24, seed=9)) == brute(docs, 24)


def test_odd_rows(spark, make_docs):
    same = "the same fifty bytes, and a few more of them, for sure"
    texts = [None, "", "short", "a" * 500, "a" * 200, same, same, same + "é", "é" * 60, "x" + "é" * 60, same, "b" * 49, "b" * 49, same[:50]]
    ids = [0, 1, 2, 3, 4, 6, 6, 7, 8, 9, None, 11, 12, None]
    docs = make_docs(texts, ids)
    assert rows(rp.report(docs.selectExpr("*", "1 as chunk", "2 as n_bytes"))) == brute(list(zip(ids, texts)))
    kept = rp.removed(docs)
    assert kept.columns == docs.columns
    got = {(r.doc_id, r.n_chars): r.text for r in kept.collect()}
    assert got[0, None] is None and got[4, 0] == "" and got[6, len(same)] == same and got[7, 0 + 1] == "é"
    assert got[9, 1] == "x" and got[None, 0] == ""


def test_empty(spark, make_docs):
    assert rp.report(make_docs([])).count() == 0
    assert rp.removed(make_docs([])).count() == 0


def test_hot_copies(spark, make_docs):
    text = " ".join(f"w{i}" for i in range(60))
    out = rows(rp.report(make_docs([text] * 300 + [f"{text} {i}" for i in range(300)])))
    assert sum(r[2] == 0 for r in out) == 1


def test_long_text_in_blocks():
    rnd = np.random.default_rng(1)
    data = rnd.integers(97, 100, 5000).astype(np.uint8)
    off = np.array([0, 1200, 1200, 1230, 5000])
    whole = rp.Pieces(data, off, 50, 20)
    block, rp._BLOCK = rp._BLOCK, 333
    try:
        cut = rp.Pieces(data, off, 50, 20)
    finally:
        rp._BLOCK = block
    spread = lambda p: sorted((s + k, m, h) for s, n, m, h in zip(p.start.tolist(), p.strings.tolist(), p.place.tolist(), p.hash.tolist()) for k in range(n))
    assert spread(whole) == spread(cut)
    assert [x for x, _, _ in spread(whole)] == [*range(0, 1151), *range(1230, 4951)]


def common_prefix(x, y):
    return next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))


def test_previous_factors_by_their_definition():
    rnd = np.random.default_rng(23)
    for length in (3, 8, 9, 50):
        for n in [0, 1, 2, *rnd.integers(3, 60, 40)]:
            text = rnd.integers(97, 99, (n, length)).astype(np.uint8)
            for i in range(1, n):                      # long prefixes in common, and whole strings
                if rnd.random() < 0.7:
                    keep = rnd.integers(0, length + 1)
                    text[i, :keep] = text[rnd.integers(0, i), :keep]
            doc = rnd.integers(0, rnd.integers(1, 12), n)
            order, common = rp.suffix_order(text)
            raw = [text[i].tobytes() for i in order]
            assert raw == sorted(x.tobytes() for x in text)
            assert common.tolist() == [common_prefix(raw[i - 1], raw[i]) if i else 0 for i in range(n)]
            want = [max((common_prefix(raw[i], raw[j]) for j in range(n) if doc[order[j]] < doc[order[i]]), default=0) for i in range(n)]
            assert rp.previous_factors(common, doc[order]).tolist() == want
            for steps in (0, 1, 3):
                assert rp._toward_smaller(common, doc[order], steps).tolist() == rp._toward_smaller(common, doc[order]).tolist()


def test_no_order_of_documents_is_slow():
    up = np.arange(30_000)
    for doc in (np.append(up, up[::-1]), np.append(up + 1, 0), up * 0):
        common = np.append(0, np.full(len(doc) - 1, 50))
        assert rp._toward_smaller(common, doc).tolist() == rp._scanned(common, doc).tolist()


def test_earlier_strings_of_pieces():
    rnd = np.random.default_rng(29)
    for _ in range(30):
        n, length, width = int(rnd.integers(1, 25)), 6, 9
        strings, doc = rnd.integers(1, width - length + 2, n), rnd.integers(0, 6, n)
        rows = rp._cleared(rnd.integers(97, 99, (n, width)).astype(np.uint8), strings + length - 1)
        cut = [[rows[i, k:k + length].tobytes() for k in range(strings[i])] for i in range(n)]
        got = rp.earlier(rows, strings, doc, length)
        for i in range(n):
            want = [any(s in cut[j] for j in range(n) if doc[j] < doc[i]) for s in cut[i]]
            assert got[i].tolist() == want + [False] * (width - length + 1 - len(want))


def test_heavy_minimizers(spark, make_docs):
    rnd = random.Random(13)
    prose = lambda n: "".join(rnd.choice("abcdefgh \n") for _ in range(n))
    lines = ["a common line of thirty bytes.", prose(25), prose(49), prose(90)]
    some = [prose(60) for _ in range(20)]
    texts = [prose(rnd.randrange(60)) + rnd.choice(some) + rnd.choice(lines) + rnd.choice(some)[:rnd.randrange(60)] + prose(rnd.randrange(40)) for _ in range(400)]
    ids = [None if i % 40 == 0 else i // 2 for i in rnd.sample(range(400), 400)]
    frame = make_docs(texts, ids)
    want = brute(list(zip(ids, texts)))
    for chunk in (8 << 20, 3000, 1):
        assert rows(rp.report(frame, chunk_bytes=chunk, heavy=20)) == want


def test_no_group_grows_with_a_minimizer():
    """A short common line: its strings go to many buckets, none of them pieces."""
    rnd = random.Random(17)
    line = "the same line in every document"
    texts = ["".join(rnd.choice("abcdefgh") for _ in range(60)) + line + "".join(rnd.choice("abcdefgh") for _ in range(60)) for _ in range(3000)]
    struct = pa.StructArray.from_arrays([pa.array(range(3000)), pa.array(texts)], ["doc_id", "text"])
    batch = pa.RecordBatch.from_arrays([pa.array([0]), pa.ListArray.from_arrays([0, 3000], struct)], ["chunk", "rows"])
    told, times = np.unique(rp.Chunk(struct, 50, 20).distinct(), return_counts=True)
    bucket, sig = rdv.split(told, 64)
    announced = pa.Table.from_batches([rdv.by_bucket(0, bucket, {"sigs": lambda g: rdv.planes(sig[g]), "times": lambda g: rdv.planes(times[g].astype(np.uint16))})])
    hot = [rdv._shared(rp.HEAVY)(announced.slice(i, 1)).to_pylist()[0] for i in range(announced.num_rows)]
    full = batch.append_column("answers", pa.array([hot]))
    sent = pa.Table.from_batches(list(rp._send(64, 50, 20)([full])))
    pieces = [len(x) for x in sent.column("strings").to_pylist()]
    strings = [len(x) // 8 for x in sent.column("names").to_pylist()]
    assert max(pieces) <= rp.HEAVY and sum(strings) > 3000 * 20 and max(strings) < 3 * sum(strings) / 64
