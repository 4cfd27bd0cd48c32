"""Windows' entropies against direct counting, neighbours and edits against plain Python."""
import hashlib
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st

from shelfwise.llm import digest as dg
from shelfwise.llm.common import table
from shelfwise.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=dg.WINDOW, max_size=300), st.integers(1, 256))
def test_window_entropies(raw, letters):
    data = np.frombuffer(bytes(b % letters for b in raw), np.uint8)
    want = [int(sum(dg._NLOGN[c] for c in Counter(data[i:i + dg.WINDOW].tolist()).values())) for i in range(len(data) - dg.WINDOW + 1)]
    assert dg._deficits(data).tolist() == want


def test_digests_dont_depend_on_company():
    rnd = random.Random(4)
    texts = [bytes(rnd.choice(b"abcdefgh ijkl\n") for _ in range(rnd.choice([0, 3, 9, 60, 64, 130, 900, 5000]))) for _ in range(60)]
    together = [d.text() for d in dg.digests(texts)]
    assert together == [dg.digests([t])[0].text() for t in texts]


def plain(docs):
    """doc_id -> (n_chars, edited sha, next id)."""
    order = sorted(docs)
    out = {}
    for i, d in enumerate(order):
        t, f = docs[d] or "", docs[order[(i + 1) % len(order)]] or ""
        k = len(t) // 4
        out[d] = (len(t), hashlib.sha256((t[:len(t) - k] + f[:k]).encode()).hexdigest(), order[(i + 1) % len(order)])
    return out


def check(rows, docs):
    want = plain(docs)
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == {d: w[:2] for d, w in want.items()}
    digests = {d: dg.digests([(docs[d] or "").encode()])[0] for d in docs}
    for r in rows:
        assert r.fingerprint == digests[r.doc_id].text()
        assert abs(r.near_next - dg.likeness(digests[r.doc_id], digests[want[r.doc_id][2]])) < 1e-12
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_whole_table(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op6_improbable_feature_digest"](spark, SF).collect()
    check(rows, docs)
    long = [r for r in rows if r.n_chars > 400]
    assert np.mean([r.near_edited > 0.4 for r in long]) > 0.98
    assert np.mean([r.near_next < 0.2 for r in long]) > 0.9


def test_odd_rows(spark, make_docs):
    texts = [None, "", "a", "é" * 50, "ab" * 40_000, "x y z " * 20, "\U0001F600" * 9, None, "word " * 30, "word " * 30]
    check(dg.compared(make_docs(texts, [i * 7 - 20 for i in range(10)])).collect(), {i * 7 - 20: t for i, t in enumerate(texts)})
    check(dg.compared(make_docs(["lone document"])).collect(), {0: "lone document"})
    assert dg.compared(make_docs([])).count() == 0


def test_repeated_null_ids_and_clashing_columns(spark, make_docs):
    docs = make_docs(["same text here"] * 40 + ["other"] * 3, [None] * 3 + [5] * 37 + [1, 2, 3]).selectExpr("*", "1 as part", "2 as tail", "3 as tie", "4 as fingerprint")
    rows = dg.compared(docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(["None"] * 3 + ["5"] * 37 + ["1", "2", "3"])
    assert len({r.fingerprint for r in rows if r.doc_id in (None, 5)}) == 1


def test_likeness_edges():
    empty, one = dg.digests([b"", b"some words"])
    assert dg.likeness(empty, empty) == 1 and dg.likeness(empty, one) == 0 and dg.likeness(one, one) == 1
