"""Containment search against brute force over every (document, item) pair."""
import re

import numpy as np

from shelfwise.llm import decontaminate as dc
from shelfwise.llm.common import table
from shelfwise.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ITEM = "item_id long, text string"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", low)


def grams(w, k):
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items, threshold=0.8):
    out = {}
    for i, t in items:
        w = words(t)
        if w:
            k = min(5, len(w))
            own = grams(w, k)
            for d, text in docs:
                share = len(own & grams(words(text), k)) / len(own)
                if share >= threshold:
                    out[d, i] = share
    return out


def got(df):
    return {(r.doc_id, r.item_id): r.containment for r in df.collect()}


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    want = brute(docs, items)
    assert want and got(QUERIES["op10_benchmark_decontamination"](spark, SF)) == want


def test_partial_copies_and_both_vocabulary_paths(spark, make_docs):
    rng = np.random.default_rng(5)
    prose = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 3000, n))
    items = [(i, prose(int(rng.integers(6, 90)))) for i in range(40)]
    texts = []
    for i, t in items:
        w = t.split()
        for cut in (0.7, 0.8, 0.85, 0.95, 1.0):
            keep = " ".join(w[:max(1, int(len(w) * cut))])
            texts.append(f"{prose(int(rng.integers(0, 900)))} {keep} {prose(50)}")
    texts.append(" ".join(t for _, t in items))
    texts += [texts[4]] * 30
    docs = make_docs(texts)
    bench = spark.createDataFrame(items, ITEM)
    want = brute(list(enumerate(texts)), items)
    assert got(dc.contained(docs, bench)) == want
    assert got(dc.contained(docs, bench, broadcast_rows=0)) == want
    kept = {r.doc_id for r in dc.decontaminated(docs, bench).collect()}
    assert kept == set(range(len(texts))) - {d for d, _ in want}


def test_odd_rows(spark, make_docs):
    items = [(1, "alpha beta"), (2, None), (3, ""), (4, "one two three four five six"), (4, "one two three four five six"), (None, "solo"), (6, "...")]
    texts = [None, "", "ALPHA, beta!", "x one two three four five six y", "solo", "a" * 50_000, "alpha gamma beta"]
    docs = make_docs(texts, [0, 1, 2, 3, 4, 5, None]).withColumnRenamed("lang", "grams").withColumnRenamed("source", "item_id")
    bench = spark.createDataFrame(items, ITEM).selectExpr("*", "1 as doc_id", "2 as words")
    assert set(got(dc.contained(docs, bench))) == {(2, 1), (3, 4), (4, None)}
    kept = dc.decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["0", "1", "5", "None"]


def test_null_id_documents_are_judged_by_text(spark, make_docs):
    docs = make_docs(["q alpha beta", "clean text"], [None, None])
    kept = dc.decontaminated(docs, spark.createDataFrame([(1, "alpha beta")], ITEM))
    assert [r.text for r in kept.collect()] == ["clean text"]


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], ITEM)
    some = spark.createDataFrame([(1, "a b c d e f")], ITEM)
    assert dc.contained(make_docs([]), some).count() == 0
    assert dc.contained(make_docs(["a b c d e f"]), none).count() == 0
    assert dc.decontaminated(make_docs(["a b c d e f"]), none).count() == 1


def test_bands_bound_the_miss():
    for low, high in ((1, 1), (16, 31), (16, 4095), (64, 127)):
        n = dc.bands(low, high, 0.8, 1e-9)
        s = 0.8 * low / (low + high - 0.8 * low)
        assert s >= 1 or (1 - s) ** n <= 1e-9
