"""The chain against enumeration of all labellings; classifiers by held-out accuracy."""
import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from shelfwise.llm import quality, toxicity
from shelfwise.llm.common import table
from shelfwise.llm.crf import Chain
from shelfwise.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(chain, score):
    """Marginals and log partition by enumeration of one sequence."""
    z, p = 0.0, np.zeros(len(score))
    for y in itertools.product((0, 1), repeat=len(score)):
        w = np.exp(chain.start * y[0] + sum(s for s, k in zip(score, y) if k) + sum(chain.trans[a, b] for a, b in zip(y, y[1:])))
        z += w
        p += w * np.array(y)
    return p / z, np.log(z)


def log_likelihood(chain, score, first, y):
    total = 0.0
    cut = np.append(np.flatnonzero(first), len(score))
    for a, b in zip(cut, cut[1:]):
        k = y[a:b]
        total += chain.start * k[0] + score[a:b][k == 1].sum() + sum(chain.trans[i, j] for i, j in zip(k, k[1:])) - brute(chain, score[a:b])[1]
    return total


def test_marginals_and_gradient():
    rng = np.random.default_rng(1)
    chain = Chain(rng.normal(size=(2, 2)), 0.7)
    sizes = [1, 5, 2, 9, 1, 3]
    score = rng.normal(size=sum(sizes)) * 2
    first = np.zeros(len(score), bool)
    first[np.cumsum([0] + sizes[:-1])] = True
    want = np.concatenate([brute(chain, s)[0] for s in np.split(score, np.cumsum(sizes)[:-1])])
    assert np.allclose(chain.marginals(score, first), want)
    y = rng.integers(0, 2, len(score))
    by_score, by_trans, by_start = chain.gradient(score, first, y)
    eps = 1e-5
    for i in range(len(score)):
        step = np.eye(len(score))[i] * eps
        assert np.isclose((log_likelihood(chain, score + step, first, y) - log_likelihood(chain, score - step, first, y)) / (2 * eps), by_score[i], atol=1e-4)
    for i, j in itertools.product((0, 1), repeat=2):
        step = np.zeros((2, 2))
        step[i, j] = eps
        got = (log_likelihood(Chain(chain.trans + step, 0.7), score, first, y) - log_likelihood(Chain(chain.trans - step, 0.7), score, first, y)) / (2 * eps)
        assert np.isclose(got, by_trans[i, j], atol=1e-4)
    got = (log_likelihood(Chain(chain.trans, 0.7 + eps), score, first, y) - log_likelihood(Chain(chain.trans, 0.7 - eps), score, first, y)) / (2 * eps)
    assert np.isclose(got, by_start, atol=1e-4)


def test_one_long_sequence_is_stable():
    chain = Chain(np.array([[2.0, -2.0], [-2.0, 2.0]]), 0.0)
    first = np.zeros(200_000, bool)
    first[0] = True
    p = chain.marginals(np.where(np.arange(200_000) < 100_000, 3.0, -3.0), first)
    assert p[:99_990].min() > 0.99 and p[100_010:].max() < 0.01


def held_out(spark, name, label, mod, rest):
    rows = QUERIES[name](spark, SF).collect()
    assert len(rows) == table(spark, SF, "documents").count()
    truth = {r.doc_id: r[label] for r in table(spark, SF, "labels").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == rest)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    right = np.mean([(s >= 0.3) == y for s, y in held])
    return auc, right


def test_quality_held_out(spark):
    auc, right = held_out(spark, "op2_quality_classifier", "quality", 5, 0)
    assert auc > 0.97 and right > 0.95


def test_toxicity_held_out(spark):
    auc, right = held_out(spark, "op3_toxicity", "toxic", 4, 2)
    assert auc > 0.8 and right > 0.92


def test_offending_offsets(spark, make_docs):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    model = toxicity.fit(toxicity.sample(docs, table(spark, "/root/testdata/sf0.1", "labels"), F.lit(True), limit=300))
    text = "Ñandú the and, IDIOT of the scum. The that."
    row = toxicity.scored(make_docs([text]), model).first()
    assert [text.encode()[s.begin:s.end].decode() for s in row.spans] == ["IDIOT", "scum"]
    clean = toxicity.scored(make_docs(["The and of that thing is here."]), model).first()
    assert clean.spans == [] and clean.score < 0.3 < row.score


def test_odd_rows(spark, make_docs):
    texts = [None, "", "\n\n", " \n\t", "!!!", "x" * 60_000, "line\n" * 5000, "é", "a\nb"]
    docs = make_docs(texts, [0, 0, None, *range(3, 9)]).selectExpr("*", "1 as score", "2 as label", "3 as quality", "4 as toxic")
    labels = spark.createDataFrame([(0, 1, 1), (0, 0, 0), (4, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 1), (8, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int").selectExpr("*", "'x' as text")
    q = quality.fit(quality.labelled_sample(docs, labels, "quality", F.lit(True), 10))
    rows = quality.scored(docs, q).collect()
    assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)
    assert {round(r.score, 9) for r in rows[:4]} == {round(q.prior, 9)}
    assert quality.kept(docs, q).columns == docs.columns
    t = toxicity.fit(toxicity.sample(docs, labels, F.lit(True)), toxicity.label_counts(labels, F.lit(True)))
    rows = toxicity.scored(docs, t).collect()
    assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = make_docs(["a b c"])
    q = quality.fit(quality.labelled_sample(some, none, "quality", F.lit(True), 10))
    assert [r.score for r in quality.scored(some, q).collect()] == [0.5]
    assert quality.scored(make_docs([]), q).count() == 0
    t = toxicity.fit(toxicity.sample(some, none, F.lit(True)))
    assert [r.score for r in toxicity.scored(some, t).collect()] == [0.5]
    assert toxicity.scored(make_docs([]), t).count() == 0
