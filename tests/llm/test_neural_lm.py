import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import neural_lm as lm
from shelfwise.llm.common import crc_mod

def held():
    return crc_mod("doc_id", 10) == 0



def _brute_base(rows):
    """base_score, n_tokens, n_known, N by the definition."""
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    tok = [(i, (t or "").encode().translate(low).split() + [None]) for i, t in rows]
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    c = Counter(w for i, ws in tok if not out(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, out(i), len(ws), sum(w in c for w in ws), n, sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, ws in tok]


@pytest.fixture(scope="module")
def corpus():
    """Two languages of words that follow one another by rule."""
    rng = np.random.default_rng(1)
    sets = [[f"a{i:02d}" for i in range(40)], [f"b{i:02d}ö" for i in range(40)]]
    out = []
    for d in range(400):
        words, at, text = sets[d % 2], 0, []
        for _ in range(int(rng.integers(20, 60))):
            at = (at * 3 + int(rng.integers(1, 4))) % 40
            text.append(words[at])
        out.append(" ".join(text) + (f" Rare{d}" if d % 3 else "") + " x")
    return out


def test_base_score_and_counts_equal_definition(spark, make_docs, corpus):
    texts = [*corpus[:120], None, "", " \t\n", "Same SAME same\x0bsame", "Same SAME same\x0bsame", "x" * 50_000]
    ids = [*range(120), None, 7, 7, 300, 300, 301]
    docs = make_docs(texts, ids).withColumn("row", F.lit(3)).withColumn("word", F.lit("w")).repartition(4)
    want = _brute_base(list(zip(ids, texts)))
    for dictionary in (lm.DICTIONARY, 30):
        got = [tuple(r) for r in lm.scored(docs, held(), 20, dictionary).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score").collect()]
        key = lambda r: (str(r[0]), r[2], r[5])
        for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
            assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6 * max(1, abs(w[5]))


def test_dictionary_bound_does_not_change_scores(spark, make_docs, corpus):
    docs = make_docs(corpus[:100]).coalesce(2)
    a, b = ({r.doc_id: r.score for r in lm.scored(docs, held(), 20, n).collect()} for n in (lm.DICTIONARY, 40))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-4 * abs(a[k]) for k in a)


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(2)
    v = lm.Vocabulary(1000, 60, {lm.END: 50, b"the": 400, b"of": 90, b"thing": 3}, {lm.END: 0, b"the": 1, b"of": 2}, np.zeros(lm.CLASSES), np.zeros(lm.CLASSES))
    v.class_count[lm.word_class(b"thing")], v.class_types[lm.word_class(b"thing")] = 3, 1
    model = lm.LogBilinear.start(v.masses())
    model.filled(model.flat() + rng.normal(0, 0.3, len(model.flat())).astype(np.float32))
    size = v.size
    for one, two in ((0, size), (size, size), (2, 1)):
        w = np.arange(size, dtype=np.int32)
        total = np.exp(model.log_probs(w, np.full(size, one, np.int32), np.full(size, two, np.int32), 2)).sum()
        assert abs(total - 1) < 1e-5
    # a class: its words' shares and the share of all words that training lacks
    k = lm.word_class(b"thing")
    assert abs((3 + .1) / v.masses()[3 + k] + .1 / v.masses()[3 + k] - 1) < 1e-12


def test_log_probs_equal_the_plain_softmax():
    model = lm.LogBilinear.start(np.arange(1.0, 9.0))
    rng = np.random.default_rng(4)
    w, one, two = (rng.integers(0, 8, 500).astype(np.int32) for _ in range(3))
    d = model.c.shape[1]
    for i, got in enumerate(model.log_probs(w, one, two, 3)):
        z = (model.r[one[i]] @ model.c[:d] + model.r[two[i]] @ model.c[d:]) @ model.t[:, :-1].T + model.t[:, -1]
        assert abs(got - (z[w[i]] - np.log(np.exp(z).sum()))) < 1e-4


def test_contexts_stop_at_text_starts():
    texts = [np.array(x, "<u2").tobytes() for x in ([5, 6, 0], [0], [7, 0])]
    w, one, two, end = lm._contexts(texts, 9)
    assert w.tolist() == [5, 6, 0, 0, 7, 0] and end.tolist() == [3, 4, 6]
    assert one.tolist() == [9, 5, 6, 9, 9, 7] and two.tolist() == [9, 9, 5, 9, 9, 9]


def test_learning_beats_the_unigram_on_held_out_texts(spark, make_docs, corpus):
    docs = make_docs(corpus * 6, range(len(corpus) * 6)).repartition(3)
    got = lm.scored(docs, held()).groupBy("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).collect()
    for r in got:
        assert r.s / r.n > r.b / r.n + 0.2          # of log10 a token


def test_gradient_steps_move_towards_the_data():
    """After learning one sequence, its symbols are likelier than the noise says."""
    mass = np.ones(12)
    model = lm.LogBilinear.start(mass)
    text = [np.array([1, 2, 3, 0] * 500, "<u2").tobytes()] * 4
    before = model.log_probs(*lm._contexts(text, 12)[:3]).mean()
    lm.learn(model, mass / 12, [text] * 10, np.random.default_rng(0))
    assert model.log_probs(*lm._contexts(text, 12)[:3]).mean() > before + 1.0


def test_tables_without_training_texts(spark, make_docs):
    out = lm.scored(make_docs(["a b", None], [0, 1]), F.lit(True)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in out) == [(0, 3, 0, 0, 0.0, 0.0), (1, 1, 0, 0, 0.0, 0.0)]
    assert lm.scored(make_docs([]), held()).count() == 0


def test_classes_of_words_agree_between_scan_and_sql(spark):
    words = [b"a", b"ab", b"abc", b"abcd", "größe".encode(), "é".encode()]
    got = spark.createDataFrame([(bytearray(w),) for w in words], "word binary").select(F.pmod(F.crc32(F.substring("word", -3, 3)), F.lit(lm.CLASSES))).collect()
    assert [r[0] for r in got] == [lm.word_class(w) for w in words]
