"""Every stage against a brute-force version of its decisions, on its own input."""
import corpus_pipeline as cp
from shelfwise.llm import quality
from shelfwise.llm.common import crc_mod, saved, table
from shelfwise.llm.queries import QUERIES

from . import test_decontaminate, test_packing, test_repeats, test_simhash

SF = "/root/testdata/sf0.001"


def check_stages(spark, docs, sf):
    columns = docs.columns
    by = lambda df: {r.doc_id: r for r in df.collect()}
    out, before = docs, by(docs)
    for name, stage in cp.STAGES:
        out = saved(spark, stage(spark, out, sf), "stage")
        if stage is cp.best_fit_packing:
            test_packing.check(out.collect(), {d: r.text for d, r in before.items()}, 2048)
            return out
        after = by(out)
        assert out.columns == columns and out.count() == len(after)
        if stage is cp.quality_filter:
            sample = quality.labelled_sample(docs, table(spark, sf, "labels"), "quality", crc_mod("doc_id", 5) != 0, quality.SAMPLE)
            scores = {r.doc_id: r.score for r in quality.scored(docs, quality.fit(sample)).collect()}
            assert set(after) == {d for d in before if scores[d] >= 0.3}
        elif stage is cp.near_dedup:
            label = test_simhash.plain_components({d: test_simhash.plain_fp(r.text) for d, r in before.items()})
            assert set(after) == set(label.values())
        elif stage is cp.repeated_strings:
            want = {w[0]: w for w in test_repeats.brute([(d, r.text) for d, r in before.items()])}
            assert set(after) == set(before)
            for d, r in after.items():
                lost = len((before[d].text or "").encode()) - len((r.text or "").encode())
                assert want[d][2] <= lost <= want[d][2] + 6 * want[d][3]       # divided characters go whole
                assert r.text is None or r.n_chars == len(r.text)
        else:
            hit = {d for d, _ in test_decontaminate.brute([(d, r.text) for d, r in before.items()], [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()])}
            assert set(after) == set(before) - hit
        if stage is not cp.repeated_strings:
            assert all(after[d] == before[d] for d in after)
        before = after


def test_stages(spark):
    rows = check_stages(spark, table(spark, SF, "documents"), SF)
    ran = QUERIES["pipeline"](spark, SF)
    key = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(ran) == key(rows)


def test_odd_documents(spark, make_docs):
    texts = [None, "", "a b c", "a b c", "x" * 30_000, "same words here and there " * 9, "same words here and there " * 9 + "more", "\n\n", "é" * 200]
    docs = make_docs(texts).selectExpr("*", "1 as chunk", "2 as fp", "3 as score", "4 as _hit_id", "5 as rows", "'x' as label", "array(6) as grams", "7 as offset")
    check_stages(spark, docs, SF)


def test_rows_with_equal_or_no_id(spark, make_docs):
    """Of repeated rows, with an id or without, near-dedup leaves one; the rest stay."""
    text = "words of a document that is not long"
    out = make_docs([text, text, "other words " * 30, "other words " * 30, None], [5, 5, None, None, 9])
    for name, stage in cp.STAGES:
        out = saved(spark, stage(spark, out, SF), "stage")
        ids = sorted((r.doc_id for r in out.select("doc_id").collect()), key=str)
        assert ids == ([5, 5, 9, None, None] if name == "quality classifier" else [5, 9, None])


def test_empty_documents(spark, make_docs):
    out = make_docs([])
    for _, stage in cp.STAGES:
        out = stage(spark, out, SF)
    assert out.count() == 0
