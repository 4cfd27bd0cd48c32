import zlib

from shelfwise.llm.common import table
from shelfwise.llm.queries import QUERIES
from shelfwise.llm.sharding import byte_shards

SF = "/root/testdata/sf0.001"


def check(rows, texts, shards=16):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    size = {d: len((t or "").encode()) + 1 for d, t in texts.items()}
    total, before = sum(size.values()), 0
    want = {}
    for d in sorted(size):
        want[d] = min(shards - 1, (2 * before + size[d]) * shards // (2 * total))
        before += size[d]
    assert {r.doc_id: r.shard for r in rows} == want
    for own in by.values():
        own.sort(key=lambda r: r.doc_id)
        assert [r.slot for r in own] == list(range(len(own)))
    assert all(r["size"] == size[r.doc_id] and r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) for r in rows)
    largest = max(size.values())
    assert all(abs(sum(r["size"] for r in own) - total / shards) <= 2 * largest for own in by.values())


def test_whole_table(spark):
    out = QUERIES["op5_byte_sharding"](spark, SF)
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    check(out.collect(), {r.doc_id: r.text for r in table(spark, SF, "documents").collect()})


def test_odd_rows(spark, make_docs):
    texts = [None, "", "é" * 9, "x" * 100_000, *(["copy of a text"] * 300)]
    check(byte_shards(make_docs(texts)).collect(), dict(enumerate(texts)))
    few = make_docs(["a", None])
    check(byte_shards(few).collect(), {0: "a", 1: None})
    assert byte_shards(make_docs([])).count() == 0


def test_repeated_and_null_ids_and_clashing_columns(spark, make_docs):
    docs = make_docs(["t"] * 64, [None] * 4 + [7] * 60).selectExpr("*", "1 as part", "2 as tie", "3 as size", "4 as shard")
    rows = byte_shards(docs, 4).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(s, i) for s in range(4) for i in range(16)]
    assert {r.shard for r in rows if r.doc_id is None} == {0}
