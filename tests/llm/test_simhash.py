"""SimHash near-dedup against a direct computation over all pairs."""
import random
import re

import numpy as np
import xxhash

from shelfwise.llm import simhash
from shelfwise.llm.common import table

SF = "/root/testdata/sf0.001"


def plain_fp(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    """doc_id -> smallest doc_id reachable at three bits or fewer."""
    label = {d: d for d in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 3 and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def check(rows, texts):
    fps = {d: plain_fp(t) for d, t in texts.items()}
    want = plain_components(fps)
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in rows}
    assert got == {d: (fps[d], want[d]) for d in fps}


def test_whole_table(spark):
    docs = table(spark, SF, "documents")
    check(simhash.components(docs).collect(), {r.doc_id: r.text for r in docs.collect()})


def test_registered_columns(spark):
    from shelfwise.llm.queries import QUERIES
    out = QUERIES["op9_simhash_near_dedup"](spark, SF)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in out.collect())


def test_odd_rows(spark, make_docs):
    texts = [None, "", " \t\n", "a", "A", "a b", "x" * 70_000, "é É ÀB ab", "a b c d", None]
    check(simhash.components(make_docs(texts)).collect(), dict(enumerate(texts)))


def test_empty_and_extra_columns(spark, make_docs):
    assert simhash.components(make_docs([])).count() == 0
    clash = make_docs(["a b c", "a b c"]).selectExpr("*", "1 as fp", "2 as label", "3 as component_id", "4 as v")
    assert {r.component_id for r in simhash.components(clash).collect()} == {0}
    kept = simhash.deduplicated(clash)
    assert kept.columns == clash.columns and [r.doc_id for r in kept.collect()] == [0]


def test_repeated_and_null_ids(spark, make_docs):
    out = simhash.components(make_docs(["a b c d", "a b c d", "q r s t", "z"], [5, 5, None, 7])).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in out) == [("5", "5"), ("5", "5"), ("7", "7"), ("None", "None")]


def test_tree_finds_every_pair_and_split_buckets_lose_none(spark):
    rnd = random.Random(3)
    base = [rnd.getrandbits(64) for _ in range(20)]
    fps = sorted({b ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randrange(5))) & ((1 << 64) - 1) for b in base for _ in range(40)})
    own = np.array(fps, np.uint64)
    tree = simhash.HammingTree(own)
    q, m = tree.search(own, 3)
    got = {(int(own[i]), int(tree.fps[j])) for i, j in zip(q, m)}
    assert got == {(a, b) for a in fps for b in fps if (a ^ b).bit_count() <= 3}
    signed = own.view(np.int64).tolist()
    want = plain_components(dict(zip(signed, fps)))
    nodes = spark.createDataFrame([(x, x) for x in signed], "v long, label long")
    for rows in (4096, 2):
        link = simhash.links(nodes.selectExpr("v as fp"), 3, bucket_rows=rows)
        labels = {r.v: r.label for r in simhash.min_labels(spark, nodes, link).collect()}
        assert {x: labels.get(x, x) for x in signed} == want


def near_texts(n):
    """Texts whose fingerprints are distinct and one to three bits from the first one's."""
    base = [f"w{i}" for i in range(400)]
    out, fps = [" ".join(base)], [plain_fp(" ".join(base))]
    for i in range(400):
        text = " ".join(base[:i] + ["changed"] + base[i + 1:])
        fp = plain_fp(text)
        if len(out) < n and fp not in fps and (fp ^ fps[0]).bit_count() <= 3:
            out.append(text)
            fps.append(fp)
    assert len(out) == n
    return out


def row_components(rows):
    """[(id, text)] -> (id, component) of rows linked by their fingerprints, smallest id or None."""
    fps = [plain_fp(t) for _, t in rows]
    root = plain_components(dict(enumerate(fps)))
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(root[i], []).append(d)
    return sorted(((d, min((x for x in ids[root[i]] if x is not None), default=None)) for i, (d, _) in enumerate(rows)), key=str)


def test_linked_null_and_repeated_ids_beside_other_components(spark, make_docs):
    near = near_texts(4)
    other = [" ".join(f"{c}{i}" for i in range(300)) for c in "xyz"]
    copy = other[0] + " more"
    cases = [
        [(None, near[0]), (None, near[1]), (None, near[2]), (None, other[0]), (7, other[1])],
        [(5, near[0]), (5, near[1]), (5, other[0]), (9, copy), (2, other[2])],
        [(None, near[0]), (None, near[1]), (8, near[2]), (3, other[0]), (4, copy), (None, other[1]), (None, other[1] + " more"), (8, other[2])],
    ]
    for rows in cases:
        ids, texts = zip(*rows)
        got = sorted(((r.doc_id, r.component_id) for r in simhash.components(make_docs(texts, ids)).collect()), key=str)
        assert got == row_components(rows)


def test_one_row_of_each_component_stays_and_other_rows_of_its_id_too(spark, make_docs, tmp_path):
    near = " ".join(f"word{i}" for i in range(200))
    other = " ".join(f"thing{i * i}" for i in range(150))
    lone = " ".join(f"lone{i * 7}" for i in range(120))
    rows = [(1, near), (1, near), (7, near), (7, other), (None, lone), (None, lone), (9, near + " more"), (None, other), (3, None), (2, ""), (None, None)]
    path = str(tmp_path / "docs")
    make_docs([t for _, t in rows], [i for i, _ in rows]).repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    # one of two equal rows of id 1; id 7 loses its copy but not its own text; one of two equal null ids; smallest id of the empty texts
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, near), (7, other), (None, lone), (2, "")], key=str)
    assert simhash.deduplicated(spark.read.schema(docs.schema).parquet(path).limit(0)).count() == 0
