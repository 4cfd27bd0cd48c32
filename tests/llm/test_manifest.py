import zlib
from hashlib import sha256

import numpy as np
import pytest

from shelfwise.llm import manifest as m

H = lambda s: sha256(s.encode()).hexdigest()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, pos long"


def _leaf(row, text):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H("".join(field(v) for v in (row[0], row[3], row[2], row[4], text)))


def _climb(digests):
    """(root, per leaf: [(slot, run)] bottom up) by the definition."""
    levels, paths = [digests], [[] for _ in digests]
    while len(levels[-1]) > 1:
        runs = [levels[-1][i:i + 8] for i in range(0, len(levels[-1]), 8)]
        for leaf, path in enumerate(paths):
            at = leaf // 8 ** (len(levels) - 1)
            path.append((at % 8, runs[at // 8]))
        levels.append([H("".join(r)) for r in runs])
    return levels[-1][0], paths


def _brute(rows):
    low = {c: c + 32 for c in range(65, 91)}
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted(((r[0] is not None, r[0] or 0, _leaf(r, r[1])), r) for r in rows if r[2] == lang)
        trees[lang] = (own, *_climb([k[2] for k, _ in own]))
    root, tops = _climb([trees[x][1] for x in langs])
    out = []
    for lang, top in zip(langs, tops):
        own, subroot, paths = trees[lang]
        for (k, r), path in zip(own, paths):
            whole = path + top
            cur = k[2]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                cur = _leaf(r, None if r[1] is None else r[1].translate(low))
            for slot, run in whole:
                cur = H("".join(run[:slot] + [cur] + run[slot + 1:]))
            proof = H("".join("".join(run[:slot] + run[slot + 1:]) for slot, run in whole))
            out.append((r[0], k[2], subroot, root, proof, cur, cur == root))
    return sorted(out, key=str)


def _got(spark, rows, height):
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in m.manifest(df, height).collect()), key=str)


def _rows(n, seed=0):
    rng = np.random.default_rng(seed)
    texts = ["Plain text", "lower only", "", None, "Ünïcode ÄB z", "A" * 3000]
    langs = ["en", "de", None, "", "é", "z"]
    return [(int(i) * 3 + 1, texts[rng.integers(6)], langs[rng.choice(6, p=[.6, .2, .1, .05, .04, .01])], None if i % 5 == 0 else "s", None if i % 7 == 0 else 12) for i in range(n)]


@pytest.mark.parametrize("height", [1, 2, 4])
def test_equals_definition(spark, height):
    rows = _rows(700)
    rows += [(None, "Null id", "en", "s", 1), (None, "Null id", "en", "s", 1), (4, "Other", "en", "s", 1), rows[0], rows[0]]
    assert _got(spark, rows, height) == _brute(rows)


@pytest.mark.parametrize("n", [1, 8, 9, 64, 65])
def test_edges_of_runs(spark, n):
    rows = [(i, f"Text {i}", "en", "s", i) for i in range(n)]
    assert _got(spark, rows, 2) == _brute(rows)


def test_many_languages_and_empty_table(spark):
    rows = [(i, f"Text {i}", f"l{i:03d}", "s", i) for i in range(75)]
    assert _got(spark, rows, 1) == _brute(rows)
    assert m.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_layout_is_recursive_and_gapless(levels):
    places = [m.address(d, np.arange(m.FAN ** d), levels) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range(m.tree_size(levels)))
    if levels == 5:                         # a bottom tree of three levels stands in one run
        top, below = m.tree_size(2), m.tree_size(3)
        assert places[2][3] == top + 3 * below
        assert {int(p) // below for p in (places[4][3 * 64:4 * 64] - top)} == {3}


def test_stored_block_reads_back():
    leaves = np.frombuffer(b"".join(sha256(bytes([i])).digest() for i in range(70)), np.uint8).reshape(-1, 32)
    b = m.Block.build(leaves, 3)
    again = m.Block(np.frombuffer(b.nodes.tobytes(), np.uint8).reshape(-1, 32), 70, 4)
    for leaf, path in zip(leaves, again.paths()):
        assert m.folded(leaf.tobytes(), path) == b.root
