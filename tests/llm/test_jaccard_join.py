from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from sightline.llm import jaccard_join as JJ
from sightline.llm.graph import components, forest


def sets_of(text, k=3):
    ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)} if len(ws) >= k else {tuple(ws)} if ws else set()


def brute(rows, percent=90):
    sets, up = [(d, sets_of(t)) for d, t in rows if d is not None], {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            o = len(x & y)
            if x and y and 100 * o >= percent * (len(x) + len(y) - o):
                lo, hi = sorted((root(a), root(b)))
                up[hi] = lo
    return sorted(((d, len(sets_of(t)), None if d is None else root(d)) for d, t in rows), key=str)


def corpus(seed, families=25, copies=6, length=(1, 80), edits=4):
    rnd = random.Random(seed)
    rows = []
    for _ in range(families):
        base = [f"w{rnd.randrange(400)}" for _ in range(rnd.randint(*length))]
        for _ in range(rnd.randint(1, copies)):
            ws = list(base)
            for _ in range(rnd.randint(0, edits)):
                ws[rnd.randrange(len(ws))] = rnd.choice(["X", "y", f"w{rnd.randrange(400)}"])
            rows.append((rnd.randrange(10**9), " ".join(ws)))
    return rows


@pytest.mark.parametrize("seed,percent,options,small", [(1, 90, {"chunk_docs": 5}, 256), (3, 80, {"chunk_tokens": 200}, 30), (4, 60, {}, 0)])
def test_against_brute_force(spark, seed, percent, options, small, monkeypatch):
    monkeypatch.setattr(JJ, "SMALL", small)
    monkeypatch.setattr(JJ, "BLOCK_BYTES", 3000)
    rows = corpus(seed) + [(5, None), (6, ""), (7, " \n"), (8, "one"), (9, "ONE"), (10, "one two"), (11, "One two"), (None, "one two"), (12, "one two three"), (12, "four")]
    docs = spark.createDataFrame([(d, t, d) for d, t in rows], "doc_id long, text string, component_id long")
    got = JJ.jaccard_components(docs, percent=percent, **options).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, percent)


@pytest.mark.parametrize("percent", [80, 90])
def test_links_across_small_are_found(spark, percent, monkeypatch):
    monkeypatch.setattr(JJ, "BLOCK_BYTES", 20_000)
    rnd, rows = random.Random(percent), []
    for i in range(24):  # one of fewer than SMALL shingles, and one of more by inserted words
        base = [f"p{i}w{j}" for j in range(rnd.randint(250, 256))]
        at, more = rnd.randrange(len(base)), rnd.randint(8, 12)
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base[:at] + [f"n{i}w{j}" for j in range(more)] + base[at:]))]
    assert all(len(sets_of(t)) < JJ.SMALL for d, t in rows if d % 2 == 0) and all(len(sets_of(t)) >= JJ.SMALL for d, t in rows if d % 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = JJ.jaccard_components(docs, percent=percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, percent)
    assert all(r.component_id == r.doc_id // 2 * 2 for r in got)


def test_large_groups_lose_no_link(spark):
    rnd = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join(base[:50] + [f"u{i}x{j}" for j in range(rnd.randint(0, 4))] + base[50:])) for i in range(150)]  # copies
    rows += [(500 + i, " ".join(base[i : i + 100])) for i in range(0, 20, 2)]  # a chain
    rows += [(900 + i, " ".join(base[:90] + [f"v{i}-{j}" for j in range(30)])) for i in range(60)]  # alike, but not linked
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for options in ({}, {"chunk_docs": 40, "chunk_tokens": 3000}):
        got = JJ.jaccard_components(docs, **options).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)


def test_every_link_shares_a_signature():
    rnd = np.random.default_rng(1)
    for percent in (60, 80, 90, 95):
        for n in (1, 2, 5, 8, 9, 10, 11, 18, 19, 20, 40, 137, 700):
            for _ in range(12):
                base = rnd.integers(1, 2**63, n).astype(np.uint64)
                gone = rnd.integers(0, n * (100 - percent) // percent + 2)
                added = rnd.integers(0, n * (100 - percent) // percent + 2)
                other = np.concatenate([base[gone:], rnd.integers(1, 2**63, added).astype(np.uint64)])
                a, b = np.unique(base), np.unique(other)
                o = len(np.intersect1d(a, b))
                if not len(b) or 100 * o < percent * (len(a) + len(b) - o) or np.array_equal(a, b):
                    continue
                sig, owner, _ = JJ.signatures(np.array([0, len(a), len(a) + len(b)]), np.concatenate([a, b]), percent)
                assert np.intersect1d(sig[owner == 0], sig[owner == 1]).size


def test_shingle_sets_are_sets():
    texts = ["a b c a b c", "A b", None, "", "x", "a b c d"]
    first, hashes = JJ.shingle_sets(pa.array(texts), 3)
    assert np.diff(first).tolist() == [len(sets_of(t)) for t in texts]


def test_forest_keeps_components():
    rnd = np.random.default_rng(2)
    for n in (1, 5, 60):
        edges = rnd.integers(-40, 40, (n, 2))
        got = {int(a): int(b) for a, b in forest(edges)}
        label = {int(x): int(x) for x in edges.ravel()}
        for _ in range(100):
            for a, b in edges.tolist():
                label[a] = label[b] = min(label[a], label[b])
        assert got == {x: c for x, c in label.items() if x != c}
    assert forest(np.empty((0, 2), np.int64)).shape == (0, 2)


def test_components_of_odd_edges(spark):
    edges = spark.createDataFrame([(5, 4), (4, 9), (9, 9), (None, 1), (7, 8), (2, 3), (3, 2), (2, 3), (20, 5)], "a long, b long")
    assert sorted(map(tuple, components(edges).collect())) == [(2, 2), (3, 2), (4, 4), (5, 4), (7, 7), (8, 7), (9, 4), (20, 4)]
    chain = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    assert {r.component for r in components(chain).collect()} == {0}
    assert components(edges.where("false")).count() == 0


def test_empty_table_and_one_of_each(spark):
    docs = spark.createDataFrame([(3, "same words here now"), (1, "same words here now"), (None, "same words here now"), (2, "")], "doc_id long, text string")
    assert JJ.jaccard_components(docs.where("false")).count() == 0
    assert sorted((r.doc_id for r in JJ.one_of_each(docs).collect()), key=str) == [1, 2, None]
