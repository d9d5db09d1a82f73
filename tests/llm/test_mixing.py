from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from sightline.llm import mixing as M
from sightline.llm.queries import QUERIES


def water(sizes, weights=(3, 1, 2), budget=1.5, cap=2):
    """Targets by plain resharing."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = {}, budget * sum(sizes.values())
    while True:
        left = total - sum(full.values())
        open_ = [s for s in names if s not in full]
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] >= cap * sizes[s]]
        if not above:
            return full | share
        full |= {s: cap * sizes[s] for s in above}
        if len(full) == len(names):
            return full


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, got, near):
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += words(t)
    want = water(sizes)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted((d is None, d or 0, words(t)) for d, t, _ in rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 2 * r.size and (r.taken % r.size == 0 if r.size else r.taken == 0)
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= near


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_against_plain_resharing(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, "w " * rnd.choice([0, 1, 2, 5, 17, 40, 400]), rnd.choice(["a", "a", "a", "é", "Z", "b10", "b9", None])) for i in range(300)]
    rows += [(9, None, "only null"), (900, "x y", "a"), (900, "x y", "a"), (None, "q r s", None), (None, "", "a")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, size int").repartition(4)
    got = M.mix(docs).collect()
    check(rows, got, near=120)
    again = M.mix(docs.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    copies = Counter((r.doc_id, r.text) for r in M.mixed(docs).collect())
    want = Counter()
    texts = {(d, words(t)): t for d, t, _ in rows}
    for r in got:
        want[r.doc_id, texts[r.doc_id, r.size]] += r.passes
    assert copies == +want


def test_fit_reaches_what_can_be_reached():
    rnd = random.Random(8)
    for _ in range(200):
        lengths = np.array(sorted(rnd.sample(range(1, 30), rnd.randint(1, 5))))
        counts = np.array([rnd.randint(1, 4) for _ in lengths])
        sums = {0}
        for x, c in zip(lengths.tolist(), counts.tolist()):
            sums = {s + k * x for s in sums for k in range(c + 1)}
        target = rnd.randint(0, int((lengths * counts).sum()) + 3)
        got = M.fit(lengths, counts, target)
        assert (got >= 0).all() and (got <= counts).all()
        miss = abs(int((lengths * got).sum()) - target)
        assert miss == min(abs(s - target) for s in sums)
    exact = [M.fit(np.arange(1, 60), np.full(59, 30), t) @ np.arange(1, 60) for t in range(0, 50000, 777)]
    assert exact == list(range(0, 50000, 777))


def test_one_length_of_equal_documents(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "'same four words here' AS text", "if(id < 1500, 'hot', 'b') AS source")
    got = M.mix(docs).collect()
    check([(r.doc_id, "same four words here", r.source) for r in got], got, near=4)


def test_empty_and_wordless_tables(spark):
    docs = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.taken, r.target) for r in M.mix(docs).collect()) == [(1, 0, 0.0), (2, 0, 0.0)]
    assert M.mix(docs.where("false")).collect() == [] and M.mixed(docs).collect() == []


def test_query(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text", "source").collect()]
    source = {d: s for d, _, s in rows}
    got = QUERIES["op7_source_mixing"](spark, sf_small)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    from types import SimpleNamespace
    check(rows, [SimpleNamespace(**r.asDict(), source=source[r.doc_id]) for r in got.collect()], near=200)
