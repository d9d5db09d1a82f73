from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from sightline.llm.line_dedup import line_dedup, repeated_runs


def brute(rows, n):
    docs = {(d is None, d or 0, t): [(i, x) for i, x in enumerate((t or "").split("\n")) if re.search(r"[^\x20\x09-\x0D]", x)] for d, t in rows}
    seen, gone = set(), {k: set() for k in docs}
    for key in sorted(docs, key=lambda k: k[:2]):
        ls = docs[key]
        for i in range(len(ls) - n + 1):
            run = tuple(x for _, x in ls[i : i + n])
            if run in seen:
                gone[key] |= {p for p, _ in ls[i : i + n]}
            seen.add(run)
    out = []
    for d, t in rows:
        key = (d is None, d or 0, t)
        kept = "\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in gone[key])
        out.append((d, len(docs[key]), len(gone[key]), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,n", [(1, 2), (2, 1), (4, 5)])
def test_against_brute_force(spark, seed, n):
    rnd = random.Random(seed)
    lines = ["a", "b", "c", "", "  ", "long line é", "\tx"]
    rows = [(i, "\n".join(rnd.choice(lines) for _ in range(rnd.randint(0, 14)))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "a\nb\nc\na\nb"), (103, "a\nb\nc\na\nb"), (None, "a\nb\nc\nend")]
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, pos int, seq int").repartition(5)
    got = line_dedup(docs, min_run=n).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_deleted, r.kept_sha256, r.kept_text) for r in got), key=str) == brute(rows, n)
    assert all(len(r.deleted) == r.n_deleted for r in got)


def test_run_in_every_document_is_kept_once(spark):
    docs = spark.range(500).selectExpr("id AS doc_id", "concat('own ', id, '\nhot one\nhot two\nhot three\nend ', id) AS text")
    got = {r.doc_id: r.n_deleted for r in line_dedup(docs).collect()}
    assert got[0] == 0 and all(got[i] == 3 for i in range(1, 500))


def test_empty_table_and_plan_without_python(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    out = line_dedup(docs)
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("seed,n", [(5, 2), (7, 3)])
def test_runs_are_maximal(spark, seed, n):
    """Each run copies its source as far as the two agree, and all runs cover what brute force deletes."""
    rnd = random.Random(seed)
    passage = [f"p{i}" for i in range(23)]
    docs = {}
    for i in range(40):
        ls = [rnd.choice(["a", "b", "c", f"own{i}"]) for _ in range(rnd.randint(0, 6))]
        a, b = sorted(rnd.choices(range(len(passage) + 1), k=2))
        docs[i] = ls[:3] + passage[a:b] + ls[3:]
    docs[100] = docs[101] = [f"x{i % 7}" for i in range(60)]  # repeats itself
    rows = [(i, "\n".join(ls)) for i, ls in docs.items()]
    runs = repeated_runs(spark.createDataFrame(rows, "doc_id long, text string"), min_run=n).collect()
    gone = {i: set() for i in docs}
    for r in runs:
        mine, other = docs[r.doc][r.seq :], docs[r.source.doc][r.source.seq :]
        assert (r.source.doc, r.source.seq) < (r.doc, r.seq) and r.length >= n
        assert mine[: r.length] == other[: r.length] and mine[r.length : r.length + 1] != other[r.length : r.length + 1] or len(mine) == r.length or len(other) == r.length
        gone[r.doc] |= set(range(r.seq, r.seq + r.length))
    assert {i: len(g) for i, g in gone.items()} == {d: x for d, _, x, _, _ in brute(rows, n)}


def test_long_copies_take_linear_time(spark):
    """Two copies of 20,000 lines: all of the second goes."""
    text = "\n".join(f"line {i}" for i in range(20_000))
    docs = spark.createDataFrame([(1, text), (2, text), (3, "line 5\nother")], "doc_id long, text string")
    begun = time.perf_counter()
    got = {r.doc_id: (r.n_lines, r.n_deleted, len(r.kept_text)) for r in line_dedup(docs).collect()}
    assert got == {1: (20_000, 0, len(text)), 2: (20_000, 20_000, 0), 3: (2, 0, 12)}
    assert time.perf_counter() - begun < 240
