from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from sightline.llm import arrays as A
from sightline.llm import substring_dedup as SD


def brute(rows, n):
    split = [(d, (t or "").encode().split()) for d, t in rows]
    least = {}
    for d, ws in split:
        for i in range(len(ws) - n + 1) if d is not None else ():
            key = tuple(ws[i : i + n])
            least[key] = min(least.get(key, d), d)
    out = []
    for d, ws in split:
        gone = set()
        for i in range(len(ws) - n + 1) if d is not None else ():
            if least[tuple(ws[i : i + n])] < d:
                gone |= set(range(i, i + n))
        kept = [w for i, w in enumerate(ws) if i not in gone]
        out.append((d, len(ws), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,n", [(1, 5), (2, 3), (3, 1), (4, 50)])
def test_against_brute_force(spark, seed, n, monkeypatch):
    monkeypatch.setattr(SD, "BLOCK_BYTES", 700)
    monkeypatch.setattr(SD, "BUCKET_WORDS", 60)
    rnd = random.Random(seed)
    passage = [" ".join(f"p{k}{i}" for i in range(n + 7)) for k in range(4)]
    rows = [(rnd.randrange(1000), " ".join(rnd.choice([*passage, "x", "é y", "\n", "z z z z"]) for _ in range(rnd.randint(0, 9)))) for _ in range(60)]
    rows = list({d: (d, t) for d, t in rows}.values()) + [(2000, None), (2001, ""), (-4, passage[0]), (None, passage[1]), (None, passage[1]), (2002, passage[2]), (2002, passage[2])]
    docs = spark.createDataFrame([(d, t, "c") for d, t in rows], "doc_id long, text string, block string").repartition(5)
    got = SD.substring_dedup(docs, window=n, with_text=True).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == brute(rows, n)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in got)
    assert all(sum(b - a for a, b in zip(r.removed_spans[::2], r.removed_spans[1::2])) == r.n_removed for r in got)


def test_rows_without_an_id_neither_lose_nor_take(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(None, text), (1, text), (2, text), (None, text), ((1 << 63) - 1, text)], "doc_id long, text string")
    got = sorted(((str(r.doc_id), r.n_removed) for r in SD.substring_dedup(docs).collect()))
    assert got == sorted([("None", 0), ("None", 0), ("1", 0), ("2", 60), (str((1 << 63) - 1), 60)])


def test_passage_in_every_document_is_kept_once(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.range(3000).selectExpr("id AS doc_id", f"concat('own', id, ' {passage} end', id) AS text")
    got = {r.doc_id: r.n_removed for r in SD.substring_dedup(docs).collect()}
    assert got[0] == 0 and all(got[i] == 60 for i in range(1, 3000))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert SD.substring_dedup(docs).count() == 0


def test_window_hashes():
    rnd = np.random.default_rng(3)
    h = rnd.integers(0, 4, 400).astype(np.uint64)
    for n in (1, 2, 3, 7, 10, 50):
        got, seen = A.windows(h, n), {}
        assert len(got) == len(h) - n + 1
        for i, x in enumerate(got.tolist()):
            assert seen.setdefault(tuple(h[i : i + n].tolist()), x) == x
        assert len(set(seen.values())) == len(seen)
    assert len(A.windows(h[:3], 4)) == 0
