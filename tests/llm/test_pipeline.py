from __future__ import annotations

import re
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from sightline.llm import byte_cnn, jaccard_join
from sightline.llm.jobs import cut_lineage

from test_decontamination import brute as hits
from test_decontamination import WORD, fold
from test_jaccard_join import sets_of


@pytest.fixture(scope="module")
def stages(spark, sf_small):
    """Each stage's output, on what the one before returned."""
    docs = cut_lineage(spark.read.parquet(f"{sf_small}/documents.parquet"))
    out = [docs]
    for _, stage in P.STAGES:
        out.append(cut_lineage(stage(spark, out[-1], sf_small)))
    return [[r.asDict() for r in df.collect()] for df in out], [df.columns for df in out]


def test_columns_stay(stages):
    rows, columns = stages
    assert all(c == columns[0] for c in columns[1:-1]) and columns[-1] == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing", "token_output"]


def test_classifier_keeps_clean_documents(spark, sf_small, stages):
    rows, _ = stages
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    model = byte_cnn.train(docs, spark.read.parquet(f"{sf_small}/labels.parquet"))
    good = {r.doc_id for r in byte_cnn.scored(docs, model).collect() if r.predicted}
    assert {r["doc_id"] for r in rows[1]} == good
    clean = {r.doc_id for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect() if r.quality}
    assert len(clean & good) >= 0.97 * len(clean)


def test_one_of_each_group(stages):
    rows, _ = stages
    sets = {r["doc_id"]: sets_of(r["text"], 5) for r in rows[1]}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, x in sets.items():
        for b, y in sets.items():
            if a < b and x and y and 100 * len(x & y) >= 80 * len(x | y):
                lo, hi = sorted((root(a), root(b)))
                up[hi] = lo
    assert {r["doc_id"] for r in rows[2]} == {root(d) for d in sets}


def test_copies_of_sizes_around_small_go(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    like, planted = docs.limit(1).first().asDict(), []
    for i in range(12):  # fewer than SMALL shingles of five words, and more by inserted words
        base = [f"p{i}w{j}" for j in range(252 + i % 6)]
        planted += [like | {"doc_id": 10**9 + 2 * i, "text": " ".join(base)}, like | {"doc_id": 10**9 + 2 * i + 1, "text": " ".join(base[:100] + [f"n{i}w{j}" for j in range(8)] + base[100:])}]
    assert all((len(sets_of(r["text"], 5)) >= jaccard_join.SMALL) == r["doc_id"] % 2 for r in planted)
    got = P.ngram_jaccard_join(spark, spark.createDataFrame(planted, docs.schema), sf_small).collect()
    assert sorted(r.doc_id for r in got) == [10**9 + 2 * i for i in range(12)]


def test_rows_of_one_id_or_without_keep_one(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    like, far, lone = docs.limit(1).first().asDict(), "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(7, far), (7, far), (None, far), (None, far), (3, far), (None, lone), (None, lone), (8, "a b c d e f g"), (8, "h i j k l m n"), (None, ""), (9, None)]
    planted = spark.createDataFrame([like | {"doc_id": d, "text": t} for d, t in rows], docs.schema).repartition(4)
    got = P.ngram_jaccard_join(spark, planted, sf_small)
    assert got.columns == docs.columns
    want = [(3, far), (None, lone), (8, "a b c d e f g"), (8, "h i j k l m n"), (None, ""), (9, None)]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)


def test_no_passage_is_left(spark, sf_small, stages):
    rows, _ = stages
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: r["text"] for r in rows[2]}
    found = {d: (n, hit) for d, n, hit, _ in hits(list(texts.items()), items, 10)}
    left = {r["doc_id"]: r["text"] for r in rows[3]}
    assert set(left) == {d for d, (n, hit) in found.items() if hit <= 0.5 * n}
    for d, text in left.items():
        assert text == texts[d] if not found[d][1] else len(WORD.findall(fold(text))) == found[d][0] - found[d][1]


def test_mix_takes_whole_documents(stages):
    rows, _ = stages
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    texts, taken = {r["doc_id"]: r["text"] for r in rows[3]}, Counter(r["doc_id"] for r in rows[4])
    assert all(texts[r["doc_id"]] == r["text"] for r in rows[4]) and max(taken.values()) <= 2
    total = sum(map(size, rows[3]))
    assert abs(sum(map(size, rows[4])) - 1.5 * total) < 0.01 * total


def test_tokens_of_all_that_is_left(stages):
    rows, _ = stages
    t, start = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER)), 0
    got = sorted(rows[5], key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted(r["doc_id"] for r in rows[4])
    texts = {r["doc_id"]: r["text"] for r in rows[4]}
    for r in got:
        assert r["start"] == start and r["n_tokens"] == len(t.encode(texts[r["doc_id"]], add_special_tokens=False).ids) + 1
        start += r["n_tokens"]


def test_run_gives_the_last_stage(spark, sf_small, stages):
    assert sorted(map(str, (r.asDict() for r in P.run(spark, sf_small).collect()))) == sorted(map(str, stages[0][5]))
