from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

from sightline.llm import byte_cnn as B
from sightline.llm.queries import QUERIES


def naive(model, text):
    """One text, place by place."""
    data = (text or "").encode()
    places = max(1, len(data))
    data += bytes(B.WIDTH)
    w = {k: v.astype(float) for k, v in model.w.items()}
    conv = np.array([sum(w["tables"][k][data[i + k]] for k in range(B.WIDTH)) for i in range(places)])
    halves = [conv[i : i + B.HALF].max(0) for i in range(0, places, B.HALF)]
    chunks = [np.maximum(a, b) for a, b in zip(halves, halves[1:])] or halves
    hidden = [np.maximum(np.maximum(c + w["bias"], 0) @ w["dense"] + w["dense_bias"], 0) for c in chunks]
    return 1 / (1 + np.exp(-(np.mean(hidden, 0) @ w["out"] + w["out_bias"][0])))


def test_score_covers_whole_texts(monkeypatch):
    monkeypatch.setattr(B, "SLICE_BYTES", 700)
    model = B.ByteCNN(3)
    texts = ["", None, "a", "é" * 64, "x" * 127, "y" * 128, "z" * 129, "word " * 60, "q" * 256, "some text, " * 100, "end"]
    assert np.allclose(model.score(pa.array(texts)), [naive(model, t) for t in texts], atol=1e-5)
    assert model.score(pa.array([], pa.string())).tolist() == []
    long = "good text here. " * 500
    assert abs(model.score(pa.array([long + "#" * 300]))[0] - model.score(pa.array([long]))[0]) > 1e-6  # the end counts


def test_learns_and_agrees_with_itself():
    rnd = np.random.default_rng(1)
    texts = ["".join(rnd.choice(list("abcdef "), 300)) + ("!!" * 3 if i % 3 == 0 else "") for i in range(60)]
    label = np.array([i % 3 == 0 for i in range(60)], float)
    models = [B.ByteCNN().fit([t.encode() for t in texts], label, steps=300) for _ in range(2)]
    scores = [m.score(pa.array(texts)) for m in models]
    assert ((scores[0] > 0.5) == label).all() and np.array_equal(*scores)


def test_learns_from_all_parts_of_long_texts():
    """The only sign is one stretch somewhere in texts of 8,000 characters."""
    rnd = np.random.default_rng(2)
    texts = ["".join(rnd.choice(list("abcdef "), 8000)) for _ in range(40)]
    texts = [t[: (k := int(rnd.integers(0, 6000)))] + "#!" * 1000 + t[k + 2000 :] if i % 2 else t for i, t in enumerate(texts)]
    label = np.array([i % 2 for i in range(40)], float)
    scores = B.ByteCNN().fit([t.encode() for t in texts], label, steps=300).score(pa.array(texts))
    assert ((scores > 0.5) == label).all()


def test_bytes_of_the_sample_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(B, "TRAIN_BYTES", 500)
    seen = []
    monkeypatch.setattr(B.ByteCNN, "fit", lambda self, texts, label, steps: seen.append((texts, label)))
    docs = spark.createDataFrame([(i, "x" * (100 if i else 600)) for i in range(50)], "doc_id long, text string")
    B.train(docs, docs.selectExpr("doc_id", "1 AS quality"))
    assert [len(t) for t in seen[0][0]] == [100] * 5 and seen[0][1].tolist() == [1.0] * 5


def test_held_out_accuracy_of_query(spark, sf_small):
    sf = sf_small.replace("sf0.001", "sf0.01")
    got = {r.doc_id: r for r in QUERIES["op10_quality_classifier"](spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for d, r in got.items())
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    pairs = [(got[d].predicted, y) for d, y in truth.items() if got[d].held_out]
    assert sum(a == b for a, b in pairs) / len(pairs) >= 0.93
    assert sum(a for a, y in pairs if y) / sum(y for _, y in pairs) >= 0.97  # clean ones stay


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, "some text", 1), (2, None, 2), (None, "x", 3), (2, None, 2), (4, "", 9)], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (77, 0)], "doc_id long, quality int")
    model = B.train(docs, labels, steps=5)
    rows = B.scored(docs, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows) and B.accepted(docs, model, threshold=0.0).count() == 5
    assert B.accepted(docs, model, threshold=2.0).count() == 0
    none = B.train(docs, labels.where("false"))
    assert none is None and {r.score for r in B.scored(docs, none).collect()} == {0.5} and B.accepted(docs, none).count() == 5
    assert B.scored(docs.where("false"), model).count() == 0 and B.train(docs.where("false"), labels) is None
