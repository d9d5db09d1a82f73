from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sightline.llm import arrays as A
from sightline.llm import jobs as J
from sightline.llm import kneser_ney as K
from sightline.llm.queries import QUERIES

RND = random.Random(5)
WORDS = [f"w{i}" for i in range(40)]


def text(toxic, n=60):
    ws = [RND.choice(WORDS) for _ in range(n)]
    if toxic:
        for i in range(0, n, 12):
            ws[i] = RND.choice(["nasty", "Vile!", "rude"])
    return " ".join(ws)


@pytest.fixture(scope="module")
def small(spark):
    toxic = {i: int(i % 4 == 0) for i in range(400)}
    docs = spark.createDataFrame([(i, text(t), "c") for i, t in toxic.items()] + [(1000 + i, text(0), "c") for i in range(100)], "doc_id long, text string, label string").repartition(3).cache()
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    return docs, labels, toxic, K.train(docs, labels)


def test_tells_held_out_documents_apart(small):
    docs, _, toxic, model = small
    got = {r.doc_id: r for r in K.scored(docs, model).collect()}
    assert len(got) == 500 and all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    held = [d for d in toxic if got[d].held_out]
    assert sum(got[d].predicted == toxic[d] for d in held) >= 0.97 * len(held)


def test_distributions_sum_to_one(small):
    model = small[3]
    ids = np.arange(len(model.vocabulary) + 1)
    assert {"nasty", "vile", "rude"} <= {w for w in ["nasty", "vile", "rude", *WORDS] if A.words(pa.array([w]), A.NOT_ALNUM, fold=True).hashes[0] in model.vocabulary}
    for m in (model.ordinary, model.toxic):
        assert abs(m.word.sum() - 1) < 1e-9 and (m.word > 0).all()
        for v in ids:
            assert abs(np.exp(m.log_likelihood(np.full(len(ids), v), ids)).sum() - 1) < 1e-9


def test_difference_is_the_mean_over_words(small):
    model = small[3]
    texts = ["nasty w1 w2 vile", "", None, "w3", "x y z " * 30]
    vocabulary = {int(h): i for i, h in enumerate(model.vocabulary)}
    rare = len(vocabulary)
    for got, t in zip(model.difference(pa.array(texts)), texts):
        hashes = A.words(pa.array([t], pa.string()), A.NOT_ALNUM, fold=True).hashes
        ids = [vocabulary.get(int(h), rare) for h in hashes]
        pairs = list(zip([rare, *ids], ids))
        want = [float((m.log_likelihood(np.array([v]), np.array([w])))[0]) for m in (model.toxic, model.ordinary) for v, w in pairs]
        assert abs(got - (sum(want[: len(pairs)]) - sum(want[len(pairs) :])) / max(1, len(pairs))) < 1e-9


def test_only_the_calibration_sample_is_not_counted(spark, monkeypatch):
    monkeypatch.setattr(K, "CALIBRATION", 10)
    fit = {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 1}
    docs = spark.createDataFrame([(i, text(0) + " onlyhere" * (i in fit and i % 4 == 0)) for i in range(600)], "doc_id long, text string").repartition(3)
    model = K.train(docs, docs.selectExpr("doc_id", "int(doc_id % 4 = 0) AS toxic"))
    assert A.words(pa.array(["onlyhere"]), A.NOT_ALNUM, fold=True).hashes[0] in model.vocabulary


def test_odd_tables(spark, small):
    docs, labels, _, model = small
    odd = spark.createDataFrame([(1, None, 1), (1, None, 1), (None, "nasty", 2), (3, "", 3)], "doc_id long, text string, score int")
    rows = K.scored(odd, model).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert K.train(docs, labels.where("false")).constant == 0.5
    assert K.train(docs, labels.where("toxic = 0")).constant == 0.25 and K.train(docs, labels.where("toxic = 1")).constant == 0.75
    assert K.train(odd, spark.createDataFrame([(None, 1), (1, None), (9, 1)], "doc_id long, toxic int")).constant == 0.5
    assert K.scored(odd.where("false"), model).count() == 0 and K.train(docs.where("false"), labels).constant == 0.5


def test_known_rows_is_a_join(spark):
    rows = spark.range(5000).selectExpr("id - 2500 AS id", "'x' AS text")
    keys = spark.createDataFrame([(i,) for i in (-2000, 0, 5, 5, 2400, 99999, None)], "id long")
    assert sorted(r.id for r in J.known_rows(rows, keys, "id").collect()) == [-2000, 0, 5, 5, 2400]


def test_query_accuracy(spark, sf_small):
    sf = sf_small.replace("sf0.001", "sf0.01")
    got = {r.doc_id: r for r in QUERIES["op1_toxicity_kneser_ney"](spark, sf).collect()}
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == 1000
    pairs = [(got[d].predicted, y) for d, y in truth.items() if got[d].held_out]
    assert sum(a == b for a, b in pairs) / len(pairs) >= 0.93


def test_words_and_bigrams_under_the_broadcast_share_count_all_the_same(spark):
    """No score depends on what is broadcast: words of the tail alone tell the classes apart here."""
    rnd = random.Random(8)
    docs = [(i, " ".join(rnd.choice(WORDS) for _ in range(50)) + "".join(f" Odd{rnd.randint(0, 4)} rude{rnd.randint(0, 2)} w1" for _ in range(rnd.randint(1, 4) if i % 3 == 0 else rnd.randint(0, 9) // 9))) for i in range(600)] + [(7, "odd1 rude2"), (None, "odd3"), (9999, None)]
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    labels = docs.where("doc_id < 600").selectExpr("doc_id", "int(doc_id % 3 = 0) AS toxic")
    whole = K.train(docs, labels, least=0.0)
    want = sorted((str(r.doc_id), round(r.score, 9), r.predicted) for r in K.scored(docs, whole).collect())
    assert whole.tail is None and len({s for _, s, _ in want}) > 100
    model = K.train(docs, labels, least=0.03)
    assert model.tail is not None and len(model.vocabulary) < len(whole.vocabulary) and len(model.ordinary.pairs) < len(whole.ordinary.pairs)
    assert sorted((str(r.doc_id), round(r.score, 9), r.predicted) for r in K.scored(docs, model).collect()) == want


def spelled_out(docs, labels, text):
    """Difference per word by the formulas of the module, with a place for every word (dicts only)."""
    words = lambda t: (t or "").lower().split()
    counted = [(words(t), labels[i]) for i, t in docs if i in labels and zlib.crc32(str(i).encode()) % 5 > 1]
    everywhere = Counter(w for _, t in docs for w in set(words(t)))
    uni, big = ([Counter(x for ws, y in counted if y == k for x in set(f(ws))) for k in (0, 1)] for f in (list, lambda ws: zip([None, *ws], ws)))
    size = [sum(u.values()) for u in uni]
    scale = [min(size) / n for n in size]
    known = set(uni[0]) | set(uni[1])
    p0 = lambda w: (everywhere[w] + 1) / (sum(everywhere[x] + 1 for x in known) + max(1, sum(everywhere[x] for x in set(everywhere) - known)) + 1)

    def own(n, kind):
        shares = [z / sum(size) for z in size]
        found = 2 * sum(k * math.log(k / (sum(n) * s)) for k, s in zip(n, shares) if k) / (1 + sum(n) * shares[0] * shares[1] / K.SPREAD[kind])
        return 1 / (1 + (K.EVIDENCE[kind] / max(found, 1e-9)) ** K.STEEP)

    drawn = lambda g, x: [sum(x) / 2 + g * (c - sum(x) / 2) for c in x]
    owns = {w: own([u[w] for u in uni], 0) for w in known}
    pairs = {p: drawn(max(owns[p[1]], own([b[p] for b in big], 1)), [b[p] * s for b, s in zip(big, scale)]) for p in set(big[0]) | set(big[1])}
    kinds = {w: drawn(owns[w], [sum(1 - (1 - s) ** n for (_, x), n in b.items() if x == w) for b, s in zip(big, scale)]) for w in known}
    p = []
    for k in (0, 1):
        total = sum(x[k] for x in kinds.values())
        free = 1 - sum(max(x[k] - K.DISCOUNT, 0) for x in kinds.values()) / total
        one = lambda w: max(kinds.get(w, [0, 0])[k] - K.DISCOUNT, 0) / total + free * p0(w)  # noqa: B023, E731

        def two(v, w):
            own = [(x[k], max(x[k] - K.DISCOUNT, 0), b) for (a, b), x in pairs.items() if a == v and v is not None]
            context = sum(c for c, _, _ in own)
            return one(w) if not context else sum(d for _, d, b in own if b == w) / context + (1 - sum(d for _, d, _ in own) / context) * one(w)  # noqa: B023

        p.append(sum(math.log(two(v, w)) for v, w in zip([None, *words(text)], words(text))))
    return (p[1] - p[0]) / max(1, len(words(text)))


@pytest.mark.parametrize("least", [0.0, 0.01])
def test_differences_are_those_of_a_model_with_a_place_for_every_word(spark, least):
    rnd = random.Random(3)
    many = [f"w{min(int(rnd.paretovariate(0.6)), 900)}" for _ in range(5000)]  # most words come once or twice
    docs = [(i, " ".join(rnd.choice(many) + (" Vile" * (i % 3 == 0 and rnd.random() < 0.1)) for _ in range(25))) for i in range(260)]
    labels = {i: int(i % 3 == 0) for i in range(220)}
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    model = K.train(frame, spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"), least=least)
    assert (model.tail is not None) == (least > 0)
    texts = [docs[1][1], docs[3][1], docs[250][1], "vile never seen w1 Vile vile", "w1 w2 w3 w1 w2", ""]
    rows = K.differences(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), model).collect()
    for r in rows:
        assert abs(r.x - spelled_out(docs, labels, texts[r.i])) < 1e-9
    assert len(rows) == 6


def test_a_bigram_of_usual_words_is_learned(spark):
    """Both words are as frequent in ordinary documents; only their order tells the classes apart."""
    rnd = random.Random(4)

    def green_door(toxic):
        ws = [rnd.choice(WORDS) for _ in range(40)]
        for a, b in (("green", "door"), ("green", "door")) if toxic else (("door", "w1"), ("green", "w2")) * 2:
            at = rnd.randrange(len(ws))
            ws[at:at] = [a, b]
        return " ".join(ws)

    toxic = {i: int(i % 3 == 0) for i in range(1500)}
    docs = spark.createDataFrame([(i, green_door(y)) for i, y in toxic.items()], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in K.scored(docs, K.train(docs, docs.selectExpr("doc_id", "int(doc_id % 3 = 0) AS toxic"))).collect()}
    held = [d for d in toxic if got[d].held_out]
    assert sum(got[d].predicted == toxic[d] for d in held) >= 0.95 * len(held)
