from __future__ import annotations

import random
import re

import pytest

from sightline.llm.decontamination import contamination, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, window):
    shapes = {}
    for name, text in items:
        ws = WORD.findall(fold(text))
        for i in range(max(1, len(ws) - window + 1)) if ws else []:
            shapes.setdefault(tuple(ws[i : i + window]), set()).add(name)
    out = []
    for doc, text in docs:
        ws, hit, names = WORD.findall(fold(text)), set(), set()
        for shape, who in shapes.items():
            for i in range(len(ws) - len(shape) + 1):
                if tuple(ws[i : i + len(shape)]) == shape:
                    hit |= set(range(i, i + len(shape)))
                    names |= who
        out.append((doc, len(ws), len(hit), sorted(names)))
    return sorted(out)


@pytest.mark.parametrize("seed,window,shortest", [(1, 4, 4), (2, 4, 1), (3, 3, 2), (4, 5, 3)])
def test_against_brute_force(spark, seed, window, shortest):
    rnd = random.Random(seed)
    some = lambda n: " ".join(rnd.choice(["a", "B", "c", "é", "x1"]) for _ in range(n))
    items = [(f"i{k}", some(rnd.randint(shortest, 12))) for k in range(12)] + [("none", " .,"), ("null", None)]
    docs = [(k, some(rnd.choice([0, 1, 3, 20, 60])) + rnd.choice(["", ".", " - "]) + some(5)) for k in range(40)] + [(90, None), (91, "")]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    for block in (1 << 20, 60):  # one automaton, and several
        got = contamination(d, i, window=window, block_bytes=block).collect()
        assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == brute(docs, items, window)


def test_removal_keeps_the_rest(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [(1, "Keep this, please. ONE two; three four five six seven eight nine ten eleven! And  this.", "x"),
            (2, item, "y"), (3, "Clean,  text stays\nas it is.", None), (None, None, "z")]
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    i = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.item_id: r for r in decontaminate(d, i, max_coverage=0.8).collect()}
    assert got["x"].text == "Keep this, please. ! And  this."
    assert "y" not in got and got[None].text == docs[2][1] and got["z"].text is None
    assert decontaminate(d, i.where("false")).count() == 4
    assert decontaminate(d.where("false"), i).count() == 0
    assert contamination(d.where("false"), i).columns[:6] == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_marking_and_removal_share_a_worker(spark):
    """Two maps over Arrow batches in a row keep two Python workers a core alive, for all stages of the pipeline that follow."""
    item = "one two three four five six seven eight nine ten"
    docs = [(1, f"before {item} after a b c d e f g h", "x"), (2, item, "y"), (3, "", None), (4, None, "z")]
    d, i = spark.createDataFrame(docs, "doc_id long, text string, more string"), spark.createDataFrame([(k, f"{item} {k}") for k in range(9)], "item_id long, text string")
    i = i.unionByName(spark.createDataFrame([(9, item)], i.schema))
    got = decontaminate(d, i)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    want = [(1, "before after a b c d e f g h", "x"), (3, "", None), (4, None, "z")]
    for block in (1 << 20, 100):  # one automaton, and several
        got = decontaminate(d, i, max_coverage=0.6, block_bytes=block)
        assert got.schema == d.schema
        assert sorted(tuple(r) for r in got.collect()) == want
