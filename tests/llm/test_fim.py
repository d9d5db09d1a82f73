from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sightline.llm import arrays as A
from sightline.llm import fim
from sightline.llm.queries import QUERIES

PATTERNS = {"code_point": r"(?s).", "word": r"^[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "line": r"[^\n]*\n|[^\n]+$"}
PARTS = st.sampled_from(["a", "é", "日本", "😀", " ", "  ", "\n", "word ", "<P", "x" * 70, "é" * 50, "\t", "line\n"])


def units(text, unit):
    return re.findall(PATTERNS[unit], text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=60).map("".join), min_size=1, max_size=5), st.sampled_from(sorted(PATTERNS)))
def test_every_rank_is_reached_exactly(texts, unit):
    buf, offsets = A.utf8(pa.array(texts, pa.string()))
    lists = fim.SkipLists.of(buf, offsets, unit)
    assert lists.units().tolist() == [len(units(t, unit)) for t in texts]
    for i, t in enumerate(texts):
        own = units(t, unit)
        ranks = np.arange(len(own) + 1)
        byte, chars = lists.find(np.full(len(ranks), i), ranks)
        assert chars.tolist() == [len("".join(own[:r])) for r in ranks]
        assert (byte - offsets[i]).tolist() == [len("".join(own[:r]).encode()) for r in ranks]


def test_a_long_text_has_lanes_whose_widths_add_up():
    buf, offsets = A.utf8(pa.array(["é" * 500_000 + "x" * 10, "", "short"]))
    lists = fim.SkipLists.of(buf, offsets)
    assert len(lists.lanes) >= 5 and all(lane.units.sum() == lane.chars.sum() == 500_015 for lane in lists.lanes)
    byte, chars = lists.find(np.array([0, 0, 1, 2]), np.array([499_999, 500_010, 0, 5]))
    assert byte.tolist() == [999_998, 1_000_010, 1_000_010, 1_000_015] and chars.tolist() == [499_999, 500_010, 0, 5]


def brute(doc, text, unit="code_point"):
    text = text or ""
    own = units(text, unit)
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(own) + 1), h2 % (len(own) + 1)))
    p, m, s = "".join(own[:a]), "".join(own[a:b]), "".join(own[b:])
    if not text or any(x in text for x in fim.MARKERS) or h3 % 100 >= 90:
        return len(own), "plain", None, None, text
    if h4 % 100 < 20:
        return len(own), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(own), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", sorted(PATTERNS))
def test_against_brute_force(spark, unit):
    rnd = random.Random(4)
    rows = [(i, "".join(rnd.choice("ab é\n日<>PSM😀") for _ in range(rnd.randint(0, 300)))) for i in range(200)]
    rows += [(7, None), (8, ""), (9, "tie"), (9, "tie"), (9, "other"), (None, "no id, long enough"), (10, "has <M> in it"), (11, "é" * 300_000)]
    docs = spark.createDataFrame([(d, t, 1, "f") for d, t in rows], "doc_id long, text string, n int, form string").repartition(3)
    out = fim.fill_in_middle(docs, unit=unit)
    got = out.withColumn("back", fim.restored("output", "form")).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted([(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got], key=key) == sorted([(d, *brute(d, t, unit)) for d, t in rows], key=key)
    assert sorted(((r.doc_id, r.back) for r in got), key=key) == sorted(((d, t or "") for d, t in rows), key=key)


def test_odd_tables_and_options(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert fim.fill_in_middle(docs).collect() == []
    one = spark.createDataFrame([("a", "some text of words"), ("b", "more <|mid|> text")], "doc_id string, text string")
    marks = ("<|pre|>", "<|suf|>", "<|mid|>")
    out = fim.fill_in_middle(one, markers=marks, plain_from=100).withColumn("back", fim.restored("output", "form", marks)).orderBy("doc_id").collect()
    assert [r.back for r in out] == ["some text of words", "more <|mid|> text"] and out[0].form != "plain" and out[1].form == "plain"
    for bad in (("<P>", "<P>", "<M>"), ("ab", "ba", "c"), ("", "a", "b")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(one, markers=bad)
    with pytest.raises(ValueError):
        fim.fill_in_middle(one, unit="page")


def test_query_on_whole_table(spark, sf_small):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_fim_skip_list"](spark, sf_small).collect()}
    assert got == {d: (*brute(d, t)[:4], sha(brute(d, t)[4]), sha(t or "")) for d, t in rows.items()}
    assert spark.range(1).select(fim.restored(F.lit("x<P>"), F.lit("plain")).alias("t")).first().t == "x<P>"
