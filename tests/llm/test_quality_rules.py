from __future__ import annotations

import random
import re
from collections import Counter

from sightline.llm import quality_rules as Q

ROWS = [(1, None, 0), (2, "", 0), (3, " \n\t ", 0), (4, "a b c a b c a b c", 0), (5, "x " * 60, 0), (6, "é ü ## |<>| 日本", 0),
        (7, "line one\nline one\n\nline one \n", 0), (8, "ALL CAPS " * 5, 0), (8, "ALL CAPS " * 5, 0), (None, "no id", 0)]


def brute(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    again = {i + j for i in range(len(ws) - 2) if grams[tuple(ws[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {"n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": len(again), "n_lines": len(lines), "n_upper": len(re.findall("[A-Z]", text)), "n_letters": len(re.findall("[A-Za-z]", text))}


def test_against_brute_force(spark):
    rnd = random.Random(4)
    parts = ["a", "b", "C", "é", "#", "\n", " ", "  ", "|x|", "word"]
    rows = ROWS + [(100 + i, " ".join(rnd.choice(parts) for _ in range(rnd.randint(0, 150))), i) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int").repartition(3)
    got = Q.judged(docs).collect()
    want = sorted(((d, *brute(t).values()) for d, t, _ in rows), key=str)
    assert sorted(((r.doc_id, *(r[m] for m in brute(""))) for r in got), key=str) == want
    for r in got:
        base = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == base and not (base and r.kept)
        assert r.failed == sum(Q.bit(k) for k, c in Q.RULES.items() if eval(c, {}, r.asDict()))


def test_ablation_by_bits(spark):
    rows = [(i, f) for i, f in enumerate([0, 1, 2, 3, 4, 5, 16, 17, 127, 0])]
    got = {(r.version, r.rule): r for r in Q.ablation(spark.createDataFrame(rows, "doc_id long, failed long")).collect()}
    for version, rules in Q.POLICIES.items():
        m = Q.mask(version)
        for rule in rules:
            r = got[version, rule]
            assert r.n_docs == 10 and r.n_kept == sum(f & m == 0 for _, f in rows)
            assert r.n_failed == sum(f & Q.bit(rule) > 0 for _, f in rows) and r.n_only == sum(f & m == Q.bit(rule) for _, f in rows)
    assert len(got) == sum(map(len, Q.POLICIES.values()))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert Q.judged(docs).count() == 0
    assert all(r.n_docs == r.n_kept == 0 for r in Q.ablation(Q.ledger(docs)).collect())
