"""Native match places against Python's, on random texts."""
from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from sightline.functions import spans as SP
from sightline.operators import pages as PG


@pytest.fixture(scope="module")
def texts(spark):
    rnd = random.Random(2)
    parts = ["ab", "\n", "é", "😀", "x", "```\n", "  ", "q" * 9]
    rows = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 120))) for _ in range(200)] + [None, "", "xx", "x\n" * 1000]
    return rows, spark.createDataFrame(list(enumerate(rows)), "id long, t string")


def test_places_lines_groups_and_context(texts):
    rows, df = texts
    got = {r.id: r.s for r in df.select("id", SP.spans(F.col("t"), "(?dU)x+(\\n?)", 1, 7).alias("s")).collect()}
    for i, t in enumerate(rows):
        t = t or ""
        want = [(m.start(), m.end(), t[: m.start()].count("\n") + 1, m[1], t[max(0, m.start() - 7) : m.end() + 7].replace("\n", "\\n")) for m in re.finditer("x+(\n?)", t)]
        assert [(s.start, s.end, s.line, s.g1, s.find) for s in got[i]] == want


def test_runs_outside_zones(texts):
    rows, df = texts
    free = SP.let(SP.spans(F.col("t"), r"(?U)\S{9,}"), lambda a: SP.apart(a, SP.spans(F.col("t"), "```[^`]*")))
    got = {r.id: [(s.start, s.end) for s in r.s] for r in df.select("id", free.alias("s")).collect()}
    for i, t in enumerate(rows):
        zones = [m.span() for m in re.finditer("```[^`]*", t or "")]
        assert got[i] == [m.span() for m in re.finditer(r"\S{9,}", t or "") if not any(m.start() < b and m.end() > a for a, b in zones)]


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 1000])
def test_running_sums(spark, n):
    got = spark.range(1).select(SP.running(F.array(*(F.lit(i % 7) for i in range(n))).cast("array<int>")).alias("x")).first().x
    want, total = [], 0
    for i in range(n):
        total += i % 7
        want.append(total)
    assert got == want


def test_twenty_thousand_matches_in_one_text(spark):
    df = spark.createDataFrame([(1, "<form> role='x'\n" * 10_000)], "id long, md string")
    begun = time.perf_counter()
    r = PG.html_leaks(df, "md").select(F.size("leaks").alias("n"), F.col("leaks")[19_999]["line"].alias("line")).first()
    assert (r.n, r.line) == (20_000, 10_000) and time.perf_counter() - begun < 30


def test_no_python_in_the_detectors(spark):
    df = spark.createDataFrame([(1, "x")], "id long, md string")
    plan = PG.section_map(PG.detect_issues(df, "md"), "md")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
