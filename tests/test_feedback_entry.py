from __future__ import annotations

import datetime as dt
import tempfile


from pyspark.sql import functions as F

from sightline.sources import feedback as FB
from sightline.streaming import feedback_stream as FS


def _entries(spark):
    ts = dt.datetime(2026, 4, 28, 21, 47, 49, 172289)
    rows = [("planning", ts, "# Title\n\n## Context\nc\n## Gap\ng\n"), ("../outside", ts, "x"), ("a/../b", ts, "x"),
            ("..", ts, "x"), (".", ts, "x"), ("sub/skill", ts, "x"), ("tables", ts, "   "),
            ("tables", ts + dt.timedelta(microseconds=1), "ok")]
    return spark.createDataFrame(rows, "skill string, ts timestamp, text string")


def test_append_scan_and_quarantine(spark):
    root = tempfile.mkdtemp(prefix="fb-")
    FB.feedback_append(_entries(spark), f"{root}/store", quarantine=f"{root}/bad")
    back = FB.feedback_scan(spark, f"{root}/store")
    got = {(r.skill, r.key, r.text) for r in back.collect()}
    assert got == {("planning", "suggestion_20260428_214749_172289", "# Title\n\n## Context\nc\n## Gap\ng\n"),
                   ("tables", "suggestion_20260428_214749_172290", "ok\n")}
    assert spark.read.parquet(f"{root}/bad").count() == 6
    only = FB.feedback_scan(spark, f"{root}/store", ["tables"])
    assert "PartitionFilters" in only._jdf.queryExecution().executedPlan().toString() or only.count() == 1
    sec = {r.skill: r for r in FB.feedback_completeness(FB.feedback_sections(back, ["skill", "key"])).collect()}
    assert sec["planning"].missing_context == 0 and sec["planning"].missing_impact == 1


def test_stream_exactly_once(spark):
    base = tempfile.mkdtemp(prefix="fbs-")
    _entries(spark).write.parquet(f"{base}/in")
    for _ in range(2):
        q = FS.start_feedback_sink(FS.keyed_entries(FS.entries_stream(spark, f"{base}/in")), f"{base}/out", f"{base}/ck")
        q.awaitTermination()
    assert spark.read.parquet(f"{base}/out").count() == 2


def test_stream_keeps_late_entries(spark):
    import datetime as dt

    base = tempfile.mkdtemp(prefix="fbl-")
    day = lambda n: dt.datetime(2024, 3, 10 - n)
    files = [[("a", day(0), "new")], [("a", day(5), "old")], [("b", day(9), "older"), ("a", day(0), "new")], [("a", day(9), "oldest"), ("a", day(9), "oldest")]]
    got = []
    for rows in files:  # one trigger a file, each older than the one before
        spark.createDataFrame(rows, "skill string, ts timestamp, text string").write.mode("append").parquet(f"{base}/in")
        FS.start_feedback_sink(FS.keyed_entries(FS.entries_stream(spark, f"{base}/in", max_files_per_trigger=1)), f"{base}/out", f"{base}/ck").awaitTermination()
        got.append(spark.read.parquet(f"{base}/out").count())
    assert got == [1, 2, 3, 4]
    assert sorted((r.skill, r.text.strip()) for r in spark.read.parquet(f"{base}/out").collect()) == [("a", "new"), ("a", "old"), ("a", "oldest"), ("b", "older")]


def test_stream_reads_keys_of_the_batch_s_times_only(spark):
    base = tempfile.mkdtemp(prefix="fbp-")
    store = [("a", "2024-01-01 00:00:00", "x"), ("a", "2024-03-01 00:00:00", "y"), ("a", None, "z")]
    rows = lambda r: FS.keyed_entries(spark.createDataFrame(r, "skill string, ts string, text string").withColumn("ts", F.to_timestamp("ts")))
    spark.createDataFrame([], FS.STORE_SCHEMA).write.partitionBy("skill").parquet(f"{base}/out")
    FS.append_new(rows(store), f"{base}/out")
    again = rows([("a", "2024-03-01 00:00:00", "y"), ("a", "2024-03-02 00:00:00", "new"), ("a", None, "z")])
    read = FS._in_store(again, f"{base}/out")
    assert sorted(r.text.strip() for r in read.collect()) == ["y", "z"]
    plan = read.select("skill", "key", "text_hash")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(IsNull(ts)" in plan and "text:" not in plan.replace("text_hash:", "")
    FS.append_new(again, f"{base}/out")
    assert spark.read.parquet(f"{base}/out").count() == 4


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0 and "next" in df.columns
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs) and len(qs) >= 80


def test_feedback_plain_files_and_binary_pages(spark):
    import os

    from sightline.sources.tables import page_source_binary

    root = tempfile.mkdtemp(prefix="fbf-")
    os.makedirs(f"{root}/planning")
    with open(f"{root}/planning/suggestion_20260428_214749_172289.md", "w") as fh:
        fh.write("# Idea\n\n## Context\nx\n")
    got = FB.feedback_scan_files(spark, f"{root}/*/suggestion_*.md").collect()
    assert [(r.skill, r.key, str(r.ts), r.text) for r in got] == [
        ("planning", "suggestion_20260428_214749_172289", "2026-04-28 21:47:49.172289", "# Idea\n\n## Context\nx\n")]

    pages = tempfile.mkdtemp(prefix="pg-")
    with open(f"{pages}/a.html", "wb") as fh:
        fh.write(b"<html><body><p>caf\xe9 ok</p></body></html>")  # latin-1 byte: invalid UTF-8
    r = page_source_binary(spark, f"{pages}/*.html").first()
    assert r.url.endswith("a.html") and "caf� ok" in r.html
