"""Join strategies and chart datasets against brute force on small frames."""
from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from sightline.operators import charts as K
from sightline.operators import joins


def _events(spark, n=400, users=4, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        u = 0 if rnd.random() < 0.5 else rnd.randrange(1, users)  # one hot user
        ts = base + dt.timedelta(seconds=rnd.randrange(0, 5 * 86400))
        rows.append((i, u, ts, rnd.choice(["view", "click", "purchase"]), float(rnd.randrange(100))))
    return rows, spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, event_type string, value double")


def test_asof_matches_brute_force(spark):
    rows, ev = _events(spark)
    purch = ev.where("event_type = 'purchase'").select("user_id", "ts", "event_id", "value")
    out = joins.asof_join(ev.select("event_id", "user_id", "ts"), purch, ["user_id"], "ts", "ts",
                          ["event_id", "value"])
    got = {r.event_id: r.asof_event_id for r in out.collect()}
    for i, u, ts, _t, _v in rows:
        cands = [(t2, j) for j, u2, t2, ty, _ in rows if u2 == u and ty == "purchase" and t2 < ts]
        assert got[i] == (max(cands)[1] if cands else None)


def test_interval_join_counts(spark):
    rows, ev = _events(spark)
    a = ev.select(F.col("event_id").alias("a_id"), "user_id", F.col("ts").alias("a_ts"))
    b = ev.select(F.col("event_id").alias("b_id"), "user_id", F.col("ts").alias("b_ts"))
    pairs = joins.interval_join(a, b, ["user_id"], F.col("a_ts") - F.expr("INTERVAL 30 MINUTES"), F.col("a_ts"),
                                F.col("b_ts"), F.col("b_ts"), bucket_seconds=600).where("a_id != b_id")
    got = sorted((r.a_id, r.b_id) for r in pairs.collect())
    want = sorted((i, j) for i, u, t, *_ in rows for j, u2, t2, *_ in rows
                  if u == u2 and i != j and t - dt.timedelta(minutes=30) <= t2 <= t)
    assert got == want


def test_not_in_null_semantics(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    some = spark.createDataFrame([(1,)], "k int")
    with_null = spark.createDataFrame([(1,), (None,)], "k int")
    empty = spark.createDataFrame([], "k int")
    assert sorted(r.k for r in joins.not_in(left, "k", some, "k").collect()) == [2]
    assert joins.not_in(left, "k", with_null, "k").count() == 0
    assert joins.not_in(left, "k", empty, "k").count() == 3


def test_transitions_match_brute_force(spark):
    rows, ev = _events(spark)
    got = {(r.from_state, r.to_state): r.n for r in K.state_transitions(ev, "user_id", ["ts", "event_id"], "event_type").collect()}
    want: dict = {}
    for u in {r[1] for r in rows}:
        seq = [r[3] for r in sorted((r for r in rows if r[1] == u), key=lambda r: (r[2], r[0]))]
        for a, b in zip(["[*]"] + seq, seq + ["[*]"]):
            want[(a, b)] = want.get((a, b), 0) + 1
    assert got == want


def test_overlap_and_shares(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "b"), (3, "c"), (3, "a")], "m int, l string")
    combos = {tuple(r.labels): r.members for r in K.set_overlap(df, "m", "l").collect()}
    assert combos == {("a", "b"): 1, ("a",): 1, ("a", "b", "c"): 1}
    pairs = {(r.label_a, r.label_b): r.members for r in K.pairwise_overlap(K.set_overlap(df, "m", "l")).collect()}
    assert pairs == {("a", "b"): 2, ("a", "c"): 1, ("b", "c"): 1}
    v = spark.createDataFrame([("x", 3.0), ("y", 1.0), ("z", -1.0)], "k string, v double")
    sh = {r.label: r.share_pct for r in K.share_of_total(v, "k", "v").collect()}
    assert sh == {"x": 75.0, "y": 25.0}
    assert [r.label for r in K.rejected_values(v, "k", "v").collect()] == ["z"]


def test_rollup_quadrant_cardinality(spark):
    df = spark.createDataFrame([("r1", "n1", 2.0), ("r1", "n2", 3.0), ("r2", "n3", 5.0), ("r2", "n3", -1.0)],
                               "r string, n string, v double")
    roll = {(x.r, x.n): (x.size, x.depth) for x in K.hierarchy_rollup(df, ["r", "n"], "v").collect()}
    assert roll[(None, None)] == (10.0, 0) and roll[("r1", None)] == (5.0, 1) and roll[("r2", "n3")] == (5.0, 2)
    q = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (0.0, 1.0), (1.0, 0.0)], "x double, y double")
    assert [r.quadrant for r in K.quadrant_class(q, "x", "y").collect()] == [3, 1, 2, 4]
    p = spark.createDataFrame([(1,), (2,)], "pk int")
    c = spark.createDataFrame([(1,), (1,), (9,)], "fk int")
    r = K.relation_cardinality(p, "pk", c, "fk").first()
    assert (r.min_children, r.max_children, r.childless_parents, r.orphan_children) == (0, 2, 1, 1)


def test_asof_ties_and_nulls_match_brute_force(spark):
    rnd = random.Random(9)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, rnd.choice([0, 0, 0, 1, None]), rnd.choice([None, *(base + dt.timedelta(minutes=m) for m in range(12))]),
             rnd.choice(["view", "purchase"]), float(i % 7)) for i in range(300)]
    ev = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, event_type string, value double").repartition(5)
    purch = ev.where("event_type = 'purchase'").select("user_id", "ts", "event_id", "value")
    for strict in (True, False):
        want = {}
        for i, u, ts, _t, _v in rows:
            c = [(t2, j) for j, u2, t2, ty, _ in rows if None not in (u, ts, u2, t2) and u2 == u and ty == "purchase" and (t2 < ts or (not strict and t2 <= ts))]
            want[i] = max(c)[1] if c else None
        out = joins.asof_join(ev.select("event_id", "user_id", "ts"), purch, ["user_id"], "ts", "ts", ["event_id", "value"], strict=strict)
        assert {r.event_id: r.asof_event_id for r in out.collect()} == want, strict
