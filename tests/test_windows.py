"""Skew-safe ranking windows against Spark's plain windows on a table with one hot key."""
from __future__ import annotations

import random

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sightline.operators import windows as WN


def test_rank_family_matches_plain_windows(spark):
    rnd = random.Random(3)
    rows = [(0 if rnd.random() < 0.4 else rnd.randrange(1, 30), i, float(rnd.randrange(50)), rnd.choice("FOP"))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, id int, v double, s string")
    order = [F.col("v").desc(), F.col("id").asc()]
    got = WN.value_ranks(WN.rank_family(df, ["k"], order, tiles=4, ), ["k"], "s")
    w = Window.partitionBy("k").orderBy(*order)
    ws = Window.partitionBy("k").orderBy("s")
    want = df.select(
        "k", "id", F.row_number().over(w).cast("bigint").alias("rn"), F.ntile(4).over(w).cast("bigint").alias("tile"),
        F.round(F.percent_rank().over(w), 9).alias("prank"), F.round(F.cume_dist().over(w), 9).alias("cdist"),
        F.rank().over(ws).cast("bigint").alias("rnk"), F.dense_rank().over(ws).cast("bigint").alias("drnk"),
    )
    got = got.select("k", "id", "rn", "tile", F.round("prank", 9).alias("prank"), F.round("cdist", 9).alias("cdist"),
                     "rnk", "drnk")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hot_key_is_split(spark):
    rows = [(0, i) for i in range(2000)] + [(1, i) for i in range(10)]
    df = spark.createDataFrame(rows, "k int, id int")
    x = df.repartitionByRange(8, "k", "id").withColumn("p", F.spark_partition_id())
    assert x.where("k = 0").select("p").distinct().count() > 1
    rn = WN.row_number_by(df, ["k"], ["id"], parts=8)
    assert sorted(r.rn for r in rn.where("k = 0").collect()) == list(range(1, 2001))


def test_shift_and_running_sum_match_plain_windows(spark):
    rnd = random.Random(5)
    rows = [(0 if rnd.random() < 0.4 else rnd.randrange(1, 20), i, rnd.choice([None, float(rnd.randrange(9))]))
            for i in range(2500)]
    df = spark.createDataFrame(rows, "k int, id int, v double")
    x = WN.ordered_pieces(df, ["k"], ["id"], parts=7)
    x = WN.with_shift(x, ["k"], ["id"], "v", 1, "lag1")
    x = WN.with_shift(x, ["k"], ["id"], "v", 2, "lag2")
    x = WN.with_shift(x, ["k"], ["id"], "v", -2, "lead2")
    x = WN.with_running_sum(x, ["k"], ["id"], "v", "run").drop("__pid")
    w = Window.partitionBy("k").orderBy("id")
    want = df.select("k", "id", "v", F.lag("v", 1).over(w).alias("lag1"), F.lag("v", 2).over(w).alias("lag2"),
                     F.lead("v", 2).over(w).alias("lead2"),
                     F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    got = x.select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_range_count_matches_brute_force(spark):
    import datetime as dt

    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, 0 if rnd.random() < 0.5 else rnd.randrange(1, 5), base + dt.timedelta(minutes=rnd.randrange(0, 600)))
            for i in range(800)]  # minute resolution: many equal timestamps
    df = spark.createDataFrame(rows, "id long, k int, ts timestamp")
    got = {r.id: r.n for r in WN.range_count_by(df, ["k"], "ts", "id", "30 MINUTES", "5 MINUTES").collect()}
    for i, k, t in rows:
        lo, hi = t - dt.timedelta(minutes=30), t + dt.timedelta(minutes=5)
        assert got[i] == sum(1 for _, k2, t2 in rows if k2 == k and lo <= t2 <= hi)


# --- the registered plans against DuckDB, on frames with NULL keys, NULL times, ties and a key with half of the rows


def _duck(sql, **tables):
    import duckdb

    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toPandas())
    return con.execute(sql).df()


def _same(spark_df, pandas_df):
    import math

    def clean(v):
        missing = v is None or v != v or str(v) == "NaT"
        return None if missing else round(float(v), 6) if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind in "if" else str(v)

    cols = spark_df.columns
    got = sorted((tuple(clean(v) for v in r) for r in spark_df.toPandas().astype(object).itertuples(index=False)), key=str)
    want = sorted((tuple(clean(v) for v in r) for r in pandas_df[cols].astype(object).itertuples(index=False)), key=str)
    assert got == want and math.isfinite(len(got))


def _odd_events(spark, n=600):
    import datetime as dt

    rnd = random.Random(21)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, rnd.choice([7, 7, 7, None, *range(6)]), None if rnd.random() < 0.05 else base + dt.timedelta(minutes=5 * rnd.randrange(900)),
             rnd.choice(["view", "click", "purchase"]), None if rnd.random() < 0.1 else float(rnd.randrange(9))) for i in range(n)]
    return spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, event_type string, value double").repartition(6)


def test_rank_plan_on_odd_keys(spark):
    from sightline.plans import sql_catalog as SC

    rnd = random.Random(2)
    rows = [(rnd.choice([1, 1, 1, None, 2, 3]), i, float(rnd.randrange(20)), rnd.choice(["F", "O", None])) for i in range(500)]
    df = spark.createDataFrame(rows, "o_custkey long, o_orderkey long, o_totalprice double, o_orderstatus string")
    got = SC.window_rank(df)
    w = "PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey"
    s = "PARTITION BY o_custkey ORDER BY o_orderstatus NULLS FIRST"
    _same(got, _duck(f"""SELECT o_custkey, o_orderkey, row_number() OVER ({w}) AS rn, rank() OVER ({s}) AS rnk, dense_rank() OVER ({s}) AS drnk,
                         ntile(3) OVER ({w}) AS tile, round(percent_rank() OVER ({w}), 6) AS prank, round(cume_dist() OVER ({w}), 6) AS cdist FROM t""", t=df))


def test_analytic_plan_on_odd_keys(spark):
    from sightline.plans import sql_catalog as SC

    ev = _odd_events(spark)
    w = "PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id"
    all_ = f"({w} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    _same(SC.window_analytic(ev), _duck(f"""SELECT event_id, user_id, lag(value) OVER ({w}) AS prev_value, lead(value, 2) OVER ({w}) AS next2_value,
        first(event_type) OVER {all_} AS first_type, last(event_type) OVER {all_} AS last_type, nth_value(value, 2) OVER {all_} AS second_value FROM t""", t=ev))


def test_frames_plan_on_odd_keys(spark):
    from sightline.plans import sql_catalog as SC

    ev = _odd_events(spark)
    w = "PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id"
    _same(SC.window_frames(ev), _duck(f"""SELECT event_id, round(sum(value) OVER ({w} ROWS UNBOUNDED PRECEDING), 4) AS running_value,
        round(avg(value) OVER ({w} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS moving_avg3,
        count(*) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS n_last_day FROM t""", t=ev))


def test_theta_plan_on_odd_keys(spark):
    from sightline.plans import sql_catalog as SC

    ev = _odd_events(spark)
    _same(SC.theta_count(ev), _duck("""SELECT a.event_id, count(b.event_id) AS n_recent FROM t a LEFT JOIN t b ON a.user_id = b.user_id
        AND a.event_id <> b.event_id AND b.ts BETWEEN a.ts - INTERVAL 10 MINUTE AND a.ts GROUP BY a.event_id""", t=ev))


def test_transitions_on_odd_keys(spark):
    from sightline.operators import charts as K

    ev = _odd_events(spark)
    w = "PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id"
    _same(K.state_transitions(ev, "user_id", ["ts", "event_id"], "event_type"), _duck(f"""
        WITH s AS (SELECT event_type, lag(event_type) OVER ({w}) AS p, lead(event_type) OVER ({w}) AS q FROM t)
        SELECT from_state, to_state, count(*) AS n FROM (SELECT coalesce(p, '[*]') AS from_state, event_type AS to_state FROM s
        UNION ALL SELECT event_type, '[*]' FROM s WHERE q IS NULL) GROUP BY ALL""", t=ev))


def test_hierarchy_beyond_a_million_rows(spark, tmp_path):
    from sightline.plans import sql_catalog as SC

    spark.createDataFrame([(0,), (1,)], "r_regionkey int").write.parquet(f"{tmp_path}/region.parquet")
    spark.createDataFrame([(0, 0), (1, 0), (2, 1)], "n_nationkey int, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(1_200_000).selectExpr("id AS c_custkey", "CAST(id % 3 AS INT) AS c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    got = {(r.root, r.depth): r.n_nodes for r in SC.sql_query("sql_recursive")(spark, str(tmp_path)).collect()}
    assert got == {(0, 0): 1, (1, 0): 1, (0, 1): 2, (1, 1): 1, (0, 2): 800_000, (1, 2): 400_000}
