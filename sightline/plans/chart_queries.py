"""Registered chart-dataset queries (K2–K12) over the star schema and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline.operators import charts as K
from sightline.plans.catalog import register
from sightline.sources.tables import read_table


def _status_flows(spark, d):
    """nation → order status (orders) and order status → return flag (lineitems)."""
    nation = read_table(spark, d, "nation").select("n_nationkey", "n_name")
    cust = read_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_returnflag")
    a = orders.join(cust, orders.o_custkey == cust.c_custkey).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    e1 = K.flow_edges(a, "n_name", "o_orderstatus")
    b = li.join(orders, li.l_orderkey == orders.o_orderkey)
    e2 = K.flow_edges(b, "o_orderstatus", "l_returnflag")
    return e1.unionByName(e2)


_FLOWS_SQL = """
SELECT n_name AS source, o_orderstatus AS target, ROUND(CAST(COUNT(*) AS DOUBLE), 2) AS value
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name, o_orderstatus
UNION ALL
SELECT o_orderstatus, l_returnflag, ROUND(CAST(COUNT(*) AS DOUBLE), 2)
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderstatus, l_returnflag
"""


@register("flow_edges", _FLOWS_SQL)
def _flow_edges(spark, d):
    return _status_flows(spark, d)


@register(
    "flow_conservation",
    f"""WITH e AS ({_FLOWS_SQL}),
    i AS (SELECT target AS node, SUM(value) AS inflow FROM e GROUP BY target),
    o AS (SELECT source AS node, SUM(value) AS outflow FROM e GROUP BY source)
    SELECT i.node, ROUND(inflow, 2) AS inflow, ROUND(outflow, 2) AS outflow
    FROM i JOIN o ON i.node = o.node WHERE ABS(inflow - outflow) > 1e-6""",
)
def _flow_conservation(spark, d):
    return K.flow_conservation(_status_flows(spark, d))


@register(
    "share_of_total",
    """SELECT p_brand AS label, ROUND(SUM(p_retailprice), 4) AS value,
              ROUND(SUM(p_retailprice) * 100.0 / SUM(SUM(p_retailprice)) OVER (), 2) AS share_pct
       FROM part GROUP BY p_brand HAVING SUM(p_retailprice) > 0""",
)
def _share(spark, d):
    return K.share_of_total(read_table(spark, d, "part"), "p_brand", "p_retailprice")


@register(
    "hierarchy_rollup",
    """SELECT r_name, n_name, ROUND(SUM(o_totalprice), 2) AS size,
              CAST(2 - GROUPING(r_name) - GROUPING(n_name) AS INTEGER) AS depth
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey
       WHERE o_totalprice >= 0
       GROUP BY ROLLUP (r_name, n_name)""",
)
def _rollup(spark, d):
    orders = read_table(spark, d, "orders").select("o_custkey", "o_totalprice")
    cust = read_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    geo = read_table(spark, d, "nation").join(read_table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    x = orders.join(cust, F.col("o_custkey") == F.col("c_custkey")).join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    return K.hierarchy_rollup(x, ["r_name", "n_name"], "o_totalprice")


@register(
    "state_transitions",
    """WITH s AS (
         SELECT event_type,
                LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev,
                LEAD(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt
         FROM events)
       SELECT from_state, to_state, COUNT(*) AS n FROM (
         SELECT COALESCE(prev, '[*]') AS from_state, event_type AS to_state FROM s
         UNION ALL SELECT event_type, '[*]' FROM s WHERE nxt IS NULL)
       GROUP BY from_state, to_state""",
)
def _transitions(spark, d):
    return K.state_transitions(read_table(spark, d, "events"), "user_id", ["ts", "event_id"], "event_type")


@register(
    "quadrant_class",
    """WITH c AS (
         SELECT c_custkey, c_acctbal, CAST(COUNT(o_orderkey) AS DOUBLE) AS n_orders
         FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_acctbal),
       m AS (SELECT MIN(c_acctbal) x0, MAX(c_acctbal) x1, MIN(n_orders) y0, MAX(n_orders) y1 FROM c),
       s AS (SELECT c_custkey, c_acctbal, n_orders,
                    CASE WHEN x1 > x0 THEN (c_acctbal - x0) / (x1 - x0) ELSE 0.0 END AS sx,
                    CASE WHEN y1 > y0 THEN (n_orders - y0) / (y1 - y0) ELSE 0.0 END AS sy FROM c, m)
       SELECT c_custkey, c_acctbal, n_orders, ROUND(sx, 6) AS sx, ROUND(sy, 6) AS sy,
              CASE WHEN sx >= 0.5 AND sy >= 0.5 THEN 1 WHEN sy >= 0.5 THEN 2 WHEN sx < 0.5 THEN 3 ELSE 4 END AS quadrant
       FROM s""",
)
def _quadrant(spark, d):
    cust = read_table(spark, d, "customer").select("c_custkey", "c_acctbal")
    orders = read_table(spark, d, "orders").select("o_custkey", "o_orderkey")
    per = cust.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey", "c_acctbal").agg(
        F.count("o_orderkey").cast("double").alias("n_orders"))
    return K.quadrant_class(per, "c_acctbal", "n_orders")


@register(
    "axis_scaling",
    """SELECT p_partkey, p_retailprice, p_size,
              ROUND((p_retailprice - 0) / (m - 0), 6) AS p_retailprice_scaled,
              ROUND((p_size - 0) / (m - 0), 6) AS p_size_scaled
       FROM part, (SELECT GREATEST(MAX(p_retailprice), MAX(p_size)) AS m FROM part)""",
)
def _axis(spark, d):
    part = read_table(spark, d, "part").select("p_partkey", "p_retailprice", "p_size")
    return K.axis_scaling(part, ["p_retailprice", "p_size"])


@register(
    "relation_cardinality",
    """WITH per AS (SELECT c_custkey, COUNT(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey
                    GROUP BY c_custkey)
       SELECT MIN(n) AS min_children, MAX(n) AS max_children,
              CAST(SUM(CASE WHEN n = 0 THEN 1 ELSE 0 END) AS BIGINT) AS childless_parents,
              (SELECT COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS orphan_children
       FROM per""",
)
def _cardinality(spark, d):
    return K.relation_cardinality(read_table(spark, d, "customer"), "c_custkey", read_table(spark, d, "orders"), "o_custkey")


@register(
    "set_overlap",
    """SELECT labels, COUNT(*) AS members, n_labels FROM (
         SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS labels,
                CAST(COUNT(DISTINCT event_type) AS INTEGER) AS n_labels
         FROM events GROUP BY user_id) GROUP BY labels, n_labels""",
)
def _overlap(spark, d):
    combos = K.set_overlap(read_table(spark, d, "events"), "user_id", "event_type")
    return combos.select(F.array_join("labels", ",").alias("labels"), "members", "n_labels")


@register(
    "pairwise_overlap",
    """SELECT a.event_type AS label_a, b.event_type AS label_b, COUNT(*) AS members
       FROM (SELECT DISTINCT user_id, event_type FROM events) a
       JOIN (SELECT DISTINCT user_id, event_type FROM events) b ON a.user_id = b.user_id AND a.event_type < b.event_type
       GROUP BY a.event_type, b.event_type""",
)
def _pairs(spark, d):
    return K.pairwise_overlap(K.set_overlap(read_table(spark, d, "events"), "user_id", "event_type"))


@register(
    "journey_scores",
    """SELECT event_type, 'user-' || CAST(user_id AS VARCHAR) AS actor,
              ROUND(AVG(LEAST(5, GREATEST(1, CAST(CEIL(value / 100.0) AS INTEGER)))), 4) AS mean_score,
              COUNT(*) AS n
       FROM events GROUP BY event_type, user_id""",
)
def _journey(spark, d):
    ev = read_table(spark, d, "events").select(
        "event_type",
        F.array(F.concat(F.lit("user-"), F.col("user_id").cast("string"))).alias("actors"),
        F.least(F.lit(5), F.greatest(F.lit(1), F.ceil(F.col("value") / 100.0).cast("int"))).alias("score"),
    )
    return K.journey_scores(ev, "event_type", "actors", "score")


@register("board_counts", "SELECT o_orderstatus AS stage, COUNT(*) AS items FROM orders GROUP BY o_orderstatus")
def _board(spark, d):
    return K.board_counts(read_table(spark, d, "orders"), "o_orderstatus")
