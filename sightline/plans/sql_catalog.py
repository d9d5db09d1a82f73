"""SQL over bound tables (inventory C1–C36).

The reference hands any SQL string to its engine; ours is ``spark.sql``
over lazily bound parquet views.  Each capability below is one named
query: the Spark SQL text and the DuckDB text that must give the same
rows.  Where Spark's SQL plan would not hold at scale (``NOT IN`` on a
large subquery, as-of and band joins on a hot key) the Spark side is a
DataFrame plan from ``sightline.operators.joins`` instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.operators import joins
from sightline.sources.tables import read_table

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def bind_views(spark: SparkSession, sf_dir: str, names: list[str] | tuple[str, ...] = TABLES) -> None:
    """Lazy temp views over the parquet tables (reads footers only)."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)


# name -> (spark SQL, DuckDB SQL).  The DuckDB text is None for
# non-deterministic capabilities (sampling, approximate sketches).
SQL: dict[str, tuple[str, str | None]] = {}


def _q(name: str, spark_sql: str, duck_sql: str | None = "same") -> None:
    SQL[name] = (spark_sql, spark_sql if duck_sql == "same" else duck_sql)


_q("sql_filter", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate
FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000
""")

_q("sql_limit", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")

_q("sql_group_order", """
SELECT o_orderpriority, o_orderstatus, COUNT(*) AS n
FROM orders GROUP BY o_orderpriority, o_orderstatus ORDER BY n DESC, o_orderpriority, o_orderstatus
""")

_q("sql_sum", """
SELECT l_returnflag, l_linestatus,
       SUM(l_quantity) AS sum_qty,
       ROUND(SUM(l_extendedprice), 2) AS sum_base_price,
       ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
       ROUND(SUM(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
       ROUND(AVG(l_quantity), 6) AS avg_qty,
       ROUND(AVG(l_extendedprice), 6) AS avg_price,
       ROUND(AVG(l_discount), 6) AS avg_disc,
       COUNT(*) AS count_order
FROM lineitem
WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00'
GROUP BY l_returnflag, l_linestatus
ORDER BY l_returnflag, l_linestatus
""")

_q("sql_join_using", """
SELECT n_name, COUNT(*) AS n_customers, ROUND(SUM(c_acctbal), 2) AS acctbal
FROM customer JOIN (SELECT n_nationkey AS c_nationkey, n_name FROM nation) USING (c_nationkey)
GROUP BY n_name
""")

# region (5 rows) and nation (25 rows) are fixed-size dimensions, so the
# product is bounded: 125 pairs whatever the scale factor.
_q("sql_cross_join", """
SELECT r_name, COUNT(*) AS n_pairs FROM region CROSS JOIN nation GROUP BY r_name
""")

_q("sql_not_in", """
SELECT c_custkey, c_mktsegment FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
""")

_q("sql_sort_desc", """
SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey
""")

_q("sql_alias_t1", """
SELECT t.n_name, t1.n_regionkey FROM t JOIN t1 ON t.n_nationkey = t1.n_nationkey
""", """
SELECT t.n_name, t1.n_regionkey FROM nation t JOIN nation t1 ON t.n_nationkey = t1.n_nationkey
""")

_q("sql_regex", """
SELECT doc_id,
       regexp_extract(text, '([A-Z][a-z]+)', 1) AS first_cap,
       regexp_count(text, '[0-9]+') AS n_numbers,
       length(regexp_replace(text, '[aeiou]', '')) AS len_no_vowels,
       regexp_extract_all(text, '([0-9]+)', 1)[0] AS first_number,
       regexp_like(text, '[A-Z][a-z]+ [0-9]') AS word_then_number
FROM documents WHERE text RLIKE '[0-9]{3}'
""", """
SELECT doc_id,
       regexp_extract(text, '([A-Z][a-z]+)', 1) AS first_cap,
       CAST(len(regexp_extract_all(text, '[0-9]+')) AS INTEGER) AS n_numbers,
       CAST(length(regexp_replace(text, '[aeiou]', '', 'g')) AS INTEGER) AS len_no_vowels,
       regexp_extract_all(text, '([0-9]+)', 1)[1] AS first_number,
       regexp_matches(text, '[A-Z][a-z]+ [0-9]') AS word_then_number
FROM documents WHERE regexp_matches(text, '[0-9]{3}')
""")

_q("sql_cte", """
WITH spend AS (
  SELECT o_custkey, SUM(o_totalprice) AS total FROM orders GROUP BY o_custkey
), seg AS (
  SELECT c_mktsegment, c_custkey FROM customer
)
SELECT c_mktsegment, COUNT(*) AS n_customers, ROUND(AVG(total), 4) AS avg_spend
FROM spend JOIN seg ON spend.o_custkey = seg.c_custkey
GROUP BY c_mktsegment
""")

_q("sql_window_rank", """
SELECT o_custkey, o_orderkey,
       CAST(ROW_NUMBER() OVER w AS BIGINT) AS rn,
       CAST(RANK() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) AS BIGINT) AS rnk,
       CAST(DENSE_RANK() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) AS BIGINT) AS drnk,
       CAST(NTILE(3) OVER w AS BIGINT) AS tile,
       ROUND(PERCENT_RANK() OVER w, 6) AS prank,
       ROUND(CUME_DIST() OVER w, 6) AS cdist
FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)
""")

_q("sql_window_analytic", """
SELECT event_id, user_id,
       LAG(value) OVER w AS prev_value,
       LEAD(value, 2) OVER w AS next2_value,
       FIRST_VALUE(event_type) OVER w AS first_type,
       LAST_VALUE(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_type,
       NTH_VALUE(value, 2) OVER (PARTITION BY user_id ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second_value
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")

_q("sql_window_frames", """
SELECT event_id,
       ROUND(SUM(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS running_value,
       ROUND(AVG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS moving_avg3,
       COUNT(*) OVER (PARTITION BY user_id ORDER BY ts
             RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS n_last_day
FROM events
""")

_q("sql_outer_joins", """
SELECT c.c_custkey, COUNT(o.o_orderkey) AS n_orders, ROUND(COALESCE(SUM(o.o_totalprice), 0), 2) AS spend
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
GROUP BY c.c_custkey
""")

_q("sql_full_outer", """
SELECT COALESCE(s.nk, c.nk) AS nationkey, s.n_suppliers, c.n_customers
FROM (SELECT s_nationkey AS nk, COUNT(*) AS n_suppliers FROM supplier GROUP BY s_nationkey) s
FULL OUTER JOIN (SELECT c_nationkey AS nk, COUNT(*) AS n_customers FROM customer WHERE c_acctbal > 9000 GROUP BY c_nationkey) c
ON s.nk = c.nk
""")

_q("sql_semi_anti", """
SELECT 'with_orders' AS kind, COUNT(*) AS n FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')
UNION ALL
SELECT 'without_orders' AS kind, COUNT(*) AS n FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')
""")

# C17: events of the same user within the 10 minutes before each event.
_q("sql_theta_join", "", """
SELECT a.event_id, COUNT(b.event_id) AS n_recent
FROM events a LEFT JOIN events b
  ON a.user_id = b.user_id AND b.ts >= a.ts - INTERVAL 10 MINUTE AND b.ts <= a.ts AND b.event_id <> a.event_id
GROUP BY a.event_id
""")

# For each event, the user's latest strictly earlier purchase.
_q("sql_asof", "", """
SELECT e.event_id, p.event_id AS asof_event_id, p.value AS asof_value, p.ts AS asof_ts
FROM events e ASOF LEFT JOIN (SELECT event_id, user_id, value, ts FROM events WHERE event_type = 'purchase') p
  ON e.user_id = p.user_id AND e.ts > p.ts
""")

_q("sql_grouping_sets", """
SELECT l_returnflag, l_linestatus, GROUPING_ID(l_returnflag, l_linestatus) AS gid,
       COUNT(*) AS n, SUM(l_quantity) AS qty
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)
""", """
SELECT l_returnflag, l_linestatus, CAST(GROUPING(l_returnflag, l_linestatus) AS BIGINT) AS gid,
       COUNT(*) AS n, SUM(l_quantity) AS qty
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)
""")

_q("sql_grouping_sets_explicit", """
SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total
FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())
""")

_q("sql_cube", """
SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n
FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)
""")

_q("sql_distinct_agg", """
SELECT o_orderstatus, COUNT(DISTINCT o_custkey) AS n_customers,
       COUNT(*) FILTER (WHERE o_totalprice > 200000) AS n_big,
       ROUND(SUM(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT'), 2) AS urgent_total
FROM orders GROUP BY o_orderstatus
""")

_q("sql_quantiles", """
SELECT l_returnflag,
       MEDIAN(l_quantity) AS med_qty,
       PERCENTILE_CONT(0.25) WITHIN GROUP (ORDER BY l_quantity) AS q25_qty,
       PERCENTILE_DISC(0.9) WITHIN GROUP (ORDER BY l_discount) AS p90_disc,
       MODE(l_linestatus) AS mode_status
FROM lineitem GROUP BY l_returnflag
""", """
SELECT l_returnflag,
       MEDIAN(l_quantity) AS med_qty,
       QUANTILE_CONT(l_quantity, 0.25) AS q25_qty,
       QUANTILE_DISC(l_discount, 0.9) AS p90_disc,
       MODE(l_linestatus) AS mode_status
FROM lineitem GROUP BY l_returnflag
""")

_q("sql_approx", """
SELECT l_returnflag,
       approx_count_distinct(l_partkey, 0.02) AS approx_parts,
       percentile_approx(l_extendedprice, array(0.5, 0.9), 10000) AS approx_price_q,
       hll_sketch_estimate(hll_sketch_agg(l_suppkey)) AS hll_suppliers,
       kll_sketch_get_quantile_double(kll_sketch_agg_double(l_extendedprice), 0.5) AS kll_median_price
FROM lineitem GROUP BY l_returnflag
""", None)

_q("sql_moments", """
SELECT o_orderstatus,
       ROUND(STDDEV_SAMP(o_totalprice), 4) AS sd,
       ROUND(VAR_POP(o_totalprice), 2) AS var_pop,
       ROUND(CORR(o_totalprice, o_custkey), 6) AS corr_pc,
       ROUND(COVAR_SAMP(o_totalprice, o_custkey), 2) AS covar,
       ROUND(SKEWNESS(o_totalprice), 6) AS skew,
       ROUND(KURTOSIS(o_totalprice), 6) AS kurt
FROM orders GROUP BY o_orderstatus
""", """
SELECT o_orderstatus,
       ROUND(STDDEV_SAMP(o_totalprice), 4) AS sd,
       ROUND(VAR_POP(o_totalprice), 2) AS var_pop,
       ROUND(CORR(o_totalprice, o_custkey), 6) AS corr_pc,
       ROUND(COVAR_SAMP(o_totalprice, o_custkey), 2) AS covar,
       ROUND(AVG(POWER(o_totalprice - m, 3)) / POWER(VAR_POP(o_totalprice), 1.5), 6) AS skew,
       ROUND(AVG(POWER(o_totalprice - m, 4)) / POWER(VAR_POP(o_totalprice), 2) - 3, 6) AS kurt
FROM (SELECT *, AVG(o_totalprice) OVER (PARTITION BY o_orderstatus) AS m FROM orders)
GROUP BY o_orderstatus
""")

_q("sql_set_ops", """
SELECT 'union' AS op, COUNT(*) AS n FROM (
  SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0)
UNION ALL
SELECT 'intersect', COUNT(*) FROM (
  SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal < 0)
UNION ALL
SELECT 'except', COUNT(*) FROM (
  SELECT c_custkey FROM customer WHERE c_acctbal < 0 EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL
SELECT 'union_all', COUNT(*) FROM (
  SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT c_custkey FROM customer WHERE c_acctbal < 0)
UNION ALL
SELECT 'intersect_all', COUNT(*) FROM (
  SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT ALL SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
UNION ALL
SELECT 'except_all', COUNT(*) FROM (
  SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")

# Hierarchy region <- nation <- customer.  Spark stops a recursive CTE at a million rows, so the
# recursion climbs the levels that don't grow with the data and customers come by one equi-join.
_q("sql_recursive", """
WITH RECURSIVE walk AS (
  SELECT CAST(r_regionkey AS BIGINT) AS node, CAST(r_regionkey AS BIGINT) AS root, 0 AS depth FROM region
  UNION ALL
  SELECT CAST(n.n_nationkey + 1000 AS BIGINT), w.root, w.depth + 1
  FROM walk w JOIN nation n ON CAST(n.n_regionkey AS BIGINT) = w.node WHERE w.depth = 0
)
SELECT root, depth, COUNT(*) AS n_nodes FROM walk GROUP BY root, depth
UNION ALL
SELECT w.root, w.depth + 1, COUNT(*) FROM walk w JOIN customer c ON CAST(c.c_nationkey + 1000 AS BIGINT) = w.node
WHERE w.depth = 1 GROUP BY w.root, w.depth
""", """
WITH RECURSIVE edges AS (
  SELECT CAST(n_nationkey + 1000 AS BIGINT) AS child, CAST(n_regionkey AS BIGINT) AS parent FROM nation
  UNION ALL
  SELECT c_custkey + 100000, CAST(c_nationkey + 1000 AS BIGINT) FROM customer
), walk AS (
  SELECT CAST(r_regionkey AS BIGINT) AS node, CAST(r_regionkey AS BIGINT) AS root, 0 AS depth FROM region
  UNION ALL
  SELECT e.child, w.root, w.depth + 1 FROM walk w JOIN edges e ON e.parent = w.node
)
SELECT root, depth, COUNT(*) AS n_nodes FROM walk GROUP BY root, depth
""")

_q("sql_subqueries", """
SELECT c.c_custkey,
       (SELECT COUNT(*) FROM orders o WHERE o.o_custkey = c.c_custkey) AS n_orders,
       c.c_acctbal > (SELECT AVG(c_acctbal) FROM customer) AS above_avg,
       l.max_price
FROM customer c,
     LATERAL (SELECT MAX(o2.o_totalprice) AS max_price FROM orders o2 WHERE o2.o_custkey = c.c_custkey) l
""")

_q("sql_topk", """
SELECT o_custkey, o_orderkey, o_totalprice, rn FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS rn
  FROM orders) WHERE rn <= 3
""")

_q("sql_pivot", """
SELECT * FROM (SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem)
PIVOT (SUM(l_quantity) AS qty FOR l_linestatus IN ('F' AS f, 'O' AS o))
""", """
SELECT l_returnflag,
       SUM(l_quantity) FILTER (WHERE l_linestatus = 'F') AS f,
       SUM(l_quantity) FILTER (WHERE l_linestatus = 'O') AS o
FROM lineitem GROUP BY l_returnflag
""")

_q("sql_unpivot", """
SELECT * FROM (SELECT s_suppkey, CAST(s_nationkey AS DOUBLE) AS nationkey, s_acctbal FROM supplier)
UNPIVOT (val FOR attr IN (nationkey, s_acctbal))
""", """
SELECT s_suppkey, 'nationkey' AS attr, CAST(s_nationkey AS DOUBLE) AS val FROM supplier
UNION ALL SELECT s_suppkey, 's_acctbal', s_acctbal FROM supplier
""")

_q("sql_sample", """
SELECT * FROM lineitem TABLESAMPLE (1 PERCENT) REPEATABLE (42)
""", None)

_q("sql_strings", """
SELECT r_name,
       listagg(n_name, ',') WITHIN GROUP (ORDER BY n_name) AS nations,
       upper(trim(r_name)) AS up,
       lpad(CAST(r_regionkey AS STRING), 4, '0') AS padded,
       split_part(min(n_name), ' ', 1) AS first_word,
       replace(r_name, 'A', 'a') AS replaced,
       concat(r_name, '-', CAST(COUNT(*) AS STRING)) AS label
FROM region JOIN nation ON r_regionkey = n_regionkey
GROUP BY r_name, r_regionkey
""", """
SELECT r_name,
       string_agg(n_name, ',' ORDER BY n_name) AS nations,
       upper(trim(r_name)) AS up,
       lpad(CAST(r_regionkey AS VARCHAR), 4, '0') AS padded,
       split_part(min(n_name), ' ', 1) AS first_word,
       replace(r_name, 'A', 'a') AS replaced,
       concat(r_name, '-', CAST(COUNT(*) AS VARCHAR)) AS label
FROM region JOIN nation ON r_regionkey = n_regionkey
GROUP BY r_name, r_regionkey
""")

_q("sql_dates", """
SELECT CAST(date_trunc('MONTH', o_orderdate) AS TIMESTAMP_NTZ) AS month,
       CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS yr,
       date_format(MIN(o_orderdate), 'yyyy-MM-dd') AS first_day,
       MAX(o_orderdate) + INTERVAL 30 DAY AS due,
       CAST(datediff(MAX(o_orderdate), MIN(o_orderdate)) AS BIGINT) AS span_days,
       to_timestamp_ntz(date_format(MIN(o_orderdate), 'yyyy-MM-dd HH:mm:ss'), 'yyyy-MM-dd HH:mm:ss') AS parsed_first,
       COUNT(*) AS n
FROM orders GROUP BY date_trunc('MONTH', o_orderdate), EXTRACT(YEAR FROM o_orderdate)
""", """
SELECT date_trunc('month', o_orderdate) AS month,
       CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS yr,
       strftime(MIN(o_orderdate), '%Y-%m-%d') AS first_day,
       MAX(o_orderdate) + INTERVAL 30 DAY AS due,
       CAST(date_diff('day', MIN(o_orderdate), MAX(o_orderdate)) AS BIGINT) AS span_days,
       strptime(strftime(MIN(o_orderdate), '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed_first,
       COUNT(*) AS n
FROM orders GROUP BY date_trunc('month', o_orderdate), EXTRACT(YEAR FROM o_orderdate)
""")

_q("sql_math", """
SELECT p_partkey,
       ROUND(p_retailprice, 1) AS r1,
       p_size % 7 AS m7,
       p_size DIV 3 AS d3,
       ROUND(LN(p_retailprice), 6) AS ln_price,
       ROUND(LOG10(p_retailprice), 6) AS log_price,
       CAST(FLOOR(p_retailprice) AS BIGINT) AS fl,
       CAST(CEIL(p_retailprice) AS BIGINT) AS ce,
       ROUND(POWER(p_size, 2), 1) AS sq,
       ROUND(SQRT(p_retailprice), 6) AS rt,
       ABS(p_size - 25) AS dist,
       CAST(SIGN(p_size - 25) AS INT) AS sgn
FROM part
""", """
SELECT p_partkey,
       ROUND(p_retailprice, 1) AS r1,
       p_size % 7 AS m7,
       CAST(p_size // 3 AS BIGINT) AS d3,
       ROUND(LN(p_retailprice), 6) AS ln_price,
       ROUND(LOG10(p_retailprice), 6) AS log_price,
       CAST(FLOOR(p_retailprice) AS BIGINT) AS fl,
       CAST(CEIL(p_retailprice) AS BIGINT) AS ce,
       ROUND(POWER(p_size, 2), 1) AS sq,
       ROUND(SQRT(p_retailprice), 6) AS rt,
       ABS(p_size - 25) AS dist,
       CAST(SIGN(p_size - 25) AS INT) AS sgn
FROM part
""")

_q("sql_arrays", """
SELECT vec_id, label,
       size(embedding) AS dim,
       ROUND(aggregate(transform(embedding, x -> CAST(x AS DOUBLE) * x), CAST(0 AS DOUBLE), (acc, x) -> acc + x), 4) AS sq_norm,
       size(filter(embedding, x -> x > 0)) AS n_pos,
       ROUND(CAST(array_max(embedding) AS DOUBLE), 5) AS mx,
       transform(slice(embedding, 1, 3), x -> ROUND(CAST(x AS DOUBLE), 5)) AS head3,
       ROUND(CAST(element_at(embedding, 1) AS DOUBLE), 5) AS first_elem
FROM embeddings
""", """
SELECT vec_id, label,
       CAST(len(embedding) AS INTEGER) AS dim,
       ROUND(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 4) AS sq_norm,
       CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS n_pos,
       ROUND(CAST(list_max(embedding) AS DOUBLE), 5) AS mx,
       list_transform(embedding[1:3], lambda x: ROUND(CAST(x AS DOUBLE), 5)) AS head3,
       ROUND(CAST(embedding[1] AS DOUBLE), 5) AS first_elem
FROM embeddings
""")

_q("sql_unnest", """
SELECT label, pos, ROUND(AVG(CAST(x AS DOUBLE)), 6) AS mean_x
FROM embeddings LATERAL VIEW POSEXPLODE(embedding) e AS pos, x
GROUP BY label, pos
""", """
SELECT label, CAST(pos - 1 AS INTEGER) AS pos, ROUND(AVG(CAST(x AS DOUBLE)), 6) AS mean_x
FROM (SELECT label, UNNEST(embedding) AS x, UNNEST(generate_series(1, len(embedding))) AS pos FROM embeddings)
GROUP BY label, pos
""")

_q("sql_maps_structs", """
SELECT s.k AS nation, s.v.region AS region, s.v.n AS n_customers, m['segments'] AS n_segments
FROM (
  SELECT named_struct('k', n_name, 'v', named_struct('region', r_name, 'n', COUNT(*))) AS s,
         map('segments', COUNT(DISTINCT c_mktsegment)) AS m
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY n_name, r_name)
""", """
SELECT s.k AS nation, s.v.region AS region, s.v.n AS n_customers, m['segments'] AS n_segments
FROM (
  SELECT {'k': n_name, 'v': {'region': r_name, 'n': COUNT(*)}} AS s,
         MAP {'segments': COUNT(DISTINCT c_mktsegment)} AS m
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY n_name, r_name)
""")

_q("sql_json", """
SELECT event_type, CAST(get_json_object(props, '$.k') AS INT) AS k, COUNT(*) AS n,
       MAX(variant_get(parse_json(props), '$.k', 'int')) AS k_variant,
       MAX(from_json(props, 'k INT').k) AS k_struct
FROM events GROUP BY event_type, CAST(get_json_object(props, '$.k') AS INT)
""", """
SELECT event_type, CAST(json_extract_string(props, '$.k') AS INT) AS k, COUNT(*) AS n,
       MAX(CAST(json_extract(props, '$.k') AS INTEGER)) AS k_variant,
       MAX(CAST(json_extract(props, '$.k') AS INTEGER)) AS k_struct
FROM events GROUP BY event_type, CAST(json_extract_string(props, '$.k') AS INT)
""")

_q("sql_cast", """
SELECT o_orderkey,
       CAST(o_totalprice AS DECIMAL(12, 2)) AS price_dec,
       CAST(o_orderkey AS STRING) AS key_text,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INT) AS prio,
       TRY_CAST(o_orderstatus AS INT) AS bad_cast,
       CAST(o_orderdate AS DATE) AS order_day
FROM orders
""", """
SELECT o_orderkey,
       CAST(o_totalprice AS DECIMAL(12, 2)) AS price_dec,
       CAST(o_orderkey AS VARCHAR) AS key_text,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INT) AS prio,
       TRY_CAST(o_orderstatus AS INT) AS bad_cast,
       CAST(o_orderdate AS DATE) AS order_day
FROM orders
""")


def reject_dialect_traps(text: str) -> None:
    """Refuse SQL that Spark would run with a different meaning.

    ``FROM a ASOF JOIN b`` parses in Spark as an inner join with alias
    ``asof`` — silently wrong.  Use ``joins.asof_join`` instead.
    """
    import re

    if re.search(r"(?i)\basof\s+(left\s+)?join\b", text):
        raise ValueError("ASOF JOIN is not Spark SQL (it parses as an alias); use sightline.operators.joins.asof_join")


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    reject_dialect_traps(text)
    return spark.sql(text)


def _theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C17: other events of the same user in the 10 minutes up to each event.

    A RANGE count on ordered pieces: no pairs of events are formed, O(events)
    for a dense user.  A comparison with NULL matches nothing.
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return theta_count(ev)


def theta_count(ev: DataFrame) -> DataFrame:
    from sightline.operators import windows as WN

    c = WN.range_count_by(ev, ["user_id"], "ts", "event_id", "10 MINUTES", out="n_in_range")
    known = F.col("user_id").isNotNull() & F.col("ts").isNotNull()
    return c.select("event_id", F.when(known, F.col("n_in_range") - 1).otherwise(0).cast("bigint").alias("n_recent"))


def _asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    purchases = ev.where(F.col("event_type") == "purchase").select("user_id", "ts", "event_id", "value")
    out = joins.asof_join(
        ev.select("event_id", "user_id", "ts"), purchases, ["user_id"], "ts", "ts", ["event_id", "value"], strict=True,
    )
    return out.select("event_id", "asof_event_id", "asof_value", "asof_ts")


def _not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = read_table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
    return joins.not_in(cust, "c_custkey", orders, "o_custkey")


def window_rank(orders: DataFrame) -> DataFrame:
    """C12 on ordered pieces: no window is keyed by the customer alone."""
    from sightline.operators import windows as WN

    x = WN.rank_family(orders, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], tiles=3)
    x = WN.value_ranks(x, ["o_custkey"], "o_orderstatus")
    return x.select("o_custkey", "o_orderkey", "rn", "rnk", "drnk", "tile",
                    F.round("prank", 6).alias("prank"), F.round("cdist", 6).alias("cdist"))


def window_analytic(ev: DataFrame) -> DataFrame:
    """Shifts on ordered pieces, first/last/nth values from aggregates."""
    from sightline.operators import windows as WN

    keys, order = ["user_id"], ["ts", "event_id"]
    x = WN.ordered_pieces(ev, keys, order)
    x = WN.with_windows(x, keys, order, shifts={"prev_value": ("value", 1), "next2_value": ("value", -2)}, sums={"__rn": F.lit(1)})
    ends = x.groupBy(*keys).agg(F.min_by("event_type", F.struct(*order)).alias("first_type"), F.max_by("event_type", F.struct(*order)).alias("last_type"),
                                F.max(F.when(F.col("__rn") == 2, F.struct("value"))).alias("second"))
    x = WN.join_keys(x, ends, keys)
    return x.select("event_id", "user_id", "prev_value", "next2_value", "first_type", "last_type", F.col("second.value").alias("second_value"))


def window_frames(ev: DataFrame) -> DataFrame:
    """C14 as a skew-safe plan.

    Running sum and the 3-row moving average come from ordered pieces; the
    1-day RANGE count is the running count of events at two query points per
    event — at ``ts`` (after equal times) and just before ``ts - 1 day`` —
    so no per-user window and no pairs of events are formed.
    """
    from sightline.operators import windows as WN

    keys, order = ["user_id"], ["ts", "event_id"]
    x = WN.ordered_pieces(ev, keys, order)
    x = WN.with_windows(x, keys, order, shifts={"__l1": ("value", 1), "__l2": ("value", 2)}, sums={"running_value": "value"})
    vals = [F.col("value"), F.col("__l1"), F.col("__l2")]
    total = sum((F.coalesce(v, F.lit(0.0)) for v in vals), F.lit(0.0))
    cnt = sum((v.isNotNull().cast("int") for v in vals), F.lit(0))
    x = x.select("event_id", F.round("running_value", 4).alias("running_value"),
                 F.round(F.when(cnt > 0, total / cnt), 4).alias("moving_avg3"))
    counts = WN.range_count_by(ev, keys, "ts", "event_id", "1 DAY", out="n_last_day").select(
        F.col("event_id").alias("qid"), "n_last_day")
    return x.join(counts, x.event_id == counts.qid).drop("qid")


def _window_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_rank(read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus"))


def _window_analytic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_analytic(read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value"))


def _window_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_frames(read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value"))


def _alias_t1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sightline.sources.tables import bind_tables, table_path

    bind_tables(spark, [table_path(sf_dir, "nation")])
    return run_sql(spark, SQL["sql_alias_t1"][0])


_DATAFRAME_PLANS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sql_theta_join": _theta,
    "sql_asof": _asof,
    "sql_not_in": _not_in,
    "sql_alias_t1": _alias_t1,
    "sql_window_rank": _window_rank,
    "sql_window_analytic": _window_analytic,
    "sql_window_frames": _window_frames,
}


def named_tables(text: str) -> list[str]:
    import re

    words = set(re.findall(r"\w+", text))
    return [t for t in TABLES if t in words]


def sql_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    if name in _DATAFRAME_PLANS:
        return _DATAFRAME_PLANS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bind_views(spark, sf_dir, named_tables(SQL[name][0]))
        return run_sql(spark, SQL[name][0])

    return run


def sql_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: sql_query(name) for name in SQL}


def sql_oracles() -> dict[str, str]:
    return {name: duck for name, (_, duck) in SQL.items() if duck}
