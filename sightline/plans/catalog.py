"""Registry of named queries over the driver tables, with DuckDB twins.

Each entry: ``name -> (fn(spark, sf_dir) -> DataFrame, duckdb_sql | None)``.
A ``None`` twin means the result is not SQL-expressible or not
deterministic (approximate sketches, sampling, HTML parsing); the driver
then checks rows only and pytest covers the semantics on fixtures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.operators import profile as P
from sightline.plans import sql_catalog
from sightline.session import configure
from sightline.sources.tables import file_inventory, per_file_map, read_table, table_path

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = (fn, oracle)
        return fn

    return deco


# ------------------------------------------------------------------ columns


@register("quote_identifier", "SELECT lang, doc_id, n_chars FROM documents")
def _quoted(spark, d):
    """B2: columns whose names hold dots, spaces and backticks, by the projection that quotes them."""
    odd = read_table(spark, d, "documents").select("doc_id", "lang", "n_chars").toDF("a.b", "c`d", "e f")
    return P.project_columns(odd, ["c`d", "a.b", "e f"]).toDF("lang", "doc_id", "n_chars")


_ORDER_COLUMNS = "o_orderkey, O_CUSTKEY, o_nothing"


@register("validate_columns", "SELECT count(*) AS n, 'Column(s) not found: O_CUSTKEY, o_nothing. Available: ' || (SELECT string_agg(column_name, ', ') FROM (DESCRIBE orders)) AS error FROM orders")
def _validated(spark, d):
    """What a projection of names in another case and of unknown ones is told, beside the table's rows."""
    orders = read_table(spark, d, "orders")
    try:
        P.project_columns(orders, _ORDER_COLUMNS)
        told = None
    except P.ColumnNotFound as e:
        told = str(e)
    return orders.agg(F.count("*").alias("n")).withColumn("error", F.lit(told))


# ---------------------------------------------------------------- A: sources


@register("scan_parquet", "SELECT * FROM orders")
def _scan(spark, d):
    return read_table(spark, d, "orders")


@register("file_inventory")
def _inventory(spark, d):
    return file_inventory(spark, f"{d.rstrip('/')}/*.parquet").select("file_pos", "file_name", "stem", "length")


_PER_FILE = ["customer", "lineitem", "nation", "orders", "part", "region", "supplier"]


@register(
    "per_file_map",
    " UNION ALL ".join(
        f"SELECT {i} AS file_pos, '{t}.parquet' AS file_name, COUNT(*) AS rows FROM {t}"
        for i, t in enumerate(sorted(_PER_FILE), 1)
    ),
)
def _per_file(spark, d):
    return per_file_map(spark, [table_path(d, t) for t in _PER_FILE], P.row_count)


@register(
    "bind_tables",
    """SELECT t2.n_name, t1.r_name FROM nation t2 JOIN region t1 ON t2.n_regionkey = t1.r_regionkey""",
)
def _bind(spark, d):
    """A3: files bound as ``t`` (= first), ``t1``, ``t2`` and queried together."""
    from sightline.plans.sql_catalog import run_sql
    from sightline.sources.tables import bind_tables

    bind_tables(spark, [table_path(d, "region"), table_path(d, "nation")])
    return run_sql(spark, "SELECT t2.n_name, t1.r_name FROM t2 JOIN t1 ON t2.n_regionkey = t1.r_regionkey")


@register("page_source", "SELECT page_id, url, CAST(length(html) AS INTEGER) AS html_chars FROM pages")
def _page_source(spark, d):
    """A5: pages with invalid UTF-8 replaced (U+FFFD); character counts per page."""
    from sightline.sources.tables import page_source_table

    p = page_source_table(read_table(spark, d, "pages"))
    return p.select("page_id", "url", F.length("html").alias("html_chars"))


@register(
    "write_result",
    "SELECT l_returnflag, l_linestatus, COUNT(*) AS len FROM lineitem GROUP BY l_returnflag, l_linestatus",
)
def _write_result(spark, d):
    """A result written as parquet and CSV into the shared checkpoint folder and read back."""
    import uuid

    from sightline.session import checkpoint_dir
    from sightline.sources.tables import write_result

    base = f"{checkpoint_dir(spark).rstrip('/')}/result-{uuid.uuid4().hex}"
    res = P.groupby_count(read_table(spark, d, "lineitem"), "l_returnflag,l_linestatus")
    write_result(res, f"{base}/parquet", "parquet")
    write_result(res, f"{base}/csv", "csv")
    back_csv = spark.read.option("header", "true").schema("l_returnflag string, l_linestatus string, len bigint").csv(
        f"{base}/csv")
    back = spark.read.parquet(f"{base}/parquet")
    # both copies must hold the same rows; the CSV copy is returned
    return back_csv.join(back.select("l_returnflag", "l_linestatus"), ["l_returnflag", "l_linestatus"], "left_semi")


@register(
    "per_file_rows",
    " UNION ALL ".join(f"SELECT '{t}.parquet' AS file_name, COUNT(*) AS rows FROM {t}"
                       for t in ("orders", "lineitem")),
)
def _per_file_rows(spark, d):
    """A4 single-scan form: row counts of several files from one distributed read."""
    from sightline.sources.tables import per_file_aggregate

    return per_file_aggregate(spark, [table_path(d, "orders"), table_path(d, "lineitem")])


# ---------------------------------------------------------------- B: profiling


@register("project_columns", "SELECT o_orderstatus, o_totalprice FROM orders")
def _project(spark, d):
    return P.project_columns(read_table(spark, d, "orders"), " o_orderstatus , o_totalprice")


@register(
    "preview",
    """SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS INTEGER) AS preview_pos, o_orderkey, o_orderstatus, o_totalprice,
              (SELECT COUNT(*) FROM orders) AS total
       FROM orders ORDER BY o_orderkey LIMIT 10""",
)
def _preview(spark, d):
    return P.preview(
        read_table(spark, d, "orders"), n=10, cols="o_orderkey,o_orderstatus,o_totalprice",
        order_by=["o_orderkey"], with_total=True,
    )


@register("preview_file_order", """SELECT CAST(row_number() OVER () AS INTEGER) AS preview_pos, * FROM (SELECT c_custkey, c_name, c_nationkey FROM customer LIMIT 25)""")
def _preview_file_order(spark, d):
    """B4 in its default form: the first rows as the file has them."""
    return P.preview(read_table(spark, d, "customer"), n=25, cols="c_custkey,c_name,c_nationkey")


@register(
    "schema",
    """SELECT CAST(ordinal_position AS INTEGER) AS pos, column_name, data_type, (SELECT COUNT(*) FROM orders) AS rows
       FROM information_schema.columns WHERE table_name = 'orders'""",
)
def _schema(spark, d):
    return P.schema(read_table(spark, d, "orders")).drop("spark_type")


@register(
    "preview_types",
    """SELECT CAST(ordinal_position AS INTEGER) AS src_pos, column_name, data_type
       FROM information_schema.columns WHERE table_name = 'lineitem'
         AND column_name IN ('l_shipdate', 'l_quantity', 'l_returnflag')""",
)
def _preview_types(spark, d):
    li = read_table(spark, d, "lineitem")
    pos = {c: i for i, c in enumerate(li.columns, 1)}
    sel = P.schema(li, "l_shipdate, l_quantity, l_returnflag", with_rows=False)
    mapping = F.create_map(*[x for c, i in pos.items() for x in (F.lit(c), F.lit(i))])
    return sel.select(mapping[F.col("column_name")].alias("src_pos"), "column_name", "data_type")


@register("row_count", "SELECT COUNT(*) AS rows FROM lineitem")
def _row_count(spark, d):
    return P.row_count(read_table(spark, d, "lineitem"))


_CMP = ["documents", "labels", "benchmark", "conversations"]


@register(
    "schema_compare",
    f"""SELECT column_name, CAST(MIN(ordinal_position) AS INTEGER) AS first_pos,
               COUNT(DISTINCT table_name) AS n_files, COUNT(DISTINCT data_type) AS n_types,
               (COUNT(DISTINCT data_type) = 1 AND COUNT(DISTINCT table_name) = {len(_CMP)}) AS consistent
        FROM information_schema.columns WHERE table_name IN ({", ".join(f"'{t}'" for t in _CMP)})
        GROUP BY column_name""",
)
def _schema_compare(spark, d):
    long = per_file_map(spark, [table_path(d, t) for t in _CMP], lambda df: P.schema(df, with_rows=False))
    return P.schema_compare(long).drop("types")


def _numeric_twin(table: str, cols: list[tuple[int, str, str]]) -> str:
    parts = []
    for pos, c, typ in cols:
        parts.append(
            f"SELECT '{c}' AS column_name, {pos} AS pos, '{typ}' AS data_type, "
            f"ROUND(MIN({c})::DOUBLE, 6) AS min_value, ROUND(MAX({c})::DOUBLE, 6) AS max_value, "
            f"ROUND(AVG({c})::DOUBLE, 6) AS avg_value, "
            f"ROUND((COUNT(*) - COUNT({c})) * 100.0 / COUNT(*), 1) AS null_pct, COUNT({c}) AS non_null, "
            + (f"CAST(MIN({c}) AS VARCHAR) AS min_exact, CAST(MAX({c}) AS VARCHAR) AS max_exact" if typ != "DOUBLE" else
               "CAST(NULL AS VARCHAR) AS min_exact, CAST(NULL AS VARCHAR) AS max_exact") + f" FROM {table}"
        )
    return " UNION ALL ".join(parts)


_LI_NUM = [(1, "l_orderkey", "BIGINT"), (2, "l_partkey", "BIGINT"), (3, "l_suppkey", "BIGINT"),
           (4, "l_linenumber", "INTEGER"), (5, "l_quantity", "DOUBLE"), (6, "l_extendedprice", "DOUBLE"),
           (7, "l_discount", "DOUBLE"), (8, "l_tax", "DOUBLE")]


@register("profile_numeric", _numeric_twin("lineitem", _LI_NUM))
def _profile_numeric(spark, d):
    return P.profile_numeric(read_table(spark, d, "lineitem"))


@register("profile_quantiles")
def _profile_quantiles(spark, d):
    return P.profile_numeric(read_table(spark, d, "events"), quantiles="approx")


@register(
    "profile_categorical",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {pos} AS pos, '{t}' AS data_type, COUNT(DISTINCT {c}) AS unique_count, "
        f"ROUND((COUNT(*) - COUNT({c})) * 100.0 / COUNT(*), 1) AS null_pct FROM orders"
        for pos, c, t in [(3, "o_orderstatus", "VARCHAR"), (5, "o_orderdate", "TIMESTAMP"),
                          (6, "o_orderpriority", "VARCHAR")]
    ),
)
def _profile_categorical(spark, d):
    return P.profile_categorical(read_table(spark, d, "orders"), exact=True)


@register("describe")
def _describe(spark, d):
    return P.describe(read_table(spark, d, "orders"))


_SHOWN = "regexp_replace(CAST(CAST(round_even({x}, 1) AS DECIMAL(38, 1)) AS VARCHAR), '\\.0$', '')"


@register(
    "describe_limits",
    " UNION ALL ".join(
        f"SELECT {pos} AS pos, '{c}' AS column_name, "
        + (f"CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max, " if whole else f"{_SHOWN.format(x=f'min({c})')} AS min, {_SHOWN.format(x=f'max({c})')} AS max, ")
        + f"{_SHOWN.format(x=f'avg({c})')} AS avg, count(*) AS rows FROM lineitem"
        for pos, c, whole in [(1, "l_orderkey", True), (2, "l_partkey", True), (3, "l_suppkey", True), (4, "l_linenumber", True),
                              (5, "l_quantity", False), (6, "l_extendedprice", False), (7, "l_discount", False), (8, "l_tax", False)]),
)
def _describe_limits(spark, d):
    """The exact part of ``describe``: limits, mean and rows of the numeric columns, as shown."""
    return P.describe(read_table(spark, d, "lineitem")).where("kind = 'numeric'").select("pos", "column_name", "min", "max", "avg", "rows")


@register(
    "profile_quantile_bounds",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n, true AS q25_ok, true AS q50_ok, true AS q75_ok FROM lineitem"
                       for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
)
def _quantile_bounds(spark, d):
    """The approximate quartiles against the ranks they may have: rows below at most p + 0.1 %, rows up to them at least p - 0.1 %."""
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    li = read_table(spark, d, "lineitem").select(*names)
    found = P.profile_numeric(li, quantiles="approx").select("column_name", "q25", "q50", "q75")
    long = li.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column_name"), F.round(c, 6).alias("v")) for c in names))))
    x = long.join(F.broadcast(found), "column_name")  # one row a column
    ok = lambda q, p: ((F.avg((F.col("v") < F.col(q)).cast("double")) <= p + 0.001) & (F.avg((F.col("v") <= F.col(q)).cast("double")) >= p - 0.001)).alias(f"{q}_ok")
    return x.groupBy("column_name").agg(F.count("*").alias("n"), ok("q25", 0.25), ok("q50", 0.5), ok("q75", 0.75))


@register("approx_distinct_bounds", "SELECT l_returnflag, count(DISTINCT l_partkey) AS exact, true AS within FROM lineitem GROUP BY l_returnflag")
def _approx_bounds(spark, d):
    """The approximate distinct count of the SQL catalogue within four standard errors of the exact one."""
    li = read_table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("exact"), F.approx_count_distinct("l_partkey", 0.02).alias("a"))
    return li.select("l_returnflag", "exact", (F.abs(F.col("a") - F.col("exact")) <= 0.08 * F.col("exact")).alias("within"))


@register("sql_approx_bounds", "SELECT l_returnflag, count(*) AS n, true AS median_ok, true AS high_ok, true AS kll_ok, true AS hll_ok FROM lineitem GROUP BY l_returnflag")
def _sql_approx_bounds(spark, d):
    """Every sketch of the SQL catalogue's approximate query against exact ranks (1 %) and counts (four standard errors)."""
    read_table(spark, d, "lineitem").createOrReplaceTempView("lineitem")
    found = spark.sql(sql_catalog.SQL["sql_approx"][0])  # a row a flag
    x = read_table(spark, d, "lineitem").select("l_returnflag", F.col("l_extendedprice").alias("v"), "l_suppkey").join(found, "l_returnflag")
    ok = lambda q, p, name: ((F.avg((F.col("v") < q).cast("double")) <= p + 0.01) & (F.avg((F.col("v") <= q).cast("double")) >= p - 0.01)).alias(name)
    hll = F.abs(F.max("hll_suppliers") - F.count_distinct("l_suppkey")) <= 0.08 * F.count_distinct("l_suppkey")
    return x.groupBy("l_returnflag").agg(F.count("*").alias("n"), ok(F.col("approx_price_q")[0], 0.5, "median_ok"), ok(F.col("approx_price_q")[1], 0.9, "high_ok"),
                                         ok(F.col("kll_median_price"), 0.5, "kll_ok"), hll.alias("hll_ok"))


@register("sample_bounds", "SELECT count(*) AS total, true AS subset, true AS size_ok, true AS again FROM lineitem")
def _sample_bounds(spark, d):
    """The sample of the SQL catalogue: rows of the table, about one in a hundred, the same ones again."""
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    read_table(spark, d, "lineitem").createOrReplaceTempView("lineitem")
    one, two = (spark.sql(sql_catalog.SQL["sql_sample"][0]).select("l_orderkey", "l_linenumber") for _ in range(2))
    total = li.agg(F.count("*").alias("total"))
    n = one.agg(F.count("*")).scalar()
    strange = one.exceptAll(li).agg(F.count("*")).scalar()
    other = one.exceptAll(two).agg(F.count("*")).scalar()
    return total.select("total", (strange == 0).alias("subset"), (F.abs(n - F.col("total") * 0.01) <= 5 * F.sqrt(F.col("total") * 0.01)).alias("size_ok"), (other == 0).alias("again"))


@register("describe_report")
def _describe_report(spark, d):
    """B10–B13 as the text report (header + one line per column) for lineitem."""
    return P.describe_lines(read_table(spark, d, "lineitem"), "lineitem")


@register(
    "null_pct",
    """SELECT source, ROUND(AVG(CASE WHEN q.doc_id IS NULL THEN 1.0 ELSE 0.0 END) * 100, 1) AS unlabelled_pct
       FROM documents dd LEFT JOIN labels q ON dd.doc_id = q.doc_id GROUP BY source""",
)
def _null_pct(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "source")
    lab = read_table(spark, d, "labels").select(F.col("doc_id").alias("l_doc"))
    j = docs.join(lab, docs.doc_id == lab.l_doc, "left")
    return j.groupBy("source").agg(P.null_pct(F.col("l_doc")).alias("unlabelled_pct"))


@register(
    "format_number",
    """SELECT o_orderpriority,
              CASE WHEN ROUND_EVEN(AVG(o_totalprice), 1) = FLOOR(ROUND_EVEN(AVG(o_totalprice), 1))
                   THEN CAST(CAST(ROUND_EVEN(AVG(o_totalprice), 1) AS DECIMAL(38,0)) AS VARCHAR)
                   ELSE CAST(CAST(ROUND_EVEN(AVG(o_totalprice), 1) AS DECIMAL(38,1)) AS VARCHAR) END AS avg_text
       FROM orders GROUP BY o_orderpriority""",
)
def _format_number(spark, d):
    o = read_table(spark, d, "orders")
    return o.groupBy("o_orderpriority").agg(P.format_number(F.avg("o_totalprice")).alias("avg_text"))


@register(
    "unique_values",
    """SELECT 1 AS col_pos, 'o_orderstatus' AS column_name, CAST(o_orderstatus AS VARCHAR) AS value
         FROM orders WHERE o_orderstatus IS NOT NULL
       UNION
       SELECT 2, 'o_orderpriority', o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL
       UNION
       SELECT 3, 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders WHERE o_custkey IS NOT NULL""",
)
def _unique(spark, d):
    return P.unique_values(read_table(spark, d, "orders"), "o_orderstatus,o_orderpriority,o_custkey")


@register(
    "groupby_count",
    "SELECT l_returnflag, l_linestatus, COUNT(*) AS len FROM lineitem GROUP BY l_returnflag, l_linestatus",
)
def _groupby(spark, d):
    return P.groupby_count(read_table(spark, d, "lineitem"), "l_returnflag,l_linestatus")


@register("groupby_count_brand", "SELECT p_brand, COUNT(*) AS len FROM part GROUP BY p_brand")
def _groupby_brand(spark, d):
    return P.groupby_count(read_table(spark, d, "part"), "p_brand")


# ---------------------------------------------------------------- C: SQL catalogue

for _name, _fn in sql_catalog.sql_queries().items():
    REGISTRY[_name] = (_fn, sql_catalog.sql_oracles().get(_name))


def _configured(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def all_queries() -> dict[str, Query]:
    _load_extensions()
    return {k: _configured(v[0]) for k, v in REGISTRY.items()}


def all_oracles() -> dict[str, str]:
    _load_extensions()
    return {k: v[1] for k, v in REGISTRY.items() if v[1]}


def _load_extensions() -> None:
    """Import the modules that register further queries (pages, docs, charts, …)."""
    import importlib

    for mod in ("sightline.plans.doc_queries", "sightline.plans.chart_queries", "sightline.plans.page_queries", "sightline.plans.dom_queries",
                "sightline.plans.record_queries"):
        try:
            importlib.import_module(mod)
        except ModuleNotFoundError as e:
            if e.name != mod:
                raise
