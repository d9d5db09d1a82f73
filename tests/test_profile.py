from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sightline.operators import profile as P

# Ten rows that can be rebuilt from the reference's golden output (FIXTURES.md §1).
ROWS = [
    ("Grand Slam", "G2000", r, ro, p)
    for r, ro, p in [("F", 2, 2000), ("SF", 4, 800), ("QF", 8, 400), ("R16", 16, 200), ("R32", 32, 100),
                     ("R64", 64, 50), ("R128", 128, 10), ("Q3", 160, 30), ("Q2", 192, 16), ("Q1", 256, 8)]
]
SCHEMA = "tourney_category string, tourney_level string, round string, round_of int, points int"


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(ROWS, SCHEMA).coalesce(1)


def test_project_keeps_order_and_trims(points):
    assert P.project_columns(points, " points , round").columns == ["points", "round"]


def test_validate_is_case_sensitive(points):
    with pytest.raises(P.ColumnNotFound, match="Column\\(s\\) not found: Points. Available: tourney_category"):
        P.project_columns(points, "Points")


def test_quote_identifier():
    assert P.quote_identifier("a`b") == "`a``b`"


def test_groupby_count_keeps_null_group(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "k string")
    rows = [tuple(r) for r in P.groupby_count(df, "k").collect()]
    assert rows == [("a", 2), (None, 1)]


def test_unique_values_sorted_and_drops_null(spark):
    df = spark.createDataFrame([(10, "b"), (2, None), (10, "a")], "n int, s string")
    got = [(r.column_name, r.value) for r in P.unique_values(df, "n,s").collect()]
    assert got == [("n", "2"), ("n", "10"), ("s", "a"), ("s", "b")]


def test_unique_subset_of_groupby(points):
    u = {r.value for r in P.unique_values(points, "round").collect()}
    g = {r["round"] for r in P.groupby_count(points, "round").collect()}
    assert u <= g


def test_preview_total_only_when_truncated(points):
    p = P.preview(points, n=2, with_total=True).collect()
    assert [r["round"] for r in p] == ["F", "SF"] and p[0].total == 10
    full = P.preview(points, n=20, with_total=True).collect()
    assert len(full) == 10 and full[0].total is None


def test_preview_file_order(spark, sf_small):
    import pyarrow.parquet as pq

    path = f"{sf_small}/orders.parquet"
    first = pq.read_table(path).slice(0, 3).column("o_orderkey").to_pylist()
    got = [r.o_orderkey for r in P.preview(spark.read.parquet(path), n=3, cols="o_orderkey").collect()]
    assert got == first


def test_schema_types_and_rows(points):
    s = {r.column_name: (r.data_type, r.rows) for r in P.schema(points).collect()}
    assert s["round_of"] == ("INTEGER", 10) and s["round"][0] == "VARCHAR"


def test_profile_numeric_exact(points):
    r = {x.column_name: x for x in P.profile_numeric(points).collect()}
    assert r["points"].min_value == 8 and r["points"].max_value == 2000 and r["points"].null_pct == 0
    assert r["round_of"].avg_value == pytest.approx(86.2)


def test_describe_classifies_by_type(spark):
    df = spark.createDataFrame([(None, "x"), (None, None)], "n int, s string")
    d = {r.column_name: r for r in P.describe(df).collect()}
    assert d["n"].kind == "numeric" and d["n"].null_pct == "100"
    assert d["s"].kind == "other" and d["s"].null_pct == "50"


def test_format_number(spark):
    df = spark.createDataFrame([(126.6,), (31.0,), (0.25,), (None,)], "x double")
    assert [r.f for r in df.select(P.format_number(F.col("x")).alias("f")).collect()] == ["126.6", "31", "0.2", None]


def test_profile_empty_table(spark):
    df = spark.createDataFrame([], "n int, s string")
    assert P.profile_numeric(df).first().null_pct is None


def test_wide_table_is_chunked(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK_COLUMNS", 3)
    cols = ", ".join(f"c{i} int" for i in range(7)) + ", s string"
    df = spark.createDataFrame([tuple(range(7)) + ("x",), tuple(range(1, 8)) + (None,)], cols)
    d = P.describe(df).collect()
    assert [r.column_name for r in sorted(d, key=lambda r: r.pos)] == [f"c{i}" for i in range(7)] + ["s"]
    assert all(r.n_cols == 8 for r in d)
    num = {r.column_name: r.max_value for r in P.profile_numeric(df).collect()}
    assert num["c6"] == 7.0 and len(num) == 7


def test_inventory_and_per_file(spark, sf_small):
    from sightline.sources.tables import file_inventory, per_file_aggregate

    inv = file_inventory(spark, f"{sf_small}/*.parquet").collect()
    assert [r.file_pos for r in inv] == list(range(1, len(inv) + 1)) and len(inv) == 14
    assert [r.file_name for r in inv] == sorted(r.file_name for r in inv)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        file_inventory(spark, f"{sf_small}/nothing-*.parquet").collect()
    rows = {r.file_name: r.rows for r in per_file_aggregate(spark, [f"{sf_small}/region.parquet",
                                                                    f"{sf_small}/nation.parquet"]).collect()}
    assert rows == {"region.parquet": 5, "nation.parquet": 25}


def test_preview_all_rows_is_a_plain_sort(points):
    df = P.preview(points, all_rows=True, with_total=True)
    assert df.count() == 10 and "preview_pos" not in df.columns
    assert all(r.total is None for r in df.collect())


def test_describe_lines(points):
    lines = [r.line for r in P.describe_lines(points, "tourney_points").collect()]
    assert lines[0] == "tourney_points{5 cols, 10 rows}:"
    assert lines[4] == "  round_of(INTEGER): min=2 max=256 avg=86.2 q25=8 q50=32 q75=160 null=0%"
    assert lines[1].startswith("  tourney_category(VARCHAR): unique=1 null=0%")


def test_checkpoint_dir_fallback_without_setting():
    """With spark.checkpoint.dir unset a per-application temp folder is used (the
    setting itself cannot be changed at runtime)."""
    from sightline import session as S

    class Conf:
        def get(self, k, d=None):
            return d

    class SC:
        applicationId = "app-test"
        _dir = None

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return self._dir

        def setCheckpointDir(self, p):
            self._dir = p

    class Spark:
        sparkContext = SC()
        conf = Conf()

    sp = Spark()
    first = S.checkpoint_dir(sp)
    assert S.checkpoint_dir(sp) == first and sp.sparkContext._dir == first


def test_limits_of_large_numbers(spark):
    big = [(9007199254740993, 1e39, float("nan")), (9007199254740995, -1e39, 1.0), (-9223372036854775808, 2.55, float("inf"))]
    df = spark.createDataFrame(big, "n long, x double, y double")
    got = {r.column_name: r for r in P.profile_numeric(df).collect()}
    assert (got["n"].min_exact, got["n"].max_exact) == ("-9223372036854775808", "9007199254740995") and got["x"].max_exact is None
    shown = {r.column_name: r for r in P.describe(df).collect()}
    assert (shown["n"].min, shown["n"].max) == ("-9223372036854775808", "9007199254740995")
    assert (shown["x"].min, shown["x"].max, shown["y"].max) == ("-1.0E39", "1.0E39", "NaN")
    texts = [r.value for r in P.unique_values(df, "n").collect()]
    assert texts == ["-9223372036854775808", "9007199254740993", "9007199254740995"]
