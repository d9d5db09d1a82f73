"""Table profiling: projection, preview, schema, statistics, distinct values, group counts.

Every function builds a plan; none runs an action.  Statistics over many
columns are computed in ONE aggregate pass (partial aggregation on every
partition, one tiny final merge), then unpivoted to one row per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
TEMPORAL_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


class ColumnNotFound(ValueError):
    """Raised by ``validate_columns``; the message lists missing and available columns."""


def split_cols(cols: str | Sequence[str]) -> list[str]:
    """Comma list → names, whitespace trimmed, order kept."""
    if isinstance(cols, str):
        return [c.strip() for c in cols.split(",")]
    return [c.strip() for c in cols]


def quote_identifier(name: str) -> str:
    """B2: backtick-quote a column name (doubling backticks), safe for dots and spaces."""
    return "`" + name.replace("`", "``") + "`"


def qcol(name: str) -> Column:
    return F.col(quote_identifier(name))


def validate_columns(df: DataFrame, cols: Sequence[str]) -> None:
    """Case-sensitive presence check, done on the schema before any plan runs."""
    available = df.columns
    bad = [c for c in cols if c not in available]
    if bad:
        raise ColumnNotFound(f"Column(s) not found: {', '.join(bad)}. Available: {', '.join(available)}")


def project_columns(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """B1: keep the listed columns in the order given."""
    names = split_cols(cols)
    validate_columns(df, names)
    return df.select(*[qcol(c) for c in names])


def duckdb_type_name(dt: T.DataType) -> str:
    """Spark type → the type name the reference prints (parity of names)."""
    simple = {
        T.LongType: "BIGINT",
        T.IntegerType: "INTEGER",
        T.ShortType: "SMALLINT",
        T.ByteType: "TINYINT",
        T.StringType: "VARCHAR",
        T.DoubleType: "DOUBLE",
        T.FloatType: "FLOAT",
        T.BooleanType: "BOOLEAN",
        T.DateType: "DATE",
        T.TimestampType: "TIMESTAMP WITH TIME ZONE",
        T.TimestampNTZType: "TIMESTAMP",
        T.BinaryType: "BLOB",
    }
    for cls, name in simple.items():
        if isinstance(dt, cls):
            return name
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    if isinstance(dt, T.ArrayType):
        return duckdb_type_name(dt.elementType) + "[]"
    if isinstance(dt, T.MapType):
        return f"MAP({duckdb_type_name(dt.keyType)}, {duckdb_type_name(dt.valueType)})"
    if isinstance(dt, T.StructType):
        inner = ", ".join(f"{f.name} {duckdb_type_name(f.dataType)}" for f in dt.fields)
        return f"STRUCT({inner})"
    return dt.simpleString().upper()


def schema(df: DataFrame, cols: str | Sequence[str] | None = None, with_rows: bool = True) -> DataFrame:
    """One row per column ``(pos, column_name, spark_type, data_type)`` (+ ``rows``).

    The column list comes from the parquet footer (driver metadata, never
    data).  The row count is a scalar subquery over the scan, which Spark
    answers from parquet footers without reading column data.
    """
    fields = df.schema.fields
    if cols is not None:
        names = split_cols(cols)
        validate_columns(df, names)
        by_name = {f.name: f for f in fields}
        fields = [by_name[n] for n in names]
    rows = [(i + 1, f.name, f.dataType.simpleString(), duckdb_type_name(f.dataType)) for i, f in enumerate(fields)]
    meta = df.sparkSession.createDataFrame(
        rows, "pos int, column_name string, spark_type string, data_type string"
    )
    if with_rows:
        meta = meta.withColumn("rows", row_count(df).scalar())
    return meta


def row_count(df: DataFrame) -> DataFrame:
    """``COUNT(*)`` as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def preview(
    df: DataFrame,
    n: int = 2,
    all_rows: bool = False,
    cols: str | Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
    with_total: bool = False,
) -> DataFrame:
    """First ``n`` rows in file order (or in ``order_by`` order).

    File order = (file path, row index inside the file) from the hidden
    ``_metadata`` column of the parquet scan.  ``orderBy(...).limit(n)``
    becomes ``TakeOrderedAndProject``: each task keeps its own top-n and
    only ``n × tasks`` rows reach the final merge — no global sort.
    ``preview_pos`` carries the order (1-based).  With ``with_total`` a
    ``total`` column holds the row count, set only when ``n < total`` and
    not ``all_rows``, as the reference reports it.
    """
    names = split_cols(cols) if cols is not None else df.columns
    validate_columns(df, names)
    if order_by:
        keys = [qcol(c).asc_nulls_last() for c in order_by]
        base = df.select(*[qcol(c) for c in dict.fromkeys([*names, *order_by])])
    else:
        try:
            base = df.select(
                *[qcol(c) for c in names],
                F.col("_metadata.file_path").alias("__file"),
                F.col("_metadata.row_index").alias("__row"),
            )
        except AnalysisException:
            # not a file scan: partition order is the table order
            base = df.select(*[qcol(c) for c in names], F.lit("").alias("__file"),
                             F.monotonically_increasing_id().alias("__row"))
        keys = [F.col("__file"), F.col("__row")]
    ordered = base.orderBy(*keys)
    if all_rows:
        # every row: a distributed range sort; no position column (numbering all
        # rows would need one task to see the whole table)
        out = ordered.select(*[qcol(c) for c in names])
    else:
        from pyspark.sql.window import Window

        # at most n rows reach this window
        out = ordered.limit(n).withColumn("preview_pos", F.row_number().over(Window.orderBy(*keys)))
        out = out.select("preview_pos", *[qcol(c) for c in names])
    if with_total:
        total = row_count(df).scalar()
        out = out.withColumn(
            "total", F.when(F.lit(not all_rows) & (F.lit(n) < total), total).cast("bigint")
        )
    return out


def _kind(dt: T.DataType) -> str:
    if isinstance(dt, NUMERIC_TYPES):
        return "numeric"
    if isinstance(dt, TEMPORAL_TYPES):
        return "temporal"
    return "other"


def null_pct(c: Column) -> Column:
    """Share of nulls in percent, one decimal (null on an empty table)."""
    return F.round(F.avg(c.isNull().cast("double")) * 100, 1)


def format_number(x: Column) -> Column:
    """Round half-even to one decimal, drop a trailing ``.0``; text for display only.

    NaN and infinities stay what they are; numbers of more than 36 digits are
    shown in floating-point notation.
    """
    d = x.cast("double")
    r = F.bround(d, 1)
    plain = F.regexp_replace(r.try_cast("decimal(38,1)").cast("string"), r"\.0$", "")
    return F.when(d.isNull(), F.lit(None)).when(F.isnan(d) | (F.abs(d) >= 1e36), d.cast("string")).otherwise(plain)


def _shown(x: Column, data_type: T.DataType) -> Column:
    """A column's own value for display: whole numbers exactly, others by ``format_number``."""
    if isinstance(data_type, T.IntegralType):
        return x.cast("string")
    if isinstance(data_type, T.DecimalType):
        return F.regexp_replace(F.bround(x, 1).cast("string"), r"\.0$", "")
    return format_number(x)


# Columns per aggregate pass: a few hundred aggregate expressions still
# compile into whole-stage code; wider tables are profiled in chunks (each
# chunk reads only its own columns from parquet) and the results stacked.
CHUNK_COLUMNS = 100


def _chunked(df: DataFrame, fields: list, fn) -> DataFrame:
    if len(fields) <= CHUNK_COLUMNS:
        return fn(fields)
    parts = [fn(fields[i:i + CHUNK_COLUMNS]) for i in range(0, len(fields), CHUNK_COLUMNS)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def profile_numeric(
    df: DataFrame,
    quantiles: str | None = None,
    accuracy: int = 10_000,
    digits: int = 6,
) -> DataFrame:
    """Per numeric column min, max, avg, null % (and quartiles), in one pass.

    ``quantiles``: ``None`` (skip), ``"approx"`` (``percentile_approx``,
    Greenwald–Khanna, bounded memory — the scalable default) or ``"exact"``
    (``percentile``; memory grows with distinct values, small tables only).
    Statistics are doubles rounded to ``digits`` decimals; ``min_exact`` and
    ``max_exact`` hold the limits of whole-number columns to the last digit, as
    text.  Columns are classified by type, so an all-null numeric column stays
    numeric.
    """
    all_fields = [(i + 1, f) for i, f in enumerate(df.schema.fields) if _kind(f.dataType) == "numeric"]
    if len(all_fields) > CHUNK_COLUMNS:
        return _chunked(df, all_fields, lambda fs: _profile_numeric_fields(df, fs, quantiles, accuracy, digits))
    return _profile_numeric_fields(df, all_fields, quantiles, accuracy, digits)


def _profile_numeric_fields(df, fields, quantiles, accuracy, digits) -> DataFrame:
    aggs: list[Column] = [F.count(F.lit(1)).alias("__n")]
    for i, f in fields:
        own = qcol(f.name)
        c = own.cast("double")
        aggs += [
            F.min(own).alias(f"mn{i}"),
            F.max(own).alias(f"mx{i}"),
            F.avg(c).alias(f"av{i}"),
            F.count(c).alias(f"nn{i}"),
        ]
        if quantiles == "approx":
            aggs.append(F.percentile_approx(c, [0.25, 0.5, 0.75], accuracy).alias(f"q{i}"))
        elif quantiles == "exact":
            aggs.append(F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}"))
    one = df.agg(*aggs)
    structs = []
    for i, f in fields:
        parts = [
            F.lit(f.name).alias("column_name"),
            F.lit(i).alias("pos"),
            F.lit(duckdb_type_name(f.dataType)).alias("data_type"),
            F.round(F.col(f"mn{i}").cast("double"), digits).alias("min_value"),
            F.round(F.col(f"mx{i}").cast("double"), digits).alias("max_value"),
            F.round(F.col(f"av{i}"), digits).alias("avg_value"),
        ]
        if quantiles:
            parts += [F.round(F.col(f"q{i}")[k], digits).alias(n) for k, n in enumerate(("q25", "q50", "q75"))]
        parts += [
            F.round(F.try_divide((F.col("__n") - F.col(f"nn{i}")) * 100.0, F.col("__n")), 1).alias("null_pct"),
            F.col(f"nn{i}").alias("non_null"),
        ]
        whole = isinstance(f.dataType, T.IntegralType)
        parts += [(F.col(f"{m}{i}") if whole else F.lit(None)).cast("string").alias(n) for m, n in (("mn", "min_exact"), ("mx", "max_exact"))]
        structs.append(F.struct(*parts))
    if not structs:
        return one.limit(0).select(F.lit(None).cast("string").alias("column_name"))
    return one.select(F.inline(F.array(*structs)))


def profile_categorical(df: DataFrame, exact: bool = False, rsd: float = 0.05) -> DataFrame:
    """Per non-numeric column distinct count and null %.

    ``exact=False`` uses HyperLogLog++ (``approx_count_distinct`` with the
    given relative standard deviation), fixed memory per column; ``exact``
    uses ``count(DISTINCT)``, which Spark runs as expand + two aggregation
    phases (a shuffle per distinct column set) — keep it for small tables.
    """
    all_fields = [(i + 1, f) for i, f in enumerate(df.schema.fields) if _kind(f.dataType) != "numeric"]
    if len(all_fields) > CHUNK_COLUMNS:
        return _chunked(df, all_fields, lambda fs: _profile_categorical_fields(df, fs, exact, rsd))
    return _profile_categorical_fields(df, all_fields, exact, rsd)


def _profile_categorical_fields(df, fields, exact, rsd) -> DataFrame:
    aggs: list[Column] = [F.count(F.lit(1)).alias("__n")]
    for i, f in fields:
        c = qcol(f.name)
        aggs.append((F.count_distinct(c) if exact else F.approx_count_distinct(c, rsd)).alias(f"u{i}"))
        aggs.append(F.count(c).alias(f"nn{i}"))
    one = df.agg(*aggs)
    structs = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(i).alias("pos"),
            F.lit(duckdb_type_name(f.dataType)).alias("data_type"),
            F.col(f"u{i}").alias("unique_count"),
            F.round(F.try_divide((F.col("__n") - F.col(f"nn{i}")) * 100.0, F.col("__n")), 1).alias("null_pct"),
        )
        for i, f in fields
    ]
    if not structs:
        return one.limit(0).select(F.lit(None).cast("string").alias("column_name"))
    return one.select(F.inline(F.array(*structs)))


def describe(df: DataFrame, accuracy: int = 10_000, rsd: float = 0.05) -> DataFrame:
    """B10–B13 display form: one row per column, the table-inspection "describe" view.

    Numeric columns: min/max/avg/q25/q50/q75 formatted by ``format_number``;
    temporal columns: min/max/quartiles as timestamps (text) and a null
    mean; other columns: approximate distinct count.  One aggregate pass.
    Also returns ``rows`` and ``n_cols`` for the header line.
    """
    all_fields = list(enumerate(df.schema.fields, 1))
    if len(all_fields) > CHUNK_COLUMNS:
        return _chunked(df, all_fields, lambda fs: _describe_fields(df, fs, accuracy, rsd, len(all_fields)))
    return _describe_fields(df, all_fields, accuracy, rsd, len(all_fields))


def _describe_fields(df, fields, accuracy, rsd, n_cols) -> DataFrame:
    aggs: list[Column] = [F.count(F.lit(1)).alias("__n")]
    for i, f in fields:
        kind = _kind(f.dataType)
        c = qcol(f.name)
        aggs.append(F.count(c).alias(f"nn{i}"))
        if kind == "numeric":
            d = c.cast("double")
            aggs += [F.min(c).alias(f"mn{i}"), F.max(c).alias(f"mx{i}"), F.avg(d).alias(f"av{i}"),
                     F.percentile_approx(d, [0.25, 0.5, 0.75], accuracy).alias(f"q{i}")]
        elif kind == "temporal":
            aggs += [F.min(c).alias(f"mn{i}"), F.max(c).alias(f"mx{i}"),
                     F.percentile_approx(c, [0.25, 0.5, 0.75], accuracy).alias(f"q{i}")]
        else:
            aggs.append(F.approx_count_distinct(c, rsd).alias(f"u{i}"))
    one = df.agg(*aggs)
    structs = []
    for i, f in fields:
        kind = _kind(f.dataType)
        if kind == "numeric":
            fmt = format_number
            vals = [_shown(F.col(f"mn{i}"), f.dataType), _shown(F.col(f"mx{i}"), f.dataType), fmt(F.col(f"av{i}"))] + [
                fmt(F.col(f"q{i}")[k]) for k in range(3)
            ]
            uniq = F.lit(None).cast("bigint")
        elif kind == "temporal":
            vals = [F.col(f"mn{i}").cast("string"), F.col(f"mx{i}").cast("string"), F.lit(None).cast("string")] + [
                F.col(f"q{i}")[k].cast("string") for k in range(3)
            ]
            uniq = F.lit(None).cast("bigint")
        else:
            vals = [F.lit(None).cast("string")] * 6
            uniq = F.col(f"u{i}")
        structs.append(
            F.struct(
                F.lit(i).alias("pos"),
                F.lit(f.name).alias("column_name"),
                F.lit(duckdb_type_name(f.dataType)).alias("data_type"),
                F.lit(kind).alias("kind"),
                *[v.alias(n) for v, n in zip(vals, ("min", "max", "avg", "q25", "q50", "q75"))],
                uniq.alias("unique"),
                format_number(F.try_divide((F.col("__n") - F.col(f"nn{i}")) * 100.0, F.col("__n"))).alias("null_pct"),
                F.col("__n").alias("rows"),
                F.lit(n_cols).alias("n_cols"),
            )
        )
    return one.select(F.inline(F.array(*structs)))


def unique_values(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Distinct non-null values per requested column, ascending, columns independent.

    One scan for all columns: each row is unpivoted into ``(column, value)``
    pairs (value as text plus a numeric sort key), de-duplicated with a
    partial (map-side) distinct before the shuffle, then range-sorted.
    """
    names = split_cols(cols)
    validate_columns(df, names)
    by_name = {f.name: f.dataType for f in df.schema.fields}
    pairs = []
    for pos, name in enumerate(names, 1):
        c = qcol(name)
        numeric = isinstance(by_name[name], NUMERIC_TYPES)
        pairs.append(
            F.struct(
                F.lit(pos).alias("col_pos"),
                F.lit(name).alias("column_name"),
                c.cast("string").alias("value"),
                (c.cast("double") if numeric else F.lit(None).cast("double")).alias("num_key"),
                (c if isinstance(by_name[name], T.IntegralType) else F.lit(None)).cast("decimal(20,0)").alias("int_key"),
                (F.lit(None).cast("string") if numeric else c.cast("string")).alias("str_key"),
            )
        )
    long = df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull()).distinct()
    return long.orderBy("col_pos", "num_key", "int_key", "str_key").select("col_pos", "column_name", "value")


def groupby_count(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """``COUNT(*) AS len`` per key combination, NULL is a group, ordered by the keys."""
    names = split_cols(cols)
    validate_columns(df, names)
    keys = [qcol(c) for c in names]
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("len"))
        .orderBy(*[k.asc_nulls_last() for k in keys])
    )


def schema_compare(per_file_schema: DataFrame) -> DataFrame:
    """Side-by-side view of a long ``(file_name, pos, column_name, data_type)`` table.

    One row per column name: first position, in how many files it occurs,
    how many distinct types it has, the (type, files) pairs — one entry per
    distinct type, never one per file — and a flag when files disagree
    (missing column or different type).
    """
    per_type = per_file_schema.groupBy("column_name", "data_type").agg(
        F.min("pos").alias("first_pos"), F.count_distinct("file_name").alias("n"))
    g = per_type.groupBy("column_name").agg(
        F.min("first_pos").alias("first_pos"),
        F.sum("n").alias("n_files"),
        F.count(F.lit(1)).alias("n_types"),
        F.sort_array(F.collect_list(F.struct("data_type", "n"))).alias("types"),
    )
    total = per_file_schema.agg(F.count_distinct("file_name").alias("f")).scalar()
    return g.withColumn("consistent", (F.col("n_types") == 1) & (F.col("n_files") == total))


def describe_lines(df: DataFrame, stem: str, accuracy: int = 10_000, rsd: float = 0.05) -> DataFrame:
    """The ``describe`` report as text lines: a header ``stem{N cols, M rows}:`` and one
    ``  name(TYPE): …`` line per column (numeric: min/max/avg/quartiles/null %;
    temporal: min/max/quartiles/null %; other: approximate unique count/null %)."""
    d = describe(df, accuracy, rsd)
    num = F.concat(
        F.lit("min="), F.col("min"), F.lit(" max="), F.col("max"),
        F.when(F.col("avg").isNotNull(), F.concat(F.lit(" avg="), F.col("avg"))).otherwise(F.lit("")),
        F.lit(" q25="), F.col("q25"), F.lit(" q50="), F.col("q50"), F.lit(" q75="), F.col("q75"),
    )
    stats = F.when(F.col("kind") == "other", F.concat(F.lit("unique="), F.col("unique").cast("string"))).otherwise(num)
    body = d.select(
        F.col("pos"),
        F.concat(F.lit("  "), F.col("column_name"), F.lit("("), F.col("data_type"), F.lit("): "), stats,
                 F.lit(" null="), F.col("null_pct"), F.lit("%")).alias("line"),
        F.concat(F.lit(f"{stem}{{"), F.col("n_cols").cast("string"), F.lit(" cols, "), F.col("rows").cast("string"),
                 F.lit(" rows}:")).alias("header"),
    )
    # header and column lines come out of the same rows: one pass over the table
    out = body.select(F.explode(F.array(
        F.when(F.col("pos") == 1, F.struct(F.lit(0).alias("pos"), F.col("header").alias("line"))),
        F.struct(F.col("pos"), F.col("line")),
    )).alias("r")).where(F.col("r").isNotNull()).select("r.pos", "r.line")
    return out.orderBy("pos")
