"""Ranking windows that do not put a hot key into one task.

``Window.partitionBy(key)`` sends every row of a key to one task; when one
key holds a third of the table that task does a third of the work.  Here:

* ``row_number_by`` range-partitions on ``(key, order)`` — a hot key's rows
  spread over several range partitions — numbers rows inside each
  ``(partition, key)`` piece, and adds the number of the key's rows in
  earlier pieces (one summary row per piece, so that window is tiny).
* ``value_ranks`` gives ``rank``/``dense_rank`` over a low-cardinality
  order column from per-(key, value) counts — an aggregation, not a sort
  of the key's rows.
* ``rank_family`` derives ``ntile``, ``percent_rank`` and ``cume_dist``
  from the row number and the key's row count (a partial aggregation).

Joins back to the row level are null-safe equi-joins on the key (a window
puts NULL keys into one group, so these plans do too); AQE's skew-join
splitting handles the hot key there.  The plans are the same at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sightline.session import cut_lineage


def _names(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL; ``left``'s key columns stay."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys]
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def row_number_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str = "rn",
                  parts: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order)`` without a per-key task.

    ``order`` must be a total order within a key (as for any meaningful
    row number).  Partition ids are only stable inside one plan, so the
    range-partitioned rows are written once with their piece id (a parquet
    table in the shared checkpoint folder, ``session.cut_lineage``);
    numbering and offsets both read that copy, and a lost executor re-reads
    it instead of re-deriving different pieces.
    """
    keys = list(keys)
    order_cols = _names(order)
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    x = cut_lineage(df.repartitionByRange(parts, *[F.col(k) for k in keys], *order_cols).withColumn(
        "__pid", F.spark_partition_id()))
    local = x.withColumn("__lrn", F.row_number().over(Window.partitionBy("__pid", *keys).orderBy(*order_cols)))
    pieces = x.groupBy("__pid", *keys).agg(F.count(F.lit(1)).alias("__c"))
    before = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.withColumn("__off", F.coalesce(F.sum("__c").over(before), F.lit(0))).drop("__c")
    return join_keys(local, offsets, ["__pid", *keys]).withColumn(out, (F.col("__lrn") + F.col("__off")).cast("bigint")).drop(
        "__pid", "__lrn", "__off")


def value_ranks(df: DataFrame, keys: Sequence[str], value: str, descending: bool = False,
                rank_col: str = "rnk", dense_col: str = "drnk") -> DataFrame:
    """``rank``/``dense_rank`` over ``value`` per key, from per-(key, value) counts."""
    keys = list(keys)
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__c"))
    v = F.col(value).desc() if descending else F.col(value).asc()
    w = Window.partitionBy(*keys).orderBy(v)
    ranks = counts.select(
        *keys, value,
        (F.coalesce(F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1)
        .cast("bigint").alias(rank_col),
        F.row_number().over(w).cast("bigint").alias(dense_col),
    )
    return join_keys(df, ranks, [*keys, value], "left")


def key_counts(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def ntile_from(rn: Column, n: Column, buckets: int) -> Column:
    """SQL ``ntile(buckets)`` from a 1-based row number and the group size."""
    size = F.floor(n / buckets)
    rem = n % buckets
    big = rem * (size + 1)  # rows held by the first ``rem`` buckets (one row larger)
    return F.when(rn <= big, F.floor((rn - 1) / (size + 1)) + 1).otherwise(
        F.floor((rn - 1 - big) / F.greatest(size, F.lit(1))) + rem + 1).cast("bigint")


def rank_family(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], tiles: int = 3,
                rn: str = "rn") -> DataFrame:
    """row_number, ntile, percent_rank and cume_dist over a total order within each key.

    With a total order, rank = row_number, so ``percent_rank = (rn-1)/(n-1)``
    and ``cume_dist = rn/n``.
    """
    x = join_keys(row_number_by(df, keys, order, rn), key_counts(df, keys, "__n"), list(keys))
    r, n = F.col(rn), F.col("__n")
    return x.select(
        "*",
        ntile_from(r, n, tiles).alias("tile"),
        F.when(n > 1, (r - 1) / (n - 1)).otherwise(F.lit(0.0)).alias("prank"),
        (r / n).alias("cdist"),
    ).drop("__n")


# ---------------------------------------------------------------------------
# Ordered pieces: one range-partitioned, written copy of the rows, on
# which running aggregates and row shifts are computed piece by piece and
# stitched together through small per-piece summaries.
# ---------------------------------------------------------------------------


def ordered_pieces(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   parts: int | None = None) -> DataFrame:
    """Rows range-partitioned on ``(keys, order)`` with their piece id ``__pid`` (written once)."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(parts, *[F.col(k) for k in keys], *_names(order)).withColumn(
        "__pid", F.spark_partition_id()))


def _piece_window(keys, order):
    return Window.partitionBy("__pid", *keys).orderBy(*_names(order))


def _before_pieces(keys, lo=Window.unboundedPreceding, hi=-1):
    return Window.partitionBy(*keys).orderBy("__pid").rowsBetween(lo, hi)


def with_windows(x: DataFrame, keys: Sequence[str], order: Sequence[str | Column], shifts: dict[str, tuple[str, int]] | None = None,
                 sums: dict[str, Column | str] | None = None) -> DataFrame:
    """Row shifts and running sums on pieces, all with one summary of the pieces and one join.

    ``shifts``: ``LAG(value, offset)`` (offset > 0) or ``LEAD(value, -offset)``;
    ``sums``: ``SUM(value) OVER (PARTITION BY keys ORDER BY order ROWS UNBOUNDED PRECEDING)``.

    Inside a piece the plain windows answer.  A running sum adds the totals of
    the key's pieces before; the first (lag) or last (lead) ``k`` rows of a piece read
    the edge values of the neighbouring ``k`` pieces — at most ``k`` values a
    piece — gathered by a window over one row per piece.
    """
    keys, shifts, sums = list(keys), shifts or {}, {n: F.col(v) if isinstance(v, str) else v for n, v in (sums or {}).items()}
    w = _piece_window(keys, order)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = {"__lrn": F.row_number().over(w), "__cnt": F.count(F.lit(1)).over(Window.partitionBy("__pid", *keys))}
    inner |= {f"__in_{n}": F.lag(v, k).over(w) if k > 0 else F.lead(v, -k).over(w) for n, (v, k) in shifts.items()}
    inner |= {f"__ls_{n}": F.sum(v).over(so_far) for n, v in sums.items()} | {f"__lc_{n}": F.count(v).over(so_far) for n, v in sums.items()}
    local = x.withColumns(inner)
    r, n_rows = F.col("__lrn"), F.col("__cnt")
    at_edge = lambda k: (r > n_rows - k) if k > 0 else (r <= -k)
    edges = [F.transform(F.sort_array(F.collect_list(F.when(at_edge(k), F.struct("__lrn", F.col(v).alias("v"))))), lambda s: s["v"]).alias(f"__e_{n}") for n, (v, k) in shifts.items()]
    totals = [c for n, v in sums.items() for c in (F.sum(v).alias(f"__ps_{n}"), F.count(v).alias(f"__pc_{n}"))]
    per = local.groupBy("__pid", *keys).agg(*edges, *totals)
    carry = {f"__c_{n}": F.flatten(F.collect_list(f"__e_{n}").over(_before_pieces(keys, -k, -1) if k > 0 else _before_pieces(keys, 1, -k))) for n, (_, k) in shifts.items()}
    carry |= {f"__o{m}_{n}": F.coalesce(F.sum(f"__p{m}_{n}").over(_before_pieces(keys)), F.lit(0)) for n in sums for m in "sc"}
    per = per.select("__pid", *keys, *(c.alias(n) for n, c in carry.items()))
    out = {}
    for n, (_, k) in shifts.items():
        c = F.coalesce(F.col(f"__c_{n}"), F.array())
        if k > 0:
            i = F.size(c) - k + r - 1
            out[n] = F.when(r > k, F.col(f"__in_{n}")).when(i >= 0, F.get(c, i))
        else:
            i = r - k - n_rows - 1
            out[n] = F.when(r <= n_rows + k, F.col(f"__in_{n}")).when(i < F.size(c), F.get(c, i))
    for n in sums:
        out[n] = F.when(F.col(f"__lc_{n}") + F.col(f"__oc_{n}") > 0, F.coalesce(F.col(f"__ls_{n}"), F.lit(0)) + F.col(f"__os_{n}"))
    return join_keys(local, per, ["__pid", *keys]).withColumns(out).select(*x.columns, *out)


def with_running_sum(x: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: Column | str,
                     out: str) -> DataFrame:
    """One running sum, see :func:`with_windows`."""
    return with_windows(x, keys, order, sums={out: value})


def with_shift(x: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, offset: int,
               out: str) -> DataFrame:
    """One row shift, see :func:`with_windows`."""
    return with_windows(x, keys, order, shifts={out: (value, offset)})


def first_last_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """First and last ``value`` per key in ``order`` — ``min_by``/``max_by`` aggregations."""
    okey = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*keys).agg(F.min_by(value, okey).alias("__first"), F.max_by(value, okey).alias("__last"))


def range_count_by(df: DataFrame, keys: Sequence[str], time_col: str, id_col: str, preceding: str,
                   following: str | None = None, out: str = "n") -> DataFrame:
    """Per row: how many rows of the same key have ``time_col`` in
    ``[t - preceding, t + following]`` (both ends inclusive, the row itself
    included) — ``COUNT(*) OVER (… RANGE BETWEEN preceding PRECEDING AND
    following FOLLOWING)``, or a band join counted without forming pairs.

    Two query points per row are merged into the key's time order — one just
    after the events at ``t + following``, one just before the events at
    ``t - preceding`` — and the running count of events (on ordered pieces,
    so a hot key is split) at the two points gives the count.  Work is
    O(rows), whatever the density of a key.  ``id_col`` must be unique and
    not NULL.  As in a window, NULL keys are one group, and a row without a
    time counts the rows of its key without one.
    """
    keys = list(keys)
    base = df.select(*keys, F.col(id_col).alias("__id"), F.col(time_col).alias("__t"))
    hi = F.col("__t") + F.expr(f"INTERVAL {following}") if following else F.col("__t")
    points = base.select(*keys, F.col("__t").alias("t"), F.lit(1).alias("side"), F.col("__id").alias("id"),
                         F.lit(1).alias("w"), F.lit(None).cast(base.schema["__id"].dataType).alias("qid")).unionByName(
        base.select(*keys, hi.alias("t"), F.lit(2).alias("side"), F.col("__id").alias("id"),
                    F.lit(0).alias("w"), F.col("__id").alias("qid"))).unionByName(
        base.select(*keys, (F.col("__t") - F.expr(f"INTERVAL {preceding}")).alias("t"), F.lit(0).alias("side"),
                    F.col("__id").alias("id"), F.lit(0).alias("w"), F.col("__id").alias("qid")))
    order = ["t", "side", "id"]
    q = with_running_sum(ordered_pieces(points, keys, order), keys, order, "w", "__run").where(
        F.col("qid").isNotNull())
    counts = q.groupBy("qid").agg(
        (F.sum(F.when(F.col("side") == 2, F.col("__run"))) - F.sum(F.when(F.col("side") == 0, F.col("__run"))))
        .cast("bigint").alias(out))
    return df.join(counts, df[id_col] == counts["qid"]).drop("qid")


def with_last_value(x: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str,
                    out: str) -> DataFrame:
    """``LAST(value, ignorenulls) OVER (PARTITION BY keys ORDER BY order ROWS UNBOUNDED PRECEDING)``
    on pieces: inside a piece the window answers; otherwise the latest non-null
    value of earlier pieces (one ``max_by`` row per piece, carried by a window
    over those rows)."""
    keys = list(keys)
    ocols = _names(order)
    w = _piece_window(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = x.withColumn("__lv", F.last(value, ignorenulls=True).over(w))
    okey = F.struct(*ocols)
    per = x.where(F.col(value).isNotNull()).groupBy("__pid", *keys).agg(F.max_by(value, okey).alias("__pl"))
    # pieces without any value still need the carry of earlier pieces
    pieces = x.select("__pid", *keys).distinct()
    allp = join_keys(pieces, per, ["__pid", *keys], "left").select(
        "__pid", *keys, F.last("__pl", ignorenulls=True).over(_before_pieces(keys)).alias("__carry"))
    j = join_keys(local, allp, ["__pid", *keys], "left")
    return j.withColumn(out, F.coalesce(F.col("__lv"), F.col("__carry"))).drop("__lv", "__carry")
