"""Join strategies Spark does not pick on its own at scale.

* ``not_in``      — SQL ``NOT IN (subquery)`` without the null-aware
                    broadcast-nested-loop fallback.
* ``asof_join``   — latest earlier right row per left row, on ordered
                    pieces, so a hot key never lands in one task.
* ``interval_join`` — overlap join keyed by (key, time bucket), each pair
                    emitted once; never all pairs of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_in(left: DataFrame, left_col: str, right: DataFrame, right_col: str) -> DataFrame:
    """Rows of ``left`` whose ``left_col`` is NOT IN ``right.right_col`` (SQL three-valued logic).

    * any NULL on the right → no row qualifies;
    * empty right side → every left row qualifies (NULL keys included);
    * otherwise a ``left_anti`` equi-join on the non-null keys, NULL left
      keys dropped.

    Spark plans ``NOT IN`` as a null-aware anti join only when the subquery
    side can be broadcast; otherwise it degrades to a nested loop.  Here the
    anti join is a normal shuffle (or AQE-broadcast) join and the two NULL
    rules are one-row scalar subqueries.
    """
    rk = right.select(F.col(right_col).alias("__k"))
    stats = rk.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("__k").alias("nn"),
    )
    both = stats.select(F.struct("n", "nn").alias("s")).scalar()  # one scalar subquery, one pass
    n_right = both["n"]
    has_null = both["n"] > both["nn"]
    keys = rk.where(F.col("__k").isNotNull())
    anti = left.join(keys, left[left_col] == keys["__k"], "left_anti")
    return anti.where(~has_null & (F.col(left_col).isNotNull() | (n_right == 0)))


def _bucket(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("long")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    right_cols: Sequence[str],
    strict: bool = True,
    tie: Sequence[str] | None = None,
    prefix: str = "asof_",
) -> DataFrame:
    """For each left row, the latest right row of the same ``by`` key with
    ``right_ts < left_ts`` (``<=`` when not ``strict``).  Left outer: no
    match → nulls.

    Both sides are merged in ``(by, time, side)`` order on range-partitioned
    pieces (``windows.with_last_value``): no window spans a key, so a hot key
    and even a burst of one key are split.  Of right rows at one time the one
    with the greatest ``tie`` columns (``right_cols`` unless given) counts.
    As in SQL, rows with a NULL key or time match nothing.
    """
    from sightline.operators import windows as WN

    by, tie = list(by), list(tie or right_cols)
    known = right.where(F.col(right_ts).isNotNull()).dropna(subset=by)
    payload = F.struct(F.col(right_ts).alias("__ts"), *[F.col(c) for c in right_cols])
    order_by = F.struct(*[F.col(c) for c in tie])
    ptype = right.select(payload.alias("p")).schema["p"].dataType
    otype = right.select(order_by.alias("o")).schema["o"].dataType
    row = F.struct(*[F.col(c) for c in left.columns])
    rowtype = left.select(row.alias("r")).schema["r"].dataType
    # side: right rows sort before left rows at equal time only for "<="
    r_side = 2 if strict else 0
    lu = left.select(*by, F.col(left_ts).alias("__t"), F.lit(1).alias("__side"), F.lit(None).cast(otype).alias("__tie"),
                     F.lit(None).cast(ptype).alias("__p"), row.alias("__row"))
    ru = known.select(*by, F.col(right_ts).alias("__t"), F.lit(r_side).alias("__side"), order_by.alias("__tie"),
                      payload.alias("__p"), F.lit(None).cast(rowtype).alias("__row"))
    order = ["__t", "__side", "__tie"]
    x = WN.ordered_pieces(lu.unionByName(ru), by, order)
    x = WN.with_last_value(x, by, order, "__p", "__m").where(F.col("__side") == 1)
    return x.select("__row.*", *[F.col("__m")[c].alias(f"{prefix}{c}") for c in right_cols],
                    F.col("__m")["__ts"].alias(f"{prefix}{right_ts}"))


def interval_join(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    a_start: Column,
    a_end: Column,
    b_start: Column,
    b_end: Column,
    bucket_seconds: int,
    how: str = "inner",
) -> DataFrame:
    """Pairs ``(a, b)`` with equal ``keys`` whose closed time intervals overlap.

    Both sides are exploded over the fixed-width time buckets they touch and
    joined on ``(keys, bucket)``; a pair is kept only in the first bucket the
    two intervals share, so it appears exactly once.  The work per join key
    is bounded by the events that share a bucket, not by the square of the
    key's size.  ``a``/``b`` columns must not collide (prefix them first).
    """
    keys = list(keys)

    def explode(df: DataFrame, s: Column, e: Column, tag: str) -> DataFrame:
        bs, be = _bucket(s, bucket_seconds), _bucket(e, bucket_seconds)
        return (
            df.withColumn(f"__{tag}s", s)
            .withColumn(f"__{tag}e", e)
            .withColumn(f"__{tag}b0", bs)
            .withColumn("__bk", F.explode(F.sequence(bs, be)))
        )

    ea = explode(a, a_start, a_end, "a")
    eb = explode(b.withColumnsRenamed({k: f"__r_{k}" for k in keys}), b_start, b_end, "b")
    cond = [ea[k] == eb[f"__r_{k}"] for k in keys] + [
        ea["__bk"] == eb["__bk"],
        ea["__as"] <= eb["__be"],
        eb["__bs"] <= ea["__ae"],
        ea["__bk"] == F.greatest(ea["__ab0"], eb["__bb0"]),
    ]
    joined = ea.join(eb, cond, how)
    drop = ["__as", "__ae", "__ab0", "__bs", "__be", "__bb0"] + [f"__r_{k}" for k in keys]
    return joined.drop(ea["__bk"]).drop(eb["__bk"]).drop(*drop)
