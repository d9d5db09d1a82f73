"""Chart-ready datasets (K2–K12): flows, shares, hierarchies, transitions, overlaps.

Every operator is an aggregation (partial aggregation before the shuffle)
or a join of aggregates; global normalisers (totals, min/max) are one-row
aggregates attached as scalar subqueries, never a window over the whole
table.  Per-entity windows (K6) run on ordered pieces of an entity's rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flow_edges(df: DataFrame, source: str, target: str, value: str | None = None, digits: int = 2) -> DataFrame:
    """K2: ``(source, target, value)`` sums; value = row count when ``value`` is None."""
    v = F.count(F.lit(1)).cast("double") if value is None else F.sum(value)
    return df.groupBy(F.col(source).alias("source"), F.col(target).alias("target")).agg(
        F.round(v, digits).alias("value"))


def flow_conservation(edges: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """K3: inner nodes (with inflow and outflow) whose totals differ."""
    inflow = edges.groupBy(F.col("target").alias("node")).agg(F.sum("value").alias("inflow"))
    outflow = edges.groupBy(F.col("source").alias("node")).agg(F.sum("value").alias("outflow"))
    j = inflow.join(outflow, "node", "inner")
    return j.where(F.abs(F.col("inflow") - F.col("outflow")) > tolerance).select(
        "node", F.round("inflow", 2).alias("inflow"), F.round("outflow", 2).alias("outflow"))


def share_of_total(df: DataFrame, label: str, value: str, digits: int = 2) -> DataFrame:
    """K4: positive values only → share in percent of the total, rounded."""
    pos = df.groupBy(F.col(label).alias("label")).agg(F.sum(value).alias("value")).where(F.col("value") > 0)
    total = pos.agg(F.sum("value").alias("t")).scalar()
    return pos.select("label", F.round("value", 4).alias("value"),
                      F.round(F.col("value") * 100.0 / total, digits).alias("share_pct"))


def rejected_values(df: DataFrame, label: str, value: str) -> DataFrame:
    """K4/K5 rejects: labels whose value is ≤ 0 (not drawable in a pie or treemap)."""
    return df.groupBy(F.col(label).alias("label")).agg(F.sum(value).alias("value")).where(F.col("value") <= 0)


def hierarchy_rollup(df: DataFrame, levels: Sequence[str], value: str) -> DataFrame:
    """K5: leaf sizes summed up the hierarchy (ROLLUP), negatives rejected; ``depth`` = levels set."""
    clean = df.where(F.col(value) >= 0)
    g = clean.rollup(*levels).agg(F.round(F.sum(value), 2).alias("size"), F.grouping_id().alias("gid"))
    return g.withColumn("depth", (F.lit(len(levels)) - F.bit_count("gid")).cast("int")).drop("gid")


def state_transitions(df: DataFrame, entity: str, order: Sequence[str], state: str,
                      start: str = "[*]", end: str = "[*]") -> DataFrame:
    """K6: per entity ordered states → transition counts, with ``[*]`` at both ends.

    ``lag``/``lead`` on ordered pieces (``windows.with_windows``), so neither a
    hot entity nor a burst of one is a single window task.  Counting is a
    partial aggregation over (from, to) pairs.  Rows without an entity are
    one entity; a state may be NULL.
    """
    from sightline.operators import windows as WN

    order = list(order)
    x = WN.ordered_pieces(df.select(entity, *order, F.struct(F.col(state).alias("s")).alias("__s")), [entity], order)
    x = WN.with_windows(x, [entity], order, shifts={"prev": ("__s", 1), "next": ("__s", -1)})
    now = F.col("__s")["s"]
    came = F.when(F.col("prev").isNull(), F.lit(start)).otherwise(F.col("prev")["s"])
    pairs = x.select(F.explode(F.array(
        F.struct(came.alias("from_state"), now.alias("to_state")),
        F.when(F.col("next").isNull(), F.struct(now.alias("from_state"), F.lit(end).alias("to_state"))),
    )).alias("p")).where(F.col("p").isNotNull())
    return pairs.groupBy("p.from_state", "p.to_state").agg(F.count(F.lit(1)).alias("n"))


def quadrant_class(df: DataFrame, x: str, y: str, digits: int = 6) -> DataFrame:
    """K7: min-max scale to 0–1 and assign quadrant 1 (top right) … 4 (bottom right)."""
    mm = df.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    x0, x1, y0, y1 = (mm.select(c).scalar() for c in ("x0", "x1", "y0", "y1"))
    sx = F.when(x1 > x0, (F.col(x) - x0) / (x1 - x0)).otherwise(F.lit(0.0))
    sy = F.when(y1 > y0, (F.col(y) - y0) / (y1 - y0)).otherwise(F.lit(0.0))
    q = (F.when((F.col("sx") >= 0.5) & (F.col("sy") >= 0.5), 1).when(F.col("sy") >= 0.5, 2)
         .when(F.col("sx") < 0.5, 3).otherwise(4))
    return df.withColumn("sx", sx).withColumn("sy", sy).withColumn("quadrant", q).withColumn(
        "sx", F.round("sx", digits)).withColumn("sy", F.round("sy", digits))


def axis_scaling(df: DataFrame, cols: Sequence[str], axis_min: float | None = 0.0, axis_max: float | None = None,
                 digits: int = 6) -> DataFrame:
    """K8: axis max from the data when absent, min default 0; values scaled to 0–1 on that axis."""
    hi = F.lit(axis_max) if axis_max is not None else df.agg(F.greatest(*[F.max(c) for c in cols])).scalar()
    lo = F.lit(axis_min) if axis_min is not None else df.agg(F.least(*[F.min(c) for c in cols])).scalar()
    out = df
    for c in cols:
        out = out.withColumn(f"{c}_scaled", F.round((F.col(c) - lo) / (hi - lo), digits))
    return out


def relation_cardinality(parent: DataFrame, pk: str, child: DataFrame, fk: str) -> DataFrame:
    """K9: observed min/max children per parent, parents without children, orphan children."""
    per_parent = child.groupBy(F.col(fk).alias("__k")).agg(F.count(F.lit(1)).alias("n"))
    j = parent.select(F.col(pk).alias("__k")).join(per_parent, "__k", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    stats = j.agg(
        F.min("n").alias("min_children"), F.max("n").alias("max_children"),
        F.sum(F.when(F.col("n") == 0, 1).otherwise(0)).alias("childless_parents"),
    )
    orphans = child.join(parent.select(F.col(pk).alias("__p")), F.col(fk) == F.col("__p"), "left_anti").agg(
        F.count(F.lit(1)).alias("orphan_children"))
    return stats.withColumn("orphan_children", orphans.scalar())


def set_overlap(df: DataFrame, member: str, label: str) -> DataFrame:
    """Size of every exact label combination (members grouped by their label set).

    One ``collect_set`` per member — bounded by the number of labels, not by
    the data — then a count per combination; intersections of any order
    follow by summing combinations that contain the wanted labels.
    """
    sets = df.groupBy(member).agg(F.array_sort(F.collect_set(label)).alias("labels"))
    return sets.groupBy("labels").agg(F.count(F.lit(1)).alias("members")).withColumn("n_labels", F.size("labels"))


def pairwise_overlap(combos: DataFrame) -> DataFrame:
    """K10 pairs: members in both labels of each pair, summed from the combination counts
    (pairs per combination are bounded by the label vocabulary, not by members)."""
    pairs = combos.select(
        F.explode(F.flatten(F.transform("labels", lambda a: F.transform(
            "labels", lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("p"),
        "members",
    ).where(F.col("p.a") < F.col("p.b"))
    return pairs.groupBy(F.col("p.a").alias("label_a"), F.col("p.b").alias("label_b")).agg(
        F.sum("members").alias("members"))


def journey_scores(df: DataFrame, section: str, actors: str | Column, score: str, digits: int = 4) -> DataFrame:
    """Mean score per section and actor (actors as an array column)."""
    a = F.col(actors) if isinstance(actors, str) else actors
    return df.select(section, F.explode(a).alias("actor"), score).groupBy(section, "actor").agg(
        F.round(F.avg(score), digits).alias("mean_score"), F.count(F.lit(1)).alias("n"))


def board_counts(df: DataFrame, stage: str) -> DataFrame:
    """Items per column/stage."""
    return df.groupBy(F.col(stage).alias("stage")).agg(F.count(F.lit(1)).alias("items"))
