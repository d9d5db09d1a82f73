"""Mixing sources to target weights by subset-sum budget fitting.

A source's target is its share of the budget by weight, stopped at ``max_epochs``
times its size; what is cut off is shared again by weight until none is above.
A target of E whole passes over a source and a rest takes each document E times,
and once more as many as fit the rest:

1. Documents are counted by source and exact length: from there on, work depends
   on the number of different lengths, not of documents.
2. For each source, the same part of every length is taken first, but for short
   documents of a few times the longest length.  Bounded-knapsack dynamic
   programming over all lengths finds the counts whose sum comes nearest to the
   rest.
3. Which documents of a length are taken follows a seeded hash of their id.
   Lengths are split by the hash's first bits, and only the one split in which
   the count ends is ordered, so equal documents of any number are no bottleneck.

Targets come from rounds of small aggregations over one row a source; sources
are numbered through a range shuffle.  Nothing but totals comes to the driver.

Defined results: null and empty texts have no words, and are taken 0 times; a
null source is a source, the last; repeated rows are documents of their own,
and of rows with equal id and text any may be the one that is taken; an empty
table gives no rows; further columns pass through :func:`mixed` unread.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm import jobs as J

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_EPOCHS = 2
SEED = 20
#: a length's documents are split by so many first bits of their hash
SPLIT_BITS = 12
#: the knapsack's capacity in units of the longest length
REACH = 2


# ----------------------------------------------------------------- targets

def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``; weights repeat over the sources by code point, null last."""
    ordered = sizes.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    ordered = J.cut_lineage(ordered.withColumns({"part": F.spark_partition_id(), "id": F.monotonically_increasing_id()}))
    parts = ordered.groupBy("part").agg(F.count("*").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row for each partition
    place = F.row_number().over(Window.partitionBy("part").orderBy("id")) - 1 + F.col("before")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights) + 1).cast("int"))
    rows = J.cut_lineage(ordered.join(parts, "part").select("source", "source_size", weight.alias("weight")))
    cap = F.col("source_size") * max_epochs
    total = float(rows.agg(F.sum("source_size")).first()[0] or 0) * budget
    per_weight, full = 0.0, -1
    while True:  # each round shares what the full sources leave; more of them are full then
        level = F.lit(per_weight) * F.col("weight")
        now = rows.agg(F.count(F.when(cap <= level, 1)).alias("full"), F.sum(F.when(cap <= level, cap)).alias("used"), F.sum(F.when(cap > level, F.col("weight"))).alias("open")).first()
        if now.full == full or not now.open:
            break
        full, per_weight = now.full, (total - (now.used or 0)) / now.open
    return rows.select("source", "source_size", F.least(cap.cast("double"), F.lit(per_weight) * F.col("weight")).alias("target"))


# ---------------------------------------------------------- counts by length

def fit(lengths: np.ndarray, counts: np.ndarray, target: int) -> np.ndarray:
    """How many documents of each length to take, so that their lengths sum up nearest to ``target``.

    ``lengths`` are different and positive.  The sum is exact wherever the
    knapsack reaches the rest.
    """
    taken = np.zeros(len(lengths), np.int64)
    total = int((lengths * counts).sum())
    if not len(lengths) or target <= 0:
        return taken
    if target >= total:
        return counts.copy()
    taken = np.array([int(c) * target // total for c in counts], np.int64)
    rest = target - int((lengths * taken).sum())
    longest_first = np.argsort(-lengths)
    for i in longest_first.tolist():  # down to what the knapsack holds
        size = int(lengths[i])
        more = min(int(counts[i] - taken[i]), max(0, rest - REACH * int(lengths.max())) // size)
        taken[i] += more
        rest -= more * size
    back = REACH * int(lengths.max())
    for i in longest_first[::-1].tolist():  # short documents fit best: the knapsack deals them anew
        less = min(int(taken[i]), -(-back // int(lengths[i])))
        taken[i] -= less
        rest += less * int(lengths[i])
        back -= less * int(lengths[i])
        if back <= 0:
            break
    # sums that the left documents reach, as bits of one number; a snapshot for each item
    items, reach = [], [1]
    limit = rest + int(lengths.max())
    window = (1 << (limit + 1)) - 1
    for i in longest_first[::-1].tolist():
        left, k = min(int(counts[i] - taken[i]), limit // int(lengths[i])), 1
        while left > 0:  # counts as powers of two and a rest
            k = min(k, left)
            items.append((i, k))
            reach.append((reach[-1] | reach[-1] << (k * int(lengths[i]))) & window)
            left -= k
            k *= 2
        if reach[-1] >> rest & 1:
            break
    bits = reach[-1]
    under = (bits & ((1 << (rest + 1)) - 1)).bit_length() - 1
    over = bits >> rest
    over = rest + ((over & -over).bit_length() - 1) if over else None
    at = over if over is not None and over - rest < rest - under else under
    for (i, k), before in zip(items[::-1], reach[-2::-1]):
        if not before >> at & 1:
            taken[i] += k
            at -= k * int(lengths[i])
    return taken


def _fitted(source: pa.Table) -> pa.Table:
    size, n = (J.column(source, c).to_numpy() for c in ("size", "n"))
    order = np.argsort(size)
    size, n = size[order], n[order]
    total, target = int((size * n).sum()), J.column(source, "target")[0].as_py()
    passes = int(target // total) if total else 0
    rest = fit(size, n, int(round(target - passes * total)))
    return pa.table({"number": pa.array(J.column(source, "number").to_numpy()[order]), "size": pa.array(size, pa.int64()),
                     "passes": pa.array(np.full(len(size), passes), pa.int64()), "rest": pa.array(rest, pa.int64())})


# --------------------------------------------------------------------- mix

def _with_passes(rows: DataFrame, plain: DataFrame, weights: tuple[float, ...], budget: float, max_epochs: int) -> DataFrame:
    """``rows`` with ``__passes`` and its source's ``__goal`` and ``__total``.

    Both frames have ``__id, __source, __size, __key`` of the same documents;
    ``plain``, read for the counts, has nothing else.
    """
    number = F.xxhash64("__source", F.col("__source").isNull())
    counted = plain.groupBy("__source", "__size").agg(F.count("*").alias("n"))
    sizes = counted.groupBy(F.col("__source").alias("source")).agg(F.sum(F.col("__size") * F.col("n")).alias("source_size"))
    goals = targets(sizes, weights, budget, max_epochs).withColumn("number", F.xxhash64("source", F.col("source").isNull()))
    goals = J.cut_lineage(goals.select("number", F.col("target").alias("__goal"), F.col("source_size").alias("__total")))
    cell = ["number", "size"]
    chosen = counted.where("__size > 0").select(number.alias("number"), F.col("__size").alias("size"), "n").join(goals.select("number", F.col("__goal").alias("target")), "number")
    chosen = chosen.groupBy("number").applyInArrow(_fitted, "number long, size long, passes long, rest long")
    split = F.shiftrightunsigned("__key", 64 - SPLIT_BITS)
    splits = plain.groupBy(number.alias("number"), F.col("__size").alias("size"), split.alias("split")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*cell).orderBy("split")) - F.col("n")  # at most 2^SPLIT_BITS rows a length
    splits = splits.withColumn("before", before).join(chosen, cell, "left").join(goals, "number")
    splits = splits.select(F.col("number").alias("__number"), F.col("size").alias("__size"), F.col("split").alias("__split"),
                           F.col("passes").alias("__whole"), (F.col("rest") - F.col("before")).alias("__open"), "__goal", "__total")
    place = ["__number", "__size", "__split"]
    rank = F.row_number().over(Window.partitionBy(*place).orderBy("__key", "__id"))
    out = rows.withColumns({"__number": number, "__split": split}).withColumn("__rank", rank).join(splits.hint("merge"), place)
    return out.withColumn("__passes", F.coalesce(F.col("__whole") + (F.col("__rank") <= F.col("__open")).cast("long"), F.lit(0).cast("long")))


def _columns(id_col: str, text_col: str, source_col: str, seed: int) -> dict:
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return {"__id": F.col(id_col), "__source": F.col(source_col).cast("string"), "__size": size,
            "__key": F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(text_col).cast("string"))}


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS,
        budget: float = BUDGET, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken, passes, source`` for each row; ``taken`` is ``size`` times ``passes``."""
    rows = J.cut_lineage(docs.select(*(c.alias(n) for n, c in _columns(id_col, text_col, source_col, seed).items())))
    out = _with_passes(rows, rows, weights, budget, max_epochs)
    return out.select(F.col("__id").alias("doc_id"), F.col("__size").alias("size"), F.col("__total").alias("source_size"), F.col("__goal").alias("target"),
                      (F.col("__size") * F.col("__passes")).alias("taken"), F.col("__passes").alias("passes"), F.col("__source").alias("source"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS,
          budget: float = BUDGET, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``docs`` as the mix takes them: each document as often as it passes, the others left out."""
    extra = _columns(id_col, text_col, source_col, seed)
    plain = J.cut_lineage(docs.select(*(c.alias(n) for n, c in extra.items())))
    out = _with_passes(docs.withColumns(extra), plain, weights, budget, max_epochs).where("__passes > 0")
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__passes").cast("int")))).select(*docs.columns)
