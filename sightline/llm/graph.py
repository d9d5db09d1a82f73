"""Connected components of an edge table, by rounds of joins and minima."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm import jobs as J


def forest(edges: np.ndarray) -> np.ndarray:
    """As few edges with the same components: each node with the least of its own. ``edges``: pairs of numbers."""
    nodes, ends = np.unique(edges, return_inverse=True)
    ends, root = ends.reshape(-1, 2), np.arange(len(nodes))
    while True:
        a, b = root[ends[:, 0]], root[ends[:, 1]]
        if (a == b).all():
            break
        least = np.minimum(a, b)
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        while (root[root] != root).any():
            root = root[root]
    out = np.flatnonzero(root != np.arange(len(nodes)))
    return np.stack([nodes[out], nodes[root[out]]], 1)


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """Each node sends its larger (``both``: large star) or its smaller neighbours to the least of them and itself."""
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    seen = edges.union(turned) if both else edges  # edges run from the larger to the smaller node
    least = seen.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    linked = seen.join(least, "a")
    if both:
        return linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))


def _larger_first(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a``, ``b`` long) that has a link; ``component`` is its least node.

    Alternating large and small stars: a logarithmic number of rounds, each a
    few shuffles of as many rows as there are edges; minima combine before the
    shuffle, so a node of very many links is no bottleneck.  Every round is
    written to the shared folder.  Links of a node to itself and null nodes count for nothing.
    """
    now = J.cut_lineage(_larger_first(edges.where("a IS NOT NULL AND b IS NOT NULL")))
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
    before = mark(now)
    while before[0]:
        now = J.cut_lineage(_larger_first(_star(_larger_first(_star(now, True)), False)))
        after = mark(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
