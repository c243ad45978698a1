"""Connected components on DataFrames."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempoframe.llm.workspace import join_counted, staged


def _two_way(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id of every node that has an edge.

    ``edges`` has long columns ``u`` and ``v``, in any direction, with repeats and loops allowed; null ends are
    ignored. Returns ``node``, ``component`` (one row per node; no row for an empty table). Alternates the large-star and small-star
    rewrites: each keeps the number of edges, and what a node of very many edges needs is broadcast instead of joined in one task.
    Every round is written to the shared folder.
    """
    stars = staged(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    for _ in range(max_rounds):
        both, n = _two_way(stars), 2 * stars.count()
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("copies"))
        large = join_counted(both.where("v > u"), low, ["u"], total=n).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("copies"))
        hooked = join_counted(large, least, ["u"], total=n).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        after = staged(hooked.where("u <> v").distinct(), "edges")
        # A forest of stars: no node is both a leaf and a centre, and no leaf has two centres.
        leaves = after.groupBy("u").agg(F.count("*").alias("n"))
        twice = leaves.where("n > 1").select("u")
        inner = after.select(F.col("v").alias("u")).distinct().join(leaves.select("u"), "u", "left_semi")
        stars = after
        if twice.unionAll(inner).isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def local_components(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes joined by the edges (a, b), within a task."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label
