"""Connected components of an edge table by large-star and small-star rounds.

Every round is joins and minima over the edges, so a node with very many neighbours is never
gathered in one place: the minima are written to the shared folder before they are joined, so
Spark sends them to every task if they are small and can otherwise split a hot node's edges.
Each round's edges are written too, which cuts lineage; what a round has used is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.workspace import materialize, remove, work_path


def _star(edges: DataFrame, small: bool, folder: str) -> DataFrame:
    """Point the larger (or, if ``small``, the smaller or equal) neighbours of each node at its
    smallest neighbour."""
    if small:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialize(
        near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least",
        f"{folder}/{'small' if small else 'large'}",
    )
    out = near.join(least, "u")
    if small:
        moved = out.select(F.col("v").alias("u"), F.col("m").alias("v"))
        root = least.select("u", F.col("m").alias("v"))
        out = moved.unionByName(root)
    else:
        out = out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, root)`` for every node of the edges ``(u, v)``; the root is the smallest node.

    NULL ends and loops are left out. An edge table without rows gives no rows.
    """
    spark = edges.sparkSession
    folder = work_path(spark, label)
    ordered = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = materialize(ordered.distinct(), label, f"{folder}/0/edges")
    before, number = None, 0
    while True:
        number += 1
        here = f"{folder}/{number}"
        made = _star(_star(edges, False, here), True, here)
        edges = materialize(made, label, f"{here}/edges")
        # A star forest no longer changes: its size and the sum of its hashes stay.
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        remove(spark, f"{folder}/{number - 1}")
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
