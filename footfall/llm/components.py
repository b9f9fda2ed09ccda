"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.session import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node reachable.

    Large-star and small-star steps (Kiveris et al., 2014) until nothing changes: every step takes
    the smallest neighbour of a node as a partial aggregate and hands it to the others by a join,
    so a node with very many edges is no single task. Each step is written to the shared folder.
    Loops and repeated edges do no harm; without edges the result is empty.
    """
    now = stage(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "edges"
    )
    before = None
    while True:
        now = stage(_star(_star(now, large=True), large=False), "edges")
        told = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if told == before:
            break
        before = told
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return members.union(roots).distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v) with v < u. Large: larger neighbours go to the least one; small: smaller ones."""
    if large:
        near = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = near.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()
