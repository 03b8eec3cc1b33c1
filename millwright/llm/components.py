"""Connected components of a distributed edge list (union-find by alternating stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node reachable.

    Large-star and small-star steps in turn, until every node hangs off one
    root.  Each step groups by node with a map-side minimum and joins it back,
    so that a node with very many neighbours is an ordinary skewed join (which
    adaptive execution splits), not one task's list.  The number of rounds is
    logarithmic in the longest path.  Self-links and null ends are ignored.
    """
    e = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    e = cut_lineage(e.where("u is not null and v is not null and u <> v").distinct())
    while not _is_star_forest(e):
        both = e.select(F.col("u").alias("a"), F.col("v").alias("b")).union(e.select("v", "u"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        star = both.where("b > a").join(low, "a").select(F.col("b").alias("u"), F.col("m").alias("v"))
        star = star.distinct()
        low = star.groupBy("u").agg(F.min("v").alias("m"))
        hung = star.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut_lineage(hung.union(low.select("u", F.col("m").alias("v"))).distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select("v", "v").distinct())


def _is_star_forest(e: DataFrame) -> bool:
    """Whether each node is either a root or has exactly one parent that is a root."""
    roles = e.select(F.col("u").alias("n"), F.lit(1).alias("child"), F.lit(0).alias("root")).union(
        e.select("v", F.lit(0), F.lit(1)))
    bad = roles.groupBy("n").agg(F.sum("child").alias("c"), F.max("root").alias("r")).where("c > 1 or (c = 1 and r = 1)")
    return bad.isEmpty()
