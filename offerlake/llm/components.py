"""Connected components of an edge table, by alternating neighbourhood contraction.

Each round links every node to the smallest node it knows (large star) and then re-links
the smaller neighbours among themselves (small star); chains halve, so rounds grow with
the logarithm of the longest chain.  Every round is a written table in the shared folder;
only whether all edges lead from a leaf to a root reaches the driver, so no round is run
just to see that nothing changes.  A hub's edges are aggregated with map-side
minima and joined under AQE's skew handling, never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.llm.common import stored


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most and none of those has one itself:
    then the edges are the components.  One aggregation with map-side partial sums."""
    ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .union(edges.select("v", F.lit(0), F.lit(1))))
    roles = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not roles.where("up > 1 OR (up = 1 AND down = 1)").limit(1).count()


def components(edges: DataFrame, spark: SparkSession) -> DataFrame:
    """``edges(a, b)`` -> ``(node, comp)`` for every node that has an edge to another one;
    ``comp`` is the smallest node of the component."""
    cur = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .distinct(), spark, "edges")
    while not _settled(cur):
        # Large star: every larger neighbour of u moves to the smallest node of u's hood.
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # Small star: u and its smaller neighbours move to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(low, "u")
        small = (near.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        cur = stored(small, spark, "edges")
    leaves = cur.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return stored(leaves.union(roots), spark, "components")


def joined(comps: DataFrame, edges: DataFrame, spark: SparkSession) -> DataFrame:
    """``comps`` (from :func:`components`) after further ``edges(a, b)``.  Only the components
    that the new edges touch are worked on, each as one node; all others keep their rows."""
    def named(side: str) -> DataFrame:
        return comps.select(F.col("node").alias(side), F.col("comp").alias(side + "c"))

    between = (edges.join(named("a"), "a", "left").join(named("b"), "b", "left")
               .select(F.coalesce("ac", "a").alias("a"), F.coalesce("bc", "b").alias("b")))
    moved = components(between, spark)
    old = (comps.join(moved.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left")
           .select("node", F.coalesce("to", "comp").alias("comp")))
    new = moved.join(comps.select("node"), "node", "left_anti")
    return stored(old.unionByName(new), spark, "components")
