"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cveflow.llm.frames import attach
from cveflow.scratch import stored


def _linked_to_least(edges: DataFrame, total: int, upward: bool) -> DataFrame:
    """Every ``v`` of a node ``u`` linked to the least of ``u`` and its neighbours; with ``upward``, only larger ``v``."""
    least = edges.groupBy("u").agg(F.count("*").alias("n"), F.least(F.min("v"), F.first("u")).alias("m"))
    joined = attach(edges, least, ["u"], total)
    if upward:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))


def _settled(edges: DataFrame) -> bool:
    """Whether every edge leads straight to a root: each ``u`` has one edge, and no ``v`` is a ``u``."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up")).distinct())
    return ends.groupBy("x").agg(F.count("*").alias("n"), F.sum("up").alias("up")).where("n > 1 and up > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (``u, v``, never null): root is the least node it is linked to.

    Each round halves the distance to the root or so; rounds end when every node is linked to its root
    alone.  Nodes without edges are not in the result.
    """
    current = stored(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    while not _settled(current):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_linked_to_least(both, 2 * current.count(), True).where("u <> v").distinct(), "large-star")
        current = stored(_linked_to_least(large, large.count(), False).where("u <> v").distinct(), "small-star")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
