"""Connected components by alternating large and small stars.

Neighbour lists are never gathered: a node's smallest neighbour is a grouped minimum with map-side
combine, and the edges of a frequent node are rows of a join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakloom.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """From (a, b): (node, component), the component being its smallest node. Loops are ignored, nodes
    without an edge are absent. Each round is written to the shared folder."""
    now = materialise(edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _state(now)
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("_u"), F.least("u", "m").alias("m"))
        large = materialise(both.where("v > u").join(least, F.col("u") == F.col("_u")).select(
            F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "large")
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "_a")
        small = large.join(low, F.col("a") == F.col("_a")).select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select("_a", "m")).where("a != b").distinct()
        now = materialise(small, "small")
        state = _state(now)
        if state == seen:
            break
        seen = state
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(now.select("b", "b").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
