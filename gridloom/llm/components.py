"""Connected components of an edge table by alternating large-star and
small-star steps (Kiveris et al., 2014).  Every step is a partial minimum per
node and a join on it, so neither a component nor a hub lands in one task;
each round is stored, so lost executors never recompute more than one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import stored_rows


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours its least neighbour (or itself)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least_neighbour(both).withColumn("m", F.least("u", "m"))
    return (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours, and itself, the least of them."""
    least = _least_neighbour(edges)
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of a pair; component is the least
    node reachable.  ``pairs`` without rows gives no rows."""
    edges, *seen = stored_rows(pairs.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    while True:
        edges, *now = stored_rows(_small_star(_large_star(edges)), "edges")
        if now == seen:
            break
        seen = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
