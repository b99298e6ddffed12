"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlark.llm.scratch import dropped, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return linked.unionAll(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for each node of ``edges(u long, v long)``; component is its smallest node.

    Each step is a partial aggregate and a join on a node, so that the edges of a hub never meet
    in one task, and ends in a table in the shared folder. Loops, nulls, repeated and reversed
    edges are harmless; no edges give no rows. Stops when a round changes nothing (two numbers
    reach the driver for each round).
    """
    clean = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stored(clean.distinct(), "edges")
    before = _state(now)
    while before[0]:
        large = stored(_large_star(now).distinct(), "edges")
        after = stored(_small_star(large).distinct(), "edges")
        state = _state(after)
        dropped(now, large)
        now = after
        if state == before:
            break
        before = state
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(roots)
