"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm import shared

# Parts in which the neighbours of one node meet its smallest one, so that a hub is not one task.
PARTS = 8


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node, component`` of every node that has an edge to another; the component is its smallest node.

    Each step links nodes to the smallest of their neighbours; the number of edges never grows, and every step
    is written to the shared folder. It ends when a step changes nothing: then each edge leads to the smallest
    node of its component.
    """
    now = shared.stored(edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
                        .where("u > v").distinct(), "edges")
    state = _state(now)
    while True:
        now = shared.stored(_small_star(_large_star(now)), "edges")
        before, state = state, _state(now)
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Each edge ``u, v`` with ``m`` of its ``u``; the edges of a node are dealt to ``PARTS`` partitions."""
    part = F.pmod(F.xxhash64("v"), F.lit(PARTS))
    everywhere = least.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    return edges.withColumn("part", part).join(everywhere, ["u", "part"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours greater than a node go to the smallest of its neighbours and itself."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _with_least(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = _with_least(edges, least).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()
