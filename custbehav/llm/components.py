"""Connected components of a link table by alternating star operations.

A large star joins every larger neighbour of a node to the smallest node next to it; a small star does the
same for the smaller neighbours. Repeated in turn they end with one star per component, its smallest node in
the middle, after a number of rounds that grows with the square of the logarithm of the size. Each
round is two aggregations with map-side minima and two equi-joins, whose hot nodes adaptive execution
splits; every round is checkpointed, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from custbehav.llm.common import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.filter("v > u").join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come as (larger, smaller)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    moved = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame):
    mark = F.xxhash64("u", "v")
    return edges.agg(
        F.count(F.lit(1)), F.sum((F.abs(mark % 1_000_003)).cast("long")), F.sum((F.abs(mark % 998_244_353)).cast("long"))
    ).first()


def components(links: DataFrame, first: str, second: str) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every node with a link to another.

    Links may repeat and come in either direction; loops and links with a null are ignored. No links
    give no rows.
    """
    a, b = F.col(first), F.col(second)
    edges = checkpointed(
        links.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    state = _state(edges)
    while state[0]:
        edges = checkpointed(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if tuple(before) == tuple(state):
            break
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
