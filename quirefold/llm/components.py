"""Connected components of a graph given as a table of edges.

Alternating large-star and small-star steps (Kiveris et al., 2014): every step moves edges towards
the smallest node of a neighbourhood, until each node hangs on its component's smallest. A
neighbourhood is only ever reduced to its minimum, by an aggregate, and joined back to its edges;
both sides of that join are read from tables, so that Spark splits a hub. Nothing is collected but
two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("u").alias("a"), F.col("v").alias("b")).unionAll(
        edges.select(F.col("v").alias("a"), F.col("u").alias("b"))
    )
    least = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "large-star")
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b"))
    least = stored(down.groupBy("a").agg(F.min("b").alias("m")), "small-star")
    moved = down.join(least, "a").select(F.col("b").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select(F.col("a").alias("u"), F.col("m").alias("v"))).filter("u > v")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node that has an edge to another.

    Edges with a null end and loops say nothing and are left out; repeated edges count once. No
    edges: an empty table.
    """
    known = edges.filter(f"{a} <> {b}")
    current = stored(known.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before = _state(current)
    while before[0]:
        wide = stored(_large_star(current).distinct(), "large")
        current = stored(_small_star(wide).distinct(), "small")
        now = _state(current)
        if now == before:
            break
        before = now
    member = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return member.unionAll(roots)
