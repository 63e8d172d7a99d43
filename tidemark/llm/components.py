"""Connected components of a graph given as edges, by turns of large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.shared import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its least neighbour to its greater ones."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its least neighbour to its lesser ones and itself; an edge leads from the greater node."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    joined = edges.join(least, "a")
    others = joined.filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, part): for each node of an edge (a, b) the least node of its component.

    Loops and repeated edges do no harm; a graph without edges has no rows. Every turn is written to the shared
    folder. It takes about as many turns as the logarithm of the longest chain.
    """
    start = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    loops = start.filter("a = b").select("a")
    current = materialize(start.filter("a > b").distinct(), "edges")
    mark = None
    while True:
        turned = materialize(_small_star(_large_star(current)), "edges")
        seen = turned.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if seen == mark:
            break
        current, mark = turned, seen
    parts = turned.select(F.col("a").alias("node"), F.col("b").alias("part"))
    roots = parts.select(F.col("part").alias("node"), "part").distinct()
    alone = loops.select(F.col("a").alias("node"), F.col("a").alias("part")).distinct()
    known = parts.unionByName(roots)
    return materialize(known.unionByName(alone.join(known, "node", "left_anti")), "parts")
