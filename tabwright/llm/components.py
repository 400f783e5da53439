"""Connected components of a graph whose edges are a table.

Alternating star contraction: a large star ties every greater neighbour of a node to the least
node of its neighbourhood, a small star does so for the lesser ones. The edges shrink to stars
around the least node of each component in a number of rounds logarithmic in the size. Every
round is written to the shared folder; the driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.session import release, settle


def connected(edges: DataFrame, *, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node with an edge but for the roots themselves.

    ``edges``: a stored table of a, b (long). Loops and repeated edges are ignored. Raises after
    ``max_rounds`` rounds without an end.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    stored: DataFrame | None = None
    state = None
    for _ in range(max_rounds):
        fresh = settle(_small_star(_large_star(now)))
        if stored is not None:
            release(stored)
        stored = now = fresh
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first()
        if seen == state:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        state = seen
    raise RuntimeError(f"no end after {max_rounds} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where(
        "hi <> lo").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()
