"""Connected components of an edge table by alternating large-star and small-star steps.

Each step replaces the edges of a node by edges to its smallest neighbour. A step is a minimum per node, which combines
before its shuffle, and a join that adaptive execution may split, so a node with a third of all edges is no one
task's work. Rounds are written tables; nothing but two numbers a round comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.sources import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) of longs: node, component (its smallest member), for every node but the smallest ones.

    Loops and repeated edges do no harm; edges with a null are left out; no edges give no rows.
    """
    state = materialise(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    before = None
    while True:
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == before or not now[0]:
            return state.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = tuple(now)
        state = materialise(_small_star(_large_star(state)), "edges")
