"""Connected components as Spark jobs: minimum labels with pointer jumping, each round cut by a checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import cut, join_hot


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in edges (a, b): component is the smallest id reachable.

    Alternating large-star and small-star steps: every node points its neighbours at its smallest neighbour, so the
    edge list never grows beyond its first size and ends as one star per component. Rounds go on until nothing changes;
    their number is logarithmic.
    Minima are aggregated before shuffling; a node with very many neighbours is joined with them by broadcast.
    Ids are non-null; a self-loop is a component of its own; an empty table gives none.
    """
    def directed(e: DataFrame) -> DataFrame:
        return e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    loops = edges.where("a = b").select("a").distinct()
    now = cut(directed(edges))
    number, before = now.count(), None
    while True:
        # large star: all larger neighbours of a node, and it, go to the smallest of its neighbours and itself
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).select("a", F.least("a", "m").alias("m"), "n")
        large = join_hot(both, least, "a", "n", 2 * number).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # small star: all smaller neighbours of a node, and it, go to the smallest of them
        small = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        now = join_hot(large, small, "a", "n", number).select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        now = cut(now.where("a <> b").distinct())
        # done when every node has one parent and no parent has one: then the same edges come out again
        sign = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(sign) == before:
            break
        before = tuple(sign)
    stars = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    alone = loops.select(F.col("a").alias("id"), F.col("a").alias("component")).join(stars.select("id").union(roots.select("id")).distinct(), "id", "left_anti")
    return stars.union(roots).union(alone)
