"""Connected components by randomised contraction; every step is a join or an aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each id of ``edges`` (a long, b long).

    In every round each vertex joins the neighbour, or itself, that a hash seeded with the
    round ranks first, and edges are drawn between the joined vertices. A chain shrinks by a
    constant factor and a star vanishes at once, so rounds grow with the logarithm of the
    longest path. Vertices without an edge are not returned; self-links and repeats are allowed.
    """
    edges = keep(edges.select("a", "b").where("a <> b").distinct(), "edges")
    both = edges.select("a").union(edges.select("b")).distinct()
    labels = both.select(F.col("a").alias("id"), F.col("a").alias("label"))
    number = 0
    while edges.head(1):
        number += 1
        ends = edges.union(edges.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(number)).alias("h"), F.col(c).alias("v"))
        best = ends.groupBy("a").agg(F.min(rank("b")).alias("best"))
        joined = keep(best.select("a", F.least("best", rank("a"))["v"].alias("to")), "joined")
        labels = labels.join(joined.withColumnRenamed("a", "label"), "label", "left")
        labels = keep(labels.select("id", F.coalesce("to", "label").alias("label")), "labels")
        a = joined.select(F.col("a"), F.col("to").alias("to_a"))
        b = joined.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
        moved = edges.join(a, "a").join(b, "b").where("to_a <> to_b")
        edges = keep(moved.select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).distinct(), "edges")
    smallest = labels.groupBy("label").agg(F.min("id").alias("component"))
    return labels.join(smallest, "label").select("id", "component")
