"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievegate.llm.shared import drop, stored


def _are_stars(edges: DataFrame) -> bool:
    """Does every node have one smaller neighbour that has none itself, or none?"""
    sides = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    sides = sides.union(edges.select("b", F.lit(0), F.lit(1)))
    each = sides.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return each.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def roots(edges: DataFrame) -> DataFrame:
    """Stored ``node`` and ``root``, the smallest node it reaches, for every node of ``edges`` (a, b).

    Alternates two steps until only stars are left: every node ties its larger neighbours, then its
    smaller ones, to the smallest node it sees. The number of rounds grows with the logarithm of a
    component's width; a hub with very many edges only takes part in joins and minima.
    """
    first = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stored(first.filter("a <> b").distinct(), "edges")
    while not _are_stars(current):
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.toDF("a", "b"))
        smaller = stored(small.filter("a <> b").distinct(), "edges")
        drop(current)
        current = smaller
    children = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    tops = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    found = stored(children.union(tops), "roots")
    drop(current)
    return found
