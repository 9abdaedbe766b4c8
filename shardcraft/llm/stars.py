"""Connected components by alternating large-star and small-star steps.

Edges are kept as (u, v) with u > v.  A large-star step links every larger
neighbour of a node to the smallest node it knows, a small-star step every smaller one; the
steps alternate until every larger end has one edge and is no smaller end, when every
component is a star about its smallest node.

The smallest neighbour is a map-side combined aggregate.  It is written before
the edges meet it, so that both sides of the join are dealt anew and the edges of a
node that very many others know can be split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def _edges(pairs: DataFrame) -> DataFrame:
    """Distinct edges, larger end first."""
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()


def large_star(edges: DataFrame) -> DataFrame:
    ends = edges.select("v", F.col("v").alias("m")).unionAll(edges.select(F.col("u").alias("v"), F.col("v").alias("m")))
    least = written(ends.groupBy("v").agg(F.min("m").alias("m")), "stars-least")
    out = written(_edges(edges.join(least, "v").select("u", F.col("m").alias("v"))), "stars-large")
    discard(least)
    return out


def small_star(edges: DataFrame) -> DataFrame:
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "stars-least")
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
    out = written(_edges(moved.unionAll(least.select("u", F.col("m").alias("v")))), "stars-small")
    discard(least)
    return out


def _are_stars(edges: DataFrame) -> bool:
    ends = edges.select("u", F.lit(1).alias("larger"), F.lit(0).alias("smaller")).unionAll(
        edges.select("v", F.lit(0), F.lit(1)))
    sides = ends.groupBy("u").agg(F.sum("larger").alias("larger"), F.max("smaller").alias("smaller"))
    return sides.where("larger > 1 or larger = 1 and smaller = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of links (a, b): the smallest node reachable, for every linked node."""
    edges = written(_edges(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "stars")
    step = large_star
    while not _are_stars(edges):
        after = step(edges)
        discard(edges)
        edges, step = after, small_star if step is large_star else large_star
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
