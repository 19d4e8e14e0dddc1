"""Connected components as rounds of joins: every vertex ends up pointing at the smallest of its component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.storage import stored


def _are_stars(edges: DataFrame) -> bool:
    """Every u points at one v, and no v points on: then each v is the smallest of its component."""
    n, starts = edges.agg(F.count("*"), F.countDistinct("u")).first()
    return n == starts and edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every vertex of the undirected edges (a, b); null ends are ignored.

    Large-star joins every larger neighbour to the smallest one, small-star does so among smaller neighbours;
    repeated until the edges form stars. Both are a grouped minimum, combined before the shuffle, and a join, so a
    vertex with very many edges is never gathered. Every round is a written table.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = stored(now.distinct(), "edges")
    while not _are_stars(now):
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.union(low).distinct(), "edges")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
