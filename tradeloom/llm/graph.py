"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import stage


def with_least(edges: DataFrame, least: Column) -> DataFrame:
    """Edges (u, v) with ``m``, made from the smallest neighbour of u, the written table of which may meet a hub's edges in pieces."""
    found = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", least)
    return edges.join(stage(found, "least"), "u")


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``edges`` (a, b): its component's smallest vertex.

    Alternating stars: every vertex hands the smallest of its neighbours to the larger ones, then to the smaller
    ones, until each component is a star around its smallest vertex. The number of rounds grows with the logarithm
    of the component's width. Minima are pre-aggregated before they are shuffled. The edges of a hub meet its
    minimum in a join of two written tables, which Spark splits where it is skewed; it would not split one whose minima come
    straight from the aggregate, as that has already dealt them out by the same key. Each step is written to the shared folder.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    edges = stage(edges, "edges")
    mark = None
    while True:
        found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == mark or not found[0]:
            break
        mark = tuple(found)
        # towards larger neighbours
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        star = with_least(both, F.least("u", "m")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = stage(star.filter("u <> v").distinct(), "star")
        # towards smaller ones; u is the larger end of each edge now
        near = with_least(star, F.col("m"))
        flat = near.select("u", F.col("m").alias("v")).union(near.select(F.col("v").alias("u"), F.col("m").alias("v")))
        flat = flat.filter("u <> v").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
        edges = stage(flat, "edges")
    # every edge now leads to the smallest vertex
    roots = edges.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("root"))
    return roots.union(edges.select(F.col("a").alias("v"), F.col("a").alias("root")).distinct())
