"""Connected components of a table of edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..runtime import staged


def _large(edges: DataFrame) -> DataFrame:
    """Hang all larger neighbours of a node below its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours below the smallest of them. Edges run from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    lower = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lower.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for nodes with edges ``(a, b)``; component is the smallest node reachable.

    Nodes without edges, loops and edges with a null end are left out. Each round is written to the shared folder;
    the end is reached when a round changes nothing.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    seen = None
    while True:
        edges = staged(_small(_large(edges).distinct()).distinct(), "components")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            roots = edges.select(F.col("v").alias("u")).distinct()
            return edges.unionByName(roots.select("u", F.col("u").alias("v"))).select(
                F.col("u").alias("node"), F.col("v").alias("component")
            )
        seen = now
