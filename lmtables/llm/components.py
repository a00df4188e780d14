"""Distributed connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmtables.session import stage, unstage


def _settled(edges: DataFrame) -> bool:
    """Whether all edges form stars: no node has two centres, and no centre has one itself."""
    ends = edges.select(F.col("v").alias("node"), F.lit(1).alias("below")).unionByName(
        edges.select(F.col("m").alias("node"), F.lit(0).alias("below"))
    )
    centres = ends.groupBy("node").agg(F.sum("below").alias("centres"), F.min("below").alias("least"))
    return not centres.where("centres > least").take(1)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("m").alias("v"), F.col("v").alias("m")))
    least = both.groupBy("v").agg(F.min("m").alias("low")).select("v", F.least("v", "low").alias("low"))
    return both.where("m > v").join(least, "v").select(F.col("m").alias("v"), F.col("low").alias("m")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("v").agg(F.min("m").alias("low"))
    moved = edges.join(least, "v").where("m <> low").select(F.col("m").alias("v"), F.col("low").alias("m"))
    return moved.unionByName(least.withColumnRenamed("low", "m")).distinct()


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Every node of an undirected edge table with the smallest node that it reaches: ``node``, ``component``.

    Each round turns the edges into flatter stars and writes them to the shared folder; rounds grow with the logarithm
    of the longest chain, and edges that are stars already take none. Minima combine before each shuffle, so a hub of any degree does not meet in one task. Edges
    with a null end and loops are left out; an empty table gives an empty result.
    """
    whole = edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull())
    pair = whole.select(F.greatest(src, dst).alias("v"), F.least(src, dst).alias("m"))
    stars = stage(pair.where("v <> m").distinct(), "edges")
    while not _settled(stars):
        flatter = stage(_small_star(_large_star(stars)), "stars")
        unstage(stars)
        stars = flatter
    centres = stars.select(F.col("m").alias("node"), F.col("m").alias("component")).distinct()
    return stars.select(F.col("v").alias("node"), F.col("m").alias("component")).unionByName(centres)
