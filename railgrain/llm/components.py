"""Connected components by alternating large and small stars, each round a few joins and minima over written edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _minima(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_minima(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _minima(down)
    out = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(u, v) of numbers to (node, label): label is the least node of its component; nodes without an edge have no row.

    A round keeps components and shortens paths; the number of rounds grows with the logarithm of the longest path.
    Star centres are hot keys of joins and minima, never of a window or a list.
    """
    edges = written(edges.where("u <> v").select("u", "v").distinct(), "edges")
    while True:
        edges = written(_small_star(_large_star(edges)).where("u <> v").distinct(), "edges")
        # Done when all edges lead from nodes with one edge to nodes with none of their own.
        ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
            edges.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        ends = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        if ends.where("out > 1 or out = 1 and into = 1").isEmpty():
            break
    out = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return out.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
