"""Connected components of a graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import drop_staged, stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (
        down.join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .union(least.select("u", F.col("m").alias("v")))
        .distinct()
    )


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node u has one v below it and no such v has one itself."""
    least = edges.groupBy("u").agg(F.min("v").alias("v"), F.max("v").alias("most"))
    inner = least.select(F.col("u").alias("v"), F.lit(True).alias("inner"))
    return least.join(inner, "v", "left").where("v <> most or inner or u < v").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """Columns (node, root) for every node of the edges (u, v); root is the smallest node reachable.

    Self links, repeated and reversed edges do no harm; rows with a null end are left out; without
    edges the result is empty. A hub's edges are joined, never gathered: adaptive skew handling
    splits them. Each round ends in written files; only one row reaches the driver. Stars are
    the fixed point of both steps, so edges that already are stars take no round.
    """
    down = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stage(down.distinct(), "edges")
    while not _are_stars(edges):
        after = stage(_small_star(_large_star(edges)), "edges")
        drop_staged(edges)
        edges = after
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
