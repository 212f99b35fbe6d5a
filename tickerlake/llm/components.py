"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (u, v); the label is the least node of its component.

    Each round hangs the larger neighbours of every node on its least
    neighbour, then the smaller ones.  The number of edges never grows, rounds
    grow with the logarithm of the longest path, and each round is stored.
    It ends when the edges are stars: no node hangs on two others, and none
    that others hang on hangs itself.  Joins carry a hash of the node as well,
    so that a large star's rows get an exchange of their own, which AQE splits.
    """
    e = stored(_down(edges), "components")
    while not _are_stars(e):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _down(_joined(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _joined(large, least)
        e = stored(_down(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))), "components")
    hung = e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return hung.union(hung.select(F.col("label").alias("node"), "label").distinct())


def _are_stars(e: DataFrame) -> bool:
    twice = e.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    inner = e.select(F.col("v").alias("u")).distinct().join(e.select("u"), "u", "left_semi")
    return twice.union(inner).isEmpty()


def _joined(edges: DataFrame, least: DataFrame) -> DataFrame:
    h = F.xxhash64("u").alias("h")
    return edges.select("u", "v", h).join(least.select("u", "m", h), ["u", "h"]).drop("h")


def _down(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    return edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
