"""Distributed union-find: connected components by alternating star
contraction. Every round is two grouped minima and joins; neither links nor
components ever reach the driver (only a count and a checksum do)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hangs its larger neighbours on its smallest neighbour."""
    near = _both(edges)
    low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return near.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hangs itself and its smaller neighbours on the smallest."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionAll(low.select("u", F.col("m").alias("v")))


def components(links: DataFrame, scratch: Scratch, name: str = "links") -> DataFrame:
    """(u, v) pairs of whole numbers -> (node, root) for every node with a
    link to another node; root is the smallest node reachable. Repeated
    pairs, loops and nulls are harmless."""
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before, k = scratch.write(edges, f"{name}-0"), None, 0
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, k = now, k + 1
        large = scratch.write(_large_star(edges).distinct(), f"{name}-{k}-large")
        edges = scratch.write(_small_star(large).distinct(), f"{name}-{k}")
        scratch.drop(f"{name}-{k}-large", f"{name}-{k - 1}")
