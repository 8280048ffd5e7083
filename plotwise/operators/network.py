"""Graph work on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.session import settle


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) with the lowest node id as the component.

    Alternates "large star" and "small star" steps: every node's larger, then smaller, neighbours are tied to
    the lowest one. Steps are a minimum and a join, so a hub is combined before the shuffle. The number of
    rounds grows with the logarithm of the graph; they end when one changes nothing. Each round is written to
    the checkpoint folder.
    """
    pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    nodes = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "node")
    work = settle(pairs.where("a != b").distinct())
    before = None
    while True:
        work = settle(_small_star(_large_star(work)))
        state = work.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    roots = work.groupBy("a").agg(F.min("b").alias("_root"))
    joined = nodes.join(roots, nodes["node"] == roots["a"], "left")
    return joined.select("node", F.coalesce("_root", "node").alias("component"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _with_lowest(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a").alias("_n"), F.least("a", "_m").alias("m"))
    return edges.join(lowest, F.col("a") == F.col("_n")).drop("_n")


def _large_star(edges: DataFrame) -> DataFrame:
    tied = _with_lowest(_both_ways(edges))
    return tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    tied = _with_lowest(down)
    moved = tied.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    anchored = tied.select("a", F.col("m").alias("b"))
    return moved.union(anchored).where("a != b").distinct()


def drop_small_components(edges: DataFrame, least: int, src: str = "src", dst: str = "dst") -> DataFrame:
    """Edges of components that have more than ``least`` edges."""
    parts = connected_components(edges, src, dst)
    placed = edges.join(parts, edges[src] == parts["node"]).drop("node")
    big = placed.groupBy("component").agg(F.count(F.lit(1)).alias("edge_count")).where(F.col("edge_count") > least)
    return placed.join(big, "component")
