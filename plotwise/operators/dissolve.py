"""Dissolving adjoining areas: shared borders cancel, what is left is stitched into rings.

All steps are aggregates and joins over edges, so a key with a third of all parts is as many rows as it has edges.
Only a finished ring is one row, and a key's rings where the caller wants them in one.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions import geometry as geo
from plotwise.session import stored


def _twice_area(ring: Column) -> Column:
    """Twice the signed area: above zero for a ring that runs against the clock."""
    return F.aggregate(geo.ring_edges(ring), F.lit(0.0), lambda a, e: a + e["x1"] * e["y2"] - e["x2"] * e["y1"])


def oriented(rings: Column) -> Column:
    """Rings that have the area on their left: outlines run against the clock, holes with it. A ring inside an odd number of others is a hole."""

    def turned(ring: Column, at: Column) -> Column:
        start = ring[0]
        around = F.filter(rings, lambda other, i: (i != at) & geo.odd_crossings(geo.ring_edges(other), start["x"], start["y"]))
        hole = F.size(around) % 2 == 1
        return F.when((_twice_area(ring) < 0) == hole, ring).otherwise(F.reverse(ring))

    return F.transform(rings, turned)


def boundary(parts: DataFrame, keys: list[str], rings: str = "rings") -> DataFrame:
    """keys, ax, ay, bx, by: directed edges, the area on their left, that no other part of the key has the other way round."""
    e = F.col("_e")
    edges = parts.select(*keys, F.explode(geo.edges(oriented(F.col(rings)))).alias("_e"))
    up = (e["x1"] < e["x2"]) | ((e["x1"] == e["x2"]) & (e["y1"] < e["y2"]))
    ends = {"lx": ("x1", "x2"), "ly": ("y1", "y2"), "hx": ("x2", "x1"), "hy": ("y2", "y1")}
    placed = edges.where((e["x1"] != e["x2"]) | (e["y1"] != e["y2"])).select(
        *keys, *[F.when(up, e[a]).otherwise(e[b]).alias(n) for n, (a, b) in ends.items()], F.when(up, 1).otherwise(-1).alias("way")
    )
    net = placed.groupBy(*keys, *ends).agg(F.sum("way").alias("net")).where("net != 0")
    pick = lambda a, b: F.when(F.col("net") > 0, F.col(a)).otherwise(F.col(b))
    return net.select(*keys, pick("lx", "hx").alias("ax"), pick("ly", "hy").alias("ay"), pick("hx", "lx").alias("bx"), pick("hy", "ly").alias("by"))


def _same(keys: list[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys], F.lit(True))


def _followers(edges: DataFrame, keys: list[str]) -> DataFrame:
    """id and next: the edge that goes on where an edge ends. Where several do, the first one with the clock from the way back, so that areas that touch in a point keep rings of their own."""
    back = F.atan2(F.col("a.ay") - F.col("a.by"), F.col("a.ax") - F.col("a.bx"))
    on = F.atan2(F.col("b.by") - F.col("b.ay"), F.col("b.bx") - F.col("b.ax"))
    turn = F.pmod(back - on, F.lit(2 * math.pi))
    met = edges.alias("a").join(edges.alias("b"), _same(keys, "a", "b") & (F.col("a.bx") == F.col("b.ax")) & (F.col("a.by") == F.col("b.ay")))
    return met.groupBy(F.col("a.id").alias("id")).agg(F.min_by(F.col("b.id"), F.struct(turn, F.col("b.id"))).alias("next"))


def ring_places(edges: DataFrame, keys: list[str]) -> DataFrame:
    """id, first (the ring's lowest start: x, y and id) and steps (from the edge to that start), by pointer doubling.

    After n rounds an edge knows the lowest start among the 2^n edges from it on. Rounds end when no edge learns of a
    lower one, so their number is the logarithm of the longest ring; each is stored.
    """
    own = edges.select("id", F.struct("ax", "ay", "id", F.lit(0).cast("long").alias("steps")).alias("low"))
    state = stored(own.join(_followers(edges, keys), "id").select("id", "next", "low"), "ring-0")
    reach = 1
    while True:
        ahead = state.select(F.col("id").alias("next"), F.col("next").alias("beyond"), F.col("low").alias("other"))
        there = F.struct("other.ax", "other.ay", "other.id", (F.col("other.steps") + reach).alias("steps"))
        joined = state.join(ahead, "next").withColumn("best", F.least("low", there))
        state = stored(joined.select("id", F.col("beyond").alias("next"), F.col("best").alias("low"), (F.col("best.id") != F.col("low.id")).alias("moved")), f"ring-{reach}")
        if state.where("moved").isEmpty():
            return state.select("id", F.struct("low.ax", "low.ay", "low.id").alias("first"), F.col("low.steps").alias("steps"))
        state = state.drop("moved")
        reach *= 2


def dissolved_rings(parts: DataFrame, keys: list[str], rings: str = "rings") -> DataFrame:
    """keys, ring (closed, from its lowest vertex on) and area: one row per ring of the dissolved parts; a hole's area is below zero.

    Parts of a key must not overlap, and adjoining ones must have the same vertices along their border; a border whose
    vertices differ stays. Parts that touch in a point only keep rings of their own. Null rings are left out.
    """
    edges = boundary(parts.where(F.col(rings).isNotNull()), keys, rings)
    edges = stored(edges.withColumn("id", F.monotonically_increasing_id()), "boundary")
    placed = edges.join(ring_places(edges, keys), "id")
    # the first edge has no way to go, the second all but one step
    order = F.when(F.col("steps") == 0, F.lit(None)).otherwise(-F.col("steps"))
    points = F.array_sort(F.collect_list(F.struct(F.coalesce(order, F.lit(-(1 << 62))).alias("o"), F.col("ax").alias("x"), F.col("ay").alias("y"))))
    open_ = placed.groupBy(*keys, "first").agg(F.transform(points, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("ring"))
    closed = open_.withColumn("ring", F.concat("ring", F.slice("ring", 1, 1)))
    return closed.select(*keys, "ring", (_twice_area(F.col("ring")) / 2).alias("area"))


def dissolve(df: DataFrame, keys: list[str], attributes: list[str], order: str, rings: str = "rings") -> DataFrame:
    """One row per key: attributes of the first part in ``order``, the outlines and holes of all parts together, and counts of parts, outlines and holes.

    A key without any outline (null or empty rings only) has null rings and no outlines.
    """
    firsts = [F.min_by(a, order).alias(a) for a in attributes]
    groups = df.groupBy(*keys).agg(*firsts, F.count(F.lit(1)).alias("num_parts"))
    found = dissolved_rings(df, keys, rings).groupBy(*keys).agg(
        F.sort_array(F.collect_list("ring")).alias(rings), F.count_if(F.col("area") > 0).alias("num_outlines"), F.count_if(F.col("area") < 0).alias("num_holes")
    )
    joined = groups.alias("g").join(found.alias("f"), _same(keys, "g", "f"), "left")
    zero = lambda c: F.coalesce(F.col(f"f.{c}"), F.lit(0)).alias(c)
    return joined.select(*[F.col(f"g.{c}") for c in groups.columns], F.col(f"f.{rings}").alias(rings), zero("num_outlines"), zero("num_holes"))
