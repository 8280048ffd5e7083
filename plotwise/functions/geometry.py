"""Planar geometry as column expressions.

A polygon is ``rings: array<array<struct<x double, y double>>>``, each ring closed (last point repeats the
first). Holes and multiple parts are further rings, told apart by the even-odd rule. WKB bytes are parsed
once per feature by a small Arrow function.
"""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

RINGS = "array<array<struct<x:double,y:double>>>"


def xy(x, y) -> Column:
    return F.struct(F.lit(x).cast("double").alias("x"), F.lit(y).cast("double").alias("y"))


def polygon(*points: tuple) -> Column:
    """A one-ring polygon from column or number pairs; closes itself."""
    ring = [*points, points[0]]
    return F.array(F.array(*[_pair(x, y) for x, y in ring]))


def rectangle(x0, y0, x1, y1) -> Column:
    return polygon((x0, y0), (x1, y0), (x1, y1), (x0, y1))


def _pair(x, y) -> Column:
    a = x if isinstance(x, Column) else F.lit(x)
    b = y if isinstance(y, Column) else F.lit(y)
    return F.struct(a.cast("double").alias("x"), b.cast("double").alias("y"))


def ring_edges(ring: Column) -> Column:
    """Consecutive point pairs of a closed ring or a line."""
    n = F.size(ring)
    starts = F.slice(ring, 1, F.greatest(n - 1, F.lit(0)))
    ends = F.slice(ring, 2, F.greatest(n - 1, F.lit(0)))
    return F.zip_with(
        starts,
        ends,
        lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")),
    )


def edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, ring_edges))


def crosses_ray(edge: Column, x: Column, y: Column) -> Column:
    """Whether a ray from (x, y) toward +x meets the edge (half-open in y)."""
    spans = (edge["y1"] > y) != (edge["y2"] > y)
    meets = edge["x1"] + (y - edge["y1"]) * (edge["x2"] - edge["x1"]) / (edge["y2"] - edge["y1"])
    return F.when(spans, x < meets).otherwise(F.lit(False))


def odd_crossings(edge_array: Column, x: Column, y: Column) -> Column:
    return F.size(F.filter(edge_array, lambda e: crosses_ray(e, x, y))) % 2 == 1


def contains(rings: Column, x: Column, y: Column) -> Column:
    """Point in polygon by ray casting."""
    return odd_crossings(edges(rings), x, y)


def _sum(array: Column, term) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, e: acc + term(e))


def ring_area(rings: Column) -> Column:
    """Shoelace area; rings turned the other way count as holes."""
    cross = _sum(edges(rings), lambda e: e["x1"] * e["y2"] - e["x2"] * e["y1"])
    return F.abs(cross) / 2


def centroid(rings: Column) -> Column:
    """Area-weighted centre as a struct."""
    all_edges = edges(rings)
    twice = _sum(all_edges, lambda e: e["x1"] * e["y2"] - e["x2"] * e["y1"])
    cx = _sum(all_edges, lambda e: (e["x1"] + e["x2"]) * (e["x1"] * e["y2"] - e["x2"] * e["y1"]))
    cy = _sum(all_edges, lambda e: (e["y1"] + e["y2"]) * (e["x1"] * e["y2"] - e["x2"] * e["y1"]))
    ok = twice != 0
    return F.struct(
        F.when(ok, cx / (3 * twice)).alias("x"), F.when(ok, cy / (3 * twice)).alias("y")
    )


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt(distance2(x1, y1, x2, y2))


def distance2(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return (x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)


def point_segment_distance2(px: Column, py: Column, e) -> Column:
    """Squared distance from a point to a segment given by four columns (x1, y1, x2, y2)."""
    x1, y1, x2, y2 = e
    dx, dy = x2 - x1, y2 - y1
    length2 = dx * dx + dy * dy
    along = F.when(length2 == 0, F.lit(0.0)).otherwise(((px - x1) * dx + (py - y1) * dy) / length2)
    t = F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0))
    return distance2(px, py, x1 + t * dx, y1 + t * dy)


def segments_cross(a, b) -> Column:
    """Whether two segments (x1, y1, x2, y2 columns) share a point."""

    def turn(px, py, qx, qy, rx, ry):
        return (qx - px) * (ry - py) - (qy - py) * (rx - px)

    ax1, ay1, ax2, ay2 = a
    bx1, by1, bx2, by2 = b
    d1, d2 = turn(bx1, by1, bx2, by2, ax1, ay1), turn(bx1, by1, bx2, by2, ax2, ay2)
    d3, d4 = turn(ax1, ay1, ax2, ay2, bx1, by1), turn(ax1, ay1, ax2, ay2, bx2, by2)
    boxes = (
        (F.greatest(ax1, ax2) >= F.least(bx1, bx2))
        & (F.greatest(bx1, bx2) >= F.least(ax1, ax2))
        & (F.greatest(ay1, ay2) >= F.least(by1, by2))
        & (F.greatest(by1, by2) >= F.least(ay1, ay2))
    )
    return boxes & (F.signum(d1) * F.signum(d2) <= 0) & (F.signum(d3) * F.signum(d4) <= 0)


def _read_wkb(blob: bytes) -> list:
    """Rings of a WKB point, line, polygon or multi-geometry (2-D)."""
    rings: list = []

    def read(offset: int) -> int:
        order = "<" if blob[offset] == 1 else ">"
        kind = struct.unpack_from(order + "I", blob, offset + 1)[0] % 1000
        offset += 5

        def points(count: int, at: int):
            flat = struct.unpack_from(f"{order}{2 * count}d", blob, at)
            return [{"x": flat[i], "y": flat[i + 1]} for i in range(0, 2 * count, 2)], at + 16 * count

        if kind == 1:
            ring, offset = points(1, offset)
            rings.append(ring)
            return offset
        count = struct.unpack_from(order + "I", blob, offset)[0]
        offset += 4
        if kind == 2:
            ring, offset = points(count, offset)
            rings.append(ring)
        elif kind == 3:
            for _ in range(count):
                n = struct.unpack_from(order + "I", blob, offset)[0]
                ring, offset = points(n, offset + 4)
                rings.append(ring)
        elif kind in (4, 5, 6, 7):
            for _ in range(count):
                offset = read(offset)
        else:
            raise ValueError(f"unsupported geometry type {kind}")
        return offset

    read(0)
    return rings


def rings_from_wkb(c: Column | str) -> Column:
    """Parse WKB bytes to rings, in Arrow batches."""

    @F.pandas_udf(RINGS)
    def parse(blobs: pd.Series) -> pd.Series:
        return blobs.map(lambda b: None if b is None else _read_wkb(bytes(b)))

    return parse(c)


def wkb_point(x: Column, y: Column) -> Column:
    """WKB bytes of a point (little-endian), written by an Arrow function."""

    @F.pandas_udf("binary")
    def write(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([struct.pack("<BIdd", 1, 1, a, b) for a, b in zip(xs, ys)])

    return write(x.cast("double"), y.cast("double"))


def wkb_polygon(rings: Column) -> Column:
    """WKB bytes of a polygon (little-endian), written by an Arrow function."""

    @F.pandas_udf("binary")
    def write(col: pd.Series) -> pd.Series:
        def one(value):
            parts = [struct.pack("<BII", 1, 3, len(value))]
            for ring in value:
                parts.append(struct.pack("<I", len(ring)))
                parts += [struct.pack("<dd", p["x"], p["y"]) for p in ring]
            return b"".join(parts)

        return col.map(one)

    return write(rings)
