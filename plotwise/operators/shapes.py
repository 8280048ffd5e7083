"""Parcel shapes, corner lots and attribute dissolves."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions import geometry as geo

_SHAPE = "vertices long, angle_sd double, edge_sd double, centroid_dist_sd double, mrr_ratio double"
# Vertices that turn by less than this many degrees are on a straight edge.
STRAIGHT_DEGREES = 1.0


def _measures(ring: np.ndarray) -> tuple:
    """Vertex count, spread of angles, edges and centre distances, and box-to-parcel area of one outline."""
    points = ring[:-1]
    before, after = np.roll(points, 1, axis=0), np.roll(points, -1, axis=0)
    u, v = before - points, after - points
    lengths = np.hypot(*u.T) * np.hypot(*v.T)
    with np.errstate(all="ignore"):
        angles = np.degrees(np.arccos(np.clip((u * v).sum(axis=1) / lengths, -1, 1)))
    kept = points[np.abs(180 - angles) > STRAIGHT_DEGREES]
    angles = angles[np.abs(180 - angles) > STRAIGHT_DEGREES]
    if len(kept) < 3:
        return len(kept), None, None, None, None
    nxt = np.roll(kept, -1, axis=0)
    edge = nxt - kept
    edge_len = np.hypot(*edge.T)
    centre = np.hypot(*(kept - kept.mean(axis=0)).T)
    area = abs((kept[:, 0] * nxt[:, 1] - nxt[:, 0] * kept[:, 1]).sum()) / 2
    # The smallest rectangle around a convex hull lies along one of the hull's edges.
    hull = _hull(kept)
    side = np.roll(hull, -1, axis=0) - hull
    turn = np.arctan2(side[:, 1], side[:, 0])
    along = hull @ np.stack([np.cos(turn), np.sin(turn)])
    across = hull @ np.stack([-np.sin(turn), np.cos(turn)])
    box = ((along.max(axis=0) - along.min(axis=0)) * (across.max(axis=0) - across.min(axis=0))).min()
    ratio = max(box / area, 1.0) if area else None
    return len(kept), angles.std(ddof=1), edge_len.std(ddof=1), centre.std(ddof=1), ratio


def _hull(points: np.ndarray) -> np.ndarray:
    order = points[np.lexsort((points[:, 1], points[:, 0]))]

    def half(rows):
        out: list = []
        for p in rows:
            while len(out) > 1:
                a, b = out[-2], out[-1]
                if (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]) > 0:
                    break
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(order) + half(order[::-1]))


def shape_features(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Shape features of each row's outer ring, computed in Arrow batches."""

    @F.pandas_udf(_SHAPE)
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for outline in batch:
                ring = None if outline is None or not len(outline) else outline[0]
                if ring is None or len(ring) < 4:
                    rows.append((None,) * 5)
                    continue
                rows.append(_measures(np.array([(p["x"], p["y"]) for p in ring])))
            yield pd.DataFrame(
                rows, columns=["vertices", "angle_sd", "edge_sd", "centroid_dist_sd", "mrr_ratio"]
            ).astype({"vertices": "Int64"})

    out = df.withColumn("_shape", measure(F.col(rings)))
    names = {
        "vertices": "shp_parcel_num_vertices",
        "angle_sd": "shp_parcel_interior_angle_sd",
        "edge_sd": "shp_parcel_edge_len_ft_sd",
        "centroid_dist_sd": "shp_parcel_centroid_dist_ft_sd",
        "mrr_ratio": "shp_parcel_mrr_area_ratio",
    }
    return out.withColumns({n: F.col(f"_shape.{c}") for c, n in names.items()}).drop("_shape")


def corner_lots(
    parcels: DataFrame, streets: DataFrame, id_col: str, reach: float, size: float, bearing: Column | None = None
) -> DataFrame:
    """Parcels from whose centre at least two arms of a cross meet a street with no other parcel between.

    ``parcels`` has x, y and rings; ``streets`` x1, y1, x2, y2. Four arms of length ``reach`` leave the centre
    at right angles, the first at ``bearing`` radians. Arms at 90° to each other, or three of them, make a corner.
    """
    turn = F.lit(0.0) if bearing is None else bearing
    arms = F.array(*[F.struct(F.lit(i).alias("arm"), (turn + F.lit(i * np.pi / 2)).alias("a")) for i in range(4)])
    rays = (
        parcels.select(id_col, "x", "y", F.explode(arms).alias("_a"))
        .select(
            id_col, F.col("_a.arm").alias("arm"), F.col("x").alias("ax1"), F.col("y").alias("ay1"),
            (F.col("x") + reach * F.cos("_a.a")).alias("ax2"), (F.col("y") + reach * F.sin("_a.a")).alias("ay2"),
        )
    )

    def in_cells(df, x1, y1, x2, y2):
        for axis, a, b in (("_cx", x1, x2), ("_cy", y1, y2)):
            span = F.sequence(F.floor(F.least(a, b) / size), F.floor(F.greatest(a, b) / size))
            df = df.withColumn(axis, F.explode(span))
        return df

    ray = tuple(F.col(c) for c in ("ax1", "ay1", "ax2", "ay2"))
    line = tuple(F.col(c) for c in ("x1", "y1", "x2", "y2"))
    placed = in_cells(rays, "ax1", "ay1", "ax2", "ay2")
    outlines = parcels.select(F.col(id_col).alias("_other"), F.explode(geo.edges(F.col("rings"))).alias("_e"))
    outlines = in_cells(outlines.select("_other", "_e.*"), "x1", "y1", "x2", "y2")
    blocked = (
        placed.join(outlines, ["_cx", "_cy"])
        .where((F.col("_other") != F.col(id_col)) & geo.segments_cross(ray, line))
        .select(id_col, "arm")
        .distinct()
    )
    on_street = (
        placed.join(in_cells(streets, "x1", "y1", "x2", "y2"), ["_cx", "_cy"])
        .where(geo.segments_cross(ray, line))
        .select(id_col, "arm")
        .distinct()
    )
    arms_left = on_street.join(blocked, [id_col, "arm"], "left_anti")
    per_parcel = arms_left.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("num_cross_branch"),
        F.count_if(F.col("arm") % 2 == 0).alias("_even"),
        F.count_if(F.col("arm") % 2 == 1).alias("_odd"),
    )
    corner = ((F.col("_even") > 0) & (F.col("_odd") > 0)) | (F.col("num_cross_branch") >= 3)
    flagged = per_parcel.where(corner).select(id_col, "num_cross_branch", F.lit(True).alias("is_corner_lot"))
    joined = parcels.select(id_col).join(flagged, id_col, "left")
    return joined.select(
        id_col, F.coalesce("is_corner_lot", F.lit(False)).alias("is_corner_lot"), "num_cross_branch"
    )
