"""Searches over packed box trees: same answers as all pairs, few comparisons, no hot key."""

import math
import random

import pytest
from pyspark.sql import functions as F

from plotwise.operators import packed, spatial


def points(spark, rows):
    return spark.createDataFrame([(i, float(x), float(y), "a" if i % 5 else "b") for i, (x, y) in enumerate(rows)], "pin long, x double, y double, year string")


def scattered(n, seed, width=1000.0):
    rng = random.Random(seed)
    return [(rng.uniform(0, width), rng.uniform(0, width)) for _ in range(n)]


def tower(n, seed):
    """Half of all points in one spot of a thousandth of the width."""
    rng = random.Random(seed)
    return [(500 + rng.uniform(0, 1), 500 + rng.uniform(0, 1)) for _ in range(n // 2)] + scattered(n - n // 2, seed + 1)


def segment_distance2(px, py, s):
    x1, y1, x2, y2 = s
    dx, dy = x2 - x1, y2 - y1
    length = dx * dx + dy * dy
    t = 0 if length == 0 else min(1, max(0, ((px - x1) * dx + (py - y1) * dy) / length))
    return (px - x1 - t * dx) ** 2 + (py - y1 - t * dy) ** 2


@pytest.fixture()
def small_leaves(monkeypatch):
    monkeypatch.setattr(packed, "LEAF", 4)


@pytest.mark.parametrize("layout", [scattered, tower])
def test_nearest_segment(spark, small_leaves, layout):
    spots = layout(150, 1)
    lines = [(a, b, a + 30 * (i % 3), b + 10 * (i % 2)) for i, (a, b) in enumerate(scattered(120, 7) + scattered(20, 8, 1e6))]
    frame = spark.createDataFrame([(i % 40, *s) for i, s in enumerate(lines)], "road long, x1 double, y1 double, x2 double, y2 double")
    got = {r.pin: (r.road, r.dist) for r in spatial.nearest(points(spark, spots), frame, ["road"]).collect()}
    for i, (x, y) in enumerate(spots):
        d2, road = min((segment_distance2(x, y, s), n % 40) for n, s in enumerate(lines))
        assert got[i][0] == road and math.isclose(got[i][1], math.sqrt(d2), rel_tol=1e-9, abs_tol=1e-9)


def test_groups_nulls_and_ties(spark):
    spots = spark.createDataFrame([(1, 0.0, 0.0, "a"), (2, 0.0, 0.0, "b"), (3, 0.0, 0.0, None), (4, None, 0.0, "a"), (5, 0.0, 0.0, "c"), (6, 0.0, 0.0, "a")], "pin long, x double, y double, year string")
    stops = spark.createDataFrame([(9, 3.0, 4.0, "a"), (7, -3.0, 4.0, "a"), (8, 1.0, 0.0, "b"), (5, 0.0, None, "a"), (4, 0.0, 0.0, None)], "stop long, x double, y double, year string")
    got = {r.pin: (r.stop, r.dist) for r in spatial.nearest(spots, spatial.point_segments(stops).drop("x", "y"), ["stop"], ["year"]).collect()}
    assert got == {1: (7, 5.0), 2: (8, 1.0), 3: (None, None), 4: (None, None), 5: (None, None), 6: (7, 5.0)}
    none = spatial.nearest(spots, spatial.point_segments(stops.where("1 = 0")).drop("x", "y"), ["stop"], ["year"]).collect()
    assert len(none) == 6 and all(r.dist is None for r in none)
    assert spatial.nearest(spots.where("1 = 0"), spatial.point_segments(stops).drop("x", "y"), ["stop"], ["year"]).collect() == []


@pytest.mark.parametrize("layout, radius, need_all", [(scattered, 60.0, False), (scattered, 1e4, True), (tower, 0.2, True), (tower, 300.0, False)])
def test_k_nearest(spark, small_leaves, layout, radius, need_all):
    spots = layout(160, 3)
    spots += spots[:10] + [(spots[0][0], 1.0), (2.0, spots[0][1])]
    got = spatial.knn(points(spark, spots), points(spark, spots), "pin", 3, radius, ["year"], need_all=need_all).collect()
    want = set()
    for i, (x, y) in enumerate(spots):
        near = sorted((math.sqrt((x - a) ** 2 + (y - b) ** 2), j) for j, (a, b) in enumerate(spots) if a != x and b != y and (i % 5 > 0) == (j % 5 > 0) and (x - a) ** 2 + (y - b) ** 2 <= radius**2)[:3]
        if not need_all or len(near) == 3:
            want |= {(i, j, rank + 1) for rank, (_, j) in enumerate(near)}
    assert {(r.pin, r.neighbour, r["rank"]) for r in got} == want


def test_smallest_radius_that_holds_all(spark):
    spots = scattered(60, 4)
    got = spatial.knn_escalating(points(spark, spots), points(spark, spots), "pin", 2, [50.0, 150.0, 2000.0]).collect()
    last = {}
    for r in got:
        last[r.pin] = max(last.get(r.pin, 0), r.dist)
    assert len(got) == 120 and all(r.radius == next(x for x in (50, 150, 2000) if last[r.pin] <= x) for r in got)


@pytest.mark.parametrize("layout", [scattered, tower])
def test_within(spark, small_leaves, layout):
    a, b = layout(100, 5), layout(140, 6)
    pairs = {(i, j) for i, (x, y) in enumerate(a) for j, (u, v) in enumerate(b) if (x - u) ** 2 + (y - v) ** 2 <= 120**2 and (i % 5 > 0) == (j % 5 > 0)}
    met = spatial.within_radius(points(spark, a), points(spark, b), 120.0, {"pin": "other"}, ["year"]).collect()
    assert {(r.pin, r.other) for r in met} == pairs and len(met) == len(pairs)
    counted = spatial.count_within_radius(points(spark, a), points(spark, b), 120.0, {"n": F.lit(1).cast("long"), "weight": F.col("pin") / 2}, ["year"]).collect()
    assert {r.pin: (r.n or 0, r.weight or 0) for r in counted} == {i: (sum(p == i for p, _ in pairs), sum(j / 2 for p, j in pairs if p == i)) for i in range(len(a))}


def compared(spark, near_rows, far_rows, prune):
    near = points(spark, near_rows).withColumns(packed.point_box("x", "y"))
    far = points(spark, far_rows).select(F.col("pin").alias("other"), F.col("x").alias("u"), F.col("y").alias("v")).withColumns(packed.point_box("u", "v"))
    a, b = packed.pack(near, far, [])
    return packed.candidates(a, b, prune, ["pin", "x", "y"], "x", "y", {"other": "other"})


def test_a_dense_coast_far_away(spark):
    """All points lie far from a coast of many rows: each is compared with few of them."""
    coast = [(i / 10, 40 * math.sin(i / 300)) for i in range(6000)]
    inland = [(x / 2, 20_000 + y) for x, y in scattered(500, 9)]
    assert compared(spark, inland, coast, packed.keep_nearest).count() < 250 * len(inland)


def test_half_of_all_points_in_one_place(spark):
    """No key of the search holds more than a leaf, and counting lists few pairs of a crowd."""
    crowd = tower(4000, 11)
    near = points(spark, crowd).withColumns(packed.point_box("x", "y"))
    a, b = packed.pack(near, near.withColumnRenamed("pin", "other"), [])
    for side in (a, b):
        assert side.rows.groupBy("_code").count().agg(F.max("count")).first()[0] <= packed.LEAF
        assert side.nodes(0).groupBy(F.shiftright("_code", packed.FAN_BITS)).count().agg(F.max("count")).first()[0] <= packed.FAN
    met = packed.candidates(a, b, packed.keep_nearest, ["pin", "x", "y"], "x", "y", {"other": "other"})
    assert met.count() < 4000 * 300
    b.sums["n"] = F.lit(1).cast("long")
    left = packed.candidates(a, b, packed.add_within(50.0, ["n"]), ["pin", "x", "y"], "x", "y", {"other": "other"}, {"_sum_n": F.lit(0).cast("long")})
    assert left.where("_met").count() < 4000 * 4000 / 10


def test_crowded_long_segments_leave_few_leaves(spark, small_leaves):
    """Boxes of long rows overlap in a crowd: a point on one of them must not bound by their far corners."""
    rng = random.Random(5)
    lines = [(rng.uniform(0, 100), rng.uniform(0, 100)) for _ in range(2000)]
    segments = spark.createDataFrame([(i, x, y, x + 40.0, y + 40.0) for i, (x, y) in enumerate(lines)], "road long, x1 double, y1 double, x2 double, y2 double")
    spots = points(spark, scattered(200, 6, 140.0)).select("x", "y").withColumns(packed.point_box("x", "y"))
    near, far = packed.pack(spots, segments.withColumns(packed.segment_box()), [])
    far = packed.with_spot(far, F.col("x1"), F.col("y1"))
    opened = packed.descend(near, far, packed.keep_nearest_spot).agg(F.sum(F.size("_open"))).first()[0]
    before = packed.descend(near, far, packed.keep_nearest).agg(F.sum(F.size("_open"))).first()[0]
    assert opened < 0.7 * before
    got = {(r.x, r.y): r.dist for r in spatial.nearest(spots.select("x", "y"), segments, ["road"]).collect()}
    assert all(math.isclose(d, math.sqrt(min(segment_distance2(x, y, (a, b, a + 40, b + 40)) for a, b in lines)), rel_tol=1e-9, abs_tol=1e-9) for (x, y), d in got.items())
