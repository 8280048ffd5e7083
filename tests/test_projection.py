"""Grids against the ellipsoid's own geometry, simplification against plain recursion."""

import math
import random

import pytest
from pyspark.sql import functions as F

from plotwise.functions import projection as P

G = P.STATE_PLANE


@pytest.fixture(scope="module")
def grid(spark):
    """Places over the zone, forth and back again."""
    places = spark.range(25 * 25).select((-91 + F.col("id") % 25 * 0.2).alias("lon"), (36.5 + F.floor(F.col("id") / 25) * 0.25).alias("lat"))
    x, y = P.to_grid(F.col("lon"), F.col("lat"))
    placed = places.select("lon", "lat", x.alias("x"), y.alias("y"))
    lon, lat = P.from_grid(F.col("x"), F.col("y"))
    again = P.to_grid(lon, lat)
    return placed.select("*", lon.alias("lon2"), lat.alias("lat2"), again[0].alias("x2"), again[1].alias("y2")).collect()


def test_round_trip(grid):
    assert max(max(abs(r.x - r.x2), abs(r.y - r.y2)) for r in grid) < 0.001  # feet
    assert max(max(abs(r.lon - r.lon2), abs(r.lat - r.lat2)) for r in grid) < 1e-9


def test_central_meridian_has_true_length(spark):
    """Along the central meridian the way north is the ellipsoid's arc times the scale, by Simpson's rule."""
    e2 = G.eccentricity**2

    def arc(a, b, steps=2000):
        h = (b - a) / steps
        f = lambda p: G.radius * (1 - e2) / (1 - e2 * math.sin(p) ** 2) ** 1.5
        return h / 3 * sum(f(a + i * h) * (1 if i in (0, steps) else 4 if i % 2 else 2) for i in range(steps + 1))

    lats = [36 + 2 / 3, 38.0, 41.9, 44.0]
    x, y = P.to_grid(F.lit(G.lon0), F.col("lat"))
    for r in spark.createDataFrame([(v,) for v in lats], "lat double").select("lat", x.alias("x"), y.alias("y")).collect():
        want = G.scale / G.unit * arc(math.radians(G.lat0), math.radians(r.lat))
        assert abs(r.x - G.east) < 1e-6 and abs(r.y - want) < 1e-4


def test_angles_are_kept(spark):
    """Small steps east and north stay at right angles and of one scale, as far as the ellipsoid's radii say."""
    rng = random.Random(4)
    d = 1e-5
    rows = [(rng.uniform(-90, -86.5), rng.uniform(37, 43)) for _ in range(40)]
    steps = [(i, k, lon + (d if k == 1 else 0), lat + (d if k == 2 else 0)) for i, (lon, lat) in enumerate(rows) for k in range(3)]
    x, y = P.to_grid(F.col("lon"), F.col("lat"))
    at = {(r.i, r.k): (r.x, r.y) for r in spark.createDataFrame(steps, "i int, k int, lon double, lat double").select("i", "k", x.alias("x"), y.alias("y")).collect()}
    e2 = G.eccentricity**2
    for i, (_, lat) in enumerate(rows):
        sine = math.sin(math.radians(lat + d / 2))
        across = G.radius / math.sqrt(1 - e2 * sine**2) * math.cos(math.radians(lat)) * math.radians(d)
        along = G.radius * (1 - e2) / (1 - e2 * sine**2) ** 1.5 * math.radians(d)
        east, north = [(at[i, k][0] - at[i, 0][0], at[i, k][1] - at[i, 0][1]) for k in (1, 2)]
        assert abs(math.hypot(*east) / across - math.hypot(*north) / along) * G.unit < 1e-5
        assert abs(east[0] * north[0] + east[1] * north[1]) / (math.hypot(*east) * math.hypot(*north)) < 1e-5


def test_airports_and_nulls(spark):
    """Two airports lie where the noise model has its centres; nulls stay null."""
    from plotwise.plans.proximity import AIRPORT_CENTRE

    rows = spark.createDataFrame([("ohare", -87.9048, 41.9786), ("midway", -87.7522, 41.7868), ("none", None, 41.0)], "name string, lon double, lat double")
    got = {r.name: (r.x, r.y) for r in rows.select("name", *[c.alias(n) for c, n in zip(P.to_grid(F.col("lon"), F.col("lat")), "xy")]).collect()}
    assert got["none"] == (None, None)
    assert all(math.dist(got[n], AIRPORT_CENTRE[n]) < 2500 for n in AIRPORT_CENTRE)


def test_rings(spark):
    ring = [(-88.0, 41.0), (-87.9, 41.0), (-87.9, 41.1), (-88.0, 41.0)]
    rows = spark.createDataFrame([([ring],), (None,), ([],)], "rings array<array<struct<x:double,y:double>>>")
    back = rows.select(P.rings_from_grid(P.rings_to_grid(F.col("rings"))).alias("r")).collect()
    assert back[1].r is None and back[2].r == []
    assert all(math.dist((p.x, p.y), q) < 1e-9 for p, q in zip(back[0].r[0], ring))


def slow(points, tolerance):
    if len(points) < 3:
        return points
    (ax, ay), (bx, by) = points[0], points[-1]
    length2 = (bx - ax) ** 2 + (by - ay) ** 2

    def off2(p):
        t = 0 if length2 == 0 else min(1, max(0, ((p[0] - ax) * (bx - ax) + (p[1] - ay) * (by - ay)) / length2))
        return (p[0] - ax - t * (bx - ax)) ** 2 + (p[1] - ay - t * (by - ay)) ** 2

    far = max(range(1, len(points) - 1), key=lambda i: (off2(points[i]), -i))
    if off2(points[far]) <= tolerance**2:
        return [points[0], points[-1]]
    return slow(points[: far + 1], tolerance)[:-1] + slow(points[far:], tolerance)


@pytest.mark.parametrize("tolerance", [0.0, 1.0, 6.0])
def test_simplified_lines(spark, tolerance):
    rng = random.Random(5)
    lines = [[(float(i), rng.uniform(-5, 5)) for i in range(n)] for n in (2, 3, 10, 60, 200)]
    lines += [[], [(1.0, 2.0)], [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)], [(1.0, 1.0)] * 5, [(float(i), 0.0) for i in range(30)]]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines + [None])], "i int, line array<struct<x:double,y:double>>")
    got = {r.i: r.s for r in rows.select("i", P.simplify_line("line", tolerance).alias("s")).collect()}
    assert got[len(lines)] is None
    for i, line in enumerate(lines):
        want = slow(line, tolerance)
        assert [(p.x, p.y) for p in got[i]] == want
