"""Transverse Mercator grids as column expressions: longitude and latitude to x and y, and back.

Krueger's series in the third flattening, to the fourth order: errors stay far below a thousandth of a foot within a
zone. A grid is a set of constants; ``STATE_PLANE`` is the published one of EPSG code 3435.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """Ellipsoid, origin (degrees), scale on the central meridian, offsets (in units) and metres of a unit."""

    lon0: float
    lat0: float
    scale: float
    east: float
    north: float
    unit: float
    radius: float = 6378137.0
    inverse_flattening: float = 298.257222101

    @property
    def n(self) -> float:
        f = 1 / self.inverse_flattening
        return f / (2 - f)

    @property
    def rectifying(self) -> float:
        """Radius of the circle as long as a meridian, scaled, in units."""
        n = self.n
        return self.radius / (1 + n) * (1 + n**2 / 4 + n**4 / 64) * self.scale / self.unit

    @property
    def forth(self) -> tuple[float, ...]:
        n = self.n
        return (
            n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
            61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280,
        )

    @property
    def back(self) -> tuple[float, ...]:
        n = self.n
        return (
            n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
            17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280,
        )

    @property
    def latitude(self) -> tuple[float, ...]:
        """From conformal to geographic latitude."""
        n = self.n
        return (
            2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
            56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630,
        )

    @property
    def eccentricity(self) -> float:
        return 2 * math.sqrt(self.n) / (1 + self.n)

    @property
    def origin(self) -> float:
        """The way from the equator to the origin along the central meridian, in units."""
        phi, e = math.radians(self.lat0), self.eccentricity
        xi = math.atan(math.sinh(math.atanh(math.sin(phi)) - e * math.atanh(e * math.sin(phi))))
        return self.rectifying * (xi + sum(c * math.sin(2 * j * xi) for j, c in enumerate(self.forth, 1)))


#: EPSG code 3435, in US survey feet.
STATE_PLANE = Grid(lon0=-88 - 1 / 3, lat0=36 + 2 / 3, scale=0.999975, east=984250.0, north=0.0, unit=1200 / 3937)


def to_grid(lon: Column, lat: Column, grid: Grid = STATE_PLANE) -> tuple[Column, Column]:
    """x and y of a place in degrees; null where either is null."""
    phi, way = F.radians(lat), F.radians(lon - grid.lon0)
    e = grid.eccentricity
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi = F.atan2(t, F.cos(way))
    eta = F.asinh(F.sin(way) / F.sqrt(t * t + F.cos(way) * F.cos(way)))
    x, y = eta, xi
    for j, c in enumerate(grid.forth, 1):
        x = x + c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return grid.east + grid.rectifying * x, grid.north - grid.origin + grid.rectifying * y


def from_grid(x: Column, y: Column, grid: Grid = STATE_PLANE) -> tuple[Column, Column]:
    """Longitude and latitude in degrees of a place on the grid; null where either is null."""
    up, side = (y - grid.north + grid.origin) / grid.rectifying, (x - grid.east) / grid.rectifying
    xi, eta = up, side
    for j, c in enumerate(grid.back, 1):
        xi = xi - c * F.sin(2 * j * up) * F.cosh(2 * j * side)
        eta = eta - c * F.cos(2 * j * up) * F.sinh(2 * j * side)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    phi = chi
    for j, c in enumerate(grid.latitude, 1):
        phi = phi + c * F.sin(2 * j * chi)
    return grid.lon0 + F.degrees(F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(phi)


def rings_to_grid(rings: Column, grid: Grid = STATE_PLANE) -> Column:
    """Rings in degrees (x longitude, y latitude) to rings on the grid."""
    return _moved(rings, lambda p: to_grid(p["x"], p["y"], grid))


def rings_from_grid(rings: Column, grid: Grid = STATE_PLANE) -> Column:
    return _moved(rings, lambda p: from_grid(p["x"], p["y"], grid))


def _moved(rings: Column, place) -> Column:
    def point(p: Column) -> Column:
        x, y = place(p)
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(rings, lambda ring: F.transform(ring, point))


def forward_sql(lon: str, lat: str, grid: Grid = STATE_PLANE) -> tuple[str, str]:
    """The series of ``to_grid`` as SQL text, for engines that have hyperbolic functions."""
    e = grid.eccentricity
    phi, way = f"radians({lat})", f"radians({lon} - ({grid.lon0!r}))"
    t = f"sinh(atanh(sin({phi})) - {e!r} * atanh({e!r} * sin({phi})))"
    xi = f"atan2({t}, cos({way}))"
    eta = f"asinh(sin({way}) / sqrt({t} * {t} + cos({way}) * cos({way})))"
    x = " + ".join([eta, *[f"({c!r}) * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})" for j, c in enumerate(grid.forth, 1)]])
    y = " + ".join([xi, *[f"({c!r}) * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})" for j, c in enumerate(grid.forth, 1)]])
    return f"{grid.east!r} + {grid.rectifying!r} * ({x})", f"{grid.north - grid.origin!r} + {grid.rectifying!r} * ({y})"


def simplify_line(points: str, tolerance: float) -> Column:
    """Douglas and Peucker's simplification of a column of points (x, y): no left out point lies farther than ``tolerance`` from the line that stays.

    The first and the last point stay; of equally far points the earlier one does. Stretches to be looked at are a stack
    in the state of an aggregate, one taken off at each step, so a line of n points takes 2 n steps at most.
    """
    limit = repr(float(tolerance) ** 2) + "D"
    a, b, p = (f"element_at({points}, {i})" for i in ("t.a", "t.b", "j"))
    length2 = f"(({b}.x - {a}.x) * ({b}.x - {a}.x) + ({b}.y - {a}.y) * ({b}.y - {a}.y))"
    along = f"if({length2} = 0, 0D, least(1D, greatest(0D, (({p}.x - {a}.x) * ({b}.x - {a}.x) + ({p}.y - {a}.y) * ({b}.y - {a}.y)) / nullif({length2}, 0D))))"
    off = lambda c: f"({p}.{c} - ({a}.{c} + {along} * ({b}.{c} - {a}.{c})))"
    far = f"if(t.b - t.a < 2, struct(-1D AS d, 0 AS j), array_max(transform(sequence(t.a + 1, greatest(t.a + 1, t.b - 1)), j -> struct({off('x')} * {off('x')} + {off('y')} * {off('y')} AS d, -j AS j))))"
    rest = "slice(s.todo, 1, size(s.todo) - 1)"
    split = f"struct(concat({rest}, array(struct(t.a AS a, -f.j AS b), struct(-f.j AS a, t.b AS b))) AS todo, array_append(s.kept, -f.j) AS kept)"
    # t is the stretch on top and f its farthest point: elements of arrays, so that each is worked out once
    step = f"transform(slice(s.todo, -1, 1), t -> transform(array({far}), f -> if(f.d > {limit}, {split}, struct({rest} AS todo, s.kept AS kept)))[0])[0]"
    start = f"struct(array(struct(1 AS a, size({points}) AS b)) AS todo, array(1, size({points})) AS kept)"
    kept = f"aggregate(sequence(1, 2 * size({points})), {start}, (s, i) -> if(size(s.todo) = 0, s, {step}), s -> array_sort(array_distinct(s.kept)))"
    return F.expr(f"if(size({points}) < 3, {points}, transform({kept}, i -> element_at({points}, i)))")
