"""Spatial joins: "inside" by square grid cells, "near" by packed box trees.

Both turn geometry into equality on a key, which Spark can hash, broadcast (if the side is under its size limit) or
split when a key is hot. Exact geometry is then tested on the candidates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from plotwise.functions import geometry as geo
from plotwise.operators import blocks, packed
from plotwise.operators.ordered import dedup_by_priority
from plotwise.session import sized, stored

#: Edges of all cells of a layer up to which the cells are broadcast to the places.
FEW_EDGES = 50_000


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(float(size)))


def _cells_between(low: Column, high: Column, size: float) -> Column:
    return F.sequence(_cell(low, size), _cell(high, size))


def with_cell(df: DataFrame, size: float, x: str = "x", y: str = "y") -> DataFrame:
    return df.withColumns({"_cx": _cell(F.col(x), size), "_cy": _cell(F.col(y), size)})


def polygon_cells(polygons: DataFrame, size: float, keep: list[str], rings: str = "rings") -> DataFrame:
    """Polygon × cell rows that carry only the edges a ray from inside that cell can meet.

    Cells that the outline does not touch and the polygon does not cover fall away here.
    """
    points = F.flatten(F.col(rings))
    boxed = polygons.select(
        *keep,
        geo.edges(F.col(rings)).alias("_edges"),
        F.array_min(F.transform(points, lambda p: p["x"])).alias("_x0"),
        F.array_max(F.transform(points, lambda p: p["x"])).alias("_x1"),
        F.array_min(F.transform(points, lambda p: p["y"])).alias("_y0"),
        F.array_max(F.transform(points, lambda p: p["y"])).alias("_y1"),
    )
    band = F.col("_cy") * F.lit(float(size))
    left = F.col("_cx") * F.lit(float(size))
    # Edges are cut down by row first, then by column, so that long outlines are not copied to every cell.
    rows = boxed.withColumn("_cy", F.explode(_cells_between(F.col("_y0"), F.col("_y1"), size)))
    rows = rows.withColumn(
        "_edges",
        F.filter(
            "_edges",
            lambda e: (F.greatest(e["y1"], e["y2"]) >= band) & (F.least(e["y1"], e["y2"]) <= band + float(size)),
        ),
    )
    cells = rows.withColumn("_cx", F.explode(_cells_between(F.col("_x0"), F.col("_x1"), size)))
    cells = cells.withColumn("_edges", F.filter("_edges", lambda e: F.greatest(e["x1"], e["x2"]) >= left))
    return cells.where(F.size("_edges") > 0).select(*keep, "_cx", "_cy", "_edges")


def points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    columns: list[str],
    size: float,
    how: str = "left",
    by: list[str] = (),
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """Attach ``columns`` of each polygon that holds the point; ``by`` lists further equality keys (a year).

    Distinct coordinates are tested once and joined back, as parcels repeat theirs every year.
    """
    place = [x, y, *by]
    spots = points.select(*place).where(F.col(x).isNotNull() & F.col(y).isNotNull()).distinct()
    cells = polygon_cells(polygons, size, [*by, *columns])
    # Cells or places, whichever Spark takes for smaller by the length of files, may be millions of rows: decided by numbers.
    edges = cells.agg(F.sum(F.size("_edges"))).first()[0] or 0
    cells = F.broadcast(cells) if edges <= FEW_EDGES else cells.hint("merge")
    candidates = with_cell(spots, size, x, y).join(cells, ["_cx", "_cy", *by])
    inside = candidates.where(geo.odd_crossings(F.col("_edges"), F.col(x), F.col(y)))
    # a row for each place: neither side is broadcast
    hits = inside.select(*place, *columns).hint("merge")
    return points.join(hits, place, how)


def within_radius(
    a: DataFrame,
    b: DataFrame,
    radius: float,
    keep: dict[str, str],
    by: list[str] = (),
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """Rows of ``a`` with each row of ``b`` at most ``radius`` away; ``keep`` renames columns of ``b``."""
    place = [x, y, *by]
    spots = a.select(*place).distinct().withColumns(packed.point_box(x, y))
    others = b.select(*by, F.col(x).alias("_bx"), F.col(y).alias("_by"), *[F.col(c).alias(n) for c, n in keep.items()])
    near, far = packed.pack(spots, others.withColumns(packed.point_box("_bx", "_by")), by)
    columns = {c: c for c in ("_bx", "_by", *keep.values())}
    met = packed.candidates(near, far, packed.keep_within(radius), place, x, y, columns)
    d2 = geo.distance2(F.col(x), F.col(y), F.col("_bx"), F.col("_by"))
    pairs = met.where(d2 <= F.lit(float(radius)) * F.lit(float(radius))).withColumn("dist", F.sqrt(d2))
    return a.join(pairs.select(*place, *keep.values(), "dist"), place)


def count_within_radius(
    a: DataFrame,
    b: DataFrame,
    radius: float,
    measures: dict[str, Column],
    by: list[str] = (),
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """Sums over everything of ``b`` within ``radius`` of each row of ``a``, without listing crowded pairs.

    ``b`` is summed per coordinate. Its blocks and leaves that lie wholly inside the circles of a few places add their
    sum; only leaves that a circle cuts are compared point by point. ``measures`` names per-row values to add.
    """
    names = list(measures)
    place = [x, y, *by]
    spots = a.select(*place).where(F.col(x).isNotNull() & F.col(y).isNotNull()).distinct()
    located = b.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        *by, F.col(x).alias("_bx"), F.col(y).alias("_by"), *[c.alias(f"_m_{n}") for n, c in measures.items()]
    )
    stacked = located.groupBy(*by, "_bx", "_by").agg(*[F.sum(f"_m_{n}").alias(f"_m_{n}") for n in names])
    kinds = T.StructType([T.StructField(n, stacked.schema[f"_m_{n}"].dataType) for n in names])
    known = stacked.select(*by, "_bx", "_by", *[F.coalesce(f"_m_{n}", F.lit(0).cast(kinds[n].dataType)).alias(f"_m_{n}") for n in names])
    packed_ = blocks.pack(spots.withColumns(packed.point_box(x, y)), known.withColumns(packed.point_box("_bx", "_by")), by, [x, y], ("_bx", "_by"), narrow=True)
    kernel = blocks.counter(radius, "_bx", "_by", [f"_m_{n}" for n in names], [to_arrow_type(f.dataType) for f in kinds])
    totals = blocks.compare(packed_, blocks.pairs_within(packed_, radius), kernel, kinds)
    return a.join(totals, place, "left")


def values_within_radius(
    a: DataFrame,
    b: DataFrame,
    radius: float,
    value: str,
    out: str,
    by: list[str] = (),
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """The distinct values (in structs, so that null is one) of ``b`` within ``radius`` of each distinct place of ``a``, without listing pairs.

    Nodes of the tree of ``b`` carry their distinct values; a node is only opened while it may add another one. Meant for
    values of which there are few, as ratings.
    """
    place = [x, y, *by]
    spots = a.select(*place).where(F.col(x).isNotNull() & F.col(y).isNotNull()).distinct()
    located = b.select(*by, F.col(x).alias("_bx"), F.col(y).alias("_by"), F.col(value).alias("_value")).distinct()
    near, far = packed.pack(spots.withColumns(packed.point_box(x, y)), located.withColumns(packed.point_box("_bx", "_by")), by)
    one = F.struct(F.col("_value").alias("value"))
    far = packed.with_values(far, one)
    carry = {"_seen": F.array().cast(T.ArrayType(T.StructType([T.StructField("value", located.schema["_value"].dataType)])))}
    met = packed.candidates(near, far, packed.meet_within(radius), place, x, y, {c: c for c in ("_bx", "_by", "_value")}, carry)
    close = geo.distance2(F.col(x), F.col(y), F.col("_bx"), F.col("_by")) <= float(radius) * float(radius)
    return met.groupBy(*place).agg(F.array_union(F.first("_seen"), F.collect_set(F.when(close, one))).alias(out))


def nearest(
    points: DataFrame,
    segments: DataFrame,
    feature: list[str],
    by: list[str] = (),
    x: str = "x",
    y: str = "y",
    distance: str = "dist",
) -> DataFrame:
    """The nearest feature of each point, the lowest ``feature`` columns winning ties.

    ``segments`` has one row per edge (x1, y1, x2, y2; a point feature repeats its coordinate), the ``feature`` columns
    and the ``by`` keys. Every point of a populated ``by`` group has an answer, however far away; the rest get nulls.
    """
    place = [x, y, *by]
    spots = points.select(*place).distinct().withColumns(packed.point_box(x, y))
    ends = ["x1", "y1", "x2", "y2"]
    lines = segments.select(*by, *ends, *[F.col(f).alias(f"_f_{f}") for f in feature]).withColumns(packed.segment_box())
    met = blocks.pack(spots, lines, by, [x, y], ("x1", "y1"))
    kinds = [T.StructField(f"_f_{f}", lines.schema[f"_f_{f}"].dataType) for f in feature]
    kernel = blocks.nearest_row(ends, [f.name for f in kinds], [to_arrow_type(f.dataType) for f in kinds])
    found = blocks.compare(met, blocks.pairs_nearest(met), kernel, T.StructType([T.StructField("_d2", T.DoubleType()), *kinds]))
    best = found.groupBy(*place).agg(F.min(F.struct(F.col("_d2").alias("d2"), *[f"_f_{f}" for f in feature])).alias("_best"))
    answers = best.select(*place, F.sqrt("_best.d2").alias(distance), *[F.col(f"_best._f_{f}").alias(f) for f in feature])
    return points.join(answers, place, "left")


def point_segments(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Point features as zero-length segments."""
    return df.withColumns({"x1": F.col(x), "y1": F.col(y), "x2": F.col(x), "y2": F.col(y)})


def ring_segments(df: DataFrame, keep: list[str], rings: str = "rings") -> DataFrame:
    """One row per edge of lines or outlines."""
    return df.select(*keep, F.explode(geo.edges(F.col(rings))).alias("_e")).select(*keep, "_e.*")


def nearest_area(
    points: DataFrame,
    polygons: DataFrame,
    feature: list[str],
    size: float,
    by: list[str] = (),
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """Nearest polygon: distance 0 inside one, else the distance to the closest outline."""
    place = [x, y, *by]
    held = points_in_polygons(points.select(*place).distinct(), polygons, feature, size, "inner", by, x, y)
    held = held.groupBy(*place).agg(F.min(F.struct(*feature)).alias("_f"))
    inside = held.select(*place, F.lit(0.0).alias("dist"), *[F.col(f"_f.{f}").alias(f) for f in feature])
    inside = sized(stored(inside, "inside"))
    rest = points.select(*place).distinct().join(inside, place, "left_anti")
    outside = nearest(rest, ring_segments(polygons, [*by, *feature]), feature, by, x, y)
    return points.join(inside.unionByName(outside.select(*inside.columns)), place, "left")


def knn(
    a: DataFrame,
    b: DataFrame,
    id_col: str,
    k: int,
    radius: float,
    by: list[str] = (),
    x: str = "x",
    y: str = "y",
    need_all: bool = False,
) -> DataFrame:
    """Up to ``k`` nearest rows of ``b`` within ``radius`` for each row of ``a``: (id, by, neighbour, dist, rank).

    Neighbours that share x or y with the row are left out, as are the row's own copies. Distance ties go to the lower
    id. ``b`` is first cut to ``k`` ids per coordinate, which loses nothing. With ``need_all`` rows with fewer than
    ``k`` neighbours are left out.
    """
    place = [x, y, *by]
    spots = a.select(*place).distinct().withColumns(packed.point_box(x, y))
    located = b.select(F.col(id_col).alias("_neighbour"), *place).where(F.col(x).isNotNull() & F.col(y).isNotNull())
    lean = dedup_by_priority(located, place, [F.col("_neighbour")], k).select("_neighbour", *by, F.col(x).alias("_bx"), F.col(y).alias("_by"))
    near, far = packed.pack(spots, lean.withColumns(packed.point_box("_bx", "_by")), by, {"n": F.lit(1).cast("long")})
    met = packed.candidates(near, far, packed.keep_k_nearest(k, radius), place, x, y, {"_neighbour": "neighbour", "_bx": "_bx", "_by": "_by"})
    d2 = geo.distance2(F.col(x), F.col(y), F.col("_bx"), F.col("_by"))
    pairs = met.where((d2 <= float(radius) * float(radius)) & (F.col("_bx") != F.col(x)) & (F.col("_by") != F.col(y)))
    pairs = pairs.select(*place, "neighbour", F.sqrt(d2).alias("dist"))
    hits = dedup_by_priority(pairs, place, [F.col("dist"), F.col("neighbour")], k, rank="rank")
    if need_all:
        hits = hits.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*place))).where(F.col("_n") == k).drop("_n")
    return a.select(id_col, *place).join(hits, place).select(id_col, *by, "neighbour", "dist", "rank")


def knn_escalating(
    a: DataFrame, b: DataFrame, id_col: str, k: int, radii: list[float], by: list[str] = (), x: str = "x", y: str = "y"
) -> DataFrame:
    """kNN that needs all ``k`` neighbours, with the smallest of ``radii`` that holds them; rows without them in the largest are left out."""
    hits = knn(a, b, id_col, k, max(radii), by, x, y, need_all=True)
    last = F.max("dist").over(Window.partitionBy(id_col, *by))
    reach = F.coalesce(*[F.when(last <= r, F.lit(float(r))) for r in sorted(radii)])
    return hits.withColumn("radius", reach)


def neighbours_wide(pairs: DataFrame, id_col: str, k: int, by: list[str] = ()) -> DataFrame:
    """Neighbour ids and distances side by side."""
    cols = []
    for i in range(1, k + 1):
        cols.append(F.max(F.when(F.col("rank") == i, F.col("neighbour"))).alias(f"nearest_neighbor_{i}_{id_col}"))
        cols.append(F.max(F.when(F.col("rank") == i, F.col("dist"))).alias(f"nearest_neighbor_{i}_dist_ft"))
    return pairs.groupBy(id_col, *by).agg(*cols)


def raster_lookup(
    points: DataFrame, cells: DataFrame, size: float, value: str, default: float, x: str = "x", y: str = "y"
) -> DataFrame:
    """Value of the raster cell under each point; ``cells`` has cell_x, cell_y and the value."""
    gridded = points.withColumns({"cell_x": _cell(F.col(x), size), "cell_y": _cell(F.col(y), size)})
    joined = gridded.join(cells.select("cell_x", "cell_y", value), ["cell_x", "cell_y"], "left")
    return joined.withColumn(value, F.coalesce(F.col(value), F.lit(default))).drop("cell_x", "cell_y")


def layered(layers: dict[str, tuple[DataFrame, list[str]]], rings: str = "rings") -> DataFrame:
    """The polygons of several layers as one frame: rings, and each layer's columns as a struct of the layer's name, null for the others."""
    frames = [f.select(F.col(rings).alias("rings"), F.struct(*columns).alias(f"_of_{n}")) for n, (f, columns) in layers.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def most_recent_boundaries(
    points: DataFrame, layers: dict[str, tuple[DataFrame, list[str]]], size: float, x: str = "x", y: str = "y", year: str = "year"
) -> DataFrame:
    """Each layer's newest boundaries at every point; the layers need not share a newest year.

    All layers go through one join of the points. A point that several polygons of a layer hold has a row for each.
    """
    newest = {n: (f.where(F.col(year) == f.agg(F.max(year)).scalar()), columns) for n, (f, columns) in layers.items()}
    spots = points.select(x, y).where(F.col(x).isNotNull() & F.col(y).isNotNull()).distinct()
    held = points_in_polygons(spots, layered(newest), [f"_of_{n}" for n in layers], size, "inner", (), x, y)
    lists = held.groupBy(x, y).agg(*[F.collect_list(f"_of_{n}").alias(f"_of_{n}") for n in layers])
    out = points.join(lists, [x, y], "left")
    for n, (_, columns) in layers.items():
        out = out.withColumn(f"_of_{n}", F.explode_outer(f"_of_{n}"))
        out = out.withColumns({c: F.col(f"_of_{n}.{c}") for c in columns}).drop(f"_of_{n}")
    return out


def noise_decibels(distances: dict[str, tuple[str, float]], base: float = 50.0) -> dict[str, Column]:
    """Inverse-square falloff to decibels for each source, plus their total over a base level.

    ``distances`` maps a source name to (distance column, strength). Reference intensity: 1e-12.
    """
    out: dict[str, Column] = {}
    for name, (column, strength) in distances.items():
        output = F.lit(strength) / (F.col(column) * F.col(column))
        level = F.greatest(F.lit(0.0), 10 * F.log10(output / F.lit(1e-12)))
        out[f"{name}_dnl"] = F.when(F.col(column).isNotNull(), level)
    out["total_dnl"] = reduce(lambda p, q: p + q, list(out.values())) + F.lit(base)
    return out
