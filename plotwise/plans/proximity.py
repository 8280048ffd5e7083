"""Distances to, and counts of, things around parcels."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions import geometry as geo
from plotwise.operators.joins import asof_years
from plotwise.operators.spatial import (
    count_within_radius, knn, nearest, nearest_area, neighbours_wide, noise_decibels, point_segments, points_in_polygons,
    ring_segments, values_within_radius,
)
from plotwise.operators.yearfill import year_fill_crosswalk
from plotwise.plans.locations import SPOT, X, Y, filled_layers, parcel_rows, parcel_spots, with_rings
from plotwise.plans.warehouse import Warehouse, model
from plotwise.session import in_stages

# Source strengths and centres of the two airports in the noise falloff, and the radius of counts.
AIRPORT_STRENGTH = {"ohare": 0.00582564978995262, "midway": 0.00297149980129393}
AIRPORT_CENTRE = {"ohare": (1099852.0, 1935070.0), "midway": (1142843.0, 1864827.0)}
HALF_MILE_FT = 2640.0
UNIVERSITIES = (
    "Illinois Institute of Technology Chicago-Kent College of Law", "Columbia College",
    "University of Illinois at Chicago College of Medicine", "Rush University Medical Center", "University of Chicago",
    "University of Illinois at Chicago", "Northwestern University", "Loyola University of Chicago", "Chicago State University",
    "Moraine Valley Community College",
)
ROAD_ATTRIBUTES = ("daily_traffic", "speed_limit", "surface_type", "lanes")


def centre_points(df: DataFrame) -> DataFrame:
    """Point features with x and y, read from their shape where columns are missing."""
    if {"x", "y"} <= set(df.columns):
        return df
    rings = with_rings(df)
    return rings.withColumns({"x": F.col("rings")[0][0]["x"], "y": F.col("rings")[0][0]["y"]}).drop("rings")


@dataclass(frozen=True)
class Target:
    """What to measure the distance to: rows, the kind of shape, and output names of its attributes."""

    rows: Callable[[Warehouse], DataFrame]
    kind: str
    attributes: dict[str, Column | str]
    prefix: str = "nearest_"


def source(name: str, where: str | None = None) -> Callable[[Warehouse], DataFrame]:
    return lambda w: w.src(name).where(where) if where else w.src(name)


def large_parks(w: Warehouse) -> DataFrame:
    parks = with_rings(w.src("spatial.park"))
    return parks.where(geo.ring_area(F.col("rings")) > 87120)


def vacant_land(w: Warehouse) -> DataFrame:
    big = with_rings(w.src("spatial.parcel")).where(geo.ring_area(F.col("rings")) >= 1000)
    vacant = w.active("pardat").where("class = '100'").select(F.substring("parid", 1, 10).alias("pin10"), F.col("taxyr").alias("year"))
    return big.select("pin10", "year", F.col(X).alias("x"), F.col(Y).alias("y")).join(vacant.distinct(), ["pin10", "year"], "left_semi")


def new_construction(w: Warehouse) -> DataFrame:
    cards = w.ref("default.vw_card_res_char").select("pin10", "year", "char_yrblt")
    rows = w.src("spatial.parcel").select("pin10", "year", F.col(X).alias("x"), F.col(Y).alias("y")).join(cards, ["pin10", "year"])
    return rows.where(F.col("year").cast("int") <= F.col("char_yrblt").cast("int") + 3)


def roads(kinds: tuple[str, ...]) -> Callable[[Warehouse], DataFrame]:
    return lambda w: w.src("spatial.road").where(F.col("road_type").isin(*kinds))


def universities(w: Warehouse) -> DataFrame:
    rows = w.src("spatial.school_location")
    return rows.where(((F.col("type") == "HigherEd") & F.col("name").isin(*UNIVERSITIES)) | (F.col("gniscode") == 407022))


def _code(c: str) -> Column:
    return F.col(c).cast("long").cast("string")


def _transit(agency: str, route_type: int) -> str:
    return f"agency = '{agency}' AND route_type = {route_type}"


_ROAD = {"name": "road_name", **{a: a for a in ROAD_ATTRIBUTES}}
TARGETS: dict[str, Target] = {
    "bike_trail": Target(source("spatial.bike_trail"), "line", {"id": "street", "name": "name"}),
    "cemetery": Target(source("spatial.cemetery"), "area", {"gnis_code": "gniscode", "name": "name"}),
    "cta_route": Target(source("spatial.transit_route", _transit("cta", 1)), "line", {"id": "route_id", "name": "route_long_name"}),
    "cta_stop": Target(source("spatial.transit_stop", _transit("cta", 1)), "point", {"id": "stop_id", "name": "stop_name"}),
    "golf_course": Target(source("spatial.golf_course"), "area", {"id": "id"}),
    "grocery_store": Target(source("spatial.grocery_store"), "point", {"name": "name"}),
    "hospital": Target(source("spatial.hospital"), "area", {"gnis_code": "gniscode", "name": "name"}),
    "lake_michigan": Target(source("spatial.coastline"), "line", {}, prefix=""),
    "major_road": Target(source("spatial.major_road"), "line", {"osm_id": "osm_id", "name": "name"}),
    "metra_route": Target(source("spatial.transit_route", _transit("metra", 2)), "line", {"id": "route_id", "name": "route_long_name"}),
    "metra_stop": Target(source("spatial.transit_stop", _transit("metra", 2)), "point", {"id": "stop_id", "name": "stop_name"}),
    "new_construction": Target(new_construction, "point", {"pin10": "pin10", "char_yrblt": "char_yrblt"}),
    "park": Target(large_parks, "area", {"osm_id": "osm_id", "name": "name"}),
    "railroad": Target(source("spatial.railroad"), "line", {"id": "name_id", "name": "name_anno"}),
    "road_arterial": Target(roads(("Minor Arterial", "Other Principal Arterial")), "line", _ROAD),
    "road_collector": Target(roads(("Major Collector", "Minor Collector")), "line", _ROAD),
    "road_highway": Target(roads(("Interstate", "Freeway and Expressway")), "line", _ROAD),
    "secondary_road": Target(source("spatial.secondary_road"), "line", {"osm_id": "osm_id", "name": "name"}),
    "stadium": Target(lambda w: w.ref("spatial.stadium"), "point", {"name": "name"}),
    "university": Target(universities, "point", {"name": "name"}),
    "vacant_land": Target(vacant_land, "point", {"pin10": "pin10"}),
    "water": Target(source("spatial.hydrology"), "area", {"id": "id", "name": "name"}),
}


def distance_to(w: Warehouse, name: str) -> DataFrame:
    """Nearest target of the as-of year for each parcel and year."""
    target = TARGETS[name]
    stem = f"{target.prefix}{name}"
    rows = target.rows(w)
    columns = {f"{stem}_{n}": _code(c) if n == "gnis_code" else F.col(c) for n, c in target.attributes.items()}
    named = {n: c for n, c in columns.items()} or {"_any": F.lit(1)}
    walk = asof_years(rows, w.src("spatial.parcel"))
    # Places repeat in the years of one source year; each is searched for once.
    place = [X, Y, "source_year"]
    spots = parcel_spots(w).join(walk, "year").select(*place).distinct()
    shaped = centre_points(rows) if target.kind == "point" else with_rings(rows)
    keep = ["x", "y"] if target.kind == "point" else ["rings"]
    shapes = shaped.select(F.col("year").alias("source_year"), *keep, *[c.alias(n) for n, c in named.items()])
    cell, features = w.settings.cell_ft, list(named)
    if target.kind == "area":
        found = nearest_area(spots, shapes, features, cell, ["source_year"], X, Y)
    else:
        lines = point_segments(shapes).drop("x", "y") if target.kind == "point" else ring_segments(shapes, ["source_year", *features])
        found = nearest(spots, lines, features, ["source_year"], X, Y)
    found = found.where(F.col("dist").isNotNull())
    # a row for each place: neither side is broadcast
    rows = parcel_rows(w).join(walk, "year").join(found.hint("merge"), place).select(
        "year", "pin10", *columns, F.col("dist").alias(f"{stem}_dist_ft"), F.col("source_year").alias(f"{stem}_data_year")
    )
    # Of several places of a parcel in a year, the one with the shortest way; ties by the row's values.
    rest = F.struct(*[c for c in rows.columns if c not in ("pin10", "year")])
    chosen = rows.groupBy("pin10", "year").agg(F.min_by(rest, F.struct(F.col(f"{stem}_dist_ft"), rest)).alias("_row"))
    return chosen.select("pin10", "year", "_row.*").select(*rows.columns)


def _register(name: str) -> None:
    model(f"proximity.dist_pin_to_{name}")(lambda w: distance_to(w, name))


for _name in TARGETS:
    _register(_name)


@model("proximity.cnt_pin_num_bus_stop")
def cnt_pin_num_bus_stop(w: Warehouse) -> DataFrame:
    """Bus stops of the same year within half a mile; years without stops are not filled."""
    stops = centre_points(w.src("spatial.transit_stop").where("route_type = 3"))
    stops = stops.select("year", F.col("x").alias(X), F.col("y").alias(Y))
    rows = parcel_rows(w).where(F.col("year") >= stops.agg(F.min("year")).scalar())
    counted = count_within_radius(rows, stops, HALF_MILE_FT, {"_n": F.lit(1).cast("long")}, ["year"], X, Y)
    n = F.coalesce("_n", F.lit(0))
    return counted.select(
        "pin10", n.alias("num_bus_stop_in_half_mile"), F.when(n > 0, F.col("year")).alias("num_bus_stop_data_year"), "year"
    )


@model("proximity.cnt_pin_num_foreclosure")
def cnt_pin_num_foreclosure(w: Warehouse) -> DataFrame:
    """Foreclosures of the year and the five before it within half a mile, per 1,000 parcels there.

    Places and sales repeat in many years. Each place is searched once, with a sum for each year of sales and of parcels.
    """
    sales = centre_points(w.src("sale.foreclosure")).select(F.col("x").alias(X), F.col("y").alias(Y), F.year("foreclosure_recording_date").alias("_first"))
    parcels = parcel_rows(w)
    recorded = sorted(r[0] for r in sales.select("_first").where(F.col("_first").isNotNull()).distinct().collect())
    years = sorted(r[0] for r in parcels.select("year").where(F.col("year").isNotNull()).distinct().collect())
    things = sales.unionByName(parcels.select(X, Y, F.col("year").alias("_year")), allowMissingColumns=True)
    marks = {f"_f{i}": F.col("_first") == y for i, y in enumerate(recorded)} | {f"_p{i}": F.col("_year") == y for i, y in enumerate(years)}
    counted = count_within_radius(parcels, things, HALF_MILE_FT, {n: F.when(c, 1).otherwise(0).cast("long") for n, c in marks.items()}, [], X, Y) if marks else parcels

    def of_year(mark: str, reach: list[list[str]]) -> Column:
        """The sum of those marks whose years the row's year is one of."""
        return reduce(lambda a, b: a + b, [F.when(F.col("year").isin(*ys), F.coalesce(f"{mark}{i}", F.lit(0))).otherwise(0) for i, ys in enumerate(reach)], F.lit(0).cast("long"))

    counted = counted.withColumns({"_f": of_year("_f", [[str(y + k) for k in range(6)] for y in recorded]), "_p": of_year("_p", [[y] for y in years])})
    n = F.coalesce("_f", F.lit(0))
    rate = F.round(n.cast("double") / (F.nullif("_p", F.lit(0)).cast("double") / 1000), 2)
    return counted.select(
        "pin10", n.alias("num_foreclosure_in_half_mile_past_5_years"), F.coalesce(F.nullif("_p", F.lit(0)), F.lit(1)).alias("num_pin_in_half_mile"),
        rate.alias("num_foreclosure_per_1000_pin_past_5_years"), F.col("year").alias("num_foreclosure_data_year"), "year",
    )


@model("proximity.cnt_pin_num_school")
def cnt_pin_num_school(w: Warehouse) -> DataFrame:
    """Schools within half a mile: public ones of the parcel's own district, and all others, with mean rating."""
    schools = centre_points(w.src("other.great_schools_rating")).select(
        F.col("year").alias("source_year"), "rating", "type", "district_geoid", F.col("x").alias(X), F.col("y").alias(Y)
    )
    # Places repeat in the years of one source year; pairs of places and schools, which grow with both, are never listed.
    walk = asof_years(w.src("other.great_schools_rating"), w.src("spatial.parcel"))
    place = [X, Y, "source_year"]
    spots = parcel_spots(w).join(walk, "year").select(*place).distinct()
    districts = with_rings(w.src("spatial.school_district")).select(F.col("geoid").alias("district_geoid"), "rings")
    inside = points_in_polygons(spots.select(X, Y).distinct(), districts, ["district_geoid"], w.settings.cell_ft, "inner", (), X, Y)
    # Public schools of a district count once for each rating.
    public = values_within_radius(
        spots.join(inside.distinct(), [X, Y]), schools.where("type = 'public'"), HALF_MILE_FT, "rating", "_own", ["source_year", "district_geoid"], X, Y
    )
    own = public.groupBy(*place).agg(F.array_distinct(F.flatten(F.collect_list("_own"))).alias("_own"))
    measures = {"_n": F.lit(1).cast("long"), "_rated": F.col("rating").isNotNull().cast("long"), "_sum": F.col("rating").cast("double")}
    others = count_within_radius(spots, schools.where("type != 'public'"), HALF_MILE_FT, measures, ["source_year"], X, Y)
    both = others.join(own, place, "left").withColumn("_own", F.coalesce(F.transform("_own", lambda s: s["value"].cast("double")), F.array().cast("array<double>")))
    known = F.filter("_own", lambda r: r.isNotNull())
    stats = both.select(
        *place, (F.coalesce("_n", F.lit(0)) + F.size("_own")).alias("_n"), (F.coalesce("_rated", F.lit(0)) + F.size(known)).alias("_rated"),
        (F.coalesce("_sum", F.lit(0.0)) + F.aggregate(known, F.lit(0.0), lambda a, r: a + r)).alias("_sum"),
    )
    first = w.src("other.great_schools_rating").agg(F.min("year")).scalar()
    rows = parcel_rows(w).where(F.col("year") >= first).join(walk, "year", "left").join(stats.hint("merge"), place, "left")
    year = F.when(F.col("_n") > 0, F.col("source_year"))
    return rows.select(
        "pin10", F.coalesce("_n", F.lit(0)).alias("num_school_in_half_mile"),
        F.coalesce("_rated", F.lit(0)).alias("num_school_with_rating_in_half_mile"),
        F.when(F.col("_rated") > 0, F.col("_sum") / F.col("_rated")).alias("avg_school_rating_in_half_mile"),
        year.alias("num_school_data_year"), year.alias("num_school_rating_data_year"), "year",
    )


@model("proximity.dist_pin_to_airport")
def dist_pin_to_airport(w: Warehouse) -> DataFrame:
    rows = parcel_rows(w).where(F.col(X).isNotNull() & F.col(Y).isNotNull())
    for name, (cx, cy) in AIRPORT_CENTRE.items():
        rows = rows.withColumn(f"airport_{name}_dist_ft", geo.distance(F.col(X), F.col(Y), F.lit(cx), F.lit(cy)))
    levels = noise_decibels({n: (f"airport_{n}_dist_ft", s) for n, s in AIRPORT_STRENGTH.items()})
    names = {"ohare_dnl": "airport_dnl_ohare", "midway_dnl": "airport_dnl_midway", "total_dnl": "airport_dnl_total"}
    return rows.withColumns({names[n]: c for n, c in levels.items()}).withColumn("airport_data_year", F.lit("2019")).drop(X, Y)


def neighbours(w: Warehouse, waiting: DataFrame, radius: float) -> DataFrame:
    """The three nearest parcels within a radius, for parcels that have all three."""
    everyone = parcel_rows(w)
    pairs = knn(waiting, everyone, "pin10", 3, radius, ["year"], X, Y, need_all=True)
    return neighbours_wide(pairs, "pin10", 3, ["year"])


def still_without(w: Warehouse, *done: str) -> DataFrame:
    rows = parcel_rows(w)
    for name in done:
        rows = rows.join(w.ref(name), ["pin10", "year"], "left_anti")
    return rows


STEPS = {"01": 100.0, "02": 500.0, "03": 10_000.0}


def _register_step(step: str) -> None:
    before = [f"proximity.dist_pin_to_pin_{s}" for s in STEPS if s < step]
    model(f"proximity.dist_pin_to_pin_{step}")(lambda w: neighbours(w, still_without(w, *before), STEPS[step]))


for _step in STEPS:
    _register_step(_step)


@model("proximity.dist_pin_to_pin")
def dist_pin_to_pin(w: Warehouse) -> DataFrame:
    return reduce(DataFrame.unionByName, [w.ref(f"proximity.dist_pin_to_pin_{s}") for s in STEPS]).distinct()


DISTANCE_FIELDS = {
    "cnt_pin_num_bus_stop": ["num_bus_stop"], "cnt_pin_num_foreclosure": ["num_foreclosure"],
    "cnt_pin_num_school": ["num_school", "num_school_rating"], "dist_pin_to_airport": ["airport"],
    **{f"dist_pin_to_{n}": [f"{t.prefix}{n}"] for n, t in TARGETS.items()},
}
# Columns that the wide tables leave out.
NOT_WIDE = ("airport_dnl_ohare", "airport_dnl_midway")


# Longest first: these wait for tables of other models, or search in steps.
SLOW = ("dist_pin_to_new_construction", "dist_pin_to_pin", "cnt_pin_num_school", "cnt_pin_num_foreclosure")


def prepare_distances(w: Warehouse, names: Iterable[str]) -> None:
    w.prepare(f"proximity.{n}" for n in sorted(names, key=lambda n: n not in SLOW))


@model("proximity.crosswalk_year_fill")
def crosswalk_year_fill(w: Warehouse) -> DataFrame:
    prepare_distances(w, DISTANCE_FIELDS)
    layers = {n: (w.ref(f"proximity.{n}"), fields) for n, fields in DISTANCE_FIELDS.items()}
    return year_fill_crosswalk(w.src("spatial.parcel"), layers)


@model("proximity.vw_pin10_proximity")
def vw_pin10_proximity(w: Warehouse) -> DataFrame:
    prepare_distances(w, [*DISTANCE_FIELDS, "dist_pin_to_pin"])
    layers = [w.ref(f"proximity.{n}").drop(*NOT_WIDE) for n in (*DISTANCE_FIELDS, "dist_pin_to_pin")]
    joins = [lambda rows, layer=layer: rows.join(layer, ["pin10", "year"], "left") for layer in layers]
    return in_stages(w.src("spatial.parcel").select("pin10", "year"), joins, "pin10", "year")


@model("proximity.vw_pin10_proximity_fill")
def vw_pin10_proximity_fill(w: Warehouse) -> DataFrame:
    fields = {k: v[:1] for k, v in DISTANCE_FIELDS.items()}
    prepare_distances(w, [*DISTANCE_FIELDS, "dist_pin_to_pin"])
    rows = filled_layers(w, "proximity", fields, "proximity.crosswalk_year_fill")
    # Both school fields come from one table and share its first field's row.
    rows = rows.drop("num_school_rating_data_year").withColumn("num_school_rating_data_year", F.col("num_school_data_year"))
    rows = rows.join(w.ref("proximity.dist_pin_to_pin"), ["pin10", "year"], "left")
    return rows.drop(*NOT_WIDE, *[f"{f}_fill_year" for names in DISTANCE_FIELDS.values() for f in names])
