"""Which areas hold each parcel: census, political, economic, school, tax and other layers."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions import geometry as geo
from plotwise.functions.logic import known_true
from plotwise.functions.text import alnum_only
from plotwise.operators.joins import asof_years, clamp_year_join
from plotwise.operators.spatial import nearest_area, points_in_polygons
from plotwise.operators.yearfill import fill_join, year_fill_crosswalk
from plotwise.plans.parcels import parcel_base, plain_parcel_id
from plotwise.plans.warehouse import Warehouse, attach, model
from plotwise.session import stored

X, Y = "x_3435", "y_3435"
SPOT = [X, Y, "year"]


def whole_text(c: str) -> Column:
    """A number without decimals, as text."""
    return F.col(c).cast("int").cast("string")


def with_rings(df: DataFrame) -> DataFrame:
    """Parse the shape bytes once per feature, unless rings are there already."""
    return df if "rings" in df.columns else df.withColumn("rings", geo.rings_from_wkb("geometry_3435"))


def parcel_rows(w: Warehouse) -> DataFrame:
    return w.src("spatial.parcel").select("pin10", *SPOT)


def parcel_spots(w: Warehouse) -> DataFrame:
    """Distinct coordinates per year; parcels share and repeat theirs."""
    return w.src("spatial.parcel").select(*SPOT).distinct()


@dataclass(frozen=True)
class Layer:
    """A polygon layer, what to take from it, and the name of its data year."""

    source: str
    take: dict[str, Column] = field(hash=False)
    data_year: str
    where: str | None = None


def read_layer(w: Warehouse, layer: Layer) -> DataFrame:
    rows = w.src(layer.source)
    return rows.where(layer.where) if layer.where else rows


def layer_hits(w: Warehouse, layers: list[Layer]) -> DataFrame:
    """Values of each layer's as-of year at each parcel spot and year.

    All layers are one frame of polygons, tagged by layer and year, that the parcels' places meet in one join; one
    crosswalk then says for which years a hit counts, and one aggregate puts the layers side by side.
    """
    rows = [read_layer(w, layer) for layer in layers]
    tag = lambda i: F.lit(i).alias("_layer")
    sources = reduce(DataFrame.unionByName, [r.select(tag(i), "year") for i, r in enumerate(rows)])
    years = w.src("spatial.parcel").select("year").distinct()
    years = years.select(F.explode(F.array(*[F.lit(i) for i in range(len(layers))])).alias("_layer"), "year")
    # a row per layer and year: small, and read twice
    walk = stored(asof_years(sources, years, by=["_layer"]), "layer-years")
    shapes = [
        with_rings(r).select(tag(i), F.col("year").alias("source_year"), "rings", *[c.alias(n) for n, c in layer.take.items()])
        for i, (r, layer) in enumerate(zip(rows, layers))
    ]
    polygons = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shapes)
    used = polygons.join(walk.select("_layer", "source_year").distinct(), ["_layer", "source_year"], "left_semi")
    taken = [n for layer in layers for n in layer.take]
    places = w.src("spatial.parcel").select(X, Y).distinct()
    held = points_in_polygons(places, used, ["_layer", "source_year", *taken], w.settings.cell_ft, "inner", (), X, Y)
    sides = []
    for i, layer in enumerate(layers):
        sides += [F.max(n).alias(n) for n in layer.take]
        sides.append(F.max(F.when(F.col("_layer") == i, F.col("source_year"))).alias(layer.data_year))
    return held.join(walk, ["_layer", "source_year"]).groupBy(*SPOT).agg(*sides)


def first_year(w: Warehouse, layers: list[Layer]) -> Column:
    years = reduce(DataFrame.unionByName, [read_layer(w, y).select("year") for y in layers])
    return years.agg(F.min("year")).scalar()


def located(w: Warehouse, layers: list[Layer], since: Column | None = None) -> DataFrame:
    """Parcel rows with the values of several layers, from the first year of any layer on."""
    rows = parcel_rows(w).where(F.col("year") >= (first_year(w, layers) if since is None else since))
    return rows.join(layer_hits(w, layers), SPOT, "left").drop(X, Y)


def city_layers() -> list[Layer]:
    return [
        Layer("spatial.police_district", {"chicago_police_district_num": whole_text("pd_num")}, "chicago_police_district_data_year"),
        Layer(
            "spatial.community_area",
            {"chicago_community_area_num": whole_text("area_number"), "chicago_community_area_name": F.col("community")},
            "chicago_community_area_data_year",
        ),
        Layer(
            "spatial.industrial_corridor",
            {"chicago_industrial_corridor_num": whole_text("num"), "chicago_industrial_corridor_name": F.col("name")},
            "chicago_industrial_corridor_data_year",
        ),
    ]


def economy_layers() -> list[Layer]:
    plain = {
        "coordinated_care": ("econ_coordinated_care_area", "cc_num"),
        "enterprise_zone": ("econ_enterprise_zone", "ez_num"),
        "industrial_growth_zone": ("econ_industrial_growth_zone", "igz_num"),
        "qualified_opportunity_zone": ("econ_qualified_opportunity_zone", "geoid"),
        "central_business_district": ("econ_central_business_district", "cbd_num"),
    }
    return [Layer(f"spatial.{s}", {f"{n}_num": F.col(c)}, f"{n}_data_year") for s, (n, c) in plain.items()]


def political_layers() -> list[Layer]:
    districts = [
        Layer(f"spatial.{n}", {f"county_{n}_num": whole_text(f"{n}_num")}, f"county_{n}_data_year")
        for n in ("board_of_review_district", "commissioner_district", "judicial_district")
    ]
    town = Layer(
        "spatial.municipality",
        {"county_municipality_num": F.col("municipality_num"), "county_municipality_name": F.upper("municipality_name")},
        "county_municipality_data_year",
    )
    wards = [
        Layer(
            "spatial.ward", {f"_{c}_num": F.col("ward_num").cast("string"), f"_{c}_name": F.col("ward_name")},
            f"ward_{c}_data_year", f"ward_name LIKE '{c[0]}%'",
        )
        for c in ("chicago", "evanston")
    ]
    return [*districts, town, *wards]


@model("location.chicago")
def chicago(w: Warehouse) -> DataFrame:
    return located(w, city_layers())


@model("location.economy")
def economy(w: Warehouse) -> DataFrame:
    return located(w, economy_layers())


@model("location.political")
def political(w: Warehouse) -> DataFrame:
    rows = located(w, political_layers())
    ward = {f"ward_{p}": F.coalesce(f"_evanston_{p}", f"_chicago_{p}") for p in ("num", "name")}
    return rows.withColumns(ward).drop(*[f"_{c}_{p}" for c in ("chicago", "evanston") for p in ("num", "name")])


@model("location.access")
def access(w: Warehouse) -> DataFrame:
    number = F.col("walk_num").cast("long").cast("string")
    take = {
        "access_cmap_walk_id": number, "access_cmap_walk_nta_score": F.col("nta_score"),
        "access_cmap_walk_total_score": F.col("total_score"),
    }
    return located(w, [Layer("spatial.walkability", take, "access_cmap_walk_data_year")])


@model("location.other")
def other(w: Warehouse) -> DataFrame:
    layer = Layer("spatial.subdivision", {"misc_subdivision_id": F.col("pagesubref")}, "misc_subdivision_data_year")
    return located(w, [layer], F.lit("2014"))  # rows start with the fixed first year of the zone layers


# Census geographies that parcels are placed in.
GEOGRAPHIES = (
    "block_group", "block", "congressional_district", "county_subdivision", "place", "puma", "school_district_elementary",
    "school_district_secondary", "school_district_unified", "state_representative", "state_senate", "tract", "zcta",
)
SURVEY_GEOGRAPHIES = tuple(g for g in GEOGRAPHIES if g not in ("block_group", "block", "zcta"))


def same_year_hits(w: Warehouse, polygons: DataFrame, spots: DataFrame, take: dict[str, Column]) -> DataFrame:
    """Values at spots from polygons of the spot's ``data_year``."""
    shapes = with_rings(polygons).select(F.col("year").alias("data_year"), "rings", *[c.alias(n) for n, c in take.items()])
    held = points_in_polygons(spots, shapes, list(take), w.settings.cell_ft, "inner", ["data_year"], X, Y)
    return held.groupBy(X, Y, "data_year").agg(*[F.max(n).alias(n) for n in take])


def by_kind(kinds: tuple[str, ...], kind: str, values: dict[str, str]) -> dict[str, Column]:
    """One column per kind and value: ``{name pattern with {kind}: column}``."""
    return {
        pattern.format(kind=k): F.when(F.col(kind) == k, F.col(c)) for k in kinds for pattern, c in values.items()
    }


@model("location.census")
def census(w: Warehouse) -> DataFrame:
    areas = w.src("spatial.census")
    take = by_kind(GEOGRAPHIES, "geography", {"census_{kind}_geoid": "geoid"})
    spots = parcel_spots(w).withColumnRenamed("year", "data_year")
    hits = same_year_hits(w, areas, spots, take).withColumn("year", F.col("data_year"))
    rows = parcel_rows(w).where(F.col("year") >= areas.agg(F.min("year")).scalar())
    return rows.join(hits, SPOT, "left").withColumnRenamed("data_year", "census_data_year").drop(X, Y)


@model("location.census_2020")
def census_2020(w: Warehouse) -> DataFrame:
    """Areas of the newest small-area geography at every parcel, whatever its year."""
    areas = w.src("spatial.census").where("year = '2022'")
    take = by_kind(GEOGRAPHIES, "geography", {"census_{kind}_geoid": "geoid"})
    spots = parcel_spots(w).select(X, Y).distinct().withColumn("data_year", F.lit("2022"))
    hits = same_year_hits(w, areas, spots, take)
    return parcel_rows(w).join(hits, [X, Y], "left").withColumnRenamed("data_year", "census_data_year").drop(X, Y)


@model("location.census_acs5")
def census_acs5(w: Warehouse) -> DataFrame:
    survey = w.src("census.acs5")
    areas = w.src("spatial.census")
    known = areas.where(F.col("year") <= survey.agg(F.max("year")).scalar())
    take = by_kind(SURVEY_GEOGRAPHIES, "geography", {"census_acs5_{kind}_geoid": "geoid"})
    walk = asof_years(survey, w.src("spatial.parcel")).withColumnRenamed("source_year", "data_year")
    spots = parcel_spots(w).join(walk, "year").select(X, Y, "data_year").distinct()
    hits = same_year_hits(w, known, spots, take).withColumnRenamed("data_year", "census_acs5_data_year")
    rows = parcel_rows(w).where(F.col("year") >= areas.agg(F.min("year")).scalar())
    rows = rows.join(walk.withColumnRenamed("data_year", "_d"), "year", "left")
    return rows.join(hits.withColumn("_d", F.col("census_acs5_data_year")), [X, Y, "_d"], "left").drop(X, Y, "_d")


@model("location.school")
def school(w: Warehouse) -> DataFrame:
    areas = w.src("spatial.school_district")
    values = {"school_{kind}_district_geoid": "geoid", "school_{kind}_district_name": "name"}
    take = by_kind(("elementary", "secondary", "unified"), "district_type", values)
    spots = parcel_spots(w).withColumnRenamed("year", "data_year")
    hits = same_year_hits(w, areas, spots, take).withColumn("year", F.col("data_year"))
    first = areas.where("geoid IS NOT NULL").agg(F.min("year")).scalar()
    rows = parcel_rows(w).where(F.col("year") >= first).join(hits, SPOT, "left").drop(X, Y)
    label = F.concat((F.col("data_year").cast("int") - 1).cast("string"), F.lit(" - "), F.col("data_year"))
    return rows.withColumn("school_school_year", label).withColumnRenamed("data_year", "school_data_year")


@model("location.environment")
def environment(w: Warehouse) -> DataFrame:
    flood = Layer("spatial.flood_fema", {"env_flood_fema_sfha": F.col("fema_special_flood_hazard_area")}, "env_flood_fema_data_year")
    contour = w.src("spatial.ohare_noise_contour")
    walk = asof_years(contour, w.src("spatial.parcel"))
    spots = parcel_spots(w).join(walk, "year")
    shapes = with_rings(contour).select(F.col("year").alias("source_year"), "airport", "rings")
    near = nearest_area(spots, shapes, ["airport"], w.settings.cell_ft, ["source_year"], X, Y)
    near = near.select(
        *SPOT, F.when(F.col("dist") == 0, True).alias("env_ohare_noise_contour_no_buffer_bool"),
        F.when(F.col("dist") <= 2640, True).alias("env_ohare_noise_contour_half_mile_buffer_bool"),
        F.col("source_year").alias("env_ohare_noise_contour_data_year"),
    ).distinct()
    noise, first_street = w.src("other.airport_noise"), w.src("other.flood_first_street")
    sources = [read_layer(w, flood), contour, first_street, noise.where("year != 'omp'")]
    years = reduce(DataFrame.unionByName, [s.select("year") for s in sources]).agg(F.min("year")).scalar()
    rows = parcel_rows(w).where(F.col("year") >= years)
    rows = rows.join(layer_hits(w, [flood]), SPOT, "left").join(near, SPOT, "left").drop(X, Y)
    scores = first_street.select(
        "pin10", F.col("year").alias("env_flood_fs_data_year"), F.col("fs_flood_factor").alias("env_flood_fs_factor"),
        F.col("fs_flood_risk_direction").alias("env_flood_fs_risk_direction"),
    )
    keys = rows.select("pin10", "year").distinct().join(scores, "pin10").where(F.col("year") >= F.col("env_flood_fs_data_year"))
    rows = rows.join(keys, ["pin10", "year"], "left")
    rows = attach(rows, noise.where("year != 'omp'"), ["pin10", "year"], {"airport_noise_dnl": "_before"})
    rows = attach(rows, noise.where("year = 'omp'"), ["pin10"], {"airport_noise_dnl": "_after"})
    old = F.col("year") <= "2020"
    return rows.withColumns(
        {
            "env_airport_noise_dnl": F.when(old, F.col("_before")).otherwise(F.col("_after")),
            "env_airport_noise_data_year": F.when(old, F.when(F.col("_before").isNotNull(), F.col("year"))).otherwise("omp"),
        }
    ).drop("_before", "_after")


# Agency types and the column they fill.
AGENCY_TYPES = {
    "MUNI": "municipality", "ELEMENTARY": "school_elementary_district", "SECONDARY": "school_secondary_district",
    "UNIFIED": "school_unified_district", "COMM COLL": "community_college_district", "FIRE": "fire_protection_district",
    "LIBRARY": "library_district", "PARK": "park_district", "SANITARY": "sanitation_district", "SSA": "special_service_area",
    "TIF": "tif_district",
}
# One township levies like a municipality and counts as one.
TOWN_AS_MUNICIPALITY = ("TOWN CICERO", "TOWN OF CICERO")


@model("location.tax")
def tax(w: Warehouse) -> DataFrame:
    """Agencies of each tax code as sorted arrays by type.

    Arrays are built per tax code and year, of which there are few, and then joined to the parcels.
    """
    agencies = w.src("tax.tax_code").select("year", F.col("tax_code_num").alias("tax_code"), "agency_num").distinct()
    agencies = attach(agencies, w.src("tax.agency_info"), ["agency_num"], ["agency_name", "minor_type"])
    as_town = (F.col("minor_type") == "TOWNSHIP") & (F.col("agency_name") == TOWN_AS_MUNICIPALITY[0])
    kind = F.when(known_true(as_town), "MUNI").otherwise(F.col("minor_type"))
    name = F.when(known_true(as_town), TOWN_AS_MUNICIPALITY[1]).otherwise(F.col("agency_name"))
    agencies = agencies.withColumns({"minor_type": kind, "agency_name": name})

    def members(code: str, column: str) -> Column:
        pairs = F.array_sort(F.collect_list(F.when(F.col("minor_type") == code, F.struct("agency_num", "agency_name"))))
        return F.transform(pairs, lambda p: p[column])

    arrays = [
        members(code, f"agency_{part}").alias(f"tax_{n}_{part}") for code, n in AGENCY_TYPES.items() for part in ("num", "name")
    ]
    kept = agencies.where(F.col("minor_type").isin(*AGENCY_TYPES) | (F.col("minor_type") == "TOWNSHIP"))
    wide = kept.groupBy("tax_code", "year").agg(*arrays)
    parcels = w.src("spatial.parcel").select("pin10", "year", "tax_code")
    per_parcel = parcels.join(wide, ["tax_code", "year"]).drop("tax_code").withColumn("tax_data_year", F.col("year"))
    rows = clamp_year_join(parcels.select("pin10", "year"), per_parcel, ["pin10"], "year")
    return rows.where(F.col("year") >= per_parcel.agg(F.min("year")).scalar()).drop("source_year")


LAYER_FIELDS = {
    "census": ["census"],
    "census_acs5": ["census_acs5"],
    "political": [
        "county_board_of_review_district", "county_commissioner_district", "county_judicial_district", "county_municipality",
        "ward_chicago", "ward_evanston",
    ],
    "chicago": ["chicago_community_area", "chicago_industrial_corridor", "chicago_police_district"],
    "economy": [
        "econ_coordinated_care_area", "econ_enterprise_zone", "econ_industrial_growth_zone",
        "econ_qualified_opportunity_zone", "econ_central_business_district",
    ],
    "environment": ["env_flood_fema", "env_flood_fs", "env_ohare_noise_contour", "env_airport_noise"],
    "school": ["school"],
    "tax": ["tax"],
    "access": ["access_cmap_walk"],
    "other": ["misc_subdivision"],
}


def combined_municipality(w: Warehouse, rows: DataFrame) -> DataFrame:
    """The taxing municipalities, else the mapped one, as an array; unincorporated places have an empty one."""
    rows = attach(
        rows, w.src("location.municipality_crosswalk"), {"county_municipality_name": "county_municipality_name"},
        {"tax_municipality_name": "_mapped"},
    )
    place = F.col("county_municipality_name")
    fallback = F.when(place == "UNINCORPORATED", F.array().cast("array<string>")).when(
        place.isNotNull(), F.array(F.coalesce("_mapped", place))
    )
    return rows.withColumn("combined_municipality_name", F.coalesce("tax_municipality_name", fallback)).drop("_mapped")


@model("location.vw_pin10_location")
def vw_pin10_location(w: Warehouse) -> DataFrame:
    rows = w.src("spatial.parcel").select("pin10", "year")
    for layer in LAYER_FIELDS:
        rows = rows.join(w.ref(f"location.{layer}"), ["pin10", "year"], "left")
    return combined_municipality(w, rows)


@model("location.crosswalk_year_fill")
def crosswalk_year_fill(w: Warehouse) -> DataFrame:
    layers = {n: (w.ref(f"location.{n}"), fields) for n, fields in LAYER_FIELDS.items()}
    return year_fill_crosswalk(w.src("spatial.parcel"), layers)


def field_columns(frame: DataFrame, field_name: str, fields: list[str]) -> list[str]:
    """Columns that belong to a field: by its prefix, or all of them where a layer has one field."""
    if len(fields) == 1:
        return [c for c in frame.columns if c not in ("pin10", "year", f"{field_name}_data_year")]
    return [c for c in frame.columns if c.startswith(field_name) and c != f"{field_name}_data_year"]


def filled_layers(w: Warehouse, schema: str, all_fields: dict[str, list[str]], crosswalk: str) -> DataFrame:
    layers = {}
    w.prepare(f"{schema}.{n}" for n in all_fields)
    for name, fields in all_fields.items():
        frame = w.ref(f"{schema}.{name}")
        layers[name] = (frame, {f: field_columns(frame, f, fields) for f in fields})
    base = w.src("spatial.parcel").select("pin10", "year")
    return fill_join(base, w.ref(crosswalk), layers)


@model("location.vw_pin10_location_fill")
def vw_pin10_location_fill(w: Warehouse) -> DataFrame:
    rows = filled_layers(w, "location", LAYER_FIELDS, "location.crosswalk_year_fill")
    ward = w.ref("location.political").select("pin10", "year", "ward_num", "ward_name", "ward_chicago_data_year", "ward_evanston_data_year")
    for city in ("chicago", "evanston"):
        known = ward.where(F.col(f"ward_{city}_data_year").isNotNull())
        names = {p: f"_{city}_{p}" for p in ("ward_num", "ward_name")}
        rows = attach(rows, known, {"pin10": "pin10", f"ward_{city}_fill_year": "year"}, names)
    for part in ("ward_num", "ward_name"):
        rows = rows.withColumn(part, F.coalesce(f"_chicago_{part}", f"_evanston_{part}")).drop(f"_chicago_{part}", f"_evanston_{part}")
    plan = F.col("env_airport_noise_data_year") == "omp"
    noise_year = F.when(plan, F.col("env_airport_noise_fill_year")).otherwise(F.col("env_airport_noise_data_year"))
    rows = rows.withColumn("env_airport_noise_data_year", noise_year)
    return combined_municipality(w, rows).drop(*[f"{f}_fill_year" for names in LAYER_FIELDS.values() for f in names])


# District numbers are cut out of longer ids at fixed places.
DISTRICT_DIGITS = {"congressional_district": 3, "state_representative": 4, "state_senate": 4}


@model("default.vw_pin_universe")
def vw_pin_universe(w: Warehouse) -> DataFrame:
    par = parcel_base(w, drop_test_class=True).where(plain_parcel_id(F.col("parid")))
    par = attach(par, w.active("legdat"), {"parid": "parid", "taxyr": "taxyr"}, {"taxdist": "tax_code", "zip1": "_zip"})
    par = par.select(
        F.col("parid").alias("pin"), F.substring("parid", 1, 10).alias("pin10"), F.col("taxyr").alias("year"),
        alnum_only("class").alias("class"), "township_code", F.regexp_replace("nbhd", "[^0-9]", "").alias("nbhd_code"),
        "tax_code", F.nullif("_zip", F.lit("00000")).alias("zip_code"),
    )
    places = w.src("spatial.parcel").select("pin10", "year", "lon", "lat", X, Y)
    rows = clamp_year_join(par, places, ["pin10"], "year")
    areas = w.ref("location.vw_pin10_location").withColumnRenamed("year", "source_year")
    rows = rows.join(areas, ["pin10", "source_year"], "left").drop("source_year")
    towns = w.src("spatial.township").withColumn("township_code", F.col("township_code").cast("string"))
    rows = attach(rows, towns, ["township_code"], ["triad_name", "triad_code", "township_name"])
    digits = {
        f"{p}_{g}_num": F.substring(f"{p}_{g}_geoid", at, 2) for p in ("census", "census_acs5") for g, at in DISTRICT_DIGITS.items()
    }
    return rows.withColumns(digits)

