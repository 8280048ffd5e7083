"""Inputs of the valuation models, their final runs and their training data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions.logic import decode, json_list, known_true
from plotwise.functions.text import alnum_only
from plotwise.operators.grouped import approx_quantile
from plotwise.operators.joins import asof_years, clamp_year_join, neighbour_fill, upto_year_join
from plotwise.operators.ordered import lag_known, streak
from plotwise.plans.census import COUNTS, SHARES
from plotwise.plans.locations import X, Y
from plotwise.plans.parcels import corner_lot_flags, parcel_base
from plotwise.plans.predictors import PREDICTORS
from plotwise.plans.warehouse import Warehouse, attach, model
from plotwise.sources.writers import incremental_new


@model("model.final_model")
def final_model(w: Warehouse) -> DataFrame:
    dates = {c: F.to_date(c, "M/d/yyyy") for c in ("date_chosen", "date_emailed", "date_finalized")}
    rows = w.src("model.final_model_raw").withColumns(dates)
    return rows.withColumns(
        {
            "triad_code": decode("triad_name", {"City": "1", "North": "2", "South": "3"}),
            "township_code_coverage": json_list("township_code_coverage"),
        }
    ).drop("triad_name")


@model("model.training_data")
def training_data(w: Warehouse) -> DataFrame:
    """Training rows of final runs that the stored table does not hold yet.

    The source "model.training_set" has the rows of all runs, tagged with their run id (see
    ``sources.readers.tagged_files``); "model.training_data_stored" is what was written before, if anything.
    """
    runs = w.src("model.metadata").select("run_id", "assessment_year").join(
        w.ref("model.final_model").select("run_id").distinct(), "run_id", "left_semi"
    )
    stored = w.src("model.training_data_stored") if "model.training_data_stored" in w.sources else None
    new = incremental_new(runs, stored, "run_id")
    rows = w.src("model.training_set").drop("assessment_year").join(new, "run_id")
    flag = "assr_is_active_exe_homeowner"
    return rows.withColumn(flag, F.col(flag).cast("boolean")) if flag in rows.columns else rows


def housing_index(w: Warehouse) -> DataFrame:
    """Mean quarterly price index of a parcel's statistical area by year.

    The index is averaged per area first; parcels of an area share it.
    """
    areas = w.ref("location.census_2020").select("pin10", "census_puma_geoid").distinct()
    index = w.src("other.ihs_index").groupBy("geoid", "year").agg(
        F.avg(F.col("ihs_index").cast("double")).alias("other_ihs_avg_year_index")
    )
    return areas.join(index, areas["census_puma_geoid"] == index["geoid"]).select("pin10", "year", "other_ihs_avg_year_index")


def distress_index(w: Warehouse) -> DataFrame:
    """Distress score of the postal area for every parcel year from the score's year on."""
    parcels = w.ref("location.census").select("pin10", "year", F.col("census_zcta_geoid").alias("geoid"))
    score = w.src("other.dci").select("geoid", "year", F.col("dci").alias("other_distressed_community_index"))
    # Area and year are few; their pairs are formed before parcels come in.
    areas = upto_year_join(parcels.select("geoid", "year").distinct(), score, ["geoid"])
    return parcels.join(areas.drop("source_year"), ["geoid", "year"]).drop("geoid")


def affordability_index(w: Warehouse) -> DataFrame:
    """Risk score of the tract from the earliest index year not before the survey year."""
    parcels = w.ref("location.census_acs5").select("pin10", "year", F.col("census_acs5_tract_geoid").alias("geoid"))
    index = w.src("other.ari").select("geoid", F.col("year").alias("source_year"), F.col("ari_score").alias("other_affordability_risk_index"))
    walk = asof_years(w.src("other.ari"), parcels, direction="forward")
    return parcels.join(walk.join(index, "source_year").drop("source_year"), ["geoid", "year"]).drop("geoid")


def tax_bills(w: Warehouse) -> DataFrame:
    parcels = w.active("pardat", drop_test_class=True).select(F.col("parid").alias("pin"), F.col("taxyr").alias("year"))
    bills = w.src("tax.pin").select("pin", "year", F.col("tax_bill_total").alias("other_tax_bill_amount_total"), "tax_code_num")
    rows = clamp_year_join(parcels, bills, ["pin"], "year").where("tax_code_num IS NOT NULL OR other_tax_bill_amount_total IS NOT NULL")
    rates = w.src("tax.tax_code").select("year", "tax_code_num", "tax_code_rate").distinct()
    keys = {"source_year": "year", "tax_code_num": "tax_code_num"}
    return attach(rows, rates, keys, {"tax_code_rate": "other_tax_bill_rate"}).drop("source_year", "tax_code_num")


def exemption_streaks(w: Warehouse) -> DataFrame:
    """Whether the homeowner exemption is active, and for how many years on end."""
    amount = F.col("exe_homeowner")
    rows = w.src("tax.pin").select("pin", "year", "exe_homeowner")
    rows = streak(rows, ["pin"], ["year"], amount != 0, "assr_n_years_exe_homeowner")
    return rows.withColumn("assr_is_active_exe_homeowner", F.signum(amount.cast("double"))).drop("exe_homeowner")


# Columns that other tables bring in, under the model's names.
LOCATION_COLUMNS = [
    "census_puma_geoid", "census_tract_geoid", "census_data_year", "census_acs5_puma_geoid", "census_acs5_tract_geoid",
    "census_acs5_data_year", "tax_municipality_name", "ward_num", "chicago_community_area_name",
    "school_unified_district_geoid", "tax_special_service_area_num", "tax_tif_district_num", "misc_subdivision_id",
    "env_flood_fema_sfha", "env_flood_fs_factor", "env_flood_fs_risk_direction", "env_ohare_noise_contour_no_buffer_bool",
    "env_airport_noise_dnl", "access_cmap_walk_nta_score", "access_cmap_walk_total_score",
]
DISTANCE_COLUMNS = [
    "num_pin_in_half_mile", "num_bus_stop_in_half_mile", "num_foreclosure_per_1000_pin_past_5_years", "num_school_in_half_mile",
    "num_school_with_rating_in_half_mile", "avg_school_rating_in_half_mile", "airport_dnl_total", "lake_michigan_dist_ft",
    "nearest_bike_trail_dist_ft", "nearest_cemetery_dist_ft", "nearest_cta_route_dist_ft", "nearest_cta_stop_dist_ft",
    "nearest_golf_course_dist_ft", "nearest_grocery_store_dist_ft", "nearest_hospital_dist_ft", "nearest_major_road_dist_ft",
    "nearest_metra_route_dist_ft", "nearest_metra_stop_dist_ft", "nearest_new_construction_dist_ft", "nearest_park_dist_ft",
    "nearest_railroad_dist_ft", "nearest_secondary_road_dist_ft", "nearest_stadium_dist_ft", "nearest_university_dist_ft",
    "nearest_vacant_land_dist_ft", "nearest_water_dist_ft", "nearest_road_arterial_daily_traffic",
    "nearest_road_arterial_dist_ft", "nearest_road_arterial_lanes", "nearest_road_arterial_speed_limit",
    "nearest_road_arterial_surface_type", "nearest_road_collector_daily_traffic", "nearest_road_collector_dist_ft",
    "nearest_road_collector_lanes", "nearest_road_collector_speed_limit", "nearest_road_collector_surface_type",
    "nearest_road_highway_daily_traffic", "nearest_road_highway_dist_ft", "nearest_road_highway_lanes",
    "nearest_road_highway_speed_limit", "nearest_road_highway_surface_type",
]
SURVEY_COLUMNS = ["count_sex_total", "median_household_owner_occupied_value"] + [
    p.removeprefix("acs5_") for p in PREDICTORS if p.startswith("acs5_")
]
SHAPE_COLUMNS = [p for p in PREDICTORS if p.startswith("shp_")]
NEIGHBOUR_COLUMNS = [
    "nearest_neighbor_1_pin10", "nearest_neighbor_1_dist_ft", "nearest_neighbor_2_pin10", "nearest_neighbor_2_dist_ft",
    "nearest_neighbor_3_pin10", "nearest_neighbor_3_dist_ft",
]
HISTORY_COLUMNS = {
    "mailed_bldg": "meta_mailed_bldg",
    "mailed_land": "meta_mailed_land",
    "mailed_tot": "meta_mailed_tot",
    "certified_bldg": "meta_certified_bldg",
    "certified_land": "meta_certified_land",
    "certified_tot": "meta_certified_tot",
    "board_bldg": "meta_board_bldg",
    "board_land": "meta_board_land",
    "board_tot": "meta_board_tot",
    "oneyr_pri_board_bldg": "meta_1yr_pri_board_bldg",
    "oneyr_pri_board_land": "meta_1yr_pri_board_land",
    "oneyr_pri_board_tot": "meta_1yr_pri_board_tot",
    "twoyr_pri_board_bldg": "meta_2yr_pri_board_bldg",
    "twoyr_pri_board_land": "meta_2yr_pri_board_land",
    "twoyr_pri_board_tot": "meta_2yr_pri_board_tot",
}


@model("model.vw_pin_shared_input")
def vw_pin_shared_input(w: Warehouse) -> DataFrame:
    par = attach(
        parcel_base(w, drop_test_class=True), w.active("legdat"), {"parid": "parid", "taxyr": "taxyr"}, {"taxdist": "meta_tax_code"}
    )
    rows = par.select(
        F.col("parid").alias("meta_pin"), F.substring("parid", 1, 10).alias("meta_pin10"), F.col("taxyr").alias("meta_year"),
        alnum_only("class").alias("meta_class"), F.col("township_code").alias("meta_township_code"),
        F.regexp_replace("nbhd", "[^0-9]", "").alias("meta_nbhd_code"), "meta_tax_code",
    )
    towns = w.src("spatial.township").withColumn("township_code", F.col("township_code").cast("string"))
    names = {c: f"meta_{c}" for c in ("triad_name", "triad_code", "township_name")}
    rows = attach(rows, towns, {"meta_township_code": "township_code"}, names)
    pin, pin10 = {"meta_pin": "pin", "meta_year": "year"}, {"meta_pin10": "pin10", "meta_year": "year"}
    place = {"lon": "loc_longitude", "lat": "loc_latitude", X: f"loc_{X}", Y: f"loc_{Y}"}
    parcel = w.src("spatial.parcel")
    shapes = {c: c for c in SHAPE_COLUMNS if c in parcel.columns}
    rows = attach(rows, parcel, pin10, {**place, **shapes})
    located = w.ref("location.vw_pin10_location_fill").withColumns(
        {f"_{k}": F.coalesce(f"school_{k}_district_geoid", "school_unified_district_geoid") for k in ("elementary", "secondary")}
    )
    schools = {f"_{k}": f"loc_school_{k}_district_geoid" for k in ("elementary", "secondary")}
    raw = {f"school_{k}_district_geoid": f"_raw_{k}" for k in ("elementary", "secondary")}
    rows = attach(rows, located, pin10, {**{c: f"loc_{c}" for c in LOCATION_COLUMNS}, **schools, **raw})
    near = w.ref("proximity.vw_pin10_proximity_fill")
    rows = attach(rows, near, pin10, {**{c: f"prox_{c}" for c in DISTANCE_COLUMNS}, **{c: c for c in NEIGHBOUR_COLUMNS}})
    address = {"prop_address_full": "address", "prop_address_city_name": "city", "prop_address_state": "state", "prop_address_zipcode_1": "zip"}
    rows = attach(rows, w.ref("default.vw_pin_address"), pin, {c: f"loc_property_{n}" for c, n in address.items()})
    rows = attach(rows, w.ref("default.vw_pin_history"), pin, HISTORY_COLUMNS)
    survey = w.ref("census.vw_acs5_stat").where("geography = 'tract'")
    keys = {"loc_census_acs5_tract_geoid": "geoid", "meta_year": "year"}
    rows = attach(rows, survey, keys, {c: f"acs5_{c}" for c in SURVEY_COLUMNS if c in {**COUNTS, **SHARES}})
    for index in (housing_index(w), distress_index(w), affordability_index(w)):
        rows = attach(rows, index, pin10, [c for c in index.columns if c.startswith("other_")])
    rows = attach(rows, tax_bills(w), pin, ["other_tax_bill_amount_total", "other_tax_bill_rate"])
    ratings = w.src("other.great_schools_rating").groupBy("district_geoid", "district_type").agg(F.avg("rating").alias("_rating"))
    for kind in ("elementary", "secondary"):
        rated = ratings.where(F.col("district_type") == kind)
        rows = attach(rows, rated, {f"_raw_{kind}": "district_geoid"}, {"_rating": f"other_school_district_{kind}_avg_rating"})
    rows = attach(rows, exemption_streaks(w), pin, ["assr_is_active_exe_homeowner", "assr_n_years_exe_homeowner"])
    rows = attach(rows, corner_lot_flags(w), pin, {"is_corner_lot": "_corner"})
    corner = F.when(F.col("meta_year") >= "2014", known_true(F.col("_corner")))
    return rows.withColumn("assr_is_corner_lot", corner).drop("_corner", "_raw_elementary", "_raw_secondary")


EXEMPTION_COLUMNS = ("assr_is_active_exe_homeowner", "assr_n_years_exe_homeowner")


def keep_exemptions(rows: DataFrame) -> DataFrame:
    """Exemptions lag a year or two; missing ones take the parcel's last known value."""
    filled = lag_known(rows, ["meta_pin"], ["meta_year"], {c: f"_{c}" for c in EXEMPTION_COLUMNS})
    return filled.withColumns({c: F.coalesce(c, f"_{c}") for c in EXEMPTION_COLUMNS}).drop(*[f"_{c}" for c in EXEMPTION_COLUMNS])


def high_area(w: Warehouse, table: str, columns: list[str]) -> DataFrame:
    """The 95th percentile of areas by year and township."""
    chars = attach(w.ref(table), w.active("legdat"), {"pin": "parid", "year": "taxyr"}, {"user1": "_town"})
    return chars.groupBy(F.col("year").alias("_year"), "_town").agg(
        *[approx_quantile(c, 0.95).cast("int").alias(f"{c}_95_percentile") for c in columns]
    )


def at_least(c: str, bound: str) -> Column:
    return known_true(F.col(c) >= F.col(bound))


@model("model.vw_pin_condo_input")
def vw_pin_condo_input(w: Warehouse) -> DataFrame:
    rows = keep_exemptions(w.ref("model.vw_pin_shared_input").where(F.col("meta_class").isin("299", "399")))
    names = {
        "tieback_key_pin": "meta_tieback_key_pin", "tieback_proration_rate": "meta_tieback_proration_rate",
        "card_proration_rate": "meta_card_proration_rate", "card": "meta_card_num", "lline": "meta_lline_num",
        "pin_is_multilline": "ind_pin_is_multilline", "pin_num_lline": "meta_pin_num_lline", "pin_is_multiland": "ind_pin_is_multiland",
        "pin_num_landlines": "meta_pin_num_landlines", "cdu": "meta_cdu", "bldg_is_mixed_use": "char_bldg_is_mixed_use",
        "is_parking_space": "_parking", "char_land_sf": "_land",
        **{c: c for c in ("char_yrblt", "char_building_pins", "char_building_non_units", "char_building_sf", "char_unit_sf", "char_bedrooms", "char_half_baths", "char_full_baths")},
    }
    rows = attach(rows, w.ref("default.vw_pin_condo_char"), {"meta_pin": "pin", "meta_year": "year"}, names)
    bounds = high_area(w, "default.vw_pin_condo_char", ["char_land_sf"])
    rows = attach(rows, bounds, {"meta_year": "_year", "meta_township_code": "_town"}, ["char_land_sf_95_percentile"])
    return rows.withColumns(
        {
            "meta_modeling_group": F.when(F.col("_parking"), "NONLIVABLE").otherwise("CONDO"),
            "ind_pin_is_prorated": known_true(F.col("meta_tieback_proration_rate") < 1.0),
            "char_land_sf": F.nullif("_land", F.lit(0)),
            "char_building_units": F.col("char_building_pins") - F.col("char_building_non_units"),
            "ind_land_gte_95_percentile": at_least("_land", "char_land_sf_95_percentile"),
            "year": F.col("meta_year"),
        }
    ).drop("_parking", "_land")


RESIDENTIAL_CLASSES = (
    "202", "203", "204", "205", "206", "207", "208", "209", "210", "211", "212", "218", "219", "234", "278", "295",
)
NOT_A_CHARACTERISTIC = ("char_repair_cnd", "char_age", "char_site", "char_renovation", "char_in_ground_pool")
# Distances that are not borrowed from neighbours.
OWN_DISTANCES = ("cta_route", "cta_stop", "golf_course", "grocery_store", "metra_route", "metra_stop", "new_construction")
OWN_COUNTS = ("num_pin_in_half_mile", "num_bus_stop_in_half_mile", "num_foreclosure_per_1000_pin_past_5_years")
BORROWED_COLUMNS = (
    [f"loc_{c}" for c in LOCATION_COLUMNS if not c.startswith("census_")]
    + [f"loc_school_{k}_district_geoid" for k in ("elementary", "secondary")]
    + [f"prox_{c}" for c in DISTANCE_COLUMNS if c not in (*OWN_COUNTS, *[f"nearest_{n}_dist_ft" for n in OWN_DISTANCES])]
    + [f"other_school_district_{k}_avg_rating" for k in ("elementary", "secondary")]
)
BORROW_WITHIN_FT = 500.0


@model("model.vw_card_res_input")
def vw_card_res_input(w: Warehouse) -> DataFrame:
    """Residential cards. Missing location values come from the first, else the second, near neighbour."""
    shared = w.ref("model.vw_pin_shared_input").where(F.col("meta_class").isin(*RESIDENTIAL_CLASSES))
    cards = w.ref("default.vw_card_res_char")
    chars = [c for c in cards.columns if c.startswith("char_") and c not in NOT_A_CHARACTERISTIC]
    names = {
        "tieback_key_pin": "meta_tieback_key_pin", "tieback_proration_rate": "_tie", "card_proration_rate": "meta_card_proration_rate",
        "card": "meta_card_num", "pin_is_multicard": "ind_pin_is_multicard", "pin_num_cards": "meta_pin_num_cards",
        "pin_is_multiland": "ind_pin_is_multiland", "pin_num_landlines": "meta_pin_num_landlines", "cdu": "meta_cdu",
        **{c: c for c in chars},
    }
    rows = attach(shared, cards, {"meta_pin": "pin", "meta_year": "year"}, names)
    bounds = high_area(w, "default.vw_card_res_char", ["char_bldg_sf", "char_land_sf"])
    areas = ["char_bldg_sf_95_percentile", "char_land_sf_95_percentile"]
    rows = attach(rows, bounds, {"meta_year": "_year", "meta_township_code": "_town"}, areas)
    group = F.when(F.col("meta_class").isin("211", "212"), "MF").when(F.col("meta_class").isin("218", "219"), "BB").otherwise("SF")
    rows = rows.withColumns(
        {
            "meta_modeling_group": group,
            "meta_tieback_proration_rate": F.coalesce(F.nullif("_tie", F.lit(0.0)), F.lit(1.0)),
            "ind_pin_is_prorated": known_true(F.col("_tie") < 1.0),
            "ind_land_gte_95_percentile": at_least("char_land_sf", areas[1]),
            "ind_bldg_gte_95_percentile": at_least("char_bldg_sf", areas[0]),
            "ind_land_bldg_ratio_gte_10": known_true(F.col("char_land_sf") / (F.col("char_bldg_sf") + 1) >= 10.0),
        }
    )
    rows = rows.withColumns({c: F.nullif(c, F.lit(0)) for c in ("char_bldg_sf", "char_land_sf")}).drop("_tie")
    # Donors are whole parcels with one card.
    donors = rows.where(~F.col("ind_pin_is_multicard") & (F.substring("meta_pin", 11, 4) == "0000"))
    near = [(f"nearest_neighbor_{i}_pin10", f"nearest_neighbor_{i}_dist_ft") for i in (1, 2)]
    filled = neighbour_fill(rows, ["meta_pin10"], near, "meta_year", BORROWED_COLUMNS, BORROW_WITHIN_FT, donors)
    return keep_exemptions(filled).withColumn("year", F.col("meta_year")).drop(*NEIGHBOUR_COLUMNS)


def stacked_training_sets(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
