"""Reporting tables: rolls, progress, top parcels, most recent sales and boundaries, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions.logic import known_true
from plotwise.functions.text import alnum_only, hyphenated_pin
from plotwise.operators.grouped import (
    approx_median, by_geographies, distinct_join, percent_complete, share_of_total, stacked_groups, with_group_values,
)
from plotwise.operators.joins import clamp_year_join, full_coalesced, lag_join, scaffold, trim_universe
from plotwise.operators.ordered import lag_values, top_with_ties
from plotwise.operators.spatial import most_recent_boundaries
from plotwise.plans.locations import X, Y, with_rings
from plotwise.plans.parcels import affordable_and_mixed, parcel_base
from plotwise.plans.values import assessments
from plotwise.plans.warehouse import PIN_YEAR, Warehouse, attach, model

# The year of a three-year cycle, counted modulo 3, in which each area is reassessed.
REASSESSED = {"North": 0, "South": 1, "City": 2}
SALE_EXCLUSIONS = ("is_multisale", "sale_filter_deed_type", "sale_filter_less_than_10k", "sale_filter_same_sale_within_365")


def joined_or_null(c: str) -> Column:
    return F.nullif(F.array_join(c, ", "), F.lit(""))


def without(df: DataFrame, flags: tuple[str, ...]) -> DataFrame:
    for flag in flags:
        df = df.where(~F.col(flag))
    return df


def at_latest_location(w: Warehouse, rows: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of the parcel's location; years after the last one use it."""
    places = w.ref("location.vw_pin10_location").select("pin10", "year", *columns)
    return clamp_year_join(rows, places, ["pin10"], "year").drop("source_year")


@model("reporting.vw_pin_township_class")
def vw_pin_township_class(w: Warehouse) -> DataFrame:
    par = parcel_base(w).select(
        F.col("parid").alias("pin"), F.col("taxyr").alias("year"), "township_code", F.substring("nbhd", 3, 3).alias("nbhd"),
        alnum_only("class").alias("class"), F.substring("parid", 1, 10).alias("pin10"),
    ).where("class != '999'")
    groups = {"reporting_class_code": "major_class", "modeling_group": "property_group"}
    rows = attach(par, w.src("class_dict"), {"class": "class_code"}, groups, "inner")
    rows = attach(rows, affordable_and_mixed(w), PIN_YEAR, ["is_ahsap"])
    rows = attach(rows, w.src("spatial.township"), ["township_code"], ["triad_name", "triad_code", "township_name"])
    rows = at_latest_location(w, rows, ["combined_municipality_name"])
    cycle = F.lit(False)
    for area, remainder in REASSESSED.items():
        cycle = cycle | ((F.col("triad_name") == area) & (F.col("year").cast("int") % 3 == remainder))
    return rows.withColumns(
        {"municipality_name": joined_or_null("combined_municipality_name"), "reassessment_year": known_true(cycle)}
    ).drop("combined_municipality_name", "pin10")


def value_sums(names: tuple[str, ...] = ("bldg", "land", "tot")) -> list[Column]:
    out = []
    for n in names:
        out += [F.sum(n).alias(f"{n}_sum"), approx_median(n).cast("int").alias(f"{n}_median")]
    return out


@model("reporting.vw_assessment_roll")
def vw_assessment_roll(w: Warehouse) -> DataFrame:
    names = {"township_name": "township_name", "triad_name": "triad", "major_class": "class", "reassessment_year": "reassessment_year"}
    rows = attach(w.ref("reporting.vw_pin_value_long"), w.ref("reporting.vw_pin_township_class"), ["pin", "year"], names)
    rows = rows.where(F.col("township_name").isNotNull()).withColumn("stage", F.lower("stage_name"))
    grouped = rows.groupBy("year", "stage", "township_name", "triad", "class", "reassessment_year")
    out = grouped.agg(F.count(F.lit(1)).alias("n"), *value_sums())
    return out.orderBy(*[F.col(c).asc_nulls_last() for c in ("township_name", "year", "stage", "class")])


ROLL_STAGES = [("mailed", 1), ("assessor certified", 2), ("bor certified", 3)]


@model("reporting.vw_assessment_roll_muni")
def vw_assessment_roll_muni(w: Warehouse) -> DataFrame:
    known = assessments(w).where(F.col("procname").isin(*w.settings.stages))
    known = known.join(w.src("class_dict").select(F.col("class_code").alias("class")), "class", "left_semi")
    seen = known.select(F.col("parid").alias("pin"), F.col("taxyr").alias("year"))
    par = w.active("pardat", drop_test_class=True).select(
        F.col("parid").alias("pin"), F.col("taxyr").alias("year"), alnum_only("class").alias("_class"),
        F.substring("parid", 1, 10).alias("pin10"),
    )
    # The latest year counts over all parcels, active or not.
    last = w.src("pardat").agg(F.max("taxyr")).scalar()
    here = par.join(seen.distinct().withColumn("_seen", F.lit(True)), ["pin", "year"], "left")
    par = here.where(F.col("_seen") | (F.col("year") == last)).drop("_seen")
    par = attach(par, w.src("class_dict"), {"_class": "class_code"}, {"reporting_class_code": "class"}, "inner")
    par = at_latest_location(w, par, ["combined_municipality_name"])
    par = par.select("pin", "year", "class", joined_or_null("combined_municipality_name").alias("municipality"))
    par = par.where(F.col("municipality").isNotNull())
    keys = ["municipality", "class", "year"]
    par = with_group_values(par, keys, [F.count(F.lit(1)).alias("num_pin_total_in_group")])
    values = lag_values(w.ref("reporting.vw_pin_value_long"), ["pin"], ["year", "stage_num"], {"tot_lag": ("tot", 1)})
    values = values.select("pin", "year", F.lower("stage_name").alias("stage"), "bldg", "land", "tot", "tot_lag", F.lit(1).alias("_has"))
    rows = scaffold(par, ROLL_STAGES, ["stage", "stage_num"]).join(values, ["pin", "year", "stage"], "left")
    total, before = F.sum("tot").cast("double"), F.sum("tot_lag").cast("double")
    grouped = rows.groupBy(*keys, "stage", "stage_num").agg(
        F.count("_has").alias("num_pin_w_value"), F.max("num_pin_total_in_group").alias("num_pin_total_in_group"),
        (F.count("_has").cast("double") / F.max("num_pin_total_in_group").cast("double")).alias("pct_pin_w_value_in_group"),
        *value_sums(), F.when(before != 0, (total - before) / before).alias("delta_pct_av"),
    )
    phase = ["year", "stage", "municipality"]
    summed = with_group_values(grouped, phase, [F.sum("tot_sum").alias("phase_total_av")])
    return share_of_total(summed, phase, "tot_sum", "phase_av_share")


PROGRESS_STAGES = [("MAILED", 1), ("ASSESSOR CERTIFIED", 2), ("BOR CERTIFIED", 3)]


@model("reporting.assessment_progress")
def assessment_progress(w: Warehouse) -> DataFrame:
    values = w.ref("reporting.vw_pin_value_long")
    arrays = {
        "municipality_name": "combined_municipality_name",
        **{f"school_{k}_district_name": f"tax_school_{k}_district_name" for k in ("elementary", "secondary", "unified")},
    }
    universe = trim_universe(w.ref("default.vw_pin_universe"), values, ["pin", "year"], "year")
    ward = F.when(F.col("ward_chicago_data_year").isNotNull(), F.replace(F.col("ward_name"), F.lit("chicago_"), F.lit("")))
    places = universe.select("pin", "year", *[F.array_join(c, ", ").alias(n) for n, c in arrays.items()], ward.alias("chicago_ward_name"))
    rows = scaffold(places, PROGRESS_STAGES, ["stage_name", "stage_num"])
    rows = attach(rows, values, ["pin", "year", "stage_name"], ["bldg", "land", "tot"])
    labels = {
        "Municipality": "municipality_name", "Chicago Ward": "chicago_ward_name",
        "Elementary School District": "school_elementary_district_name",
        "Secondary School District": "school_secondary_district_name", "Unified School District": "school_unified_district_name",
    }
    aggs = [F.count(F.lit(1)).alias("num_pin_total"), F.count("tot").alias("num_pin_w_value"), *value_sums()]
    out = by_geographies(rows, labels, ["year", "stage_name", "stage_num"], aggs)
    out = out.withColumn("pct_pin_w_value", percent_complete(F.col("num_pin_w_value"), F.col("num_pin_total")))
    return out.orderBy(F.col("year").desc(), "geo_type", F.col("geo_id").asc_nulls_last(), F.col("stage_name").desc())


@model("reporting.vw_pin_most_recent_sale")
def vw_pin_most_recent_sale(w: Warehouse) -> DataFrame:
    """The latest sale of each parcel; parcels of the latest year without one keep an empty row."""
    valid = without(w.ref("default.vw_pin_sale"), SALE_EXCLUSIONS)
    last = valid.groupBy("pin").agg(F.max("sale_date").alias("_last")).select(F.col("pin").alias("_pin"), "_last")
    latest = valid.join(last, (valid["pin"] == last["_pin"]) & (valid["sale_date"] == last["_last"]), "left_semi")
    par = w.active("pardat", drop_test_class=True)
    par = par.where(F.col("taxyr") == w.src("pardat").agg(F.max("taxyr")).scalar()).select(F.col("parid").alias("pin")).distinct()
    inner = [c for c in latest.columns if not c.startswith(("flag_", "review_", "has_", "outlier_"))]
    kept = latest.select(*inner).drop(
        "nbhd", "sale_filter_same_sale_within_365", "sale_filter_less_than_10k", "sale_filter_deed_type", "is_outlier",
        "mydec_deed_type", "sale_filter_ptax_flag",
    )
    return full_coalesced(kept, par, ["pin"]).drop("in_left", "in_right")


@model("reporting.vw_top_5")
def vw_top_5(w: Warehouse) -> DataFrame:
    values = w.ref("default.vw_pin_value").select(
        "pin", "year", F.coalesce("certified_tot", "mailed_tot").alias("total_av"),
        F.when(F.col("certified_tot").isNull(), "mailed").otherwise("certified").alias("stage_used"),
    ).where("total_av IS NOT NULL")
    names = {"township_name": "township", "triad_name": "triad", "class": "class", "township_code": "_town"}
    rows = attach(values, w.ref("reporting.vw_pin_township_class"), ["pin", "year"], names)
    top = top_with_ties(rows.where(F.col("township").isNotNull()), ["_town", "year"], [F.col("total_av").desc()], 5)
    # Addresses are joined for the few rows that are left.
    address = {"prop_address_full": "address", "prop_address_city_name": "city", "mail_address_name": "owner_name"}
    out = attach(top, w.ref("default.vw_pin_address"), ["pin", "year"], address).drop("_town")
    return out.orderBy("township", "year", "class", "rank")


# City names that are printed in another spelling.
CITY_SPELLING = {"Mc Cook": "McCook", "Forestview": "Forest View"}


@model("reporting.vw_top_5_muni")
def vw_top_5_muni(w: Warehouse) -> DataFrame:
    values = w.ref("reporting.vw_pin_value_long")
    places = trim_universe(w.ref("reporting.vw_pin_township_class"), values, ["pin", "year"], "year")
    places = places.select("pin", "year", F.col("municipality_name").alias("municipality"), "major_class", "class")
    totals = places.where(F.col("municipality").isNotNull()).groupBy("municipality", "year").agg(F.count(F.lit(1)).alias("num_pin_total_in_group"))
    certified, board = F.col("certified_tot"), F.col("board_tot")
    recent = w.ref("default.vw_pin_history").select(
        "pin", "year", F.col("oneyr_pri_board_tot").alias("prior_bor_av"),
        F.coalesce("certified_tot", "mailed_tot", "pre_mailed_tot").alias("assessor_av"),
        F.when(certified.isNotNull(), "certified").when(F.col("mailed_tot").isNotNull(), "mailed").otherwise("pre-mailed").alias("assessor_stage_used"),
        board.alias("bor_av"), (board - certified).alias("nom_bor_change"),
        F.when(certified > 0, (board - certified).cast("double") / certified.cast("double")).alias("per_bor_change"),
    )
    rows = attach(recent, places, ["pin", "year"], ["municipality", "major_class", "class"]).where(F.col("municipality").isNotNull())
    rows = with_group_values(rows, ["municipality", "year"], [F.count(F.lit(1)).alias("num_pin_w_value")])
    top = top_with_ties(rows, ["municipality", "year"], [F.col("assessor_av").desc_nulls_last()], 5)
    city = F.col("prop_address_city_name")
    for old, new in CITY_SPELLING.items():
        city = F.when(F.col("prop_address_city_name") == old, new).otherwise(city)
    address = w.ref("default.vw_pin_address").withColumn("_city", city)
    top = attach(top, address, ["pin", "year"], {"prop_address_full": "address", "_city": "city", "mail_address_name": "taxpayer_name"})
    top = attach(top, totals, ["municipality", "year"], ["num_pin_total_in_group"])
    share = F.col("num_pin_w_value").cast("double") / F.col("num_pin_total_in_group").cast("double")
    out = top.withColumns({"pin": hyphenated_pin("pin"), "pct_pin_w_value_in_group": share})
    return out.orderBy("municipality", "year", "class", "rank")


def model_estimates(w: Warehouse, same_year: bool) -> DataFrame:
    """Final model values: of the run's own townships, and of the final run for all other areas."""
    runs = w.ref("model.final_model").select(
        "run_id", F.col("township_code_coverage").alias("_towns"), F.col("triad_code").alias("_triad"), "is_final",
        F.col("year").alias("_run_year"),
    )
    rows = w.src("model.assessment_pin").join(runs, "run_id")
    own = F.array_contains("_towns", F.col("township_code")) & (F.col("meta_triad_code") == F.col("_triad"))
    elsewhere = (F.col("meta_triad_code") != F.col("_triad")) & F.col("is_final")
    rows = rows.where(known_true(own) | known_true(elsewhere))
    rows = rows.where(F.col("year") == F.col("_run_year")) if same_year else rows
    return rows.select(
        F.col("meta_pin").alias("pin"), "year", F.col("meta_class").alias("class"), F.lit("model").alias("assessment_stage"),
        F.col("pred_pin_final_fmv_round").cast("double").alias("total"),
    )


@model("reporting.ratio_stats_input")
def ratio_stats_input(w: Warehouse) -> DataFrame:
    recorded = w.ref("reporting.vw_pin_value_long").where("year >= '2021'").select(
        "pin", "year", "class", F.lower("stage_name").alias("assessment_stage"), (F.col("tot") * 10).cast("double").alias("total")
    )
    values = model_estimates(w, same_year=False).union(recorded).distinct().where("total > 0")
    sales = without(w.ref("default.vw_pin_sale"), SALE_EXCLUSIONS).select(
        "pin", F.col("year").alias("sale_year"), "township_code", "sale_price"
    ).withColumn("year", (F.col("sale_year").cast("int") + 1).cast("string"))
    rows = values.join(sales, ["pin", "year"])
    rows = attach(rows, w.src("class_dict"), {"class": "class_code"}, {"modeling_group": "property_group"})
    parking = w.ref("default.vw_pin_condo_char").where("is_parking_space").select("pin", "year")
    rows = rows.where(F.col("property_group").isNotNull()).join(parking, ["pin", "year"], "left_anti")
    rows = attach(rows, w.src("spatial.township"), ["township_code"], {"triad_code": "triad"})
    return rows.select(
        "pin", "year", "sale_year", "property_group", "assessment_stage", "triad", "township_code", F.col("total").alias("fmv"),
        "sale_price", (F.col("total") / F.col("sale_price")).alias("ratio"),
    )


@model("reporting.res_report_summary_sales_input")
def res_report_summary_sales_input(w: Warehouse) -> DataFrame:
    sales = without(w.ref("default.vw_pin_sale"), (*SALE_EXCLUSIONS, "sale_filter_is_outlier"))
    sales = sales.select("pin", "doc_no", "sale_price", F.col("nbhd").alias("townnbhd"), F.col("year").alias("sale_year"))
    names = ["property_group", "township_code", "triad_name"]
    rows = attach(sales, w.ref("reporting.vw_pin_township_class"), {"pin": "pin", "sale_year": "year"}, names)
    return rows.where("property_group IS NOT NULL AND triad_name IS NOT NULL").drop("triad_name")


@model("reporting.res_report_summary_values_input")
def res_report_summary_values_input(w: Warehouse) -> DataFrame:
    recorded = w.ref("reporting.vw_pin_value_long").where("year >= '2021'").select(
        "pin", "year", F.col("stage_name").alias("assessment_stage"), (F.col("tot") * 10).cast("double").alias("total")
    )
    values = model_estimates(w, same_year=True).drop("class").unionByName(recorded)
    homes = w.active("dweldat").groupBy(F.col("parid").alias("pin"), F.col("taxyr").alias("year")).agg(
        F.min("yrblt").cast("int").alias("yrblt"), F.sum("sfla").cast("long").alias("total_bldg_sf")
    )
    condos = w.ref("default.vw_pin_condo_char").where("NOT is_parking_space AND NOT is_common_area").select(
        "pin", "year", F.col("char_yrblt").cast("int").alias("yrblt"), F.col("char_building_sf").cast("long").alias("total_bldg_sf")
    )
    # a row for each parcel and year, which Spark takes for few
    rows = values.join(homes.unionByName(condos).hint("merge"), ["pin", "year"])
    names = {"property_group": "property_group", "class": "class", "triad_name": "triad", "township_code": "township_code", "nbhd": "_nbhd"}
    rows = attach(rows, w.ref("reporting.vw_pin_township_class"), ["pin", "year"], names)
    rows = attach(rows, w.ref("default.vw_pin_land"), ["pin", "year"], {"sf": "total_land_sf"})
    rows = rows.where("property_group IS NOT NULL AND triad IS NOT NULL")
    return rows.withColumn("townnbhd", F.concat("township_code", "_nbhd")).drop("_nbhd")


GEOGRAPHY_COLUMNS = [("Town", "township_code"), ("TownNBHD", "townnbhd")]


@model("reporting.res_report_summary")
def res_report_summary(w: Warehouse) -> DataFrame:
    values, sales = w.ref("reporting.res_report_summary_values_input"), w.ref("reporting.res_report_summary_sales_input")
    medians = {"total": "fmv_median", "total_land_sf": "land_sf_median", "total_bldg_sf": "bldg_sf_median", "yrblt": "yrblt_median"}
    aggs = [F.count(F.lit(1)).alias("pin_n"), *[approx_median(c).alias(n) for c, n in medians.items()]]
    shared = ["triad", "assessment_stage", "year"]
    stacked = stacked_groups(values, shared, GEOGRAPHY_COLUMNS, "property_group", aggs, "ALL REGRESSION")
    # The most frequent class needs a count per class first, so it is a grouping of its own.
    per_class = stacked_groups(
        values.withColumn("_class", F.col("class")), [*shared, "_class"], GEOGRAPHY_COLUMNS, "property_group",
        [F.count(F.lit(1)).alias("_n")], "ALL REGRESSION",
    )
    keys = [*shared, "geography_type", "geography_id", "property_group"]
    best = F.min_by("_class", F.struct(-F.col("_n"), F.col("_class"))).alias("class_mode")
    modes = per_class.where(F.col("_class").isNotNull()).groupBy(*keys).agg(best)
    sale_aggs = [
        F.min("sale_price").alias("sale_min"), approx_median("sale_price").alias("sale_median"), F.max("sale_price").alias("sale_max"),
        F.count(F.lit(1)).alias("sale_n"),
    ]
    sold = stacked_groups(sales, ["sale_year"], GEOGRAPHY_COLUMNS, "property_group", sale_aggs, "ALL REGRESSION")
    sold = sold.drop("geography_type").withColumn("year", F.col("sale_year"))
    out = stacked.join(modes, keys, "left")
    return lag_join(out, sold, ["geography_id", "property_group"], "year", 1)


@model("reporting.vw_town_sale_history")
def vw_town_sale_history(w: Warehouse) -> DataFrame:
    sales = without(w.ref("default.vw_pin_sale"), (*SALE_EXCLUSIONS, "sale_filter_is_outlier"))
    rows = attach(sales, w.ref("reporting.vw_pin_township_class"), ["pin", "year"], ["property_group", "triad_code"])
    rows = rows.where("property_group IS NOT NULL").withColumn("sale_year", F.col("year"))
    aggs = [approx_median("sale_price").alias("sale_median"), F.count(F.lit(1)).alias("sale_n")]
    return stacked_groups(rows, ["triad_code", "sale_year"], GEOGRAPHY_COLUMNS[:1], "property_group", aggs, "ALL REGRESSION")


def two_largest_cards(w: Warehouse, columns: list[str]) -> DataFrame:
    """The two largest cards of each parcel-year; cards that tie keep their rank."""
    cards = w.ref("default.vw_card_res_char").select("pin", "year", *columns)
    order = [F.col("char_bldg_sf").desc_nulls_last(), F.col("card").asc_nulls_last()]
    return top_with_ties(cards, ["pin", "year"], order, 2, "rnk")


@model("reporting.vw_market_tracker")
def vw_market_tracker(w: Warehouse) -> DataFrame:
    sales = w.ref("default.vw_pin_sale").where("year >= '2020'")
    sales = attach(sales, w.src("class_dict"), {"class": "class_code"}, ["modeling_group"])
    sales = sales.where(F.col("modeling_group").isin("SF", "CONDO", "MF"))
    universe = ["triad_name", "township_name", "chicago_community_area_name", "combined_municipality_name", "lat", "lon"]
    rows = attach(sales, w.ref("default.vw_pin_universe"), ["pin", "year"], universe).where("lat IS NOT NULL AND lon IS NOT NULL")
    area = F.col("chicago_community_area_name")
    nowhere = area.isNull() & (F.size("combined_municipality_name") == 0)
    place = F.when(nowhere, F.concat(F.lit("UNINCORPORATED "), F.upper("township_name"))).otherwise(
        F.coalesce(area, F.array_join("combined_municipality_name", ", "))
    )
    rows = attach(rows, w.ref("default.vw_pin_address"), ["pin", "year"], ["prop_address_full"])
    measures = {
        "card": "card", "char_yrblt": "year_built", "char_bldg_sf": "bldg_sf", "char_land_sf": "land_sf", "char_fbath": "full_baths",
        "char_hbath": "half_baths", "char_beds": "bedrooms",
    }
    cards = two_largest_cards(w, [*measures, "pin_is_multicard", "pin_num_cards"])
    for rank in (1, 2):
        extra = {c: c for c in ("pin_is_multicard", "pin_num_cards")} if rank == 1 else {}
        rows = attach(rows, cards.where(F.col("rnk") == rank), ["pin", "year"], {**{c: f"{n}{rank}" for c, n in measures.items()}, **extra})
    condo = {
        "char_yrblt": "_built", "char_unit_sf": "unit_sf1", "is_common_area": "is_common_area", "is_parking_space": "is_parking_space",
        "char_full_baths": "_full", "char_half_baths": "_half", "char_bedrooms": "_beds",
    }
    rows = attach(rows, w.ref("default.vw_pin_condo_char"), ["pin", "year"], condo)
    runs = w.ref("model.final_model").where("is_final").select("run_id", F.concat_ws(" ", "type", "year").alias("_model"))
    used = w.ref("model.training_data").select(F.col("meta_sale_document_num").alias("doc_no"), "run_id").join(runs, "run_id")
    rows = attach(rows, distinct_join(used, ["doc_no"], "_model", "models_used"), ["doc_no"], ["models_used"])
    rows = attach(rows, w.src("sale.deed_type"), {"deed_type": "deed_num"}, {"deed_name": "_deed"})
    renamed = {f"flag_outlier_reason{i}": f"sv_outlier_reason{i}" for i in (1, 2, 3)} | {"flag_is_outlier": "sv_is_outlier"}
    return rows.select(
        "pin", "pin_is_multicard", "pin_num_cards", "class", "modeling_group", "year", F.col("triad_name").alias("triad"),
        F.col("township_name").alias("township"), place.alias("geo_name"),
        F.when(area.isNotNull(), "community area").otherwise("municipality").alias("geo_type"), "prop_address_full", "lat", "lon",
        "doc_no", F.col("_deed").alias("deed_type"), "sale_price", "sale_date", "sale_filter_is_outlier", *SALE_EXCLUSIONS,
        *[F.col(c).alias(n) for c, n in renamed.items()], "card1", F.coalesce("year_built1", "_built").alias("year_built1"), "bldg_sf1",
        "land_sf1", "unit_sf1", "is_common_area", "is_parking_space", F.coalesce("full_baths1", "_full").alias("full_baths1"),
        F.coalesce("half_baths1", "_half").alias("half_baths1"), F.coalesce("bedrooms1", "_beds").alias("bedrooms1"),
        *[f"{n}2" for n in measures.values()], "models_used",
    )


# Layers of the latest-boundary table and the columns taken from each.
RECENT_LAYERS = {
    "municipality": ("spatial.municipality", None, {"municipality_name": "municipality_name", "municipality_num": "municipality_num"}),
    "ward_chicago": ("spatial.ward", "ward_name LIKE '%chicago%'", {"ward_name": "ward_chicago_name", "ward_num": "ward_chicago_num"}),
    "ward_evanston": ("spatial.ward", "ward_name LIKE '%evanston%'", {"ward_name": "ward_evanston_name", "ward_num": "ward_evanston_num"}),
    "community_area": ("spatial.community_area", None, {"community": "community_area_name", "area_number": "community_area_num"}),
    **{
        n: (f"spatial.{n}", None, {f"{n}_name": f"{n}_name", f"{n}_num": f"{n}_num"})
        for n in ("commissioner_district", "state_representative_district", "state_senate_district")
    },
}


@model("reporting.vw_pin_most_recent_boundary")
def vw_pin_most_recent_boundary(w: Warehouse) -> DataFrame:
    parcels = w.src("spatial.parcel")
    newest = parcels.agg(F.max("year")).scalar()
    rows = parcels.where((F.col("year") == newest) & F.col("town_code").isNotNull()).select(
        "pin10", F.col("town_code").alias("township_code"), F.col("year").alias("parcel_year"), X, Y
    )
    layers = {}
    for name, (source, where, columns) in RECENT_LAYERS.items():
        layer = with_rings(w.src(source).where(where) if where else w.src(source))
        named = layer.select(*[F.col(c).alias(n) for c, n in columns.items()], F.col("year").alias(f"{name}_year"), "year", "rings")
        layers[name] = (named, [*columns.values(), f"{name}_year"])
    return most_recent_boundaries(rows, layers, w.settings.cell_ft, X, Y).drop(X, Y)


TAX_EXEMPTIONS = (
    "exe_homeowner", "exe_senior", "exe_freeze", "exe_longtime_homeowner", "exe_disabled", "exe_vet_returning",
    "exe_vet_dis_lt50", "exe_vet_dis_50_69", "exe_vet_dis_ge70", "exe_abate",
)


@model("reporting.vw_pin_school_impact")
def vw_pin_school_impact(w: Warehouse) -> DataFrame:
    pins = w.src("tax.pin").where("class != '0'")
    codes = attach(w.src("tax.tax_code"), w.src("tax.agency_info"), ["agency_num"], ["agency_name", "major_type", "minor_type"], "inner")
    schools = codes.where("major_type = 'SCHOOL'").select("tax_code_num", "tax_code_rate", "year", "agency_num", "agency_name")
    rows = pins.join(schools, ["tax_code_num", "year"])
    group = ["agency_name", "year"]
    # A bill rank is one more than the number of larger bills, counted per distinct bill.
    ranked = top_with_ties(rows, group, [F.col("av_board").desc_nulls_last()], 10, "av_board_rank")
    bills = rows.groupBy(*group, "tax_bill_total").agg(F.count(F.lit(1)).alias("_n"))
    wanted = ranked.select(*group, F.col("tax_bill_total").alias("_bill")).distinct()
    above = wanted.join(bills, group).where(F.col("tax_bill_total") > F.col("_bill")).groupBy(*group, "_bill").agg(F.sum("_n").alias("_above"))
    ranked = attach(ranked, above, {"agency_name": "agency_name", "year": "year", "tax_bill_total": "_bill"}, ["_above"])
    ranked = attach(ranked, w.src("tax.eq_factor"), ["year"], ["eq_factor_final"])
    exempt = F.lit(0)
    for e in TAX_EXEMPTIONS:
        exempt = exempt + F.col(e)
    out = ranked.select(
        "agency_name", "agency_num", "av_board_rank", "pin", "class", "av_mailed", "av_certified", "av_board",
        (F.col("av_board") * F.col("eq_factor_final") - exempt).cast("int").alias("taxable_eav"), "tax_bill_total",
        (F.coalesce("_above", F.lit(0)) + 1).alias("bill_rank"), "tax_code_num", "tax_code_rate", "year",
    )
    # Agency names per tax code, not per parcel.
    for kind in ("TIF", "SSA"):
        names = codes.where(F.col("minor_type") == kind).groupBy("tax_code_num", "year").agg(
            F.array_sort(F.collect_set("agency_name")).alias(kind.lower())
        )
        out = attach(out, names, ["tax_code_num", "year"], [kind.lower()])
    return out.orderBy("year", "agency_num", "av_board_rank")

