"""Valuation reports: comparable sales and assessment cards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.functions.logic import known_true
from plotwise.operators.grouped import with_group_values, year_span_label
from plotwise.operators.joins import explode_join
from plotwise.operators.ordered import dedup_by_priority
from plotwise.operators.reshape import numbered_to_long
from plotwise.plans.predictors import predictors
from plotwise.plans.warehouse import Warehouse, attach, model

SCHOOL_KINDS = ("elementary", "secondary")


def school_names(w: Warehouse) -> DataFrame:
    return w.src("spatial.school_district").where("geoid IS NOT NULL").groupBy("geoid", "year").agg(F.max("name").alias("name"))


def with_school_names(w: Warehouse, rows: DataFrame, out: str) -> DataFrame:
    names = school_names(w)
    for kind in SCHOOL_KINDS:
        keys = {f"loc_school_{kind}_district_geoid": "geoid", "meta_year": "year"}
        rows = attach(rows, names, keys, {"name": out.format(kind=kind)})
    return rows


@model("pinval.comp")
def comp(w: Warehouse) -> DataFrame:
    """Five comparable sales per card, one row each, with what is known of the sale."""
    metadata, runs = w.src("model.metadata"), w.ref("pinval.model_run").where("type = 'comp'")
    wanted = metadata.join(runs.select("run_id"), "run_id", "left_semi").select("run_id")
    raw = w.src("model.comp").join(wanted, "run_id", "left_semi")
    prefixes = ["comp_pin", "comp_score", "comp_document_num"]
    pairs = numbered_to_long(raw, ["pin", "card", "year", "run_id"], prefixes, 5, index="comp_num")
    training = attach(w.ref("model.training_data"), metadata, ["run_id"], ["model_predictor_all_name"])
    if "pinval.training_run" in w.sources:
        # One training run per assessment year; which ones is a setting of the data.
        training = training.join(w.src("pinval.training_run").select("run_id"), "run_id", "left_semi")
    training = with_school_names(w, training, "loc_school_{kind}_district_name")
    keys = {"year": "assessment_year", "comp_pin": "meta_pin", "comp_document_num": "meta_sale_document_num"}
    chosen = predictors(training.columns)
    feature_names = [c for c in training.columns if c in set(training.select(*chosen).columns)]
    sale = [
        "ind_pin_is_multicard", "loc_property_address", "meta_sale_price", "meta_sale_date", "model_predictor_all_name",
        *[f"loc_school_{k}_district_name" for k in SCHOOL_KINDS],
    ]
    extra = {c: c for c in [*feature_names, *sale]} | {"assessment_year": "_assessment_year"}
    rows = attach(pairs, training, keys, extra)
    years = [F.min(F.year("meta_sale_date")).alias("_first"), F.max(F.year("meta_sale_date")).alias("_last")]
    rows = with_group_values(rows, ["pin", "run_id"], years)
    price = F.col("meta_sale_price")
    return rows.select(
        "pin", "card", "comp_num", *prefixes, "run_id", known_true(F.col("pin") == F.col("comp_pin")).alias("is_subject_pin_sale"),
        F.when(F.col("ind_pin_is_multicard"), "Subject card").otherwise("Subject property").alias("property_label"),
        F.col("loc_property_address").alias("property_address"), "meta_sale_price",
        F.concat(F.round(price / 1000).cast("long").cast("string"), F.lit("K")).alias("sale_price_short"),
        F.round(price / F.nullif("char_bldg_sf", F.lit(0))).alias("sale_price_per_sq_ft"),
        F.date_format("meta_sale_date", "MMM yyyy").alias("sale_month_year"), *feature_names,
        F.col("char_bldg_sf").alias("combined_bldg_sf"), *[f"loc_school_{k}_district_name" for k in SCHOOL_KINDS],
        "model_predictor_all_name", year_span_label(F.col("_first"), F.col("_last")).alias("sale_year_range"),
        F.col("_assessment_year").alias("assessment_year"),
    )


def report_runs(w: Warehouse) -> DataFrame:
    """Runs whose cards are reported, with the townships they cover."""
    final = w.ref("model.final_model").select("run_id", "township_code_coverage")
    listed = w.ref("pinval.model_run").where("type = 'card'").select("run_id").distinct()
    cols = ["run_id", "model_predictor_all_name", "assessment_year", "assessment_data_year", "assessment_triad"]
    runs = w.src("model.metadata").select(*cols).join(listed, "run_id", "left_semi").join(final, "run_id")
    return runs.withColumn("final_model_run_date", F.substring("run_id", 1, 10))


def covered_shap(w: Warehouse) -> DataFrame:
    """Contribution rows of the runs to report; a run without a final model covers all townships."""
    final = w.ref("model.final_model").select("run_id", "township_code_coverage")
    runs = w.ref("pinval.model_run").where("type = 'shap'").select("run_id", "assessment_year").join(final, "run_id", "left")
    everywhere = F.array(F.lit("all"))
    runs = runs.withColumn("township_code_coverage", F.coalesce("township_code_coverage", everywhere))
    rows = w.src("model.shap").drop("assessment_year")
    return explode_join(rows, runs, ["run_id"], "township_code_coverage", "township_code")


# Modelling groups that get a report.
REPORTED_GROUPS = ("SF", "MF", "BB")


@model("pinval.assessment_card")
def assessment_card(w: Warehouse) -> DataFrame:
    runs = report_runs(w)
    meta = ["model_predictor_all_name", "assessment_year", "assessment_data_year", "assessment_triad", "final_model_run_date"]
    cards = w.src("model.assessment_card").drop(*meta)
    own = runs.withColumn("meta_township_code", F.explode("township_code_coverage")).drop("township_code_coverage")
    cards = cards.join(own, ["run_id", "meta_township_code"])
    # Card counts: what the pin table says, else the number of cards of the run.
    counted = w.src("model.assessment_card").groupBy("meta_pin", "run_id").agg(F.count(F.lit(1)).alias("_cards"))
    pins = attach(w.src("model.assessment_pin"), counted, ["meta_pin", "run_id"], ["_cards"])
    pins = pins.withColumn("_num_cards", F.coalesce("meta_pin_num_cards", "_cards").cast("int"))
    pin_cols = {
        "_num_cards": "meta_pin_num_cards", "loc_property_address": "property_address", "loc_property_city": "loc_property_city",
        "meta_tieback_proration_rate": "_tie_rate", "meta_tieback_key_pin": "_tie_pin", "pred_pin_final_fmv_round": "pred_pin_final_fmv_round",
    }
    cards = attach(cards, pins, ["meta_pin", "run_id"], pin_cols)
    small = known_true((F.col("assessment_year").cast("int") >= 2025) & F.col("meta_pin_num_cards").isin(2, 3))
    area = F.coalesce("char_bldg_sf", F.lit(0))
    largest = F.min(F.struct((-area).alias("a"), F.col("meta_card_num").alias("c"))).alias("_largest")
    cards = with_group_values(cards, ["meta_pin", "run_id"], [F.sum(area).alias("combined_bldg_sf"), largest])
    cards = cards.withColumns(
        {
            "is_parcel_small_multicard": small,
            "is_frankencard": small & (F.struct((-area).alias("a"), F.col("meta_card_num").alias("c")) == F.col("_largest")),
        }
    ).drop("_largest")
    shap = covered_shap(w)
    shap_columns = predictors(shap.columns, alias_prefix="shap")
    shap = shap.select("meta_pin", "meta_card_num", "assessment_year", F.col("run_id").alias("shap_run_id"), *shap_columns)
    kept = [c for c in shap.columns if c.startswith("shap_")]
    cards = attach(cards, shap, ["meta_pin", "meta_card_num", "assessment_year"], kept)
    cards = with_school_names(w, cards, "school_{kind}_district_name")
    features = [c for c in cards.select(*predictors(cards.columns, exclude=("meta_township_code", "meta_nbhd_code", "char_class"))).columns]
    cards = attach(cards, w.src("spatial.township"), {"township_code": "township_code"}, {"township_name": "_card_town"})
    cards = attach(cards, w.src("class_dict"), {"char_class": "class_code"}, {"class_desc": "_card_desc"})
    cards = cards.select(*[F.col(c).alias(f"c_{c}") if c in ("meta_pin", "assessment_year", "assessment_triad", "township_code", "char_class", "meta_nbhd_code") else F.col(c) for c in cards.columns])

    newest = dedup_by_priority(runs, ["assessment_data_year"], [F.col("run_id").desc()])
    universe = w.ref("default.vw_pin_universe").select("pin", "year", "township_name", "township_code", "nbhd_code", "triad_name", F.col("class").alias("pin_class"))
    universe = attach(
        universe, newest, {"year": "assessment_data_year"}, {"assessment_year": "_u_year", "assessment_triad": "_u_triad"}, "inner"
    )
    classes = {"class_desc": "_pin_desc", "class_code": "_known", "regression_class": "_regression", "modeling_group": "_group"}
    universe = attach(universe, w.src("class_dict"), {"pin_class": "class_code"}, classes)
    rows = universe.join(cards, (universe["pin"] == F.col("c_meta_pin")) & (universe["year"] == F.col("meta_year")), "full")
    home = F.lower("triad_name") == F.lower("_u_triad")
    modelled = F.col("_group").isin(*REPORTED_GROUPS)
    has_card = F.col("c_meta_pin").isNotNull() & F.col("meta_card_num").isNotNull()
    reason = (
        F.when(F.col("pin_class") == "299", "condo")
        .when(F.col("_known").isNull() | ~F.col("_regression") | ~modelled, "non_regression_class")
        .when(~home, "non_tri")
        .when(F.col("meta_card_num").isNull(), "missing_card")
        .when(has_card & home, F.lit(None).cast("string"))
        .otherwise("unknown")
    )
    value = F.col("pred_card_initial_fmv")
    divisor = F.when(F.col("is_parcel_small_multicard"), F.col("combined_bldg_sf")).otherwise(F.col("char_bldg_sf"))

    def per_foot(amount, feet):
        return F.round(amount / F.nullif(feet, F.lit(0)), 0).cast("int")

    return rows.select(
        F.coalesce("c_meta_pin", "pin").alias("meta_pin"), "meta_card_num", F.coalesce("_card_town", "township_name").alias("meta_township_name"),
        F.coalesce("c_meta_nbhd_code", "nbhd_code").alias("meta_nbhd_code"), F.lower("triad_name").alias("meta_triad_name"), "pin_class",
        F.coalesce("c_char_class", "pin_class").alias("char_class"), F.coalesce("_card_desc", "_pin_desc").alias("char_class_desc"),
        F.coalesce("c_assessment_triad", "_u_triad").alias("assessment_triad_name"), "run_id", "model_predictor_all_name",
        "final_model_run_date", (has_card & home & F.col("_known").isNotNull() & F.col("_regression") & modelled).alias("is_report_eligible"),
        reason.alias("reason_report_ineligible"), *features, *kept,
        F.concat(F.col("c_char_class").cast("string"), F.lit(": "), F.col("_card_desc")).alias("char_class_detailed"), "property_address",
        "loc_property_city", known_true((F.col("_tie_rate") != 1) | F.col("_tie_pin").isNotNull()).alias("is_prorated"), "pred_card_initial_fmv",
        per_foot(value, divisor).alias("pred_card_initial_fmv_per_sqft"), "pred_pin_final_fmv_round",
        per_foot(F.col("pred_pin_final_fmv_round"), F.col("combined_bldg_sf")).alias("pred_pin_final_fmv_round_per_sqft"), "meta_pin_num_cards",
        "is_parcel_small_multicard", "is_frankencard", "combined_bldg_sf", *[f"school_{k}_district_name" for k in SCHOOL_KINDS],
        F.coalesce("c_assessment_year", "_u_year").alias("assessment_year"), F.coalesce("c_township_code", "township_code").alias("meta_township_code"),
    )
