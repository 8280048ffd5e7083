"""Sales: validated sales, two sources combined, flags, reviews and their verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotwise.functions.logic import json_object, known_true
from plotwise.functions.text import alnum_only, empty_to_null
from plotwise.operators.grouped import count_distinct_pairs, with_group_values
from plotwise.operators.joins import latest_version
from plotwise.operators.ordered import lag_values
from plotwise.plans.parcels import parcel_base
from plotwise.plans.warehouse import Warehouse, attach, model

# Deed types that are no market sales; lines of the declaration and their meaning.
NON_MARKET_DEEDS = ("03", "04", "06")
PRICE_FLOOR = 10_000
DECLARATION_LINES = {
    "line_7_property_advertised": "property_advertised",
    "line_8_current_use": "line_8_current_use",
    "line_9_no_changes": "line_9_no_changes",
    "line_9_demolitiondamage": "line_9_demolition_damage",
    "line_9_additions": "line_9_additions",
    "line_9_major_remodeling": "line_9_major_remodeling",
    "line_9_new_construction": "line_9_new_construction",
    "line_9_other_change": "line_9_other_change",
    "line_9_other_change_description": "line_9_other_change_description",
    "line_9_date_of_significant_change": "line_9_date_of_significant_change",
    "line_10a": "is_installment_contract_fulfilled",
    "line_10b": "is_sale_between_related_individuals_or_corporate_affiliates",
    "line_10c": "is_transfer_of_less_than_100_percent_interest",
    "line_10d": "is_court_ordered_sale",
    "line_10e": "is_sale_in_lieu_of_foreclosure",
    "line_10f": "is_condemnation",
    "line_10g": "is_short_sale",
    "line_10h": "is_bank_reo_real_estate_owned",
    "line_10i": "is_auction_sale",
    "line_10j": "is_seller_buyer_a_relocation_company",
    "line_10k": "is_seller_buyer_a_financial_institution_or_government_agency",
    "line_10l": "is_buyer_a_real_estate_investment_trust",
    "line_10m": "is_buyer_a_pension_fund",
    "line_10n": "is_buyer_an_adjacent_property_owner",
    "line_10o": "is_buyer_exercising_an_option_to_purchase",
    "line_10p": "is_simultaneous_trade_of_property",
    "line_10q": "is_sale_leaseback",
    "line_10s": "is_homestead_exemption",
    "line_10s_generalalternative": "homestead_exemption_general_alternative",
    "line_10s_senior_citizens": "homestead_exemption_senior_citizens",
    "line_10s_senior_citizens_assessment_freeze": "homestead_exemption_senior_citizens_assessment_freeze",
}
SUSPECT_LINES = [
    "line_10b", "line_10c", "line_10d", "line_10e", "line_10f", "line_10g", "line_10h", "line_10i", "line_10k",
]


def document_number(c: str) -> Column:
    return empty_to_null(F.replace(F.col(c), F.lit("D"), F.lit("")))


def town_and_class(w: Warehouse) -> DataFrame:
    """Township, neighbourhood and class of each parcel-year."""
    return parcel_base(w).select(
        "parid", "taxyr", "township_code", alnum_only("class").alias("class"),
        F.concat("township_code", F.substring(F.regexp_replace("nbhd", "[^0-9]", ""), 3, 3)).alias("nbhd"),
    )


def party(c: str, missing: str) -> Column:
    return F.when(~F.trim(c).isin("", missing), F.col(c))


def first_of(df: DataFrame, keys: dict[str, Column], order: Column, out: str) -> DataFrame:
    """Mark the first row of each group. The first row is found by aggregation, so that one large group (all
    rows without a document, say) is never sorted in one task."""
    named = df.withColumns(keys).withColumn("_order", order)
    marked = with_group_values(named, list(keys), [F.min("_order").alias("_first")])
    return marked.withColumn(out, F.col("_order") == F.col("_first")).drop(*keys, "_order", "_first")


def unique_sales(w: Warehouse) -> DataFrame:
    """One sale per parcel and day, without documents that appear on several parcels by mistake."""
    live = w.active("sales")
    doc = document_number("instruno")
    counted = count_distinct_pairs(live.withColumn("_doc", doc), ["_doc"], ["parid"], "_parcels")
    year = F.substring("saledt", 1, 4)
    kept = live.where(
        F.col("instruno").isNotNull() & F.col("price").isNotNull() & year.cast("int").between(1997, F.year(w.date()))
    ).withColumns({"_doc": doc, "_year": year})
    kept = attach(kept, town_and_class(w), {"parid": "parid", "_year": "taxyr"}, ["township_code", "nbhd", "class"], "inner")
    kept = attach(kept.where(F.col("township_code").isNotNull()), counted, ["_doc"], ["_parcels"])
    market = ~F.col("instrtyp").isin(*NON_MARKET_DEEDS)
    kept = kept.withColumns(
        {
            "_market": market, "_day": F.to_date(F.substring("saledt", 1, 10)),
            "is_multisale": known_true((F.col("nopar") > 1) | (F.col("_parcels") > 1)),
        }
    )
    # A parcel's sales, of a day or of a price, are few by nature: plain windows, which do not copy the joins above as a join with an aggregate of them does.
    by_price = F.struct((-F.col("price")).alias("p"), "salekey")
    rows = kept.withColumn("_top_price", by_price == F.min(by_price).over(Window.partitionBy("parid", "saledt", "_market")))
    document = {"_a": F.col("_doc"), "_b": F.col("_market"), "_c": F.col("price") > PRICE_FLOOR}
    rows = first_of(rows, document, F.struct("saledt", "salekey"), "_first_document")
    lagged = lag_values(rows, ["parid", "price", "_market"], ["saledt", "salekey"], {"_before": ("_day", 1)})
    out = lagged.where(F.col("_top_price") & (F.col("_first_document") | F.col("is_multisale")))
    return out.select(
        F.col("parid").alias("pin"), F.col("_year").alias("year"), "township_code", "nbhd", "class",
        F.col("_day").alias("sale_date"), F.col("price").cast("long").alias("sale_price"),
        F.col("salekey").alias("sale_key"), F.col("_doc").alias("doc_no"), empty_to_null("instrtyp").alias("deed_type"),
        "is_multisale",
        F.when(F.col("nopar") > 1, F.col("nopar")).otherwise(F.col("_parcels")).alias("num_parcels_sale"),
        party("oldown", "MISSING SELLER NAME").alias("seller_name"),
        party("own1", "MISSING BUYER NAME").alias("buyer_name"),
        F.when(F.col("saletype") == "0", "LAND").when(F.col("saletype") == "1", "LAND AND BUILDING").alias("sale_type"),
        known_true(F.datediff("_day", "_before") <= 365).alias("sale_filter_same_sale_within_365"),
        (F.col("price") <= PRICE_FLOOR).alias("sale_filter_less_than_10k"),
        known_true(F.col("instrtyp").isin(*NON_MARKET_DEEDS) | F.col("instrtyp").isNull()).alias("sale_filter_deed_type"),
    )


def declarations(rows: DataFrame, same_day: list[str]) -> DataFrame:
    """Transfer declarations with the number of declarations of the same parcel and day."""
    counted = with_group_values(rows, same_day, [F.count(F.lit(1)).alias("_same_day")])
    flags = [F.col(c) for c in SUSPECT_LINES]
    suspect = flags[0]
    for flag in flags[1:]:
        suspect = suspect | flag
    return counted.select(
        F.replace(F.col("document_number"), F.lit("D"), F.lit("")).alias("doc_no"),
        F.replace(F.col("line_1_primary_pin"), F.lit("-"), F.lit("")).alias("pin"),
        F.to_date("line_4_instrument_date").alias("mydec_date"), F.col("line_5_instrument_type").alias("mydec_deed_type"),
        empty_to_null(F.trim("seller_name")).alias("seller_name"), empty_to_null(F.trim("buyer_name")).alias("buyer_name"),
        *[F.col(c).alias(f"mydec_{n}") for c, n in DECLARATION_LINES.items()],
        suspect.alias("sale_filter_ptax_flag"), "is_multisale", "year_of_sale", "_same_day",
        *[F.col(c) for c in ("line_11_full_consideration", "line_2_total_parcels") if c in counted.columns],
    )


DECLARED = [f"mydec_{n}" for n in DECLARATION_LINES.values()]
OUTLIER_COLUMNS = [
    "flag_is_outlier", "flag_is_ptax_outlier", "flag_is_heuristic_outlier", "flag_outlier_reason1", "flag_outlier_reason2",
    "flag_outlier_reason3", "flag_run_id", "flag_version", "review_is_arms_length", "review_is_flip",
    "review_has_class_change", "review_has_characteristic_change", "review_json", "outlier_reason",
]


@model("default.vw_pin_sale")
def vw_pin_sale(w: Warehouse) -> DataFrame:
    single = w.src("sale.mydec").where("NOT is_multisale")
    declared = declarations(single, ["line_1_primary_pin", "line_4_instrument_date"])
    declared = declared.where((F.col("_same_day") == 1) | (F.col("year_of_sale") > "2020"))
    named = {c: c for c in ["mydec_date", "mydec_deed_type", "sale_filter_ptax_flag", "year_of_sale", *DECLARED]}
    named |= {"seller_name": "_seller", "buyer_name": "_buyer"}
    rows = attach(unique_sales(w), declared, ["doc_no"], named)
    verdict = {c: c for c in OUTLIER_COLUMNS} | {"is_outlier": "_outlier", "has_flag": "_flag", "has_review": "_review"}
    rows = attach(rows, w.ref("sale.vw_outlier"), ["doc_no"], verdict)
    moved = known_true(F.col("mydec_date") != F.col("sale_date"))
    out = rows.withColumns(
        {
            "year": F.when(moved, F.col("year_of_sale")).otherwise(F.col("year")),
            "is_mydec_date": F.col("mydec_date").isNotNull() | known_true(F.year("sale_date") >= 2021),
            "seller_name": F.coalesce("seller_name", "_seller"),
            "buyer_name": F.coalesce("buyer_name", "_buyer"),
            "has_flag": known_true(F.col("_flag")),
            "has_review": known_true(F.col("_review")),
            "is_outlier": known_true(F.col("_outlier")),
            "sale_filter_is_outlier": known_true(F.col("_outlier")),
        }
    )
    final_date = F.when(moved, F.col("mydec_date")).otherwise(F.col("sale_date"))
    return out.withColumn("sale_date", final_date).drop(
        "mydec_date", "year_of_sale", "_seller", "_buyer", "_flag", "_review", "_outlier"
    )


@model("default.vw_pin_sale_combined")
def vw_pin_sale_combined(w: Warehouse) -> DataFrame:
    recorded = unique_sales(w)
    recorded = recorded.withColumnRenamed(
        "sale_filter_same_sale_within_365", "sale_filter_same_iasworld_sale_within_365"
    ).drop("township_code", "nbhd", "class", "sale_filter_less_than_10k", "sale_filter_deed_type")
    declared = declarations(w.src("sale.mydec"), ["line_1_primary_pin", "line_4_instrument_date", "line_2_total_parcels"])
    declared = declared.where((F.col("_same_day") == 1) | F.col("is_multisale") | (F.col("year_of_sale") > "2020"))
    declared = declared.withColumn("line_11_full_consideration", F.col("line_11_full_consideration").cast("long"))
    declared = declared.select(*[F.col(c).alias(f"d_{c}") if not c.startswith(("mydec_", "sale_filter")) else F.col(c) for c in declared.columns])
    # Declarations of several parcels stay on their own.
    key = F.when(~F.col("d_is_multisale"), F.col("d_doc_no"))
    both = recorded.join(declared, F.col("doc_no") == key, "full")

    def latest(recorded_col: str, declared_col: str) -> Column:
        early = F.col("year") < "2021"
        return F.when(early, F.coalesce(declared_col, recorded_col)).otherwise(F.coalesce(recorded_col, declared_col))

    merged = both.withColumns({"_pin": F.coalesce("pin", "d_pin"), "_town_year": F.coalesce("year", "d_year_of_sale")})
    merged = attach(
        merged, town_and_class(w), {"_pin": "parid", "_town_year": "taxyr"}, ["township_code", "nbhd", "class"], "inner"
    )
    merged = merged.select(
        F.col("_pin").alias("pin"), latest("year", "d_year_of_sale").alias("year"), "township_code", "nbhd", "class",
        latest("sale_date", "mydec_date").alias("sale_date"),
        (F.col("mydec_date").isNotNull() | known_true(F.year("sale_date") >= 2021)).alias("is_mydec_date"),
        F.coalesce("sale_price", "d_line_11_full_consideration").alias("sale_price"), "sale_key",
        F.coalesce("doc_no", "d_doc_no").alias("doc_no"), F.coalesce("deed_type", "mydec_deed_type").alias("deed_type"),
        F.coalesce("seller_name", "d_seller_name").alias("seller_name"),
        F.coalesce("is_multisale", "d_is_multisale").alias("is_multisale"),
        F.coalesce("num_parcels_sale", "d_line_2_total_parcels").alias("num_parcels_sale"),
        F.coalesce("buyer_name", "d_buyer_name").alias("buyer_name"), "sale_type",
        known_true(F.col("sale_filter_same_iasworld_sale_within_365")).alias("sale_filter_same_iasworld_sale_within_365"),
        "mydec_deed_type", "sale_filter_ptax_flag", *DECLARED,
        F.when(F.col("doc_no").isNotNull(), "iasworld").otherwise("mydec").alias("source"),
    )
    merged = lag_values(merged, ["pin", "sale_price"], ["sale_date", "doc_no"], {"_before": ("sale_date", 1)})
    merged = merged.withColumns(
        {
            "sale_filter_same_sale_within_365": known_true(F.datediff("sale_date", "_before") <= 365),
            "sale_filter_less_than_10k": F.col("sale_price") <= PRICE_FLOOR,
            "sale_filter_deed_type": F.col("deed_type").isin(*NON_MARKET_DEEDS) | F.col("deed_type").isNull(),
        }
    ).drop("_before")
    flags = ["sv_is_outlier", "sv_is_ptax_outlier", "sv_is_heuristic_outlier", *[f"sv_outlier_reason{i}" for i in (1, 2, 3)]]
    out = attach(merged, w.ref("sale.vw_flag"), ["doc_no"], {c: c for c in flags} | {"run_id": "sv_run_id", "version": "sv_version"})
    return out.withColumn("sale_filter_is_outlier", known_true(F.col("sv_is_outlier")))


FLAG_COLUMNS = [
    "sv_is_outlier", "sv_is_ptax_outlier", "sv_is_heuristic_outlier", "sv_outlier_reason1", "sv_outlier_reason2",
    "sv_outlier_reason3", "run_id", "version",
]


@model("sale.vw_flag")
def vw_flag(w: Warehouse) -> DataFrame:
    newest = latest_version(w.src("sale.flag"), ["meta_sale_document_num"], "version")
    return newest.select(F.col("meta_sale_document_num").alias("doc_no"), *FLAG_COLUMNS)


@model("sale.vw_flag_group")
def vw_flag_group(w: Warehouse) -> DataFrame:
    rows = w.src("sale.flag").select(
        F.col("meta_sale_document_num").alias("doc_no"), "run_id", F.col("group").alias("group_id"),
        F.col("meta_sale_price_original").alias("sale_price"), "sv_is_outlier", F.col("ptax_flag_original").alias("ptax_flag"),
        "sv_is_ptax_outlier", "sv_outlier_reason1", "sv_outlier_reason2", "sv_outlier_reason3",
    )
    rows = attach(rows, w.src("sale.group_mean"), {"run_id": "run_id", "group_id": "group"}, ["group_size"])
    rows = attach(rows, w.src("sale.parameter"), ["run_id"], ["min_group_thresh"])
    rows = attach(rows, w.ref("default.vw_pin_sale"), ["doc_no"], ["pin", "year", "sale_date"])
    rows = attach(rows, w.ref("default.vw_pin_universe"), ["pin", "year"], ["triad_code", "class"])
    return rows.withColumn("meets_group_threshold", F.col("group_size") >= F.col("min_group_thresh"))


@model("sale.vw_ias_salesval_upload")
def vw_ias_salesval_upload(w: Warehouse) -> DataFrame:
    keys = w.active("sales").select("salekey", document_number("instruno").alias("doc_no"))
    cols = ["sv_is_outlier", "sv_outlier_reason1", "sv_outlier_reason2", "sv_outlier_reason3", "run_id"]
    return attach(keys, w.ref("sale.vw_flag"), ["doc_no"], cols, "inner").drop("doc_no")


# Algorithm reasons that are about price, in order of precedence.
PRICE_REASONS = ("High price", "High price per square foot", "Low price", "Low price per square foot")


def with_price_reason(label: str, reasons: Column) -> Column:
    """The label, followed by the first price reason among the algorithm's."""
    hits = F.filter(F.array(*[F.lit(r) for r in PRICE_REASONS]), lambda r: F.array_contains(reasons, r))
    return F.when(F.size(hits) > 0, F.concat(F.lit(f"{label}, Algorithm: "), F.get(hits, F.lit(0)))).otherwise(F.lit(label))


@model("sale.vw_outlier")
def vw_outlier(w: Warehouse) -> DataFrame:
    flag = w.ref("sale.vw_flag").withColumn("_key", F.col("doc_no"))
    reviewed = ["is_arms_length", "is_flip", "has_class_change", "has_characteristic_change"]
    review = w.src("sale.flag_review").select("doc_no", *reviewed)
    rows = flag.join(review, "doc_no", "full")
    names = [f"sv_outlier_reason{i}" for i in (1, 2, 3)]
    changed = F.col("has_class_change") | (F.col("has_characteristic_change") == "yes_major")
    rows = rows.select(
        "doc_no", F.col("sv_is_outlier").isNotNull().alias("has_flag"),
        *[known_true(F.col(f"sv_is_{n}")).alias(f"flag_is_{n}") for n in ("outlier", "ptax_outlier", "heuristic_outlier")],
        *[F.col(n).alias(n.replace("sv_", "flag_")) for n in names],
        F.filter(F.array(*names), lambda r: r.isNotNull()).alias("_reasons"),
        F.col("run_id").alias("flag_run_id"), F.col("version").alias("flag_version"),
        F.coalesce(*[F.col(c).cast("string") for c in reviewed]).isNotNull().alias("has_review"),
        F.coalesce("is_arms_length", F.lit(True)).alias("review_is_arms_length"),
        known_true(F.col("is_flip")).alias("review_is_flip"),
        known_true(F.col("has_class_change")).alias("review_has_class_change"),
        F.coalesce("has_characteristic_change", F.lit("no")).alias("review_has_characteristic_change"),
        known_true(changed).alias("_major"), json_object(**{c: F.col(c) for c in reviewed}).alias("review_json"),
    )
    reasons = F.col("_reasons")
    flagged = F.col("has_flag") & F.col("flag_is_outlier")
    by_review = (
        F.when(F.col("_major"), "Review: Major Characteristic Change")
        .when(flagged & F.col("review_is_flip"), with_price_reason("Review: Flip", reasons))
        .when(flagged & ~F.col("review_is_arms_length"), with_price_reason("Review: Non-Arms-Length", reasons))
        .otherwise("Review: Valid Sale")
    )
    by_algorithm = F.when(
        F.col("flag_is_outlier"), F.concat_ws(", ", F.lit("Algorithm: Outlier Sale"), F.nullif(F.array_join("_reasons", ", "), F.lit("")))
    ).otherwise("Algorithm: Valid Sale")
    reason = F.when(F.col("has_review"), by_review).when(F.col("has_flag"), by_algorithm)
    valid = F.col("outlier_reason").isNull() | F.col("outlier_reason").endswith("Valid Sale")
    return rows.withColumn("outlier_reason", reason).withColumn("is_outlier", ~valid).drop("_reasons", "_major")


