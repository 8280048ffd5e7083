"""Quality-control views: rows that someone should look at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions.logic import all_of, any_of, flag_comments, known_true
from plotwise.functions.text import hyphenated_pin, insert_hyphens
from plotwise.operators.grouped import distinct_in_group, filtered_set_or_marker, with_group_values, zscore
from plotwise.operators.joins import lag_join, unmatched_counts
from plotwise.operators.ordered import dedup_by_priority, first_n_wide, lag_values
from plotwise.operators.reshape import current_minus_history, union_missing
from plotwise.plans.warehouse import PAR_KEYS, Warehouse, attach, model

FIRST_QC_YEAR = "2014"
VALUES = [f"val{k}{i}" for k in ("apr", "asm") for i in (1, 2, 3)]


def year_of(c: str) -> Column:
    return F.substring(c, 1, 4)


def us_date(c: str, pattern: str = "M/d/yyyy") -> Column:
    return F.date_format(F.to_timestamp(c), pattern)


def hyphened(c: str, *positions: int) -> Column:
    return insert_hyphens(c, *positions)


def drift(now: Column, before: Column) -> Column:
    """Whether a count moved by more than five percent."""
    return (
        F.when(now > 1.05 * before, "More than 5% growth").when(now < 0.95 * before, "More than 5% decrease")
        .otherwise("No significant change")
    )


def share_of_rows(cond: Column) -> Column:
    return F.count_if(cond).cast("double") / F.count(F.lit(1)).cast("double")


def short_or_null(c: str) -> Column:
    return known_true(F.length(c) < 2) | F.col(c).isNull()


def recorded_sales(w: Warehouse) -> DataFrame:
    rows = w.active("sales").where(F.col("instruno").isNotNull())
    return rows.withColumn("sale_year", year_of("saledt")).where(F.col("sale_year") >= FIRST_QC_YEAR)


def declared_sales(w: Warehouse) -> DataFrame:
    rows = w.src("sale.mydec").withColumn("sale_year", F.substring("year_of_sale", 1, 4))
    return rows.where(F.col("sale_year") >= FIRST_QC_YEAR)


@model("qc.vw_change_in_ahsap_values")
def vw_change_in_ahsap_values(w: Warehouse) -> DataFrame:
    steps = {
        "large_mail_increase": ("mailed_tot", "oneyr_pri_certified_tot"), "large_certified_increase": ("certified_tot", "mailed_tot"),
        "large_board_increase": ("board_tot", "certified_tot"),
    }
    flags = {n: F.col(now) > F.col(before) * 1.2 for n, (now, before) in steps.items()}
    rows = w.ref("default.vw_pin_history").withColumns(flags)
    housing = w.ref("reporting.vw_pin_township_class").where("is_ahsap").select("pin", "year")
    rows = rows.where(any_of([known_true(F.col(n)) for n in flags])).join(housing, ["pin", "year"])
    return rows.select(
        "pin", "year", "class", "township_name", "oneyr_pri_certified_tot", "mailed_class", "mailed_tot", "large_mail_increase",
        "certified_class", "certified_tot", "large_certified_increase", "board_class", "board_tot", "large_board_increase",
    )


@model("qc.vw_change_in_high_low_value_sales")
def vw_change_in_high_low_value_sales(w: Warehouse) -> DataFrame:
    low, high = "price_less_than_10k", "price_greater_than_1m"

    def counts(rows: DataFrame, price: str, source: str) -> DataFrame:
        yearly = rows.groupBy(F.col("sale_year").alias("taxyr")).agg(
            F.count_if(F.col(price) < 10_000).alias(f"{low}_count"), F.count_if(F.col(price) > 1_000_000).alias(f"{high}_count")
        )
        return yearly.withColumn("source", F.lit(source))

    both = counts(recorded_sales(w).where("price IS NOT NULL"), "price", "iasWorld").unionByName(
        counts(declared_sales(w), "line_11_full_consideration", "MyDec")
    )
    lags = {f"prev_year_{n}_count": (f"{n}_count", 1) for n in (low, high)}
    out = lag_values(both, ["source"], ["taxyr"], lags)
    status = {f"{n}_growth_status": drift(F.col(f"{n}_count"), F.col(f"prev_year_{n}_count")) for n in (low, high)}
    return out.withColumns(status).orderBy("taxyr")


@model("qc.vw_iasworld_asmt_all_joined_to_legdat")
def vw_asmt_all_joined_to_legdat(w: Warehouse) -> DataFrame:
    rows = w.src("asmt_all").where(
        (F.col("rolltype") != "RR") & F.col("procname").isin(*w.settings.stages) & F.col("deactivat").isNull() & F.col("valclass").isNull()
    )
    rows = rows.join(w.active("pardat").select("parid", "taxyr"), ["parid", "taxyr"])
    return attach(rows, w.active("legdat"), PAR_KEYS, {"user1": "township_code"})


def current_assessments(w: Warehouse) -> DataFrame:
    return w.active("asmt_all").where(F.col("valclass").isNull())


@model("qc.vw_iasworld_asmt_all_with_prior_year_values")
def vw_asmt_all_with_prior_year_values(w: Warehouse) -> DataFrame:
    asmt = current_assessments(w).select("parid", "taxyr", *VALUES)
    before = asmt.select("parid", "taxyr", *[F.col(c).alias(f"{c}_prev") for c in VALUES])
    rows = lag_join(asmt, before, ["parid"], "taxyr", 1)
    rows = attach(rows, w.active("pardat"), PAR_KEYS, ["nbhd", "class", "luc"], "inner")
    rows = attach(rows, w.active("legdat"), PAR_KEYS, {"user1": "township_code"})
    rows = attach(rows, w.active("owndat"), PAR_KEYS, ["own1"])
    change = attach(w.active("aprval"), w.src("aprval_reascd"), ["reascd"], ["description"])
    change = change.withColumn("reascd", F.concat_ws(": ", "reascd", F.when(F.col("reascd").isNotNull(), F.col("description"))))
    return attach(rows, change.withColumn("reascd", F.nullif("reascd", F.lit(""))), PAR_KEYS, ["reascd", "who"])


@model("qc.vw_iasworld_sales_day_of_month")
def vw_sales_day_of_month(w: Warehouse) -> DataFrame:
    rows = recorded_sales(w).where("price IS NOT NULL").where(F.col("sale_year").cast("int") <= F.year(w.date()))
    days = rows.groupBy(F.col("sale_year").alias("taxyr"), F.substring("saledt", 9, 2).alias("day_of_month")).agg(
        F.countDistinct("instruno").alias("sales_by_day")
    )
    return with_group_values(days, ["taxyr"], [F.sum("sales_by_day").alias("total_sales")]).orderBy("taxyr", "day_of_month")


@model("qc.vw_iasworld_sales_high_value_by_class")
def vw_sales_high_value_by_class(w: Warehouse) -> DataFrame:
    homes = w.src("pardat").where((F.substring("class", 1, 1) == "2") & (F.col("class") != "299"))
    sales = recorded_sales(w).select("parid", "instruno", "price", "who", "wen", F.col("sale_year").alias("taxyr"))
    rows = attach(sales, homes, PAR_KEYS, ["class"], "inner")
    return with_group_values(rows, ["instruno"], [F.count(F.lit(1)).alias("parcel_count")]).drop("instruno")


@model("qc.vw_iasworld_sales_latest_sale")
def vw_sales_latest_sale(w: Warehouse) -> DataFrame:
    rows = w.src("sales").where("price > 1")
    # The sale key settles sales of one day.
    latest = dedup_by_priority(rows, ["parid"], [F.col("saledt").desc_nulls_last(), F.col("salekey")])
    return latest.select("parid", "instruno", "price", "saledt", us_date("saledt").alias("saledt_fmt"))


@model("qc.vw_iasworld_sales_null_values")
def vw_sales_null_values(w: Warehouse) -> DataFrame:
    return recorded_sales(w).groupBy(F.col("sale_year").alias("taxyr")).agg(
        share_of_rows(F.col("price").isNull()).alias("price"), share_of_rows(F.col("instrtyp").isNull()).alias("deed_type"),
        share_of_rows(short_or_null("own1")).alias("buyer"), share_of_rows(short_or_null("oldown")).alias("seller"),
    )


@model("qc.vw_sale_mydec_null_values")
def vw_sale_mydec_null_values(w: Warehouse) -> DataFrame:
    return declared_sales(w).groupBy(F.col("sale_year").alias("year")).agg(
        share_of_rows(F.col("line_11_full_consideration").isNull()).alias("price"),
        share_of_rows(F.col("full_address").isNull()).alias("address"),
        share_of_rows(F.col("line_5_instrument_type").isNull()).alias("deed_type"),
        share_of_rows(short_or_null("buyer_name")).alias("buyer"), share_of_rows(short_or_null("seller_name")).alias("seller"),
    )


def plain_document(c: str) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


@model("qc.vw_iasworld_sales_price_diff_sale_mydec")
def vw_sales_price_diff(w: Warehouse) -> DataFrame:
    left = w.active("sales").select(
        plain_document("instruno").alias("document_number"), year_of("saledt").alias("taxyr"), "parid", F.col("price").alias("price_iasworld")
    ).where(F.col("taxyr") >= FIRST_QC_YEAR)
    right = declared_sales(w).select(
        "document_number", F.col("sale_year").alias("taxyr"), F.col("sale_year").alias("year_mydec"), F.col("line_11_full_consideration").alias("price_mydec")
    )
    # Unmatched rows have no second price to differ from, so the outer join is an inner one.
    return left.join(right, ["document_number", "taxyr"]).where(F.col("price_iasworld") != F.col("price_mydec"))


@model("qc.vw_iasworld_sales_rowcount_matches_sale_mydec")
def vw_sales_rowcount_matches(w: Warehouse) -> DataFrame:
    left = recorded_sales(w).groupBy(F.col("sale_year").alias("taxyr")).agg(F.countDistinct("instruno").alias("iasworld_sales"))
    right = declared_sales(w).groupBy(F.col("sale_year").alias("taxyr")).agg(F.countDistinct("document_number").alias("mydec_sales"))
    a, b = F.col("iasworld_sales"), F.col("mydec_sales")
    label = F.when(a > 1.05 * b, "IasWorld 5% Higher").when(b > 1.05 * a, "Mydec 5% Higher").otherwise("No significant difference")
    return left.join(right, "taxyr").withColumn("comparison", label).orderBy("taxyr")


@model("qc.vw_iasworld_sales_unmatched_joins_sale_mydec")
def vw_sales_unmatched_joins(w: Warehouse) -> DataFrame:
    left = recorded_sales(w).select(F.col("sale_year").alias("taxyr"), plain_document("instruno").alias("document")).distinct()
    right = declared_sales(w).select(F.col("sale_year").alias("taxyr"), F.col("document_number").alias("document")).distinct()
    out = unmatched_counts(left, right, ["taxyr", "document"], ["taxyr"])
    return out.withColumnsRenamed({"only_left": "iasworld_unmatched", "only_right": "mydec_unmatched"}).orderBy("taxyr")


def not_in_history(w: Warehouse) -> DataFrame:
    """Assessment rows that the history table does not hold in the same form."""
    current = w.src("asmt_all")
    return current_minus_history(current, w.src("asmt_hist"), current.columns)


@model("qc.vw_neg_asmt_value")
def vw_neg_asmt_value(w: Warehouse) -> DataFrame:
    rows = not_in_history(w).where((F.col("cur") == "Y") & F.col("deactivat").isNull())
    rows = rows.join(w.active("pardat").select("parid", "taxyr"), ["parid", "taxyr"])
    rows = attach(rows, w.active("legdat"), PAR_KEYS, {"user1": "township_code", "taxdist": "taxdist"})
    numbered = [c for c in rows.columns if c.startswith("val") and c != "valclass"]
    return rows.select("taxyr", "parid", "township_code", "taxdist", "class", "valclass", "who", "wen", *numbered)


# Value columns that hold no amounts.
NOT_AMOUNTS = {f"val{n}" for n in (14, 15, 23, 34, 45, 57)}


@model("qc.vw_report_town_close_neg_asmt_value")
def vw_report_town_close_neg_asmt_value(w: Warehouse) -> DataFrame:
    rows = w.ref("qc.vw_neg_asmt_value")
    amounts = [c for c in rows.columns if c.startswith("val") and c != "valclass" and c not in NOT_AMOUNTS]
    return rows.where(any_of([F.col(c) < 0 for c in amounts])).select("parid", "taxyr", "township_code", "class", "valclass", *amounts)


@model("qc.vw_nonlivable_condos_with_chars")
def vw_nonlivable_condos_with_chars(w: Warehouse) -> DataFrame:
    rows = attach(w.ref("default.vw_pin_condo_char"), w.src("spatial.township"), ["township_code"], ["township_name"])
    known = F.col("char_bedrooms").isNotNull() | F.col("char_full_baths").isNotNull()
    return rows.where((F.col("is_common_area") | F.col("is_parking_space")) & known).select(
        "pin", "year", "class", "township_name", "tieback_proration_rate", "char_unit_sf", "char_half_baths", "char_full_baths",
        "note", "unitno", "is_parking_space", "parking_space_flag_reason", "is_common_area",
    )


@model("qc.vw_pin_appeal_mismatched_outcomes")
def vw_pin_appeal_mismatched_outcomes(w: Warehouse) -> DataFrame:
    """Appeals whose stated outcome disagrees with the values: any move for "no change", none for "change"."""
    pairs = [(F.col(f"mailed_{v}"), F.col(f"certified_{v}")) for v in ("bldg", "land", "tot")]
    moved = any_of([known_true(F.abs(a - b) > 1) for a, b in pairs])
    still = all_of([known_true(F.abs(a - b) <= 1) for a, b in pairs])
    bad = ((F.col("change") == "no change") & moved) | ((F.col("change") == "change") & still)
    columns = [f"{s}_{v}" for v in ("bldg", "land", "tot") for s in ("mailed", "certified")]
    return w.ref("default.vw_pin_appeal").where(bad).select("pin", "year", "case_no", "change", *columns)


@model("qc.vw_pin_condo_review")
def vw_pin_condo_review(w: Warehouse) -> DataFrame:
    rows = w.ref("default.vw_pin_condo_char")
    towns = w.src("spatial.township").select("township_code", "township_name", "triad_name").distinct()
    rows = attach(rows, towns, ["township_code"], ["township_name", "triad_name"])
    building = ["pin10", "year"]
    rows = with_group_values(rows, building, [F.sum("char_unit_sf").alias("_units")])
    rows = distinct_in_group(rows.withColumn("_bldg", F.coalesce("char_building_sf", F.lit(-1))), building, "_bldg", "_sizes")
    unit, bldg, this_year = F.col("char_unit_sf"), F.col("char_building_sf"), F.year(w.date())
    livable = F.col("char_building_pins") - F.col("char_building_non_units")
    flags = {
        "flag_half_baths": F.col("char_half_baths") > 2, "flag_full_baths": F.col("char_full_baths") > 4,
        "flag_bedrooms": F.col("char_bedrooms") > 4, "flag_unit_sf": ~unit.between(500, 3000) | (unit > bldg),
        "flag_unit_sf_gt_bldg": unit > bldg, "flag_building_sf": ~bldg.between(2500, 500000), "flag_unit_sf_sum": F.col("_units") > bldg,
        "flag_diff_bldg_sf": F.col("_sizes") > 1, "flag_no_livable_units": livable == 0,
        "flag_yrblt": ~F.col("char_yrblt").between(1880, this_year),
    }
    # The printed unit bounds differ from the tested ones, as in the published report.
    texts = {
        "flag_half_baths": "More than 2 Half Baths", "flag_full_baths": "More than 4 Full Baths", "flag_bedrooms": "More than 4 Bedrooms",
        "flag_unit_sf": "Unit SF not between 300 and 5,000", "flag_unit_sf_gt_bldg": "Unit SF exceeds building SF",
        "flag_building_sf": "Building SF not between 2,500 and 500,000",
        "flag_unit_sf_sum": "Combined Unit SF for all units in PIN10 exceeds Building SF",
        "flag_diff_bldg_sf": "Multiple Building SF values for same PIN10", "flag_no_livable_units": "Building has no livable units",
    }
    rows = rows.withColumns({n: known_true(c) for n, c in flags.items()})
    comment = flag_comments([(F.col(n), t) for n, t in texts.items()])
    built = F.when(F.col("flag_yrblt"), F.concat(F.lit("Year Built not between 1880 and "), this_year.cast("string")))
    comment = F.nullif(F.concat_ws(", ", comment, built), F.lit(""))
    return rows.withColumn("flag_comments", comment).where("flag_comments IS NOT NULL").select(
        hyphenated_pin("pin").alias("pin"), hyphened("pin10", 2, 4, 7).alias("pin10"), "year", "township_name", "triad_name",
        "char_half_baths", "char_full_baths", "char_bedrooms", "char_unit_sf", "char_building_sf",
        livable.alias("char_building_livable_units"), "char_yrblt", *flags, "flag_comments",
    )


@model("qc.vw_pin_sale_high_number_of_sales_per_year")
def vw_pin_sale_high_number_of_sales_per_year(w: Warehouse) -> DataFrame:
    return w.ref("default.vw_pin_sale").groupBy("pin", "year").agg(F.count(F.lit(1)).alias("num_sales")).where("num_sales > 3")


@model("qc.vw_pin_value_null_values")
def vw_pin_value_null_values(w: Warehouse) -> DataFrame:
    columns = [f"{s}_{c}" for s in ("board", "certified", "mailed") for c in ("class", "tot_mv", "tot")]
    tests = {f"{c}_is_null": F.col(c).isNull() for c in columns}
    rows = w.ref("default.vw_pin_value").withColumns(tests)
    return rows.where(any_of([F.col(t) for t in tests])).select("pin", "year", "stage_name", *tests)


def with_parcel(w: Warehouse, rows: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """Parcel columns of the reference views; homes are left out."""
    names = {"jur": "jur", "class": "_class", "tieback": "_tieback", "nbhd": "_nbhd"} | (columns or {})
    rows = attach(rows, w.active("pardat"), PAR_KEYS, names).where(~F.col("_class").between("200", "299"))
    return rows.withColumns(
        {"pardat_class": hyphened("_class", 1), "tieback": hyphened("_tieback", 2, 4, 7, 10), "nbhd": hyphened("_nbhd", 2)}
    ).drop("_class", "_tieback", "_nbhd")


def labelled(w: Warehouse, rows: DataFrame, column: str, table: str, key: str, out: str) -> DataFrame:
    """"code:description"; an unknown code keeps its colon."""
    rows = attach(rows, w.src(table), {column: key}, {"description": "_text"})
    label = F.concat(F.coalesce(column, F.lit("")), F.when(F.col(column).isNotNull(), ":").otherwise(""), F.coalesce("_text", F.lit("")))
    return rows.withColumn(out, label).drop("_text")


@model("qc.vw_ic_reference_all_non_res_land_details")
def vw_ic_land_details(w: Warehouse) -> DataFrame:
    rows = w.active("land").select(
        "parid", "taxyr", "lline", "acres", "orate", "sf", "brate", "price", "ovrprice", hyphened("class", 1).alias("land_class"), "influ",
        "code", "note1", "allocpct", "influ2", "infl1", "infl2", "ltype", "oincr", "odecr", "exmppct", "osize", "user7",
    )
    rows = with_parcel(w, rows, {"zoning": "zoning"})
    rows = attach(rows, w.active("legdat"), PAR_KEYS, ["user1"])
    for c in ("infl1", "infl2"):
        rows = labelled(w, rows, c, "infl_reascd", "reascd", c)
    return rows


APPRAISED = ["comval", "obyval", "aprland", "aprtot", "aprbldg", "dwelval"]


def open_assessments(w: Warehouse) -> DataFrame:
    rows = not_in_history(w)
    return rows.where((F.col("cur") == "Y") & F.col("deactivat").isNull() & F.col("valclass").isNull() & (F.col("rolltype") != "RR"))


@model("qc.vw_ic_reference_all_non_res_pin_level_data")
def vw_ic_pin_level_data(w: Warehouse) -> DataFrame:
    rows = w.active("aprval").select("parid", "taxyr", *APPRAISED, "ecf", "exmppct")
    rows = with_parcel(w, rows, {"note1": "note1", "user1": "user1", "zoning": "zoning"})
    site = {"adrno": "adrno", "adrdir": "adrdir", "adrstr": "adrstr", "user1": "township_code", "cityname": "leg_cityname", "taxdist": "taxdist", "zip1": "leg_zip1"}
    rows = attach(rows, w.active("legdat"), PAR_KEYS, site)
    owner = {"own1": "own1", "addr1": "addr1", "cityname": "own_cityname", "statecode": "statecode", "zip1": "own_zipcode"}
    rows = attach(rows, w.active("owndat"), PAR_KEYS, owner)
    return attach(rows, open_assessments(w), PAR_KEYS, ["valasm1", "valasm2", "valasm3"])


@model("qc.vw_ic_reference_all_non_res_pin_level_prior_year_vals")
def vw_ic_prior_year_vals(w: Warehouse) -> DataFrame:
    """Last year's appraised and assessed values beside this year's parcel."""
    rows = w.active("aprval").select("parid", "taxyr", *APPRAISED)
    rows = attach(rows, open_assessments(w), PAR_KEYS, ["valasm3"])
    rows = rows.withColumn("taxyr", (F.col("taxyr").cast("int") + 1).cast("string"))
    rows = with_parcel(w, rows, {"note1": "note1"})
    rows = attach(rows, w.active("legdat"), PAR_KEYS, ["adrno", "adrdir", "adrstr", "cityname", "user1"])
    return attach(rows, w.active("owndat"), PAR_KEYS, ["own1"])


# Commercial columns and their printed names.
COMMERCIAL_NAMES = {
    "user16": "alt_cdu", "user20": "gross_building_area", "user26": "gross_building_description", "user28": "net_rentable_area",
    "user15": "basement_area", "user1": "stories", "parkcover": "parking_spaces", "user3": "studios", "user7": "one_beds",
    "user8": "two_beds", "user9": "three_beds", "user27": "four_beds", "user42": "mobile_home_pads", "user43": "comm_sf",
    "user44": "car_wash", "user45": "food_op_rental", "user46": "auto_service_bays", "user47": "idph_license_no",
    "user48": "ceiling_height", "user50": "agg_units", "user51": "agg_gross_bldg_area", "user52": "agg_net_rentable_area",
    "user54": "agg_studios", "user55": "agg_one_beds", "user56": "agg_two_beds", "user57": "agg_three_beds", "user58": "agg_four_beds",
    "user59": "agg_mobile_home_pads", "user60": "agg_comm_sf", "user61": "agg_car_wash", "user62": "agg_food_op_rental",
    "user63": "agg_auto_service_bays", "user64": "agg_idph_license_no", "user65": "agg_ceiling_height", "user30": "location_factor",
    "grade": "condition_factor", "user22": "investment_rating",
}
COMMERCIAL_PLAIN = [
    "bldnum", "class", "ovrrcnld", "card", "yrblt", "effyr", "chgrsn", "external_calc_rcnld", "external_occpct", "external_propct",
    "external_rcnld", "calc_meth", "imprname", "units", "note1", "note2", "exmppct", "user12", "user13", "user29",
]


@model("qc.vw_ic_reference_all_towns_com_bldg_detail")
def vw_ic_com_bldg_detail(w: Warehouse) -> DataFrame:
    names = [F.col(c).alias(n) for c, n in COMMERCIAL_NAMES.items()]
    rows = with_parcel(w, w.active("comdat").select("parid", "taxyr", *COMMERCIAL_PLAIN, *names)).drop("nbhd")
    rows = attach(rows, w.active("legdat"), PAR_KEYS, {"user1": "township_code"})
    lists = {"user12": "major_subclass", "user13": "minor_subclass", "user29": "model_group"}
    for c, n in lists.items():
        rows = labelled(w, rows, c, f"commercial_{n}", "code", n)
    return rows.drop(*lists)


@model("qc.vw_ic_reference_all_towns_oby_detail")
def vw_ic_oby_detail(w: Warehouse) -> DataFrame:
    rows = w.active("oby").select(
        "parid", "taxyr", "card", "lline", hyphened("class", 1).alias("oby_class"), "ovrrcnld", F.col("user20").alias("proration_percent"),
        F.col("user16").alias("alt_cdu"), "mktadj", "convoby", "yrblt", "chgrsn", F.col("user18").alias("held_market_value"),
        "external_calc_rcnld", "external_occpct", "external_propct", "external_rcnld", "calc_meth",
    )
    rows = with_parcel(w, rows).drop("nbhd")
    return attach(rows, w.active("legdat"), PAR_KEYS, {"user1": "township_code"}, "inner")


FARM_CLASSES = ("239", "224")


def land_tests() -> Column:
    """Texts of all land checks that a row fails."""
    # The checks and the texts they print.
    farm, lot, code = F.col("class").isin(*FARM_CLASSES), F.col("ltype"), F.col("code")
    tests = [
        (farm & (lot != "A"), "❌ Error: Farmland must have land type A (Acre)"),
        (farm & (code != "900"), "❌ Error: Farmland must have land code 900"),
        ((lot == "A") & ~farm, "❌ Error: Land type A must be farmland (class 239 or 224)"),
        ((code == "900") & ~farm, "❌ Error: Land code 900 must be farmland (class 239 or 224)"),
        ((lot == "G") & ~F.col("class").isin("EX", "RR"), "❌ Error: Land type G must have class EX or RR"),
        (code == "0", "❌ Error: Land code 0 should not exist"),
        ((code == "21") & (F.col("land_av") > 1), "❌ Error: Land code 21 (Common Area) must have land AV <= 1"),
        ((code == "56") & (F.col("land_av") <= 1), "❌ Error: Land code 56 (Unbuildable) must not have land AV <= 1"),
        (~F.col("land_class").isin("100", "200", "239", "241", "500"), "❌ Error: Land class must be 100, 200, 239, 241, or 500"),
        (farm & (F.col("land_class") == "200"), "🔍 Check: Review class 200 homestead land on farmland PINs"),
        (farm & (F.col("land_class") == "500"), "🔍 Check: Send industrial land on farmland PINs to Manager of Industrial"),
        (code.isin("500", "600", "EX"), "🔍 Check: Review land codes 500, 600, and EX"),
        (F.col("land_av_pct_diff") >= 100, "🔍 Check: Review big increases in land AV (>100%)"),
        (F.col("land_sf_zscore") > 2, "🔍 Check: Review values for PINs with largest land in the township"),
        (F.col("land_av_diff") <= 0, "🔍 Check: Review land value that is decreasing or has zero-percent change"),
    ]
    return F.filter(F.array(*[F.when(cond, F.lit(text)) for cond, text in tests]), lambda t: t.isNotNull())


@model("qc.vw_report_res_land")
def vw_report_res_land(w: Warehouse) -> DataFrame:
    def newest(rows: DataFrame) -> DataFrame:
        kept = rows.where((F.col("rolltype") == "RP") & (F.col("cur") == "Y") & F.col("valclass").isNull())
        return dedup_by_priority(kept, ["parid", "taxyr"], [F.col("wen").desc_nulls_last(), F.xxhash64(*kept.columns)])

    def current(table: str) -> DataFrame:
        return w.src(table).where("cur = 'Y'")

    par = w.active("pardat").where(F.substring("class", 1, 1).isin("1", "2"))
    rows = par.select("parid", "taxyr", "tieback", "class", F.col("nbhd").alias("nbhd_code"))
    rows = attach(rows, current("legdat"), PAR_KEYS, {"user1": "township_code", "taxdist": "taxdist"})
    now = {"valasm1": "land_av", "valasm2": "bldg_av", "valasm3": "tot_av", "val30": "hie_incentive_amount"}
    rows = attach(rows, newest(not_in_history(w)), PAR_KEYS, now, "inner")
    appraisal = {"reascd": "reascd", "revcode": "revcode", "who": "aprval_who", "wen": "aprval_wen", "wencalc": "aprval_wencalc", "whocalc": "aprval_whocalc", "spcflg": "spcflg"}
    rows = attach(rows, current("aprval"), PAR_KEYS, appraisal)
    lot = {"lline": "lline", "ltype": "ltype", "code": "code", "class": "land_class", "sf": "land_sf", "brate": "land_brate"}
    rows = attach(rows, current("land"), PAR_KEYS, lot)
    rows = attach(rows, current("owndat"), PAR_KEYS, {"own1": "owner_name"})
    marks = current("oby").groupBy("parid", "taxyr", "lline").agg(F.min("user10").alias("hie_incentive_year"))
    rows = attach(rows, marks, ["parid", "taxyr", "lline"], ["hie_incentive_year"])
    before = newest(w.src("asmt_all")).select(
        "parid", "taxyr", F.col("valasm1").alias("board_land_av_prev"), F.col("valasm2").alias("board_bldg_av_prev"),
        F.col("valasm3").alias("board_tot_av_prev"), F.col("class").alias("class_prev"),
        *[F.col(c).alias(f"asmt_prev_{c}") for c in ("wen", "wencalc", "who", "whocalc")],
    )
    rows = lag_join(rows, before, ["parid"], "taxyr", 1)
    towns = w.src("spatial.township").withColumn("township_code", F.col("township_code").cast("string"))
    rows = attach(rows, towns, ["township_code"], ["township_name"])
    change = F.col("land_av") - F.col("board_land_av_prev")
    rows = rows.withColumns(
        {
            "land_av_diff": change, "tot_av_diff": F.col("tot_av") - F.col("board_tot_av_prev"),
            "land_av_pct_diff": 100.0 * change / F.nullif(F.col("board_land_av_prev").cast("double"), F.lit(0.0)),
        }
    )
    for c in ("land_av_pct_diff", "land_sf"):
        rows = zscore(rows, ["township_code", "taxyr"], c, f"{c}_zscore")
    return rows.withColumn("tests", land_tests()).withColumnsRenamed({"parid": "pin", "taxyr": "year"}).drop("revcode", "township_code")


def town_close(where: str, extra: list[str] = ()):
    """A report over assessments with last year's values; ``where`` is SQL text, so nothing needs a session yet."""

    def build(w: Warehouse) -> DataFrame:
        columns = ["parid", "taxyr", "township_code", "class", *extra, "own1", "reascd", "who"]
        rows = w.ref("qc.vw_iasworld_asmt_all_with_prior_year_values").where(where)
        return rows.select(*columns, *[f"{c}_prev" for c in VALUES], *VALUES)

    return build


# Classes of land without buildings.
VACANT_CLASSES = (
    "100", "200", "239", "240", "241", "300", "400", "500", "550", "637", "637A", "637B", "650", "651", "651A", "651B", "700", "700A",
    "700B", "742", "742A", "742B", "800", "800A", "800B", "850", "850A", "850B", "900", "EX", "RR", "999", "535",
)
VACANT_WITH_VALUE = tuple(c for c in VACANT_CLASSES if c != "535")


_TAXED = "class NOT IN ('EX', 'RR')"
TOWN_CLOSE_REPORTS = {
    "0_land_value": (f"valasm1 = 0 AND {_TAXED} AND substr(parid, 11, 1) != '8'", []),
    "0_value": (f"valasm3 = 0 AND {_TAXED}", []),
    "class_does_not_equal_luc": ("class != luc", ["luc"]),
    "improved_class_without_bldg_value": (f"valasm2 = 0 AND class NOT IN {VACANT_CLASSES}", []),
    "vacant_class_with_bldg_value": (f"valasm2 != 0 AND class IN {VACANT_WITH_VALUE}", []),
}


@model("qc.vw_report_town_close_289s")
def vw_report_town_close_289s(w: Warehouse) -> DataFrame:
    rows = w.active("oby").where("class = '289'").select("parid", "taxyr", "class")
    rows = rows.join(w.active("pardat").select("parid", "taxyr"), ["parid", "taxyr"])
    return attach(rows, w.active("legdat"), PAR_KEYS, {"user1": "township_code"})


CARD_REASON = {"dweldat": "mktrsn", "comdat": "chgrsn", "oby": "chgrsn"}


@model("qc.vw_report_town_close_500k_increase_1m_decrease")
def vw_report_town_close_large_change(w: Warehouse) -> DataFrame:
    rows = w.ref("qc.vw_iasworld_asmt_all_with_prior_year_values")
    diff = F.col("valapr3") - F.col("valapr3_prev")
    rows = rows.where((diff >= 500_000) | (diff <= -1_000_000)).withColumn("difference", diff)
    rows = rows.withColumn("_last", (F.col("taxyr").cast("int") - 1).cast("string"))
    parcels = w.active("pardat").select("parid", "taxyr").distinct()
    for table, reason in CARD_REASON.items():
        coded = w.active(table).groupBy("parid", "taxyr").agg(F.max(known_true(F.substring(reason, 1, 1) == "5")).alias("_five"))
        marked = attach(parcels, coded, PAR_KEYS, ["_five"])
        mark = F.when(known_true(F.col("_five")), "Y").otherwise("")
        # a row for each parcel and year, which Spark takes for small
        rows = attach(rows, marked.withColumn("_mark", mark).hint("merge"), {"parid": "parid", "_last": "taxyr"}, {"_mark": f"{table}_code_5"})
    share = F.round(F.col("difference") / F.col("valapr3_prev").cast("double") * 100, 2)
    percent = F.when(F.col("valapr3_prev") != 0, F.concat(share.cast("string"), F.lit("%")))
    return rows.select(
        "parid", "taxyr", "township_code", "class", "reascd", *[f"valapr{i}_prev" for i in (1, 2, 3)], *[f"valapr{i}" for i in (1, 2, 3)],
        "difference", percent.alias("percent_change"), *[f"{t}_code_5" for t in CARD_REASON],
    )


# Classes that need no matching building.
NO_BUILDING_CLASSES = ("100", "200", "239", "240", "241", "300", "400", "500", "535", "550")
NO_BUILDING_PREFIXES = ("637", "700", "742", "800", "900")


@model("qc.vw_report_town_close_bldg_parcel_class_mismatch")
def vw_report_town_close_class_mismatch(w: Warehouse) -> DataFrame:
    par = w.active("pardat").select("parid", "taxyr", F.col("class").alias("parcel_class"))
    par = par.where(~F.col("parcel_class").isin(*NO_BUILDING_CLASSES) & ~F.substring("parcel_class", 1, 3).isin(*NO_BUILDING_PREFIXES))
    rows = attach(par, w.active("legdat"), PAR_KEYS, {"user1": "township_code"})
    for table in ("comdat", "dweldat", "oby"):
        classes = filtered_set_or_marker(w.active(table), ["parid", "taxyr"], "class", F.col("class").isNotNull(), "_classes")
        rows = attach(rows, classes, PAR_KEYS, {"_classes": f"{table}_classes"})
    lists = [F.col(f"{t}_classes") for t in ("comdat", "dweldat", "oby")]
    none_match = all_of([c.isNull() | ~F.array_contains(c, F.col("parcel_class")) for c in lists])
    bare = F.col("parcel_class").isin("EX", "RR") & all_of([c.isNull() for c in lists])
    rows = rows.where(none_match & ~bare)
    return rows.withColumns({f"{t}_classes": F.array_join(f"{t}_classes", ", ") for t in ("comdat", "dweldat", "oby")})


@model("qc.vw_report_town_close_ovrrcnlds_to_review")
def vw_report_town_close_overrides(w: Warehouse) -> DataFrame:
    parts = []
    for table, reason in CARD_REASON.items():
        line = F.col("lline").cast("string") if table == "oby" else F.lit(None).cast("string")
        parts.append(
            w.active(table).select(
                F.lit(table.upper()).alias("table_name"), "parid", "card", line.alias("lline"), "taxyr", "external_rcnld", "external_occpct",
                "external_propct", "external_calc_rcnld", "ovrrcnld", (F.col("external_calc_rcnld") - F.col("ovrrcnld")).alias("value_difference"),
                F.col(reason).alias("card_code"), F.col("user16").alias("alt_cdu"), "who", us_date("wen", "M/d/yyyy HH:mm").alias("wen"),
            )
        )
    rows = union_missing(parts).where("value_difference != 0")
    rows = attach(rows, w.active("pardat"), PAR_KEYS, ["class"], "inner")
    rows = attach(rows, w.active("legdat"), PAR_KEYS, {"user1": "township_code"})
    appraisal = w.active("aprval")
    before = appraisal.select("parid", "taxyr", F.col("aprbldg").alias("aprbldg_prev"))
    appraisal = lag_join(appraisal.withColumn("_revdt", us_date("revdt")), before, ["parid"], "taxyr", 1)
    rows = attach(rows, appraisal, PAR_KEYS, {"reascd": "reason_for_change", "_revdt": "revdt", "aprbldg": "aprbldg", "aprbldg_prev": "aprbldg_prev"})
    return rows.where(known_true(F.col("reason_for_change") != "22") | F.col("reason_for_change").isNull())


def code_five_report(table: str, value: str, keys: list[str]):
    """Cards with reason 5 last year: last year's value as a percentage of this year's, beside its occupancy."""
    reason = CARD_REASON[table]

    def build(w: Warehouse) -> DataFrame:
        cards = w.active(table)
        if table == "oby":
            cards = cards.join(w.active("pardat").select("parid", "taxyr"), ["parid", "taxyr"], "left_semi").hint("merge")
        occupied = F.coalesce("external_occpct", "mktadj")
        before = cards.where(F.col(reason).isin("5", "5B")).select(
            *keys, (F.col("taxyr").cast("int") + 1).cast("string").alias("taxyr"), reason, F.col(value).alias(f"{value}_prev"),
            occupied.alias("_occupied"),
        )
        now = cards.select(*keys, "taxyr", value, "external_occpct")
        rows = before.join(now, [*keys, "taxyr"], "left")
        percent = F.when(F.col(value) != 0, F.round(F.col(f"{value}_prev") / F.col(value).cast("double") * 100, 1))
        rows = rows.withColumns({f"pct_prev_of_cur_{value}": percent, "external_occpct_prev": F.round("_occupied", 1)})
        rows = rows.withColumn("difference_in_pct", F.round(F.col(f"pct_prev_of_cur_{value}") - F.col("_occupied"), 1))
        rows = rows.where(F.col("difference_in_pct").isNull() | (F.col("difference_in_pct") != 0)).drop("_occupied")
        names = ["township_code", "class", "own1", "reascd", "who", *[f"{c}_prev" for c in VALUES], *VALUES]
        return attach(rows, w.ref("qc.vw_iasworld_asmt_all_with_prior_year_values"), PAR_KEYS, names)

    return build


FIRST_CARDS = ["yrblt", "sfla", "stories", "rmbed", "fixbath", "fixhalf", "bsmt", "bsmt_fin", "external_propct", "alt_cdu"]


@model("qc.vw_report_town_close_res_edit")
def vw_report_town_close_res_edit(w: Warehouse) -> DataFrame:
    cards = w.active("dweldat").withColumns({"bsmt_fin": F.col("user12"), "alt_cdu": F.col("user16")})
    wide = first_n_wide(cards, ["parid", "taxyr"], [F.col("card"), F.xxhash64(*FIRST_CARDS)], 5, FIRST_CARDS)
    counted = cards.groupBy("parid", "taxyr").agg(F.count(F.lit(1)).alias("num_dwellings"))
    par = w.active("pardat").where(F.substring("class", 1, 1) == "2").select(
        "parid", "taxyr", "nbhd", "class", F.coalesce("tiebldgpct", F.lit(0)).alias("tiebldgpct")
    )
    site = ["adrno", "adradd", "adrdir", "adrstr", "adrsuf", "adrsuf2", "unitdesc", "unitno", "cityname"]
    rows = attach(par, w.active("legdat"), PAR_KEYS, {"user1": "township_code", **{c: c for c in site}})
    sums = ["aprland", "aprbldg", "aprtot", "dwelval"]
    appraisal = w.active("aprval").select("parid", "taxyr", *sums, "reascd", "obyval")
    before = appraisal.select("parid", "taxyr", *[F.col(c).alias(f"{c}_prev") for c in sums])
    appraisal = lag_join(appraisal, before, ["parid"], "taxyr", 1)
    rows = attach(rows, appraisal, PAR_KEYS, [c for c in appraisal.columns if c not in PAR_KEYS])
    rows = rows.withColumns({f"dweltot{s}": F.col(f"dwelval{s}") + F.col(f"aprland{s}") for s in ("", "_prev")})

    def change(c: str) -> Column:
        return F.round((F.col(c) - F.col(f"{c}_prev")) / F.nullif(F.col(f"{c}_prev").cast("double"), F.lit(0.0)), 2)

    rows = rows.withColumns({f"{c}_percent_change": change(c) for c in ("aprtot", "dweltot")})
    rows = attach(rows, counted, PAR_KEYS, ["num_dwellings"])
    rows = attach(rows, wide, PAR_KEYS, [c for c in wide.columns if c not in PAR_KEYS])
    rows = attach(rows, w.ref("default.vw_pin_land"), {"parid": "pin", "taxyr": "year"}, ["sf"])
    return attach(rows, recent_sale(w), ["parid"], ["saledt_fmt", "price", "instruno"])


def recent_sale(w: Warehouse) -> DataFrame:
    return w.ref("qc.vw_iasworld_sales_latest_sale").where("saledt >= '2021-01-01'")


@model("qc.vw_report_town_close_res_multicodes")
def vw_report_town_close_res_multicodes(w: Warehouse) -> DataFrame:
    cards = w.active("dweldat").select("parid", "taxyr", "card", F.col("class").alias("dweldat_class"), "sfla", "adjrcnld")
    cards = with_group_values(cards, ["parid", "taxyr"], [F.count(F.lit(1)).alias("_cards")]).where("_cards > 1").drop("_cards")
    before = w.active("dweldat").select("parid", "card", "taxyr", F.col("adjrcnld").alias("adjrcnld_prev"))
    rows = lag_join(cards, before, ["parid", "card"], "taxyr", 1)
    appraised = [f"valapr{i}{s}" for s in ("", "_prev") for i in (1, 2, 3)]
    names = {"township_code": "township_code", "class": "parcel_class", "nbhd": "nbhd", **{c: c for c in appraised}}
    rows = attach(rows, w.ref("qc.vw_iasworld_asmt_all_with_prior_year_values"), PAR_KEYS, names)
    return attach(rows, recent_sale(w), ["parid"], ["saledt_fmt", "price"])


@model("qc.vw_report_town_close_res_parcels_not_set_to_cost_approach")
def vw_report_town_close_not_cost_approach(w: Warehouse) -> DataFrame:
    rows = w.active("aprval").where(F.col("revcode").isNull() | (F.col("revcode") != "1")).select(
        "parid", "taxyr", "revcode", F.col("reascd").alias("reason_for_change"), "aprland", "aprbldg", "aprtot", "who",
        us_date("wen", "M/d/yyyy HH:mm").alias("wen"),
    )
    rows = attach(rows, w.active("pardat"), PAR_KEYS, ["class"]).where(F.col("class").like("2%"))
    return attach(rows, w.active("legdat"), PAR_KEYS, {"user1": "township_code"})


for _name, (_where, _extra) in TOWN_CLOSE_REPORTS.items():
    model(f"qc.vw_report_town_close_{_name}")(town_close(_where, _extra))
for _table, (_value, _keys) in {
    "comdat": ("bldgval", ["parid", "card"]), "dweldat": ("adjrcnld", ["parid", "card"]), "oby": ("adjrcnld", ["parid", "card", "lline"]),
}.items():
    model(f"qc.vw_report_town_close_prior_year_card_code_5s_{_table}")(code_five_report(_table, _value, _keys))
