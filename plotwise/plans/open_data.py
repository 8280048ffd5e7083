"""Published tables: a row id, whole-number years and decoded values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions.logic import decode
from plotwise.functions.text import row_id
from plotwise.operators.filters import equals_extreme
from plotwise.plans.warehouse import Warehouse, attach, model


def published(df: DataFrame, columns: list[str], key: list[str] = ("pin", "year")) -> DataFrame:
    """``row_id``, the columns, and the year as a number."""
    named = [F.col("year").cast("int").alias("year") if c == "year" else F.col(c) for c in columns]
    return df.select(row_id(*key).alias("row_id"), *named)


# Kinds of appeal hearings.
HEARINGS = {
    "1": "Assessor recommendation", "2": "Certificate of correction", "A": "Current year appeal",
    "C": "Current year appeal & prior year(s) certificate of error", "D": "Certificate of error only",
    "F": "Smartfile exemption certificate of error filing", "O": "Omitted assessment", "R": "Re-review",
    "S": "Specific objection", "T": "Taxable", "X": "Exempt",
}


@model("open_data.vw_appeal")
def vw_appeal(w: Warehouse) -> DataFrame:
    rows = w.ref("default.vw_pin_appeal")
    late = F.when(F.col("year") >= "2026", "Determinations for C and D records").otherwise("Certificate of error only")
    hearing = F.when(F.col("hearing_type") == "E", late).otherwise(decode("hearing_type", HEARINGS, F.col("hearing_type")))
    values = [f"{s}_{v}" for s in ("mailed", "certified") for v in ("bldg", "land", "tot")]
    reasons = [f"reason_{kind}{i}" for i in (1, 2, 3) for kind in ("code", "desc")]
    columns = ["pin", "class", "township_code", "year", *values, "case_no", "appeal_type", "hearing_type", "subkey", "change", *reasons]
    out = published(rows, [*columns, "agent_code", "agent_name", "status"], ["pin", "year", "case_no", "hearing_type", "subkey"])
    raw = rows.select(row_id("pin", "year", "case_no", "hearing_type", "subkey").alias("row_id"), hearing.alias("_hearing")).distinct()
    return attach(out, raw, ["row_id"], {"_hearing": "hearing_type"})


@model("open_data.vw_assessed_value")
def vw_assessed_value(w: Warehouse) -> DataFrame:
    values = [f"{s}_{v}" for s in ("mailed", "certified", "board") for v in ("bldg", "land", "tot", "hie")]
    return published(w.ref("default.vw_pin_history"), ["pin", "year", "class", "township_code", "township_name", "nbhd", *values])


@model("open_data.vw_parcel_address")
def vw_parcel_address(w: Warehouse) -> DataFrame:
    place = ["address_full", "address_city_name", "address_state", "address_zipcode_1"]
    columns = [f"prop_{p}" for p in place] + [f"{who}_{p}" for who in ("mail", "owner") for p in ("address_name", *place)]
    return published(w.ref("default.vw_pin_address"), ["pin", "pin10", "year", *columns])


# Columns of the wide distance table that are not published.
UNPUBLISHED_DISTANCE = ("speed_limit", "surface_type", "lanes")


@model("open_data.vw_parcel_proximity")
def vw_parcel_proximity(w: Warehouse) -> DataFrame:
    rows = w.ref("proximity.vw_pin10_proximity")
    columns = [c for c in rows.columns if not c.endswith(UNPUBLISHED_DISTANCE)]
    return published(rows, columns, ["pin10", "year"])


@model("open_data.vw_parcel_sale")
def vw_parcel_sale(w: Warehouse) -> DataFrame:
    rows = attach(w.ref("default.vw_pin_sale"), w.src("sale.deed_type"), {"deed_type": "deed_num"}, {"deed_name": "_deed"})
    rows = rows.withColumn("deed_type", F.col("_deed"))
    flags = ["sale_filter_same_sale_within_365", "sale_filter_less_than_10k", "sale_filter_deed_type"]
    columns = [
        "pin", "year", "township_code", "nbhd", "class", "sale_date", "is_mydec_date", "sale_price", "doc_no", "deed_type",
        "seller_name", "is_multisale", "num_parcels_sale", "buyer_name", "sale_type", *flags, "mydec_deed_type",
    ]
    return published(rows, columns, ["sale_key"])


@model("open_data.vw_parcel_status")
def vw_parcel_status(w: Warehouse) -> DataFrame:
    conditions = [f"{t}_cdu_{c}" for t in ("oby", "comdat", "dweldat") for c in ("code", "description")]
    columns = [
        "pin", "year", "class", "is_corner_lot", "is_ahsap", "is_exempt", "is_zero_bill", "is_parking_space",
        "parking_space_flag_reason", "is_common_area", "is_leasehold", "is_mixed_use", "is_railroad", "is_weird",
        "weird_flag_reason", *conditions, "pardat_note", "is_filler_class", "is_filler_pin",
    ]
    return published(w.ref("default.vw_pin_status"), columns)


@model("open_data.vw_parcel_universe_historical")
def vw_parcel_universe_historical(w: Warehouse) -> DataFrame:
    """All years; agency arrays become text."""
    rows = w.ref("default.vw_pin_universe").drop("combined_municipality_name")
    arrays = [f.name for f in rows.schema.fields if f.dataType.typeName() == "array"]
    return published(rows.withColumns({a: F.array_join(a, ", ") for a in arrays}), rows.columns)


@model("open_data.vw_parcel_universe_current")
def vw_parcel_universe_current(w: Warehouse) -> DataFrame:
    rows = w.ref("open_data.vw_parcel_universe_historical")
    return equals_extreme(rows, "year", rows, "year")


PERMIT_STATUS = {"C": "CLOSED", "L": "LEGACY", "M": "MANAGER REVIEW", "O": "OPEN", "P": "PENDING", "R": "RECHECK"}
PRIMARY_JOBS = {
    "1": "RESIDENTIAL PERMIT", "2": "COMMERCIAL PERMIT", "3": "RAILROAD PERMIT", "4": "EXEMPT PERMIT", "5": "OFFICE PERMIT",
    "6": "OCCUPANCY PERMIT", "7": "OTHER",
}


def code_map(codes: DataFrame) -> Column:
    """A code list (code, description) as one map; a scalar subquery, so Spark runs it once."""
    return codes.agg(F.map_from_entries(F.collect_list(F.struct("code", "description")))).scalar()


@model("open_data.vw_permit")
def vw_permit(w: Warehouse) -> DataFrame:
    """Permits with decoded jobs. The two long code lists are the sources "permit_job_code" and
    "permit_improvement_code"; the second decodes all four improvement columns."""
    rows = w.ref("default.vw_pin_permit").withColumns(
        {"_jobs": code_map(w.src("permit_job_code")), "_works": code_map(w.src("permit_improvement_code"))}
    )
    empty = F.lit("")
    key = F.concat("pin", F.coalesce("permit_number", empty), F.coalesce("date_issued", empty))
    works = [F.try_element_at("_works", F.col(f"improvement_code_{i}")).alias(f"improvement_code_{i}") for i in range(1, 5)]
    return rows.select(
        key.alias("row_id"), "pin", F.col("year").cast("int").alias("year"), "permit_number", "local_permit_number",
        F.col("date_issued").cast("timestamp").alias("date_issued"), "estimated_date_of_completion",
        decode("status", PERMIT_STATUS).alias("status"), decode("assessable", {"A": "Assessable", "N": "Non-Assessable"}).alias("assessable"),
        "amount", F.col("tax_municipality_name").alias("municipality"), F.col("township_name").alias("township"),
        F.col("prop_address_full").alias("property_address"), F.col("mail_address").alias("mailing_address"), "applicant_name",
        decode("job_code_primary", PRIMARY_JOBS).alias("job_code_primary"),
        F.try_element_at("_jobs", F.col("job_code_secondary")).alias("job_code_secondary"), "work_description", *works,
    )


@model("open_data.vw_property_tax_exempt_parcel")
def vw_property_tax_exempt_parcel(w: Warehouse) -> DataFrame:
    columns = [
        "pin", "year", "township_name", "township_code", "owner_name", "owner_num", "class", "property_address", "property_city",
        "lon", "lat",
    ]
    return published(w.ref("default.vw_pin_exempt"), columns)


@model("open_data.vw_res_condo_unit_char")
def vw_res_condo_unit_char(w: Warehouse) -> DataFrame:
    chars = ["yrblt", "building_sf", "unit_sf", "bedrooms", "half_baths", "full_baths", "building_non_units", "building_pins", "land_sf"]
    columns = [
        "pin", "pin10", "card", "year", "class", "township_code", "tieback_key_pin", "tieback_proration_rate", "card_proration_rate",
        *[f"char_{c}" for c in chars], "cdu", "bldg_is_mixed_use", "is_parking_space", "is_common_area", "pin_is_multiland",
        "pin_num_landlines",
    ]
    return published(w.ref("default.vw_pin_condo_char"), columns)


# Printed names of dwelling codes, by column.
DWELLING_CODES: dict[str, dict] = {
    "char_cnst_qlty": {"1": "Deluxe", "2": "Average", "3": "Poor"},
    "char_apts": {"1": "Two", "2": "Three", "3": "Four", "4": "Five", "5": "Six", "6": "None"},
    "char_attic_fnsh": {"1": "Living Area", "2": "Partial", "3": "None"},
    "char_gar1_att": {"1": "Yes", "2": "No"},
    "char_gar1_area": {"1": "Yes", "2": "No"},
    "char_gar1_size": {
        "1": "1 cars", "2": "1.5 cars", "3": "2 cars", "4": "2.5 cars", "5": "3 cars", "6": "3.5 cars", "7": "0 cars", "8": "4 cars",
    },
    "char_gar1_cnst": {"1": "Frame", "2": "Masonry", "3": "Frame + Masonry", "4": "Stucco"},
    "char_attic_type": {"1": "Full", "2": "Partial", "3": "None"},
    "char_bsmt": {"1": "Full", "2": "Slab", "3": "Partial", "4": "Crawl"},
    "char_ext_wall": {"1": "Frame", "2": "Masonry", "3": "Frame + Masonry", "4": "Stucco"},
    "char_heat": {"1": "Warm Air Furnace", "2": "Hot Water Steam", "3": "Electric Heater", "4": "None"},
    "char_repair_cnd": {"1": "Above Average", "2": "Average", "3": "Below Average"},
    "char_bsmt_fin": {"1": "Formal Rec Room", "2": "Apartment", "3": "Unfinished"},
    "char_roof_cnst": {"1": "Shingle + Asphalt", "2": "Tar + Gravel", "3": "Slate", "4": "Shake", "5": "Tile", "6": "Other"},
    "char_use": {"1": "Single-Family", "2": "Multi-Family"},
    "char_site": {"1": "Beneficial To Value", "2": "Not Relevant To Value", "3": "Detracts From Value"},
    "char_renovation": {"1": "Yes", "2": "No"},
    "char_porch": {"0": "None", "1": "Frame Enclosed", "2": "Masonry Enclosed"},
    "char_air": {"1": "Central A/C", "2": "No Central A/C"},
    "char_tp_plan": {"0": "None", "1": "Architect", "2": "Stock Plan"},
}
STORIES = {"1": "1 Story", "2": "2 Story", "3": "3 Story +", "4": "Split Level", **{str(n): "1.5 Story" for n in range(5, 10)}}


@model("open_data.vw_sf_mf_improvement_char")
def vw_sf_mf_improvement_char(w: Warehouse) -> DataFrame:
    rows = w.ref("default.vw_card_res_char")
    decoded = {c: decode(F.col(c).cast("string"), names) for c, names in DWELLING_CODES.items()}
    decoded["char_type_resd"] = decode(F.col("char_type_resd").cast("int").cast("string"), STORIES)
    plain = [
        "pin", "year", "card", "class", "township_code", "cdu", "tieback_key_pin", "tieback_proration_rate", "card_proration_rate",
        "pin_is_multicard", "pin_num_cards", "pin_is_multiland", "pin_num_landlines", "char_yrblt", "char_bldg_sf", "char_land_sf",
        "char_beds", "char_rooms", "char_fbath", "char_hbath", "char_frpl", "char_ncu",
    ]
    return published(rows.withColumns(decoded), [*plain, *decoded], ["pin", "card", "year"])
