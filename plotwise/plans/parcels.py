"""Parcel-year tables: addresses, exemptions, exemptions wide, status, permits, appeals, universe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions.logic import decode, known_true, yes_no
from plotwise.functions.text import alnum_only, concat_address, digits_only, empty_to_null
from plotwise.operators.filters import suppress
from plotwise.operators.grouped import with_group_values
from plotwise.operators.joins import clamp_year_join, trailing_years_join
from plotwise.operators.ordered import dedup_by_priority, fill_forward
from plotwise.plans.warehouse import PAR_KEYS, PIN_YEAR, Warehouse, attach, model


@model("util.vw_time_util")
def vw_time_util(w: Warehouse) -> DataFrame:
    return w.spark.range(1).select(w.date().alias("date_today"))


def parcel_base(w: Warehouse, drop_test_class: bool = False) -> DataFrame:
    """Active parcels with their township."""
    par = w.active("pardat", drop_test_class)
    return attach(par, w.active("legdat"), PAR_KEYS, {"user1": "township_code"})


def plain_parcel_id(c: Column) -> Column:
    return (F.regexp_count(c, F.lit("[a-zA-Z]")) == 0) & (F.length(c) == 14)


def zip_part(c: str, empty: str) -> Column:
    return F.nullif(F.col(c), F.lit(empty))


@model("default.vw_pin_address")
def vw_pin_address(w: Warehouse) -> DataFrame:
    par = w.active("pardat", drop_test_class=True)
    par = par.where(plain_parcel_id(F.col("parid"))).select(
        F.col("parid").alias("pin"), F.substring("parid", 1, 10).alias("pin10"), F.col("taxyr").alias("year")
    )
    number = F.when(F.col("adrno") != 0, F.col("adrno"))
    street = ["adrpre", number.cast("string"), "adrdir", "adrstr", "adrsuf", "unitdesc", "unitno"]
    names = {
        "adrpre": "prefix", "adrdir": "street_dir", "adrstr": "street_name", "adrsuf": "suffix_1", "adrsuf2": "suffix_2",
        "unitdesc": "unit_prefix", "unitno": "unit_number", "cityname": "city_name", "statecode": "state",
    }
    site = w.active("legdat").select(
        "parid", "taxyr",
        *[F.col(c).alias(f"prop_address_{n}") for c, n in names.items()],
        number.alias("prop_address_street_number"),
        empty_to_null(F.concat_ws(" ", *street)).alias("prop_address_full"),
        zip_part("zip1", "00000").alias("prop_address_zipcode_1"),
        zip_part("zip2", "0000").alias("prop_address_zipcode_2"),
    )
    parts = F.concat_ws(" ", F.col("adrno").cast("string"), "adrdir", "adrstr", "adrsuf", "unitdesc", "unitno")
    owner = w.active("owndat").select(
        "parid", "taxyr",
        empty_to_null(F.concat_ws(" ", "own1", "own2")).alias("owner_address_name"),
        F.coalesce(empty_to_null("addr1"), empty_to_null("addr2"), empty_to_null(parts)).alias("owner_address_full"),
        F.col("cityname").alias("owner_address_city_name"),
        F.col("statecode").alias("owner_address_state"),
        zip_part("zip1", "00000").alias("owner_address_zipcode_1"),
        zip_part("zip2", "0000").alias("owner_address_zipcode_2"),
    )
    mail = with_group_values(w.active("maildat"), ["parid", "taxyr"], [F.max("mailseq").alias("_newest")])
    mail = mail.where(F.col("mailseq") == F.col("_newest")).select(
        "parid", "taxyr",
        concat_address("mail1", "mail2").alias("mail_address_name"),
        concat_address("maddr1", "maddr2").alias("mail_address_full"),
        F.col("mcityname").alias("mail_address_city_name"),
        F.col("mstatecode").alias("mail_address_state"),
        zip_part("mzip1", "00000").alias("mail_address_zipcode_1"),
        zip_part("mzip2", "0000").alias("mail_address_zipcode_2"),
    )
    out, private = par, []
    for right in (site, owner, mail):
        cols = [c for c in right.columns if c not in ("parid", "taxyr")]
        private += [c for c in cols if not c.startswith("prop_")]
        out = attach(out, right, PIN_YEAR, cols)
    return suppress(out, w.src("hidename"), "pin", private)


# Codes of each exemption.
EXEMPTION_CODES = {
    "exe_disabled": ("DP", "C-DP", "DPHE"),
    "exe_freeze": ("SF", "C-SF"),
    "exe_homeowner": ("HO", "C-HO"),
    "exe_longtime_homeowner": ("LT", "C-LT", "LT1", "LT2"),
    "exe_senior": ("SR", "C-SR", "SC", "SCHE"),
    "exe_muni_built": ("MUNI",),
    "exe_vet_dis_lt50": ("DV1", "C-DV1", "DV0", "C-DV0", "DV-1"),
    "exe_vet_dis_50_69": ("DV2", "C-DV2", "DV-2"),
    "exe_vet_dis_ge70": ("DV3", "C-DV3", "DV3-M", "DV-3"),
    "exe_vet_dis_100": ("DV4", "DV4-M", "DV-4"),
    "exe_vet_dis_100_idor": ("DV5",),
    "exe_vet_returning": ("RTV", "C-RTV", "RDV1", "RV1", "RDV2"),
    "exe_wwii": ("WW2",),
}
WIDE_EXEMPTIONS = [e for e in EXEMPTION_CODES if e != "exe_vet_dis_100_idor"]


@model("default.vw_pin_exe_long")
def vw_pin_exe_long(w: Warehouse) -> DataFrame:
    kinds = {code: kind for kind, codes in EXEMPTION_CODES.items() for code in codes}
    granted = w.active("exadmn").where("exstat = 'A'").select(
        "parid", "taxyr", "caseno", "excode", "user126", F.substring("udate9", 1, 10).alias("_day")
    )
    detail = w.active("exdet").where(F.substring("excode", 1, 2) != "I-")
    rows = detail.select("parid", "taxyr", "caseno", "excode", "apother").join(
        granted, ["parid", "taxyr", "caseno", "excode"]
    )
    rows = rows.join(w.active("excode").select("excode", "taxyr"), ["excode", "taxyr"])
    rows = rows.join(w.active("pardat").select("parid", "taxyr"), ["parid", "taxyr"])
    named = rows.select(
        F.col("parid").alias("pin"), F.col("taxyr").alias("year"), F.col("excode").alias("exemption_code"),
        decode("excode", kinds).alias("exemption_type"), F.col("apother").cast("int").alias("exemption_amount"),
        yes_no(F.upper(F.substring("user126", 1, 1))).alias("is_cofe"), F.to_date("_day").cast("timestamp").alias("cofe_date"),
    )
    # The code settles ties, which the order alone would leave open.
    order = [F.col(c).desc_nulls_last() for c in ("is_cofe", "cofe_date", "exemption_amount")] + [F.col("exemption_code")]
    return dedup_by_priority(named, ["pin", "year", "exemption_type"], order)


@model("default.vw_pin_exe")
def vw_pin_exe(w: Warehouse) -> DataFrame:
    amount = F.col("exemption_amount")
    sums = [
        F.sum(F.when(F.col("exemption_type") == e, amount).otherwise(0)).cast("int").alias(e) for e in WIDE_EXEMPTIONS
    ]
    return w.ref("default.vw_pin_exe_long").groupBy("pin", "year").agg(*sums)


@model("default.vw_pin_exempt")
def vw_pin_exempt(w: Warehouse) -> DataFrame:
    par = parcel_base(w, drop_test_class=True).where(plain_parcel_id(F.col("parid")) & (F.col("taxyr") >= "2022"))
    owned = attach(par, w.active("owndat"), PAR_KEYS, {"own1": "owner_name", "ownnum": "owner_num"})
    owned = owned.where(F.col("owner_num").isNotNull()).select(
        F.col("parid").alias("pin"), F.col("taxyr").alias("year"), "township_code", "owner_name", "owner_num",
        alnum_only("class").alias("class"),
    )
    address = w.ref("default.vw_pin_address")
    out = attach(
        owned, address, ["pin", "year"],
        {"pin10": "pin10", "prop_address_full": "property_address", "prop_address_city_name": "property_city"},
    )
    out = attach(out, w.src("spatial.parcel"), ["pin10", "year"], {"lon": "_lon", "lat": "_lat"})
    out = fill_forward(out, ["pin"], ["year"], {"_lon": "lon", "_lat": "lat"})
    towns = w.src("spatial.township").withColumn("township_code", F.col("township_code").cast("string"))
    out = attach(out, towns, ["township_code"], ["township_name"])
    return out.select(
        "pin", "year", "township_name", "township_code", "owner_name", "owner_num", "class", "property_address",
        "property_city", "lon", "lat",
    )


@model("default.vw_pin_permit")
def vw_pin_permit(w: Warehouse) -> DataFrame:
    single = F.when(F.length("adradd") == 1, F.col("adradd"))
    direction = F.coalesce("adrdir", single)
    number = F.col("adrno")
    street = F.concat_ws(" ", number.cast("string"), direction, "adrstr", "adrsuf", "adrsuf2")
    mail = F.replace(F.regexp_replace("note2", ",,$", ""), F.lit(",,"), F.lit(", "))
    plain = {
        "num": "permit_number", "user28": "local_permit_number", "permdt": "date_issued", "certdate": "date_submitted",
        "udate2": "estimated_date_of_completion", "user31": "assessment_year", "flag": "status", "user18": "assessable",
        "amount": "amount", "adrno": "prop_address_street_number", "adrstr": "prop_address_street_name",
        "adrsuf": "prop_address_suffix_1", "adrsuf2": "prop_address_suffix_2", "user21": "applicant_name",
        "why": "job_code_primary", "user42": "job_code_secondary", "user43": "work_description",
        **{f"user{i + 5}": f"improvement_code_{i}" for i in range(1, 5)}, "id1": "filing_type", "note3": "notes",
    }
    permits = w.active("permit").select(
        F.col("parid").alias("pin"), F.substring("permdt", 1, 4).alias("year"),
        F.coalesce("udate3", "wen").alias("date_updated"), digits_only("user11").cast("int").alias("recheck_year"),
        empty_to_null(street).alias("prop_address_full"), direction.alias("prop_address_street_dir"),
        mail.alias("mail_address"), *[F.col(c).alias(n) for c, n in plain.items()],
    )
    universe = w.ref("default.vw_pin_universe").select(
        "pin", "year", "township_name",
        empty_to_null(F.array_join("tax_municipality_name", ", ")).alias("tax_municipality_name"),
    )
    return attach(permits, universe, ["pin", "year"], ["township_name", "tax_municipality_name"])


APPEAL_TYPES = {
    "CC": "condo/coop", "CE": "c of e - exempt", "CI": "c of e - incentive", "CO": "c of e - omitted",
    "CV": "c of e - valuations", "IC": "commercial", "IN": "incentive", "LD": "land", "OM": "omitted assessment",
    "RS": "residential",
}
APPEAL_STATUS = {"C": "closed", "O": "open", "P": "pending", "X": "closed pending c of e"}
# Mark columns of the appeal reasons, and classes heard as condominiums.
APPEAL_REASONS = {
    "user19": "reason_lack_of_uniformity", "user20": "reason_fire_damage", "user21": "reason_building_no_longer_exists",
    "user22": "reason_over_valuation", "user23": "reason_property_description_error", "user24": "reason_vacancy_occupancy",
    "user25": "reason_building_is_uninhabitable", "user109": "reason_homeowner_exemption",
    "user110": "reason_legal_argument", "user40": "reason_other",
}
CONDO_APPEAL_CLASSES = ("213", "297", "299", "399", "599")


def appeal_reason_code(old: str, new: str) -> Column:
    """Up to 2020 the code is the start of one field; later it is another field."""
    early = F.trim(F.substring(old, 1, 2))
    return F.when((F.col("taxyr") <= "2020") & ~early.isin("0", ":"), early).when(F.col("taxyr") > "2020", alnum_only(new))


@model("default.vw_pin_appeal")
def vw_pin_appeal(w: Warehouse) -> DataFrame:
    heard = (F.col("heartyp") == "A") | ((F.col("heartyp") == "C") & (F.substring("caseno", 1, 3) != "COE"))
    outcome = F.trim(F.lower("user104"))
    early = F.col("taxyr") <= "2020"
    change = (
        F.when(early, decode("resact", {"C": "change", "NC": "no change"}))
        .when(outcome == "decrease", "change")
        .when(outcome.isin("change", "no change"), outcome)
    )
    codes = {f"reason_code{i}": pair for i, pair in enumerate((("user42", "user89"), ("user43", "user100"), ("user44", "user101")), 1)}
    rows = (
        w.active("htpar").where(F.col("caseno").isNotNull() & heard)
        .select(
            F.col("parid").alias("pin"), F.col("taxyr").alias("year"), F.col("caseno").alias("case_no"),
            F.col("heartyp").alias("hearing_type"), "subkey", "user38",
            *[yes_no(c).alias(n) for c, n in APPEAL_REASONS.items()], F.col("user81").alias("reason_other_description"),
            change.alias("change"), *[appeal_reason_code(*pair).alias(n) for n, pair in codes.items()],
            F.col("cpatty").alias("agent_code"), decode("hrstatus", APPEAL_STATUS).alias("status"), "user125",
        )
        .distinct()
    )
    par = parcel_base(w).withColumn("class", alnum_only("class"))
    rows = attach(rows, par, PIN_YEAR, ["class", "township_code"], "inner")
    values = [f"{s}_{v}" for s in ("mailed", "certified") for v in ("bldg", "land", "tot")]
    rows = attach(rows, w.ref("default.vw_pin_value"), ["pin", "year"], values)
    rows = attach(rows, w.active("htagnt"), {"agent_code": "agent"}, {"name1": "agent_name"})
    for i in (1, 2, 3):
        rows = attach(rows, w.src("htpar_reascd"), {f"reason_code{i}": "reascd"}, {"description": f"reason_desc{i}"})
    as_condo = F.col("user38").isin("RS", "IC") & F.col("class").isin(*CONDO_APPEAL_CLASSES)
    kind = F.when(as_condo, "condo/coop").otherwise(decode("user38", APPEAL_TYPES))
    return rows.withColumn("appeal_type", kind).drop("user38", "user125")


def condition_codes(w: Warehouse, table: str, column: str) -> DataFrame:
    """Distinct condition codes and descriptions of each parcel-year in one string."""
    rows = w.active(table).where(F.col(column).isNotNull()).select("parid", "taxyr", F.upper(column).alias("code"))
    named = attach(rows.distinct(), w.src("cdu"), {"code": "cdu_code"}, {"cdu_description": "description"})
    return named.groupBy("parid", "taxyr").agg(
        F.array_join(F.array_sort(F.collect_set("code")), ", ").alias("cdu_code"),
        F.array_join(F.array_sort(F.collect_set("description")), ", ").alias("cdu_description"),
    )


def starts(c: str, text: str) -> Column:
    return F.substring(c, 1, len(text)) == text


def affordable_and_mixed(w: Warehouse) -> DataFrame:
    """Affordable-housing and mixed-use flags of each parcel-year.

    Each table is reduced to its own flags first, so no product of cards, lines and lots is built.
    """
    keys = ["parid", "taxyr"]

    def flags(table: str, **conds: Column) -> DataFrame:
        aggs = [F.max(known_true(c)).alias(n) for n, c in conds.items()]
        return w.active(table).groupBy(*keys).agg(*aggs)

    oby_class, two = F.col("class"), F.substring("class", 1, 1)
    parts = [
        flags("land", land_a=F.col("infl1").isin("30", "31", "32") | starts("user7", "SAP")),
        flags(
            "oby", oby_a=starts("user16", "AI") | starts("user3", "SAP"),
            oby_other=~two.isin("1", "2") & ~oby_class.isin("OA2", "EX"), oby_res=(two == "2") | (oby_class == "OA2"),
        ),
        flags(
            "comdat", com_a=starts("user16", "AI") | starts("user4", "SAP") | F.col("user13").isin("49", "50", "51"),
            com_any=F.lit(True), com_class=F.col("class").isNotNull(),
        ),
        flags("aprval", apr_a=F.col("ecf").isNotNull()),
        flags("dweldat", dwel_a=starts("user16", "AI"), dwel_class=F.col("class").isNotNull()),
        flags("exadmn", adm_a=F.col("excode") == "INCV"),
    ]
    out = w.active("pardat").select(*keys).distinct()
    for part in parts:
        out = out.join(part, keys, "left")

    def on(name: str) -> Column:
        return known_true(F.col(name))

    affordable = on("land_a") | on("oby_a") | on("com_a") | on("apr_a") | on("dwel_a") | on("adm_a")
    mixed = (on("dwel_class") & (on("com_any") | on("oby_other"))) | (on("oby_res") & on("com_class"))
    return out.select(*keys, affordable.alias("is_ahsap"), mixed.alias("is_mixed_use"))


def assessable_permits(w: Warehouse) -> DataFrame:
    """Assessable permits of the year and the two before it."""
    permits = w.ref("default.vw_pin_permit").where("assessable = 'A' AND date_issued IS NOT NULL")
    yearly = permits.groupBy("pin", F.substring("date_issued", 1, 4).alias("year")).agg(F.count(F.lit(1)).alias("n"))
    parcels = w.src("pardat").select(F.col("parid").alias("pin"), F.col("taxyr").alias("year")).distinct()
    out = trailing_years_join(parcels, yearly, ["pin"], "year", 2, [F.sum("n").alias("_n")])
    return out.select("pin", "year", F.coalesce("_n", F.lit(0)).alias("num_assessable_permits"))


def corner_lot_flags(w: Warehouse) -> DataFrame:
    """Corner-lot flag of each active parcel-year; unknown before the first year of the corner table."""
    par = w.active("pardat").select(
        F.col("parid").alias("pin"), F.col("taxyr").alias("year"), F.substring("parid", 1, 10).alias("pin10")
    )
    corner = w.src("spatial.corner").select("pin10", "year", F.col("is_corner_lot").alias("_corner"))
    first_year = w.src("spatial.corner").agg(F.min("year")).scalar()
    out = clamp_year_join(par, corner, ["pin10"], "year")
    return out.select("pin", "year", F.when(F.col("year") >= first_year, known_true(F.col("_corner"))).alias("is_corner_lot"))


@model("default.vw_pin_status")
def vw_pin_status(w: Warehouse) -> DataFrame:
    par = w.active("pardat").select(
        F.col("parid").alias("pin"), F.col("taxyr").alias("year"), "class", F.col("note2").alias("pardat_note")
    )
    out = attach(par, corner_lot_flags(w), ["pin", "year"], ["is_corner_lot"])
    out = attach(out, affordable_and_mixed(w), PIN_YEAR, ["is_ahsap", "is_mixed_use"])
    exempt = w.ref("default.vw_pin_exempt").select("pin", "year", F.lit(True).alias("_exempt"))
    out = attach(out, exempt, ["pin", "year"], ["_exempt"])
    out = attach(out, w.src("tax.pin"), ["pin", "year"], {"tax_bill_total": "_bill"})
    condo = ["is_parking_space", "parking_space_flag_reason", "is_common_area"]
    out = attach(out, w.ref("default.vw_pin_condo_char"), ["pin", "year"], condo)
    for table in ("oby", "comdat", "dweldat"):
        names = {c: f"{table}_{c}" for c in ("cdu_code", "cdu_description")}
        out = attach(out, condition_codes(w, table, "user16"), PIN_YEAR, names)
    out = attach(out, w.src("pin_test"), ["pin", "year"], {"test_type": "weird_flag_reason"})
    out = attach(out, assessable_permits(w), ["pin", "year"], {"num_assessable_permits": "_permits"})
    return out.withColumns(
        {
            "is_exempt": known_true(F.col("_exempt")),
            "is_zero_bill": F.col("_bill") == 0,
            "is_leasehold": F.substring("pin", 11, 1) == "8",
            "is_railroad": F.col("class") == "RR",
            "is_weird": F.col("weird_flag_reason").isNotNull(),
            "is_filler_class": F.col("class") == "999",
            "is_filler_pin": F.col("pin").like("%999%"),
            "has_recent_assessable_permit": F.col("_permits") > 0,
        }
    ).drop("_exempt", "_bill", "_permits")
