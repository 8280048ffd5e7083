"""Dwelling and condominium characteristics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions.logic import known_true
from plotwise.functions.text import alnum_only
from plotwise.operators.grouped import first_in_group, with_group_values
from plotwise.operators.ordered import fill_backward, lag_values, recent_change
from plotwise.plans.values import stage_values
from plotwise.plans.warehouse import PAR_KEYS, PIN_YEAR, Warehouse, attach, model

# Dwelling columns and the characteristics they hold.
DWELLING = {
    "yrblt": "char_yrblt", "sfla": "char_bldg_sf", "rmbed": "char_beds", "rmtot": "char_rooms", "fixbath": "char_fbath",
    "fixhalf": "char_hbath", "wbfp_o": "char_frpl", "stories": "char_type_resd", "grade": "char_cnst_qlty",
    "user14": "char_apts", "user4": "char_tp_dsgn", "user6": "char_attic_fnsh", "user31": "char_gar1_att",
    "user32": "char_gar1_area", "user33": "char_gar1_size", "user34": "char_gar1_cnst", "attic": "char_attic_type",
    "bsmt": "char_bsmt", "extwall": "char_ext_wall", "heat": "char_heat", "user1": "char_repair_cnd",
    "user12": "char_bsmt_fin", "user13": "char_roof_cnst", "class": "char_class", "user15": "char_use", "user17": "char_age",
    "user2": "char_site", "user20": "char_ncu", "user3": "char_renovation", "user30": "char_porch", "user7": "char_air",
    "user5": "char_tp_plan",
}


@model("default.vw_card_res_char")
def vw_card_res_char(w: Warehouse) -> DataFrame:
    cards = w.active("dweldat")
    cards = with_group_values(cards, ["parid", "taxyr"], [F.count(F.lit(1)).alias("pin_num_cards")])
    par = w.active("pardat", drop_test_class=True)
    rows = attach(cards, par, PAR_KEYS, {"tieback": "tieback_key_pin", "tiebldgpct": "_tie"}, "inner")
    rows = recent_change(rows, ["parid", "card"], ["taxyr"], "user3", "1", 3, "char_recent_renovation")
    share = F.when(F.col("taxyr") < "2024", F.col("user24").cast("double")).otherwise(F.coalesce("external_propct", F.lit(0)))
    rows = rows.select(
        F.col("parid").alias("pin"), F.substring("parid", 1, 10).alias("pin10"), F.col("taxyr").alias("year"), "card", "seq",
        F.col("who").alias("updated_by"), F.to_timestamp("wen").alias("updated_at"), "class", "cdu", "tieback_key_pin",
        F.coalesce(F.col("_tie") / 100.0, F.lit(1.0)).alias("tieback_proration_rate"), (share / 100.0).alias("card_proration_rate"),
        (F.col("pin_num_cards") > 1).alias("pin_is_multicard"), "pin_num_cards",
        *[F.col(c).alias(n) for c, n in DWELLING.items()], "char_recent_renovation",
    )
    rows = attach(rows, w.ref("default.vw_pin_land"), ["pin", "year"], {"num_landlines": "pin_num_landlines", "sf": "char_land_sf"})
    rows = attach(rows, w.active("legdat"), PIN_YEAR, {"user1": "township_code"})
    # Code 297 with mark 13 stands for an in-ground pool.
    pools = w.active("oby").where("code = '297' AND user1 = '13'").select("parid", "taxyr").distinct()
    rows = attach(rows, pools.withColumn("_pool", F.lit(True)), PIN_YEAR, ["_pool"])
    return rows.withColumns(
        {
            "pin_is_multiland": known_true(F.col("pin_num_landlines") > 1),
            "char_in_ground_pool": known_true(F.col("_pool")),
        }
    ).drop("_pool")


CONDO_CLASSES = ("299", "399")


def top_line(w: Warehouse, table: str, order: str, cols: list[str]) -> DataFrame:
    """First condominium line of each parcel-year with the number of lines."""
    rows = w.src(table).where((F.col("cur") == "Y") & F.col("class").isin(*CONDO_CLASSES))
    first = F.min_by(F.struct(*cols), order).alias("_f")
    grouped = rows.groupBy("parid", "taxyr").agg(first, F.count(F.lit(1)).alias("num_lines"))
    return grouped.select("parid", "taxyr", F.lit(True).alias("here"), "num_lines", *[f"_f.{c}" for c in cols])


def condo_cards(w: Warehouse) -> DataFrame:
    """Condominium units: values from outbuilding lines for class 299, from commercial cards for class 399."""
    cols = ["card", "user16", "yrblt", "effyr", "external_propct"]
    oby = top_line(w, "oby", "lline", [*cols, "lline", "user20"])
    com = top_line(w, "comdat", "card", [*cols, "user24"])
    par = w.active("pardat").select(
        "parid", "taxyr", alnum_only("class").alias("class"), F.col("tieback").alias("tieback_key_pin"), "tiebldgpct",
        F.col("note2").alias("note"), "unitno",
    )
    rows = attach(par, oby, PAR_KEYS, {c: f"o_{c}" for c in oby.columns if c not in PAR_KEYS})
    rows = attach(rows, com, PAR_KEYS, {c: f"c_{c}" for c in com.columns if c not in PAR_KEYS})
    rows = rows.where(F.col("o_here") | F.col("c_here"))
    given = ["building_sf", "unit_sf", "bedrooms", "half_baths", "full_baths", "parking_pin"]
    rows = attach(rows, w.src("pin_condo_char"), {"parid": "pin"}, given)
    rows = attach(rows, w.src("legdat"), PAR_KEYS, {"user1": "township_code"})
    rows = attach(rows, w.src("pin_nonlivable"), {"parid": "pin"}, {"flag": "nonlivable"})
    as_oby, as_com = F.col("class") == "299", F.col("class") == "399"

    def prefer(o: Column, c: Column) -> Column:
        return F.when(as_com, F.coalesce(c, o)).otherwise(F.coalesce(o, c))

    one_side = F.col("o_card").isNull() | F.col("c_card").isNull()
    built_o, built_c = F.coalesce("o_yrblt", "o_effyr"), F.coalesce("c_yrblt", "c_effyr")
    condition = F.when(as_oby, F.col("o_user16")).when(
        as_com & F.col("nonlivable").isNotNull(), F.when(F.col("nonlivable") == "399 GR", "GR").otherwise(F.col("c_user16"))
    )
    share = F.when(F.col("taxyr") < "2024", prefer(F.col("o_user20"), F.col("c_user24")).cast("double")).otherwise(
        F.coalesce(prefer(F.col("o_external_propct"), F.col("c_external_propct")), F.lit(0))
    )
    whole = {f"char_{c}": F.round(c, 0).cast("int") for c in ("building_sf", "unit_sf")}
    whole |= {f"char_{c}": F.col(c).cast("int") for c in ("bedrooms", "half_baths", "full_baths")}
    # a group for each building and year, which Spark takes for few; so with the units below
    rows = with_group_values(
        rows.withColumn("pin10", F.substring("parid", 1, 10)).hint("merge"), ["pin10", "taxyr"],
        [F.max(~F.col("class").isin(*CONDO_CLASSES)).alias("bldg_is_mixed_use")],
    )
    return rows.where(F.col("class").isin(*CONDO_CLASSES)).select(
        F.col("parid").alias("pin"), "pin10", F.col("taxyr").alias("year"), "class", "township_code",
        F.when(one_side, F.coalesce("o_card", "c_card")).when(as_oby, F.col("o_card")).when(as_com, F.col("c_card")).alias("card"),
        F.col("o_lline").alias("lline"), F.coalesce("o_num_lines", "c_num_lines").alias("num_lines"), "tieback_key_pin",
        F.coalesce(F.col("tiebldgpct") / 100.0, F.lit(0.0)).alias("tieback_proration_rate"), (share / 100.0).alias("card_proration_rate"),
        condition.alias("cdu"), F.when(as_oby, F.coalesce(built_o, built_c)).otherwise(F.coalesce(built_c, built_o)).alias("char_yrblt"),
        *[c.alias(n) for n, c in whole.items()], "parking_pin", "unitno", "note", "nonlivable", known_true(F.col("bldg_is_mixed_use")).alias("bldg_is_mixed_use"),
    )


@model("default.vw_pin_condo_char")
def vw_pin_condo_char(w: Warehouse) -> DataFrame:
    units = condo_cards(w)
    # The condition of a unit's latest year holds for all its years; notes are filled from the next known year.
    units = first_in_group(units.withColumn("_late", -F.col("year").cast("int")).hint("merge"), ["pin"], ["_late"], {"cdu": "_cdu"})
    units = fill_backward(units, ["pin"], ["year"], {"note": "_note"}).withColumns({"cdu": F.col("_cdu"), "note": F.col("_note")})
    units = units.drop("_late", "_cdu", "_note")
    by_number = ((F.substring("unitno", 1, 1) == "P") & (F.substring("unitno", 1, 2) != "PH")) | (F.substring("unitno", 1, 3) == "GAR")
    by_staff = (F.col("note") == "PARKING/STORAGE/COMMON UNIT") | F.col("parking_pin")
    by_code, negative = F.col("cdu").isin("GR", "PS"), F.col("nonlivable") == "negative pred"
    questionable = known_true(F.col("nonlivable") == "questionable")
    tests = [known_true(c) for c in (by_code, by_staff, by_number, negative)]
    parking = (tests[0] | tests[1] | tests[2] | tests[3]) & ~questionable
    reason = (
        F.when(questionable, F.lit(None).cast("string")).when(tests[0], "cdu").when(tests[1], "identified by valuations as non-unit")
        .when(tests[2], "unit number").when(tests[3], "model predicted negative value")
    )
    units = units.withColumns(
        {
            "is_parking_space": parking, "parking_space_flag_reason": reason, "is_question_garage_unit": questionable,
            "is_negative_pred": tests[3], "pin_is_multilline": F.col("num_lines") > 1,
        }
    ).withColumnRenamed("num_lines", "pin_num_lline")
    units = with_group_values(
        units.hint("merge"), ["pin10", "year"],
        [F.count(F.lit(1)).alias("char_building_pins"), F.sum(F.col("is_parking_space").cast("long")).alias("char_building_non_units")],
    )
    units = attach(units, w.ref("default.vw_pin_land"), ["pin", "year"], {"num_landlines": "pin_num_landlines", "sf": "char_land_sf"})
    board = lag_values(stage_values(w).select("pin", "year", "board_tot"), ["pin"], ["year"], {"_before": ("board_tot", 1)})
    units = attach(units, board, ["pin", "year"], {"_before": "oneyr_pri_board_tot"})
    return units.withColumns(
        {
            "is_common_area": known_true(F.col("oneyr_pri_board_tot") < 10),
            "pin_is_multiland": known_true(F.col("pin_num_landlines") > 1),
        }
    ).drop("nonlivable", "parking_pin").distinct()
