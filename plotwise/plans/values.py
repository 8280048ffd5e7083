"""Assessed values by stage, their history, tax roll and land."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotwise.functions.logic import known_true, pre_certified, pre_mailed
from plotwise.functions.text import alnum_only
from plotwise.operators.ordered import lag_values
from plotwise.operators.reshape import wide_to_long
from plotwise.plans.warehouse import PIN_YEAR, Warehouse, attach, model
from plotwise.session import spread

# Printed names and numbers of the stages, latest first.
STAGES = {
    "board": ("BOARD CERTIFIED", 3.0),
    "certified": ("ASSESSOR CERTIFIED", 2.0),
    "pre_certified": ("ASSESSOR PRE-CERTIFIED", 1.5),
    "mailed": ("MAILED", 1.0),
    "pre_mailed": ("PRE-MAILED", 0.5),
}
# From this year on values are in the plain columns, before it in the override columns.
PLAIN_VALUES_FROM = "2020"
PARTS = {"land": 1, "bldg": 2, "tot": 3}


def assessments(w: Warehouse) -> DataFrame:
    """Assessment rows that carry a parcel's value: no railroads, no test classes, no value classes."""
    return w.src("asmt_all").where(
        (F.col("rolltype") != "RR") & F.col("deactivat").isNull() & F.col("valclass").isNull() & (F.col("class") != "999")
    )


def named_stages(w: Warehouse) -> DataFrame:
    """The set of finished stages of each parcel-year."""
    # Marks rather than a collected set: plain values combine before they are sent and need no objects.
    names = {f"_{i}": stage for i, stage in enumerate(w.settings.stages)}
    marked = assessments(w).groupBy("parid", "taxyr").agg(*[F.max(F.col("procname") == stage).alias(n) for n, stage in names.items()])
    known = F.array_compact(F.array(*[F.when(F.col(n), stage) for n, stage in names.items()]))
    return marked.select("parid", "taxyr", known.alias("stages"))


def stage_of(w: Warehouse) -> Column:
    """The stage a row belongs to, by its procedure name or, for open rows, by the finished stages."""
    s, proc = w.settings, F.col("procname")
    stages = F.coalesce("stages", F.array().cast("array<string>"))
    return (
        F.when(proc == s.mailed, "mailed").when(proc == s.certified, "certified").when(proc == s.board, "board")
        .when(pre_mailed(proc, F.col("cur"), stages), "pre_mailed")
        .when(pre_certified(proc, F.col("cur"), stages, s.certified), "pre_certified")
    )


def stage_values(w: Warehouse) -> DataFrame:
    """Values of all stages side by side, with the latest stage, for active parcels."""
    # One pass: rows are summed up by the stage that their own columns name, open ones apart, and the group's finished
    # stages then tell which stage its open rows belong to. A task holds so many rows, however short their files.
    settings, proc = w.settings, F.col("procname")
    named = F.when(proc == settings.mailed, "mailed").when(proc == settings.certified, "certified").when(proc == settings.board, "board")
    kind = F.coalesce(named, F.when(proc.isNull() & (F.col("cur") == "Y"), "open"))
    rows = spread(assessments(w).withColumn("_kind", kind).where("_kind IS NOT NULL"), w.src("asmt_all").count(), "parid", "taxyr")
    plain = F.col("taxyr") >= PLAIN_VALUES_FROM
    measures: dict[str, Column] = {"class": alnum_only("class")}
    for part in ("bldg", "land", "tot"):
        n = PARTS[part]
        measures[part] = F.when(plain, F.col(f"valasm{n}")).otherwise(F.col(f"ovrvalasm{n}"))
    measures["hie"] = F.when(plain, F.coalesce("tot30", F.lit(0)))
    for part in ("bldg", "land", "tot"):
        measures[f"{part}_mv"] = F.when(plain, F.col(f"valapr{PARTS[part]}"))
    # ``max`` gives the one value of a stage, and the same one on every run if a stage has several.
    kinds = ("open", "mailed", "certified", "board")
    grouped = rows.groupBy(F.col("parid").alias("pin"), F.col("taxyr").alias("year")).agg(
        *[F.count_if(F.col("_kind") == k).alias(f"_n_{k}") for k in kinds],
        *[F.max(F.when(F.col("_kind") == k, value)).alias(f"{k}_{name}") for k in kinds for name, value in measures.items()],
    )
    finished = sum((F.col(f"_n_{k}") for k in kinds[1:]), F.lit(0))
    this_year = F.date_format(w.date(), "yyyy")
    opened = {
        "pre_mailed": (F.col("_n_open") > 0) & (finished == 0) & (F.col("year") == this_year),
        "pre_certified": (F.col("_n_open") > 0) & (finished > 0) & (F.col("_n_certified") == 0),
    }
    wide = [
        (F.when(opened[stage], F.col(f"open_{name}")) if stage in opened else F.col(f"{stage}_{name}")).alias(f"{stage}_{name}")
        for stage in reversed(STAGES) for name in measures
    ]
    values = grouped.where((finished > 0) | opened["pre_mailed"]).select("pin", "year", *wide)
    latest = F.coalesce(*[F.when(F.col(f"{s}_tot").isNotNull(), F.lit(s)) for s in STAGES])
    name, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    for stage, (label, order) in reversed(STAGES.items()):
        name = F.when(latest == stage, label).otherwise(name)
        number = F.when(latest == stage, order).otherwise(number)
    values = values.withColumns({"stage_name": name, "stage_num": number})
    return attach(values, w.active("pardat").select("parid", "taxyr").distinct(), PIN_YEAR, [], "inner")


@model("default.vw_pin_value")
def vw_pin_value(w: Warehouse) -> DataFrame:
    values = stage_values(w)
    labels = F.create_map(*[F.lit(x) for s, (n, _) in STAGES.items() for x in (s, n)])
    reasons = w.src("aprval").where("reascd IS NOT NULL").join(named_stages(w), ["parid", "taxyr"], "left")
    reasons = reasons.select(
        F.col("parid").alias("pin"), F.col("taxyr").alias("year"), "reascd", F.try_element_at(labels, stage_of(w)).alias("stage_name")
    )
    described = attach(reasons, w.src("aprval_reascd"), ["reascd"], {"description": "change_reason"})
    return attach(values, described, ["pin", "year", "stage_name"], ["change_reason"])


@model("default.vw_pin_tax_roll")
def vw_pin_tax_roll(w: Warehouse) -> DataFrame:
    s = w.settings
    columns = {
        "mailed_taxable_av": (s.mailed, "tot13"), "certified_taxable_av": (s.certified, "tot13"),
        "board_taxable_av": (s.board, "tot13"), "final_eav": (s.final_eav, "tot51"),
    }
    rows = assessments(w).where(F.col("procname").isin(*s.stages, s.final_eav))
    roll = rows.groupBy(F.col("parid").alias("pin"), F.col("taxyr").alias("year")).agg(
        *[F.max(F.when(F.col("procname") == code, F.col(c))).alias(n) for n, (code, c) in columns.items()]
    )
    exemptions = w.ref("default.vw_pin_exe")
    roll = attach(roll, exemptions, ["pin", "year"], [c for c in exemptions.columns if c not in ("pin", "year")])
    return attach(roll, w.active("pardat"), PIN_YEAR, [], "inner")


@model("default.vw_pin_history")
def vw_pin_history(w: Warehouse) -> DataFrame:
    stages = ("pre_mailed", "mailed", "certified", "board")
    kept = [f"{s}_{v}" for s in stages for v in ("class", "bldg", "land", "tot", "hie")]
    carried = [f"{s}_{v}" for s in stages[1:] for v in ("bldg", "land", "tot", "hie")] + ["change_reason"]
    lags = {f"{word}yr_pri_{c}": (c, n) for word, n in (("one", 1), ("two", 2)) for c in carried}
    # wide rows: dealt by their number for the lags and for both joins, not by their length in a compressed shuffle
    number = w.src("asmt_all").count()
    values = spread(w.ref("default.vw_pin_value").select("pin", "year", *kept, "change_reason"), number, "pin")
    rows = spread(lag_values(values, ["pin"], ["year"], lags), number, "pin", "year")
    par = w.active("pardat").select(
        "parid", "taxyr", alnum_only("class").alias("class"), F.regexp_replace("nbhd", "[^0-9]", "").alias("nbhd")
    )
    out = attach(rows, par, PIN_YEAR, ["class", "nbhd"], "inner")
    out = attach(out, w.active("legdat"), PIN_YEAR, {"user1": "township_code"})
    return attach(out, w.src("spatial.township"), ["township_code"], ["township_name"])


@model("default.vw_pin_land")
def vw_pin_land(w: Warehouse) -> DataFrame:
    """Land area: the top line where several equal lines are prorated or the class is split, else the sum."""
    keys = ["parid", "taxyr"]
    lines = w.active("land").join(w.active("pardat").select(*keys), keys)
    prorated = F.when(F.col("taxyr") < "2024", F.col("influ").isNotNull()).otherwise(F.col("allocpct").isNotNull())
    split = known_true(F.col("infl1") == "35")
    # Lines of a parcel-year are few by nature: a window on the join's keys, so that lines are sent once.
    group = Window.partitionBy(*keys)
    values = {
        "num_landlines": F.count(F.lit(1)), "_sum": F.sum("sf"), "_top": F.min_by(F.struct("sf"), "lline"), "_prorated": F.count_if(prorated),
        "_max": F.max("sf"), "_min": F.min("sf"), "_line": F.min("lline"),
    }
    # A parcel-year gives one row for each of its top lines; there is normally one.
    grouped = lines.withColumns({n: c.over(group) for n, c in values.items()}).where(F.col("lline") == F.col("_line"))
    equal = (F.col("_prorated") > 1) & (F.col("_max") == F.col("_min"))
    return grouped.select(
        F.col("parid").alias("pin"), F.col("taxyr").alias("year"), "num_landlines",
        F.when(equal | split, F.col("_top.sf")).otherwise(F.col("_sum")).alias("sf"),
    )


LONG_STAGES = {
    "PRE-MAILED": {"stage_num": 0.5}, "MAILED": {"stage_num": 1.0}, "ASSESSOR PRE-CERTIFIED": {"stage_num": 1.5},
    "ASSESSOR CERTIFIED": {"stage_num": 2.0}, "BOR CERTIFIED": {"stage_num": 3.0},
}


@model("reporting.vw_pin_value_long")
def vw_pin_value_long(w: Warehouse) -> DataFrame:
    order = ("pre_mailed", "mailed", "pre_certified", "certified", "board")
    measures = {m: [f"{s}_{m}" for s in order] for m in ("class", "bldg", "land", "tot", "bldg_mv", "land_mv", "tot_mv")}
    long = wide_to_long(w.ref("default.vw_pin_value"), ["pin", "year"], LONG_STAGES, measures, label="stage_name")
    groups = {"reporting_class_code": "major_class", "modeling_group": "property_group"}
    return attach(long.where(F.col("class").isNotNull()), w.src("class_dict"), {"class": "class_code"}, groups, "inner")
