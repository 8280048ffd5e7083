"""Survey statistics with years filled forward."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.operators.joins import asof_years
from plotwise.plans.warehouse import Warehouse, model


def _sum(table: str, *lines: int) -> Column:
    return reduce(lambda a, b: a + b, [F.col(f"{table}_{n:03d}e") for n in lines])


# Output name → (table, line numbers). The senior sum takes line 46 twice and leaves out line 47,
# as the published figures do.
COUNTS = {
    "count_sex_total": ("b01001", 1), "count_sex_male": ("b01001", 2), "count_sex_female": ("b01001", 26),
    "count_age_children": ("b01001", 3, 4, 5, 6, 7, 27, 28, 29, 30, 31),
    "count_age_senior": ("b01001", 20, 21, 22, 23, 24, 25, 44, 45, 46, 46, 48, 49),
    "median_age_total": ("b01002", 1), "median_age_male": ("b01002", 2), "median_age_female": ("b01002", 3),
    "count_race_total": ("b02001", 1), "count_race_white": ("b02001", 2), "count_race_black": ("b02001", 3),
    "count_race_hisp": ("b03003", 3), "count_race_aian": ("b02001", 4), "count_race_asian": ("b02001", 5),
    "count_race_nhpi": ("b02001", 6), "count_race_other": ("b02001", 7, 8, 9, 10),
    "count_mobility_total": ("b07003", 1), "count_mobility_no_move": ("b07003", 4), "count_mobility_moved_in_county": ("b07003", 7),
    "count_mobility_moved_in_state": ("b07003", 10), "count_mobility_moved_from_other_state": ("b07003", 13),
    "count_mobility_moved_from_abroad": ("b07003", 16),
    "count_household_total": ("b11001", 1), "count_household_family_total": ("b11001", 2), "count_household_family_married": ("b11001", 3),
    "count_household_family_other": ("b11001", 4), "count_household_nonfamily_alone": ("b11001", 8),
    "count_household_nonfamily_not_alone": ("b11001", 9),
    "count_education_total": ("b15002", 1), "count_education_high_school": ("b15002", 11, 28),
    "count_education_associate": ("b15002", 14, 31), "count_education_bachelor": ("b15002", 15, 32),
    "count_education_graduate": ("b15002", 16, 17, 18, 33, 34, 35),
    "count_income_total_poverty_level": ("b17001", 1), "count_income_below_poverty_level": ("b17001", 2),
    "count_income_above_poverty_level": ("b17001", 31),
    "median_income_household_past_year": ("b19013", 1), "median_income_per_capita_past_year": ("b19301", 1),
    "count_income_household_received_snap_past_year": ("b22003", 2),
    "count_employment_in_civilian_labor_force": ("b23025", 3), "count_employment_unemployed": ("b23025", 5),
    "count_employment_not_in_labor_force": ("b23025", 7),
    "count_household_total_occupied": ("b25003", 1), "count_household_owner_occupied": ("b25003", 2),
    "count_household_renter_occupied": ("b25003", 3),
    "median_household_total_occupied_year_built": ("b25037", 1), "median_household_owner_occupied_year_built": ("b25037", 2),
    "median_household_renter_occupied_year_built": ("b25037", 3),
    "median_household_renter_occupied_gross_rent": ("b25064", 1), "median_household_owner_occupied_value": ("b25077", 1),
    **{f"count_household_owner_occupied_{i}_sel_cond": ("b25123", i + 2) for i in range(1, 5)},
    **{f"count_household_renter_occupied_{i}_sel_cond": ("b25123", i + 8) for i in range(1, 5)},
}
# Share → (part, base), each a count above or a (table, lines) pair.
SHARES = {
    **{f"percent_sex_{s}": (f"count_sex_{s}", "count_sex_total") for s in ("male", "female")},
    **{f"percent_age_{s}": (f"count_age_{s}", "count_sex_total") for s in ("children", "senior")},
    **{f"percent_race_{s}": (f"count_race_{s}", "count_race_total") for s in ("white", "black", "hisp", "aian", "asian", "nhpi", "other")},
    **{
        f"percent_mobility_{s}": (f"count_mobility_{s}", "count_mobility_total")
        for s in ("no_move", "moved_in_county", "moved_in_state", "moved_from_other_state", "moved_from_abroad")
    },
    **{
        f"percent_household_{s}": (f"count_household_{s}", "count_household_total")
        for s in ("family_married", "nonfamily_alone", "nonfamily_not_alone")
    },
    **{
        f"percent_education_{s}": (f"count_education_{s}", "count_education_total")
        for s in ("high_school", "associate", "bachelor", "graduate")
    },
    **{
        f"percent_income_{s}_poverty_level": (f"count_income_{s}_poverty_level", "count_income_total_poverty_level")
        for s in ("below", "above")
    },
    "percent_income_household_received_snap_past_year": ("count_income_household_received_snap_past_year", ("b22003", 1)),
    "percent_employment_unemployed": ("count_employment_unemployed", "count_employment_in_civilian_labor_force"),
    **{f"percent_household_{s}_occupied": (f"count_household_{s}_occupied", "count_household_total_occupied") for s in ("owner", "renter")},
    "percent_household_total_occupied_w_sel_cond": (("b25123", 3, 4, 5, 6, 9, 10, 11, 12), ("b25123", 1)),
    "percent_household_owner_occupied_w_sel_cond": (("b25123", 3, 4, 5, 6), ("b25123", 2)),
    "percent_household_renter_occupied_w_sel_cond": (("b25123", 9, 10, 11, 12), ("b25123", 8)),
}


def _value(key) -> Column:
    table, *lines = COUNTS[key] if isinstance(key, str) else key
    return _sum(table, *lines)


@model("census.vw_acs5_stat")
def vw_acs5_stat(w: Warehouse) -> DataFrame:
    survey = w.src("census.acs5")
    walk = asof_years(survey, w.src("spatial.parcel"))
    rows = walk.join(survey.withColumnRenamed("year", "source_year"), "source_year")
    counts = {n: F.nullif(_value(n), F.lit(0.0)) if "year_built" in n else _value(n) for n in COUNTS}
    shares = {n: F.try_divide(_value(part), _value(base)) for n, (part, base) in SHARES.items()}
    return rows.select(
        "year", F.col("source_year").alias("acs5_data_year"), "geoid", "geography",
        *[c.alias(n) for n, c in {**counts, **shares}.items()],
    )
