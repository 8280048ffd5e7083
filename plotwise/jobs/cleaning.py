"""Jobs that turn landed rows into typed tables: declarations, reviews, rates, foreclosures, appeals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotwise.functions.text import digits_only, squeeze
from plotwise.operators.grouped import with_group_values
from plotwise.operators.ordered import dedup_by_priority
from plotwise.operators.reshape import union_missing
from plotwise.sources.readers import typed, wide_rates


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def blank_to_null(df: DataFrame, blanks: tuple[str, ...] = ("", "NULL")) -> DataFrame:
    """Squeeze text columns and null the values that stand for nothing."""
    cleaned = {c: F.when(~squeeze(c).isin(*blanks), squeeze(c)) for c in text_columns(df)}
    return df.withColumns(cleaned)


def known_count(columns: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in columns])


def sale_declarations(
    raw: DataFrame, crosswalk: dict[str, tuple[str, str]], document: str = "document_number",
    total: str = "line_2_total_parcels", pin: str = "line_1_primary_pin", date: str = "line_4_instrument_date",
    recorded: str = "date_recorded", year: str = "year",
) -> DataFrame:
    """Transfer declarations: rename, type, drop rows without a document, keep consistent documents.

    A document's rows must share one date, and their number must be its parcel total unless there is one row.
    Of several rows for one parcel the fullest stays.
    """
    missing = [c for c in crosswalk if c not in raw.columns]
    whole = raw.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else raw
    tidy = blank_to_null(whole)
    dates = {c: F.substring(c, 1, 10) for c, (name, _) in crosswalk.items() if "date" in name}
    tidy = tidy.withColumns(dates) if dates else tidy
    named = typed(tidy, {**crosswalk, year: ("year_of_sale", "string")})
    rows = named.withColumn(document, digits_only(document)).where(F.col(document).isNotNull())
    per_document = [
        F.max(total).alias("_total"), F.count(F.lit(1)).alias("_rows"),
        F.countDistinct(date).alias("_dates"), F.count_if(F.col(date).isNull()).alias("_undated"),
    ]
    grouped = with_group_values(rows, [document], per_document).withColumn(total, F.col("_total"))
    one_day = F.col("_dates") + F.when(F.col("_undated") > 0, 1).otherwise(0) == 1
    sound = grouped.where(((F.col("_rows") == 1) | (F.col(total) == F.col("_rows"))) & one_day)
    marked = sound.withColumn("is_multisale", (F.col("_rows") > 1) | (F.col(total) > 1))
    columns = [*rows.columns, "is_multisale"]
    fullest = [known_count(rows.columns).desc(), F.col(date), F.col(recorded), F.xxhash64(*rows.columns)]
    return dedup_by_priority(marked.select(columns), [document, pin], fullest)


# Accepted spellings of a reviewed characteristic change, typing slips included.
MAJOR_CHANGE = r"(?i)YES[^A-Z]*MAJ[OA][REOT]"
MINOR_CHANGE = r"(?i)YES[^A-Z]*MIN(?:OR|OT)"
REVIEW_FLAGS = {
    "sale_is_arms_length": "is_arms_length",
    "flip": "is_flip",
    "class_change": "has_class_change",
    "field_check": "requires_field_check",
}


def sale_reviews(
    raw: DataFrame, patches: dict[str, dict[str, str]] | None = None, keep: list[str] = ("doc_no",)
) -> DataFrame:
    """Desk-review rows: trimmed text to flags; rows in which nothing was reviewed are left out."""
    tidy = raw.withColumns({c: F.trim(c) for c in text_columns(raw)})
    for column, words in (patches or {}).items():
        for old, new in words.items():
            tidy = tidy.withColumn(column, F.replace(F.col(column), F.lit(old), F.lit(new)))
    key_fields = ["sale_is_arms_length", "characteristic_change", "class_change", "flip"]
    seen = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) != "", F.lit(False)) for c in key_fields])
    change = F.col("characteristic_change")
    flags = {out: F.coalesce(F.col(c).rlike("(?i)YES"), F.lit(False)) for c, out in REVIEW_FLAGS.items()}
    flags["has_characteristic_change"] = (
        F.when(change.rlike(MAJOR_CHANGE), "yes_major").when(change.rlike(MINOR_CHANGE), "yes_minor").otherwise("no")
    )
    return tidy.where(seen).withColumns(flags).select(*keep, *flags)


def land_rates(
    raw: DataFrame, years: dict[str, str], data_year: str, classes: list[str], nbhd: str = "town_nbhd",
    only_classes: dict[str, tuple[bool, list[str]]] | None = None, label: str | None = None,
) -> DataFrame:
    """Neighbourhood land rates: one row per neighbourhood, class and year.

    ``only_classes`` maps a label of the rate to (whether it lists or excludes, classes).
    """
    ids = [nbhd, *([label] if label else [])]
    tidy = raw.withColumn(nbhd, digits_only(nbhd))
    tidy = tidy.withColumns({c: F.col(c).cast("string") for c in years})
    rates = wide_rates(tidy, ids, years, "land_rate_per_sqft")
    number = F.regexp_replace("land_rate_per_sqft", r"[$,\s]", "").try_cast("double")
    rates = rates.withColumn("land_rate_per_sqft", number).where(F.col("land_rate_per_sqft").isNotNull())
    spread = rates.withColumn("class", F.explode(F.array(*[F.lit(c) for c in classes])))
    for text, (listed, members) in (only_classes or {}).items():
        fits = F.col("class").isin(*members)
        spread = spread.where((F.col(label) != text) | (fits if listed else ~fits))
    return spread.select(
        F.substring(nbhd, 1, 2).alias("township_code"), F.col(nbhd), "class", "year", "land_rate_per_sqft",
        F.lit(data_year).alias("data_year"),
    )


def land_site_rates(raw: DataFrame, crosswalk: dict[str, tuple[str, str]], year: str) -> DataFrame:
    """Flat land rates per parcel; rows without parcel or rate fall away."""
    named = typed(raw, crosswalk)
    plain = {c: F.replace(F.col(c), F.lit("-"), F.lit("")) for c in ("town_nbhd", "class") if c in named.columns}
    tidy = named.withColumns(plain).withColumn("year", F.lit(year))
    return tidy.dropna(subset=["pin", "land_rate_per_pin"])


def flagged_units(sources: dict[str, DataFrame], pin: str = "pin", year: str = "year") -> DataFrame:
    """Non-livable condominium units of several lists, each with its flag; the first list wins."""
    parts = []
    for order, (flag, df) in enumerate(sources.items()):
        digits = F.regexp_replace(F.col(pin).cast("string"), "-", "")
        parts.append(
            df.where(digits.rlike("^[0-9]+$")).select(
                F.lpad(digits, 14, "0").alias("pin"), F.col(year).cast("string").alias("year"),
                F.lit(flag).alias("flag"), F.lit(order).alias("_order"),
            )
        )
    stacked = union_missing(parts)
    return dedup_by_priority(stacked, ["pin", "year"], [F.col("_order")]).drop("_order")


def stack_workbooks(frames: dict[str, DataFrame], year: str = "year") -> DataFrame:
    """Sheets of several years as one table; columns that a year lacks are null."""
    return union_missing([blank_to_null(df).withColumn(year, F.lit(name)) for name, df in frames.items()])


def zoning(raw: DataFrame, pin: str, code: str, date: str, year: str) -> DataFrame:
    """Distinct zoning codes of each parcel in one string, with the latest date."""
    single = raw.groupBy(F.col(pin).alias("pin"), F.col(code).alias("_code")).agg(F.max(date).alias("_date"))
    return single.groupBy("pin").agg(
        F.array_join(F.array_sort(F.collect_set("_code")), ", ").alias("zoning_code"), F.max("_date").alias("zoning_date")
    ).withColumn("year", F.lit(year))


def appeals(raw: DataFrame, names: dict[str, str], year: str = "taxyr") -> DataFrame:
    """Board appeals: renamed, "N/A" and empty text to null, values to whole numbers."""
    named = blank_to_null(raw.select(*[F.col(c).alias(n) for c, n in names.items()]), ("", "N/A"))
    values = {c: F.col(c).try_cast("int") for c in named.columns if "value" in c}
    return named.withColumns(values).where(F.col(year).isNotNull()) if values else named


# Mortgage types told by a word they contain.
MORTGAGE_EXACT = ("ARM", "BALLOON", "FHA", "VA")
MORTGAGE_WORDS = {
    "COMMER": "COMMERCIAL", "CONSTR": "CONSTRUCTION", "CONVENT": "CONVENTIONAL", "MECHAN": "MECHANIC LIEN",
    "OWNER ": "OWNER FINANCE", "REVERSE|RES": "REVERSE",
}


def mortgage_type(c: Column) -> Column:
    kind = F.upper(c)
    out = F.when(kind.isin(*MORTGAGE_EXACT), kind)
    for word, name in MORTGAGE_WORDS.items():
        out = out.when(kind.rlike(word), name)
    return out.when(kind.isNotNull(), "OTHER")


def foreclosures(
    raw: DataFrame, box: tuple[float, float, float, float], today: Column, first_year: str = "2013",
    keys: tuple[str, ...] = ("case_number", "pin", "sale_results", "date_of_sale"), x: str = "global_x", y: str = "global_y",
) -> DataFrame:
    """Foreclosure sales inside a coordinate box, from a first year on and not in the future, one per case."""
    x0, y0, x1, y1 = box
    day = F.to_date("date_of_sale")
    inside = F.col(x).between(x0, x1) & F.col(y).between(y0, y1)
    kept = raw.where(inside & (day < today)).withColumns(
        {
            "pin": F.regexp_replace("pin", r"[^0-9.-]", ""),
            "mortgage_type": mortgage_type(F.col("mortgage_type")),
            "sale_results": F.upper("sale_results"),
            "year_of_sale": F.year(day).cast("string"),
        }
    ).where(F.col("year_of_sale") >= first_year)
    return dedup_by_priority(kept, list(keys), [F.xxhash64(*kept.columns)])
