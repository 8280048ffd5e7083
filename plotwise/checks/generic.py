"""Data-quality checks: each returns the rows that fail, with any extra columns asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.functions.logic import all_of, any_of, extra_columns, is_aggregate
from plotwise.functions.text import slugify
from plotwise.operators.ordered import lag_values


def _pick(df: DataFrame, columns: list[str], extra=()) -> DataFrame:
    names = [F.col(c) for c in columns]
    return df.select(*names, *extra_columns([e for e in extra if e not in columns]))


def accepted_range(df: DataFrame, c: str, low=None, high=None, inclusive: bool = True, extra=()) -> DataFrame:
    value, bad = F.col(c), F.lit(False)
    if low is not None:
        bad = bad | ~(value >= low if inclusive else value > low)
    if high is not None:
        bad = bad | ~(value <= high if inclusive else value < high)
    return _pick(df.where(bad), [c], extra)


def accepted_values(df: DataFrame, c: str, values: list, extra=()) -> DataFrame:
    return _pick(df.where(~F.col(c).isin(*values)), [c], extra)


def not_accepted_values(df: DataFrame, c: str, values: list, extra=()) -> DataFrame:
    return _pick(df.where(F.col(c).isin(*values)), [c], extra)


def subset_of(df: DataFrame, c: str, other: DataFrame, other_c: str, extra=()) -> DataFrame:
    """Values missing from the other column; a null value counts as missing."""
    known = other.select(F.col(other_c).alias("_known")).distinct()
    return _pick(df.join(known, df[c] == known["_known"], "left_anti"), [c], extra)


def relationships(df: DataFrame, c: str, parent: DataFrame, field: str, extra=()) -> DataFrame:
    """Values missing from the parent; null values are left out."""
    return subset_of(df.where(F.col(c).isNotNull()), c, parent, field, extra)


def column_length(df: DataFrame, cols: list[str], length: int, extra=()) -> DataFrame:
    """Rows with a value longer than ``length``; reports ``len_<column>``."""
    measured = df.withColumns({f"len_{c}": F.length(c) for c in cols})
    return _pick(measured.where(any_of([F.col(f"len_{c}") > length for c in cols])), [f"len_{c}" for c in cols], extra)


def columns_match(df: DataFrame, c: str, others: list[str], extra=()) -> DataFrame:
    """Rows whose value differs from every one of the other columns."""
    return _pick(df.where(all_of([F.col(c) != F.col(o) for o in others])), [c, *others], extra)


def count_is_consistent(df: DataFrame, c: str, group: str, low=None, high=None) -> DataFrame:
    """Groups whose distinct count is out of bounds or, without bounds, below the largest."""
    counts = df.groupBy(group).agg(F.countDistinct(c).alias("count"))
    if low and high:
        bad = ~F.col("count").between(low, high)
    elif low:
        bad = F.col("count") < low
    elif high:
        bad = F.col("count") > high
    else:
        # Below the maximum is the same as ranked after it, without ordering all groups in one task.
        bad = F.col("count") < counts.agg(F.max("count")).scalar()
    return counts.where(bad)


def expression_is_true(df: DataFrame, expression: str | Column, columns: list[str] = (), extra=()) -> DataFrame:
    cond = F.expr(expression) if isinstance(expression, str) else expression
    return _reported(df.where(~cond), columns, extra)


def expression_is_false(df: DataFrame, expression: str | Column, columns: list[str] = (), extra=()) -> DataFrame:
    cond = F.expr(expression) if isinstance(expression, str) else expression
    return _reported(df.where(cond), columns, extra)


def _reported(df: DataFrame, columns, extra) -> DataFrame:
    return _pick(df, list(columns), extra) if columns or extra else df.select(F.lit(1).alias("fail"))


def is_null(df: DataFrame, c: str, extra=()) -> DataFrame:
    return _pick(df.where(F.col(c).isNotNull()), [c], extra)


def not_null(df: DataFrame, c: str, extra=()) -> DataFrame:
    bad = df.where(F.col(c).isNull())
    return bad.select(*extra_columns(list(extra))) if extra else bad


def no_extra_whitespace(df: DataFrame, cols: list[str], allow_interior: bool = False) -> DataFrame:
    """Leading or trailing spaces, and doubled ones unless ``allow_interior`` is set."""
    tests = []
    for c in cols:
        value = F.col(c)
        tests += [value.like("% "), value.like(" %")]
        if not allow_interior:
            tests.append(value.like("%  %"))
    return df.where(any_of(tests)).select(*cols)


def row_count(df: DataFrame, above: int | None = None, equals: int | None = None, c: str | None = None) -> DataFrame:
    """One row with the count when it is too low, or other than expected."""
    if (above is None) == (equals is None):
        raise ValueError("give either above or equals")
    counted = df.agg(F.count(F.col(c) if c else F.lit(1)).alias("row_count"))
    return counted.where(F.col("row_count") < above if above is not None else F.col("row_count") != equals)


def value_is_present(df: DataFrame, expression: str | Column) -> DataFrame:
    """One row when nothing satisfies the expression."""
    cond = F.expr(expression) if isinstance(expression, str) else expression
    return df.where(cond).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") == 0)


def unique_combination(df: DataFrame, cols: list[str], allowed_duplicates: int = 0, extra=()) -> DataFrame:
    aggs = [c for e, c in zip(extra, extra_columns(list(extra))) if is_aggregate(e)]
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("num_duplicates"), *aggs)
    return counted.where(F.col("num_duplicates") > allowed_duplicates + 1)


def unique(df: DataFrame, c: str) -> DataFrame:
    """Non-null values that occur more than once."""
    return unique_combination(df.where(F.col(c).isNotNull()), [c])


def sequential_values(
    df: DataFrame, c: str, interval: int = 1, group_by: list[str] = (), unit: str | None = None,
    chunk: Column | None = None, extra=(),
) -> DataFrame:
    """Rows that do not follow the previous value by ``interval`` (of ``unit``, for dates)."""
    previous = f"previous_{slugify(c)}"
    seen = lag_values(df, list(group_by), [c], {previous: (c, 1)}, chunk)
    if unit:
        expected = F.expr(f"timestampadd({unit}, {int(interval)}, cast({previous} as timestamp))")
        bad = F.col(c).cast("timestamp") != expected
    else:
        bad = F.col(c) != F.col(previous) + interval
    return _pick(seen.where(bad), [*group_by, c, previous], extra)


def class_matches_parcel(
    df: DataFrame, c: str, parcels: DataFrame, exempt: DataFrame, keys: list[str], parcel_keys: list[str],
    parcel_class: str = "class", major_only: bool = False, how: str = "left",
) -> DataFrame:
    """Parcels none of whose rows share the parcel's class prefix; parcels listed in ``exempt`` are skipped.

    Rows fold to their distinct classes before the classes are collected.
    """
    digits = 1 if major_only else 3
    skip = exempt.select(*[F.col(p).alias(k) for p, k in zip(parcel_keys, keys)]).distinct()
    kept = df.join(skip, keys, "left_anti")
    folded = kept.groupBy(*keys, c).agg(F.count(F.lit(1)).alias("_rows"))
    owner = parcels.select(
        *[F.col(p).alias(k) for p, k in zip(parcel_keys, keys)], F.col(parcel_class).alias("pardat_class")
    )
    joined = folded.join(owner, keys, how)
    agree = F.substring("pardat_class", 1, digits) == F.substring(F.col(c), 1, digits)
    grouped = joined.groupBy(*keys).agg(
        F.array_sort(F.collect_set(c)).alias(c),
        F.max("pardat_class").alias("pardat_class"),
        F.count_if(agree).alias("_hits"),
    )
    return grouped.where(F.col("_hits") == 0).drop("_hits")


def values_match_after_join(
    df: DataFrame, c: str, external: DataFrame, external_c: str, keys: list[str], group_by: list[str] = (),
    how: str = "inner", alias: str = "model_col", external_alias: str = "external_model_col",
) -> DataFrame:
    """Rows whose joined value differs; with ``group_by``, groups in which no joined value agrees.

    Groups report the distinct values of both sides, a null value included.
    """
    left = external.select(*keys, F.col(external_c).alias(external_alias))
    right = df.select(*dict.fromkeys([*keys, *group_by]), F.col(c).alias(alias))
    joined = left.join(right, keys, how)
    if not group_by:
        return joined.where(F.col(external_alias) != F.col(alias)).select(alias, external_alias)
    pairs = joined.select(*group_by, alias, external_alias).distinct()

    def values(name: str) -> Column:
        packed = F.array_sort(F.array_distinct(F.collect_list(F.struct(F.col(name).alias("v")))))
        return F.transform(packed, lambda s: s["v"]).alias(name)

    hits = F.count_if(F.col(alias) == F.col(external_alias)).alias("_hits")
    return pairs.groupBy(*group_by).agg(values(alias), values(external_alias), hits).where("_hits = 0").drop("_hits")


