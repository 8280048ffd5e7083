"""Aggregations. Group-wide values come from ``groupBy`` and a join back rather than from a window, so
that a group holding a large part of all rows is combined before the shuffle and its join can be split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# A sketch this fine returns exact data values for groups of up to about a million rows and stays bounded beyond.
FINE = 1_000_000
COARSE = 10_000


def approx_median(c: Column | str, accuracy: int = COARSE) -> Column:
    return approx_quantile(c, 0.5, accuracy)


def approx_quantile(c: Column | str, q: float, accuracy: int = COARSE) -> Column:
    """A data value at rank q, from a mergeable sketch of bounded size."""
    return F.percentile_approx(c, q, accuracy)


def with_group_values(df: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Attach group aggregates to every row of the group."""
    grouped = df.groupBy(*keys).agg(*aggs)
    extra = [c for c in grouped.columns if c not in keys]
    right = grouped.select(*[F.col(k).alias(f"_g_{k}") for k in keys], *extra)
    cond = None
    for k in keys:
        part = df[k].eqNullSafe(right[f"_g_{k}"])
        cond = part if cond is None else cond & part
    return df.join(right, cond).select(*df.columns, *extra)


def share_of_total(df: DataFrame, keys: list[str], c: str, out: str) -> DataFrame:
    """Share of the group's sum; null for an all-zero group."""
    summed = with_group_values(df, keys, [F.sum(c).alias("_total")])
    return summed.withColumn(out, F.when(F.col("_total") != 0, F.col(c) / F.col("_total"))).drop("_total")


def zscore(df: DataFrame, keys: list[str], c: str, out: str) -> DataFrame:
    """Distance from the group mean in sample standard deviations; null when there is no spread."""
    stats = with_group_values(df, keys, [F.avg(c).alias("_mean"), F.stddev_samp(c).alias("_sd")])
    score = F.when(F.col("_sd") != 0, (F.col(c) - F.col("_mean")) / F.col("_sd"))
    return stats.withColumn(out, score).drop("_mean", "_sd")


def distinct_in_group(df: DataFrame, keys: list[str], c: str, out: str) -> DataFrame:
    """Number of distinct non-null values in the row's group."""
    return with_group_values(df, keys, [F.countDistinct(c).alias(out)])


def first_in_group(df: DataFrame, keys: list[str], order: list[str], cols: dict[str, str]) -> DataFrame:
    """Values of the group's first row (nulls respected) on every row of the group."""
    rank = F.struct(*[F.col(o) for o in order])
    aggs = [F.min_by(F.struct(c), rank).alias(f"_first_{c}") for c in cols]
    out = with_group_values(df, keys, aggs)
    for c, name in cols.items():
        out = out.withColumn(name, F.col(f"_first_{c}.{c}")).drop(f"_first_{c}")
    return out


def pivot_values(
    df: DataFrame, keys: list[str], pivot: str, values: dict, measure: Column | str, agg: str = "max"
) -> DataFrame:
    """Long to wide. ``values`` maps pivot values to output names, so no pass is needed to find them."""
    source = F.col(measure) if isinstance(measure, str) else measure
    return df.groupBy(*keys).agg(
        *[F.call_function(agg, F.when(F.col(pivot) == v, source)).alias(n) for v, n in values.items()]
    )


def count_distinct_pairs(df: DataFrame, keys: list[str], pair: list[str], out: str) -> DataFrame:
    """Number of different ``pair`` combinations of each key."""
    return df.select(*keys, *pair).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def distinct_join(df: DataFrame, keys: list[str], c: Column | str, out: str, sep: str = ", ") -> DataFrame:
    """Distinct values of the group in order, joined to one string.

    Values are made distinct before they are collected, so the array holds codes and not rows.
    """
    source = F.col(c) if isinstance(c, str) else c
    single = df.select(*keys, source.alias("_value")).distinct()
    return single.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("_value")), sep).alias(out))


def mode_lowest(df: DataFrame, keys: list[str], c: str, out: str) -> DataFrame:
    """Most frequent non-null value; the lowest one wins ties."""
    counts = df.where(F.col(c).isNotNull()).groupBy(*keys, c).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min_by(F.col(c), F.struct(-F.col("_n"), F.col(c)))
    return counts.groupBy(*keys).agg(best.alias(out))


def value_counts_map(df: DataFrame, keys: list[str], c: str, out: str) -> DataFrame:
    """Map from each distinct value to its count."""
    counts = df.where(F.col(c).isNotNull()).groupBy(*keys, c).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(c, "_n")))).alias(out)
    )


def collect_sorted(df: DataFrame, keys: list[str], c: str, out: str, keep_nulls: bool = False) -> DataFrame:
    """Distinct values of a group as a sorted array; a struct wrapper keeps a null member when asked."""
    single = df.select(*keys, c).distinct()
    if keep_nulls:
        packed = F.array_sort(F.collect_list(F.struct(F.col(c).isNotNull().alias("known"), F.col(c).alias("v"))))
        return single.groupBy(*keys).agg(F.transform(packed, lambda s: s["v"]).alias(out))
    return single.groupBy(*keys).agg(F.array_sort(F.collect_list(c)).alias(out))


def filtered_set_or_marker(
    df: DataFrame, keys: list[str], c: str, cond: Column, out: str, marker: str = "NULL"
) -> DataFrame:
    """Distinct values that pass ``cond``; a group where none does gets ``[marker]``."""
    single = df.select(*keys, F.when(cond, F.col(c)).alias("_v")).distinct()
    kept = F.array_sort(F.collect_set("_v"))
    return single.groupBy(*keys).agg(F.when(F.size(kept) == 0, F.array(F.lit(marker))).otherwise(kept).alias(out))


def year_span_label(lowest: Column, highest: Column) -> Column:
    """"2021" for one year, "2021 and 2023" for two."""
    return F.when(lowest == highest, lowest.cast("string")).otherwise(
        F.concat(lowest.cast("string"), F.lit(" and "), highest.cast("string"))
    )


def stacked_groups(
    df: DataFrame, shared: list[str], sets: list[tuple[str, str]], optional: str, aggs: list[Column], all_label: str
) -> DataFrame:
    """Stack groupings: every (label, column) geography, with and without the ``optional`` column.

    Rows are expanded to their geographies and grouped once by GROUPING SETS, so the input is read once.
    ``None`` geographies form a group of their own, as in separate queries.
    """
    places = F.array(*[F.struct(F.lit(n).alias("t"), F.col(c).cast("string").alias("i")) for n, c in sets])
    long = df.withColumn("_place", F.explode(places)).select(
        "*", F.col("_place.t").alias("geography_type"), F.col("_place.i").alias("geography_id")
    )
    base = [*shared, "geography_type", "geography_id"]
    grouped = long.groupingSets([[*map(F.col, base), F.col(optional)], [*map(F.col, base)]], *base, optional)
    out = grouped.agg(F.grouping(optional).alias("_rolled"), *aggs)
    label = F.when(F.col("_rolled") == 1, F.lit(all_label)).otherwise(F.col(optional))
    return out.withColumn(optional, label).drop("_rolled")


def by_geographies(df: DataFrame, columns: dict[str, str], keys: list[str], aggs: list[Column]) -> DataFrame:
    """One stacked result over several geography columns; null and empty ids are left out."""
    places = F.array(*[F.struct(F.lit(n).alias("t"), F.col(c).cast("string").alias("i")) for n, c in columns.items()])
    long = df.withColumn("_place", F.explode(places)).select(
        "*", F.col("_place.t").alias("geo_type"), F.col("_place.i").alias("geo_id")
    )
    known = long.where(F.col("geo_id").isNotNull() & (F.col("geo_id") != ""))
    return known.groupBy("geo_type", "geo_id", *keys).agg(*aggs)


def percent_complete(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, F.round(part.cast("double") / whole.cast("double"), 4))


def row_count_by_group(
    df: DataFrame, by: str, ascending: bool = True, where: Column | None = None
) -> DataFrame:
    kept = df if where is None else df.where(where)
    order = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return kept.groupBy(by).agg(F.count(F.lit(1)).alias("count")).orderBy(order)


