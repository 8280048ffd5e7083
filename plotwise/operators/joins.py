"""Year-aware, versioned and wildcard joins, all reduced to equality keys."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on all keys, still hashable by Spark."""
    return reduce(and_, [left[k].eqNullSafe(right[k]) for k in keys])


def full_coalesced(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join that keeps one copy of each key, plus the side flags ``in_left`` / ``in_right``."""
    a = left.withColumn("in_left", F.lit(True))
    b = right.withColumn("in_right", F.lit(True))
    out = a.join(b, keys, "full")
    return out.withColumns({n: F.coalesce(F.col(n), F.lit(False)) for n in ("in_left", "in_right")})


def unmatched_counts(left: DataFrame, right: DataFrame, keys: list[str], by: list[str] = ()) -> DataFrame:
    """How many keys only one side has."""
    lone = full_coalesced(left, right, keys).where(~(F.col("in_left") & F.col("in_right")))
    return lone.groupBy(*by).agg(
        F.count_if("in_left").alias("only_left"), F.count_if("in_right").alias("only_right")
    )


def lag_join(
    left: DataFrame, right: DataFrame, keys: list[str], year: str, offset: int, how: str = "left"
) -> DataFrame:
    """Join the row ``offset`` years away: ``offset=1`` meets the prior year's row.

    The right side's year is shifted before the join, so the condition stays an equality.
    """
    shifted = right.withColumn(year, (F.col(year).cast("int") + offset).cast(left.schema[year].dataType))
    return left.join(shifted, [*keys, year], how)


def trailing_years_join(
    left: DataFrame, events: DataFrame, keys: list[str], year: str, n: int, aggs: list[Column]
) -> DataFrame:
    """Aggregate each key's events of the years ``year-n .. year`` onto the left rows.

    Events are first reduced to one row per key and year where the caller can do so; each is then
    copied to the ``n+1`` years it counts for, which turns the range condition into an equality.
    """
    moved = events.withColumn("_reach", F.explode(F.sequence(F.lit(0), F.lit(n))))
    moved = moved.withColumn(year, (F.col(year).cast("int") + F.col("_reach")).cast(left.schema[year].dataType))
    grouped = moved.groupBy(*keys, year).agg(*aggs)
    return left.join(grouped, [*keys, year], "left")


def clamp_year_join(
    left: DataFrame, right: DataFrame, keys: list[str], year: str, source_year: str = "source_year"
) -> DataFrame:
    """Left join by year where years past the right side's last year use that last year."""
    last = right.agg(F.max(year)).scalar()
    clamped = left.withColumn(source_year, F.least(F.col(year), last))
    return clamped.join(right.withColumnRenamed(year, source_year), [*keys, source_year], "left")


def asof_years(
    source_years: DataFrame, row_years: DataFrame, year: str = "year", direction: str = "backward", by: list[str] = ()
) -> DataFrame:
    """Crosswalk ``by, year → source_year``: the latest source year not after (or earliest not before) each year.

    Works on the distinct years only. Both lists are merged and swept once, so no pair is built; joins broadcast the few rows. With ``by`` (columns of
    both lists, a layer's name) each of its values has a crosswalk of its own.
    """
    rows = row_years.select(*by, F.col(year).alias("year")).distinct()
    sources = source_years.select(*by, F.col(year).alias("year"), F.col(year).alias("source_year")).distinct()
    merged = rows.join(sources, [*by, "year"], "full")
    order = F.col("year").asc() if direction == "backward" else F.col("year").desc()
    sweep = Window.partitionBy(*(by or [F.lit(1)])).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = merged.withColumn("source_year", F.last("source_year", ignorenulls=True).over(sweep))
    return F.broadcast(filled.where(F.col("source_year").isNotNull()).join(rows, [*by, "year"], "left_semi"))


def asof_join(
    left: DataFrame,
    source: DataFrame,
    keys: list[str],
    year: str = "year",
    direction: str = "backward",
    how: str = "left",
    source_year: str = "source_year",
) -> DataFrame:
    """Join each left row with the source rows of its as-of year (layer-wide, not per key)."""
    walk = asof_years(source, left, year, direction).select(
        F.col("year").alias(year), F.col("source_year").alias(source_year)
    )
    dated = source.withColumnRenamed(year, source_year).join(walk, source_year)
    return left.join(dated, [*keys, year], how)


def upto_year_join(left: DataFrame, source: DataFrame, keys: list[str], year: str = "year") -> DataFrame:
    """Each left row with every source row of the same key that is not later.

    The output itself holds all such pairs; equality on ``keys`` bounds them to one key's history.
    """
    right = source.withColumnRenamed(year, "source_year")
    return left.join(right, keys).where(F.col("source_year") <= F.col(year))


def explode_join(
    left: DataFrame, right: DataFrame, keys: list[str], array_col: str, member: str, wildcard: str = "all"
) -> DataFrame:
    """Inner join where the right side lists its members in an array and ``wildcard`` matches any.

    Two equality joins: listed members, and wildcard rows that match on ``keys`` alone. A right row that
    lists both would match twice, so its other members are dropped.
    """
    any_member = F.array_contains(array_col, wildcard)
    listed = right.where(~any_member).withColumn(member, F.explode(F.array_distinct(array_col))).drop(array_col)
    open_ended = right.where(any_member).drop(array_col)
    by_member = left.join(listed, [*keys, member])
    by_wildcard = left.join(open_ended, keys)
    return by_member.unionByName(by_wildcard)


def listed_or_equal_join(
    left: DataFrame, right: DataFrame, keys: list[str], value: str, array_col: str, equal_col: str
) -> DataFrame:
    """Inner join on ``keys`` where the left value equals ``equal_col`` or is in ``array_col``."""
    members = F.array_distinct(
        F.concat(F.coalesce(F.col(array_col), F.array().cast("array<string>")), F.array(F.col(equal_col)))
    )
    spread = right.withColumn(value, F.explode(members))
    return left.join(spread, [*keys, value])


def latest_version(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Rows that carry the highest version of their key; ties stay."""
    top = df.groupBy(*keys).agg(F.max(version).alias("_top"))
    right = top.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_top")
    cond = reduce(and_, [df[k].eqNullSafe(right[f"_k_{k}"]) for k in keys]) & (df[version] == right["_top"])
    return df.join(right, cond, "left_semi")


def scaffold(groups: DataFrame, stages: list[tuple], names: list[str]) -> DataFrame:
    """Every group with every stage of a fixed list; the list rides along as a literal array."""
    rows = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(stage, names)]) for stage in stages])
    return groups.withColumn("_stage", F.explode(rows)).select(*groups.columns, "_stage.*")


def trim_universe(df: DataFrame, seen: DataFrame, keys: list[str], year: str) -> DataFrame:
    """Rows seen in another table, plus all rows of the latest year."""
    last = df.agg(F.max(year)).scalar()
    marked = df.join(seen.select(*keys).distinct().withColumn("_seen", F.lit(True)), keys, "left")
    return marked.where(F.col("_seen") | (F.col(year) == last)).select(*df.columns)


def role_joins(base: DataFrame, lookup: DataFrame, key: str, value: str, roles: dict[str, str]) -> DataFrame:
    """Join one lookup several times, once for each role column; ``roles`` maps base column → output."""
    out = base
    for number, (column, name) in enumerate(roles.items()):
        role = lookup.select(F.col(key).alias(f"_role{number}"), F.col(value).alias(name))
        out = out.join(role, F.col(column) == F.col(f"_role{number}"), "left").drop(f"_role{number}")
    return out


def neighbour_fill(
    df: DataFrame,
    key: list[str],
    neighbours: list[tuple[str, str]],
    year: str,
    cols: list[str],
    max_dist: float,
    donors: DataFrame | None = None,
) -> DataFrame:
    """Fill nulls from the first, then the next, near enough neighbour of the same year.

    ``neighbours`` lists (neighbour id column, distance column) in order of preference.
    """
    source = df if donors is None else donors
    out = df
    names = {c: [F.col(c)] for c in cols}
    for rank, (neighbour, distance) in enumerate(neighbours):
        # Of several rows of a donor, the one with the fewest nulls; ties by the values themselves.
        values = F.struct(*[F.col(c).alias(f"_n{rank}_{c}") for c in cols])
        nulls = sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))
        donor = (
            source.groupBy(F.col(key[0]).alias("_donor"), F.col(year).alias("_donor_year"))
            .agg(F.min_by(values, F.struct(nulls.alias("_nulls"), values.alias("_values"))).alias("_row"))
            .select("_donor", "_donor_year", "_row.*")
        )
        # Rows without a near neighbour get a key of their own, or they would all meet in one task.
        near = F.coalesce(
            F.when(F.col(distance) <= max_dist, F.col(neighbour)), F.concat(F.lit("none:"), F.col(key[0]))
        )
        out = out.join(donor, (near == F.col("_donor")) & (F.col(year) == F.col("_donor_year")), "left").drop(
            "_donor", "_donor_year"
        )
        for c in cols:
            names[c].append(F.col(f"_n{rank}_{c}"))
    return out.select(*[F.coalesce(*names[c]).alias(c) if c in cols else F.col(c) for c in df.columns])
