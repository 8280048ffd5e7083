"""Deltas between a table and its published copy, and freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole_year(c: Column) -> Column:
    """Published years may come back as "2020.0"."""
    return c.cast("string").try_cast("double").cast("int").cast("string")


def publish_delta(current: DataFrame, published: DataFrame, row_id: str = "row_id", year: str = "year") -> DataFrame:
    """Current rows, plus published ids of the same years that are gone, flagged in ``:deleted``."""
    years = current.select(F.col(year).cast("string").alias("_year")).distinct()
    old = published.select(F.col(row_id), whole_year(F.col(year)).alias("_py"))
    old = old.join(years, F.col("_py").eqNullSafe(F.col("_year")), "left_semi").select(row_id, F.lit(True).alias("_old"))
    new = current.withColumn("_new", F.lit(True))
    both = new.join(old, row_id, "full")
    return both.withColumn(":deleted", F.when(F.col("_new").isNull(), True)).drop("_new", "_old")


def dropped_years(current: DataFrame, published: DataFrame, row_id: str = "row_id", year: str = "year") -> DataFrame:
    """Published ids of years that the current table no longer has."""
    have = current.select(F.col(year).cast("string").alias("_year")).distinct()
    old = published.select(F.col(row_id), whole_year(F.col(year)).alias("_py"))
    gone = old.join(have, F.col("_py").eqNullSafe(F.col("_year")), "left_anti")
    return gone.select(row_id, F.lit(True).alias(":deleted"))


def freshness(
    df: DataFrame, loaded_at: str, now, warn_hours: float = 24, error_hours: float = 48, where: Column | None = None
) -> DataFrame:
    """Age of the newest load and its status: pass, warn or error; an empty table is an error."""
    kept = df if where is None else df.where(where)
    newest = kept.agg(F.max(F.col(loaded_at).cast("timestamp")).alias("max_loaded_at"))
    moment = now if isinstance(now, Column) else F.lit(now)
    hours = (F.unix_timestamp(moment.cast("timestamp")) - F.unix_timestamp("max_loaded_at")) / 3600
    status = (
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass")
    )
    return newest.withColumn("age_hours", hours).withColumn("status", status)
