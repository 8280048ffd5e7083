"""Layers derived from lists of places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.functions import geometry as geo
from plotwise.plans.warehouse import Warehouse, model


def expand_open_years(places: DataFrame, years: DataFrame, opened: str, year: str = "year") -> DataFrame:
    """One row per place and year from its opening year on.

    The list of years is one small array from an aggregate; each place keeps its tail of it.
    """
    listed = years.agg(F.array_sort(F.collect_set(year))).scalar()
    open_years = F.filter("_years", lambda y: y >= F.col(opened))
    return places.withColumn("_years", listed).withColumn(year, F.explode(open_years)).drop("_years")


@model("spatial.stadium")
def stadium(w: Warehouse) -> DataFrame:
    raw = w.src("spatial.stadium_raw").withColumnRenamed("year", "_opened").withColumn("_opened", F.col("_opened").cast("string"))
    rows = expand_open_years(raw, w.src("spatial.parcel"), "_opened")
    return rows.select(
        "name", "year", geo.wkb_point(F.col("lon"), F.col("lat")).alias("geometry"),
        geo.wkb_point(F.col("x_3435"), F.col("y_3435")).alias("geometry_3435"), F.current_timestamp().cast("string").alias("loaded_at"),
    ).distinct()
