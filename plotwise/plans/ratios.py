"""Ratio statistics by township and by reassessment area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.operators.ratio import ratio_statistics
from plotwise.plans.warehouse import Warehouse, model

GROUPS = ["year", "triad", "geography_type", "property_group", "assessment_stage", "geography_id", "sale_year"]


@model("reporting.ratio_stats")
def ratio_stats(w: Warehouse, nboot: int = 300) -> DataFrame:
    rows = w.ref("reporting.ratio_stats_input").where("ratio IS NOT NULL AND ratio > 0")
    places = F.array(
        F.struct(F.lit("Tri").alias("t"), F.col("triad").cast("string").alias("i")),
        F.struct(F.lit("Town").alias("t"), F.col("township_code").cast("string").alias("i")),
    )
    # Both geographies in one pass over the input.
    long = rows.withColumn("_p", F.explode(places)).select(
        "*", F.col("_p.t").alias("geography_type"), F.col("_p.i").alias("geography_id")
    )
    return ratio_statistics(long, GROUPS, "fmv", "sale_price", nboot=nboot)
