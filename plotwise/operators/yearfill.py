"""Crosswalks that say which year of a layer fills which parcel year."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotwise.session import in_stages


def year_fill_crosswalk(years: DataFrame, layers: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """For each parcel year and field: ``<field>_fill_year`` and ``<field>_data_year``.

    Layers are already filled forward; years before a field's first are filled back from it. Everything
    happens on at most one row per year, after the layers were reduced to their distinct years.
    """
    out = years.select("year").distinct()
    fields: list[str] = []
    for frame, names in layers.values():
        per_year = frame.groupBy("year").agg(
            *[F.max(f"{f}_data_year").alias(f"{f}_data_year") for f in names]
        )
        per_year = per_year.withColumns(
            {f"{f}_fill_year": F.when(F.col(f"{f}_data_year").isNotNull(), F.col("year")) for f in names}
        )
        out = out.join(per_year, "year", "left")
        fields += names
    # One row per year, so a single partition is enough.
    later = Window.partitionBy(F.lit(1)).orderBy(F.col("year").desc()).rowsBetween(Window.unboundedPreceding, 0)
    columns = [f"{f}_{kind}_year" for f in fields for kind in ("fill", "data")]
    return out.select("year", *[F.last(c, ignorenulls=True).over(later).alias(c) for c in columns])


def fill_join(
    base: DataFrame,
    crosswalk: DataFrame,
    layers: dict[str, tuple[DataFrame, dict[str, list[str]]]],
    key: str = "pin10",
) -> DataFrame:
    """Attach each field's columns from the layer row of its fill year.

    ``layers`` maps a name to (frame, {field: columns}). A layer is joined once for each distinct field. Its rows take the
    years that they fill first (the crosswalk has one row per year), so that all joins have the same keys and the growing
    rows of ``base`` are dealt and sorted once in several joins, not once for each field.
    """

    def joined(field: str, columns: list[str], frame: DataFrame) -> Callable[[DataFrame], DataFrame]:
        fill = f"{field}_fill_year"

        def join(dated: DataFrame) -> DataFrame:
            order = [key, fill, *[c for c in dated.columns if c not in (key, fill)], *columns]
            filled = F.broadcast(crosswalk.select("year", fill))
            right = frame.select(F.col(key), F.col("year").alias(fill), *columns).join(filled, fill).drop(fill)
            return dated.join(right, [key, "year"], "left").select(*order)

        return join

    dated = base.join(F.broadcast(crosswalk), "year", "left")
    return in_stages(dated, [joined(f, columns, frame) for frame, fields in layers.values() for f, columns in fields.items()], key, "year")


def union_years(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [f.select("year") for f in frames]).distinct()
