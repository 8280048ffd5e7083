"""Choosing the fullest row, and borrowing missing values from near rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.functions import geometry as geo
from plotwise.operators.ordered import top_with_ties
from plotwise.operators.spatial import nearest, point_segments


def most_complete(df: DataFrame, keys: list[str], cols: list[str], weights: list[int] | None = None) -> DataFrame:
    """Rows of each key with the most known (optionally weighted) values; ties stay."""
    weight = dict(zip(cols, weights or [1] * len(cols)))
    known = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") * weight[c] for c in cols])
    scored = df.withColumn("_known", known)
    return top_with_ties(scored, keys, [F.col("_known").desc()], 1, rank="_rank").drop("_known", "_rank")


def nearest_fill(df: DataFrame, id_col: str, cols: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """Fill missing values from the nearest row that has them all; the lowest id wins ties."""
    full = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    donors = df.where(full)
    spots = df.where(~full).select(x, y).distinct()
    places = point_segments(donors.select(F.col(id_col).alias("_donor"), x, y), x, y).drop(x, y)
    found = nearest(spots, places, ["_donor"], (), x, y).drop("dist")
    given = donors.select(F.col(id_col).alias("_donor"), *[F.col(c).alias(f"_d_{c}") for c in cols])
    values = found.join(given, "_donor").drop("_donor")
    joined = df.join(values, [x, y], "left")
    return joined.select(*[F.coalesce(F.col(c), F.col(f"_d_{c}")).alias(c) if c in cols else F.col(c) for c in df.columns])


def touching_mean_fill(
    segments: DataFrame, id_col: str, name: str, cols: list[str], size: float
) -> DataFrame:
    """Fill missing values with the mean over touching segments of the same name.

    ``segments`` has x1, y1, x2, y2. Segments meet on the grid cells their boxes cover.
    """
    boxed = segments.withColumn(
        "_cx", F.explode(F.sequence(F.floor(F.least("x1", "x2") / size), F.floor(F.greatest("x1", "x2") / size)))
    ).withColumn(
        "_cy", F.explode(F.sequence(F.floor(F.least("y1", "y2") / size), F.floor(F.greatest("y1", "y2") / size)))
    )
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    open_rows = boxed.where(missing).select(
        F.col(id_col).alias("_id"), name, "_cx", "_cy", *[F.col(c).alias(f"_{c}") for c in ("x1", "y1", "x2", "y2")]
    )
    touch = geo.segments_cross(
        tuple(F.col(f"_{c}") for c in ("x1", "y1", "x2", "y2")), tuple(F.col(c) for c in ("x1", "y1", "x2", "y2"))
    )
    pairs = (
        open_rows.join(boxed, [name, "_cx", "_cy"])
        .where((F.col("_id") != F.col(id_col)) & touch)
        .select("_id", id_col, *cols)
        .distinct()  # a pair may share several cells
    )
    means = pairs.groupBy("_id").agg(*[F.avg(c).alias(f"_m_{c}") for c in cols])
    joined = segments.join(means, segments[id_col] == means["_id"], "left")
    return joined.select(
        *[F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}")).alias(c) if c in cols else F.col(c) for c in segments.columns]
    )
