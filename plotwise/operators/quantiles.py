"""Exact interpolated quantiles for groups of any size."""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotwise.operators.grouped import with_group_values


def exact_quantiles(
    df: DataFrame, keys: list[str], c: str, quantiles: dict[str, float], accuracy: int = 10_000
) -> DataFrame:
    """One row per group with linearly interpolated quantiles.

    A sketch of bounded size brackets each wanted rank. Then values below the bracket are only counted and
    values inside it, a few per ``accuracy`` rows, are ranked. No task holds a whole group.
    """
    slack = 4.0 / accuracy
    known = df.where(F.col(c).isNotNull()).select(*keys, F.col(c).cast("double").alias("_v"))
    probes = sorted({p for q in quantiles.values() for p in (max(q - slack, 0.0), min(q + slack, 1.0))})
    sketch = [
        F.count(F.lit(1)).alias("_n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx("_v", probes, accuracy).alias("_p"),
    ]
    sketched = with_group_values(known, keys, sketch)
    brackets = []
    for name, q in quantiles.items():
        low, high = max(q - slack, 0.0), min(q + slack, 1.0)
        # In a small group the slack is less than a rank; there the bracket is the whole group.
        small = F.col("_n") <= 2 * accuracy
        lo = F.when(small | F.lit(low == 0.0), F.col("_min")).otherwise(F.col("_p")[probes.index(low)])
        hi = F.when(small | F.lit(high == 1.0), F.col("_max")).otherwise(F.col("_p")[probes.index(high)])
        position = (F.col("_n") - 1) * F.lit(q)
        brackets.append(
            F.struct(
                F.lit(name).alias("name"), position.alias("pos"),
                (F.col("_v") < lo).alias("below"), ((F.col("_v") >= lo) & (F.col("_v") <= hi)).alias("inside"),
            )
        )
    tagged = sketched.withColumn("_b", F.explode(F.array(*brackets))).select(*keys, "_v", "_b.*")
    tagged = tagged.where(F.col("below") | F.col("inside"))
    # Rows below the bracket fold into one count, equal values inside it into one row.
    folded = tagged.groupBy(*keys, "name", F.when(F.col("inside"), F.col("_v")).alias("_v")).agg(
        F.count(F.lit(1)).alias("_m"), F.max("pos").alias("pos")
    )
    order = Window.partitionBy(*keys, "name").orderBy(F.col("_v").asc_nulls_first())
    ranked = folded.withColumn("_upto", F.sum("_m").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    start = F.col("_upto") - F.col("_m")
    at_low = F.floor("pos")
    at_high = F.ceil("pos")

    def pick(index):
        return F.max(F.when(F.col("_v").isNotNull() & (start <= index) & (index < F.col("_upto")), F.col("_v")))

    ends = ranked.groupBy(*keys, "name").agg(
        pick(at_low).alias("_a"), pick(at_high).alias("_b"), F.max(F.col("pos") - at_low).alias("_w")
    )
    value = F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_w")
    return (
        ends.withColumn("_q", value)
        .groupBy(*keys)
        .agg(*[F.max(F.when(F.col("name") == n, F.col("_q"))).alias(n) for n in quantiles])
    )


def trim_between(
    df: DataFrame, keys: list[str], c: str, low: float = 0.05, high: float = 0.95
) -> DataFrame:
    """Rows strictly between two quantiles of their group."""
    edges = exact_quantiles(df, keys, c, {"_low": low, "_high": high})
    right = edges.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_low", "_high")
    cond = None
    for k in keys:
        part = df[k].eqNullSafe(right[f"_k_{k}"])
        cond = part if cond is None else cond & part
    kept = df.join(right, cond).where((F.col(c) > F.col("_low")) & (F.col(c) < F.col("_high")))
    return kept.select(*df.columns)


