"""Ratio statistics of a hot group: rank sums against plain ranks, bootstrap sums in lanes, limits around the values."""

import numpy as np
from pyspark.sql import functions as F

from plotwise.operators import ratio


def mki(prices, estimates):
    order = sorted(zip(prices, estimates))
    s, e = np.array([p for p, _ in order]), np.array([v for _, v in order])
    k, n = np.arange(1, len(s) + 1), len(s)
    gini = lambda x: (2 * (x * k).sum() / x.sum() - (n + 1)) / n
    return gini(e) / gini(s)


def sales(spark, n, shares):
    """Rows with many equal pairs; the first group holds most."""
    g = F.when(F.col("id") % 100 < shares, F.lit("hot")).otherwise(F.when(F.col("id") % 100 == 99, F.lit(None)).otherwise(F.lit("cold")))
    price = F.pmod(F.xxhash64("id"), F.lit(700)) * 10 + 50
    estimate = price * (0.8 + F.pmod(F.xxhash64("id", F.lit(3)), F.lit(40)) / 100)
    return spark.range(n, numPartitions=8).select(g.alias("g"), price.cast("double").alias("s"), F.round(estimate, 1).alias("e"))


def test_rank_sums_over_range_partitions(spark):
    rows = sales(spark, 30_000, 90)
    got = {r.g: r.mki for r in ratio.kakwani_index(rows, ["g"], "e", "s").collect()}
    held = {}
    for r in rows.collect():
        held.setdefault(r.g, []).append((r.s, r.e))
    assert set(got) - {None} == set(held) - {None}
    for g in ("hot", "cold"):
        assert abs(got[g] - mki(*zip(*held[g]))) < 1e-9
    pairs = rows.groupBy("g", "s", "e").agg(F.count(F.lit(1)).alias("_c")).select("g", F.col("s").alias("_s"), F.col("e").alias("_e"), "_c")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = ratio._rank_sums(pairs, ["g"]).where("g = 'hot'").select("_part", "_n").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 2 and max(r._n for r in parts) < 0.6 * 27_000  # the hot group is not one task's


def test_limits_do_not_depend_on_lanes(spark, monkeypatch):
    rows = sales(spark, 12_000, 95).where("g IS NOT NULL")
    name = "r"
    rows = rows.withColumn(name, F.col("e") / F.col("s"))
    stats = ratio.point_statistics(rows, ["g"], "e", "s", name)
    first = {r.g: r for r in ratio.bootstrap_limits(rows, stats, ["g"], "e", "s", name, nboot=200).collect()}
    monkeypatch.setattr(ratio, "LANES", 3)
    monkeypatch.setattr(ratio, "HELD", 5)
    second = {r.g: r for r in ratio.bootstrap_limits(rows.repartition(13), stats, ["g"], "e", "s", name, nboot=200).collect()}
    points = {r.g: r for r in stats.collect()}
    for g, r in first.items():
        for m in ("med_ratio", "cod", "prd", "prb"):
            low, high = r[f"{m}_ci_l"], r[f"{m}_ci_u"]
            assert np.allclose([low, high], [second[g][f"{m}_ci_l"], second[g][f"{m}_ci_u"]], rtol=1e-7, atol=1e-12)
            assert low - 0.01 * abs(low) <= points[g][m] <= high + 0.01 * abs(high)
