"""Assessment ratio statistics by group.

Point statistics are Spark aggregates. Formulas follow the published assessment-ratio literature:
COD = 100 · mean|r − median| / median; PRD = mean r / (Σ estimate / Σ price); PRB = slope of (r − med)/med on
log2((estimate/med + price)/2); MKI = Gini(estimate) / Gini(price), both in price order. Confidence limits come
from a bootstrap in which each distinct (estimate, price) draws Poisson weights, so replicates are sums that can
be combined across tasks and no group has to fit into one of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotwise.operators.ordered import lag_values
from plotwise.operators.quantiles import exact_quantiles, trim_between
from plotwise.session import settle

# Accepted ranges of the published ratio-study standard.
MET_RANGES = {
    "med_ratio": (0.90, 1.10),
    "cod": (5.0, 15.0),
    "prd": (0.98, 1.03),
    "prb": (-0.05, 0.05),
    "mki": (0.95, 1.05),
}
CHASING_BOUNDS = (0.98, 1.02)
CHASING_GAP = 0.03
BINS = 256
#: Lanes in which the vectors of a hot bin are added up first, and (group, bin) vectors that a task holds before it hands them on.
LANES = 64
HELD = 512


def met(value: Column, name: str) -> Column:
    low, high = MET_RANGES[name]
    return value.between(low, high)


def _same(left: DataFrame, right: DataFrame, groups: list[str], how: str = "left") -> DataFrame:
    renamed = right.withColumnsRenamed({g: f"_r_{g}" for g in groups})
    cond = reduce(lambda a, b: a & b, [left[g].eqNullSafe(renamed[f"_r_{g}"]) for g in groups])
    return left.join(renamed, cond, how).drop(*[f"_r_{g}" for g in groups])


def within_counts(ratio: str) -> list[Column]:
    """Counts of ratios at most 20, 10 and 5 percent away from 1."""
    gap = F.abs(F.lit(1.0) - F.col(ratio))
    return [F.count_if(gap <= t).alias(f"within_{n}_pct") for n, t in (("20", 0.20), ("10", 0.10), ("05", 0.05))]


def point_statistics(trimmed: DataFrame, groups: list[str], estimate: str, price: str, ratio: str) -> DataFrame:
    """n, median ratio, COD, PRD and PRB of each group."""
    medians = exact_quantiles(trimmed, groups, ratio, {"med_ratio": 0.5})
    rows = _same(trimmed, medians, groups)
    r, med = F.col(ratio), F.col("med_ratio")
    y = (r - med) / med
    x = F.log2((F.col(estimate) / med + F.col(price)) * 0.5)
    return rows.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        F.first("med_ratio").alias("med_ratio"),
        (100 * F.avg(F.abs(r - med)) / F.first("med_ratio")).alias("cod"),
        (F.avg(r) / (F.sum(estimate) / F.sum(price))).alias("prd"),
        F.regr_slope(y, x).alias("prb"),
    )


def _rank_sums(pairs: DataFrame, groups: list[str]) -> DataFrame:
    """groups, _part, _n, _se, _ss, _re, _rs for each range partition of (group, price, estimate): counts, sums and sums weighted by the rank within the partition.

    ``pairs`` has distinct _s and _e with their number _c, so a hot group spreads over as many partitions as its prices.
    """
    key_fields = [pairs.schema[g] for g in groups]
    sums = ("_se", "_ss", "_re", "_rs")
    schema = T.StructType([*key_fields, T.StructField("_part", T.IntegerType()), T.StructField("_n", T.LongType()), *[T.StructField(n, T.DoubleType()) for n in sums]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), (None, 0)
        for batch in batches:
            e, s, c = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("_e", "_s", "_c"))
            frame = batch.select(groups).to_pandas()
            changed = np.append(True, ~((frame.iloc[1:].to_numpy() == frame.iloc[:-1].to_numpy()) | (frame.iloc[1:].isna().to_numpy() & frame.iloc[:-1].isna().to_numpy())).all(axis=1)) if len(frame) else np.zeros(0, bool)
            first = np.flatnonzero(changed)
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(e)]):
                key = tuple(None if pd.isna(v) else v for v in frame.iloc[a])
                start = before[1] if before[0] == key else 0
                n = c[a:b]
                ahead = start + np.cumsum(n) - n  # rows before each pair
                weight = n * ahead + n * (n + 1) / 2  # the sum of the ranks of its rows
                before = (key, start + int(n.sum()))
                values = [[*key, part, int(n.sum()), float(n @ e[a:b]), float(n @ s[a:b]), float(weight @ e[a:b]), float(weight @ s[a:b])]]
                columns = [pa.array([v], t) for v, t in zip(values[0], [batch.schema.field(g).type for g in groups] + [pa.int32(), pa.int64()] + [pa.float64()] * 4)]
                yield pa.RecordBatch.from_arrays(columns, names=[*groups, "_part", "_n", *sums])

    order = [*groups, "_s", "_e"]
    found = pairs.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)
    # ranks go on through the batches of a partition, so these add up
    return found.groupBy(*groups, "_part").agg(F.sum("_n").alias("_n"), *[F.sum(n).alias(n) for n in sums])


def kakwani_index(df: DataFrame, groups: list[str], estimate: str, price: str) -> DataFrame:
    """MKI of each group from rank-weighted sums: ranks within range partitions, moved by the counts of those before."""
    pairs = df.groupBy(*groups, F.col(price).cast("double").alias("_s"), F.col(estimate).cast("double").alias("_e")).agg(F.count(F.lit(1)).alias("_c"))
    # one row for each partition that a group reaches into
    bands = _rank_sums(pairs, groups)
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = bands.withColumn("_off", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    totals = offset.groupBy(*groups).agg(
        F.sum("_n").alias("_n"),
        F.sum("_se").alias("_se"),
        F.sum("_ss").alias("_ss"),
        F.sum(F.col("_re") + F.col("_off") * F.col("_se")).alias("_re"),
        F.sum(F.col("_rs") + F.col("_off") * F.col("_ss")).alias("_rs"),
    )

    def gini(weighted: str, total: str) -> Column:
        return (2 * F.col(weighted) / F.col(total) - (F.col("_n") + 1)) / F.col("_n")

    return totals.select(*groups, F.try_divide(gini("_re", "_se"), gini("_rs", "_ss")).alias("mki"))


def _normal_share(mean: Column, sd: Column) -> Column:
    """Share of a normal distribution inside the chasing bounds; one value per group."""
    low, high = CHASING_BOUNDS

    @F.pandas_udf("double")
    def share(means: pd.Series, sds: pd.Series) -> pd.Series:
        from statistics import NormalDist

        def one(m, s):
            return NormalDist(m, s).cdf(high) - NormalDist(m, s).cdf(low) if s and s > 0 else None

        return pd.Series([one(m, s) for m, s in zip(means, sds)], dtype="float64")

    return share(mean, sd)


def sales_chased(df: DataFrame, groups: list[str], ratio: str) -> DataFrame:
    """True where the ratio distribution jumps near 1 and holds more there than a normal one would."""
    low, high = CHASING_BOUNDS
    shares = df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("_n"),
        F.avg(F.col(ratio).between(low, high).cast("double")).alias("_share"),
        F.avg(ratio).alias("_mean"),
        F.stddev_samp(ratio).alias("_sd"),
    )
    steps = df.groupBy(*groups, ratio).agg(F.count(F.lit(1)).alias("_m"))
    steps = lag_values(steps, groups, [ratio], {"_before": (ratio, 1)}, F.floor(F.col(ratio) * 256))
    jump = F.max_by("_before", F.struct(F.col("_m"), -F.col("_before"))).alias("_where")
    jumps = steps.where(F.col("_before").isNotNull()).groupBy(*groups).agg(F.max("_m").alias("_jump"), jump)
    both = _same(shares, jumps, groups)
    cdf = (F.col("_jump") / F.col("_n") > CHASING_GAP) & (F.col("_where") > low) & (F.col("_where") < high)
    dist = F.col("_share") > _normal_share(F.col("_mean"), F.col("_sd"))
    return both.select(
        *groups,
        (F.coalesce(cdf, F.lit(False)) & F.coalesce(dist, F.lit(False))).alias("is_sales_chased"),
    )


def _uniform(seeds: np.ndarray, nboot: int) -> np.ndarray:
    """Repeatable uniforms for each row and replicate (an integer mix of the row's hash)."""
    with np.errstate(over="ignore"):
        steps = np.arange(1, nboot + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = seeds.astype(np.int64).view(np.uint64)[:, None] + steps[None, :]
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _poisson(uniform: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """Poisson draws by inversion, one table per distinct rate."""
    out = np.empty_like(uniform)
    for m in np.unique(rate):
        rows = rate == m
        reach = int(m + 12 * np.sqrt(m) + 20)
        k = np.arange(reach)
        log_pmf = k * np.log(m) - m - np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, reach)))])
        out[rows] = np.searchsorted(np.cumsum(np.exp(log_pmf)), uniform[rows])
    return out


_VECTORS = ("w", "r", "e", "s", "x", "y", "xx", "xy")


def bootstrap_limits(
    trimmed: DataFrame, stats: DataFrame, groups: list[str], estimate: str, price: str, ratio: str,
    nboot: int = 300, seed: int = 0,
) -> DataFrame:
    """95 percent limits of the median, COD, PRD and PRB.

    Replicate sums are kept per ratio bin, which gives each replicate its own median and mean deviation. The
    PRB limits keep the group's median inside the logarithm.
    """
    spans = trimmed.groupBy(*groups).agg(F.min(ratio).alias("_lo"), F.max(ratio).alias("_hi"))
    spans = _same(spans, stats.select(*groups, "med_ratio"), groups)
    folded = trimmed.groupBy(*groups, estimate, price).agg(
        F.count(F.lit(1)).alias("_m"), F.first(ratio).alias("_r")
    )
    rows = _same(folded, spans, groups)
    width = F.when(F.col("_hi") > F.col("_lo"), (F.col("_hi") - F.col("_lo")) / BINS).otherwise(F.lit(1.0))
    rows = rows.select(
        *groups,
        F.least(F.floor((F.col("_r") - F.col("_lo")) / width), F.lit(BINS - 1)).cast("int").alias("bin"),
        F.col("_m").cast("double").alias("m"),
        F.col("_r").cast("double").alias("r"),
        F.col(estimate).cast("double").alias("e"),
        F.col(price).cast("double").alias("s"),
        ((F.col("_r") - F.col("med_ratio")) / F.col("med_ratio")).alias("y"),
        F.log2((F.col(estimate) / F.col("med_ratio") + F.col(price)) * 0.5).alias("x"),
        F.xxhash64(F.lit(seed), *groups, estimate, price).alias("h"),
    )
    key_fields = [trimmed.schema[g] for g in groups]
    vectors = T.StructType(
        key_fields
        + [T.StructField("bin", T.IntegerType())]
        + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in _VECTORS]
    )

    def accumulate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list[np.ndarray]] = {}
        for batch in batches:
            weight = _poisson(_uniform(batch["h"].to_numpy(), nboot), batch["m"].to_numpy())
            r, e, s, x, y = (batch[c].to_numpy() for c in ("r", "e", "s", "x", "y"))
            terms = {"w": np.ones(len(batch)), "r": r, "e": e, "s": s, "x": x, "y": y, "xx": x * x, "xy": x * y}
            for key, index in batch.groupby([*groups, "bin"], dropna=False, sort=False).indices.items():
                key = tuple(None if pd.isna(k) else k for k in key)
                w = weight[index]
                new = [terms[v][index] @ w for v in _VECTORS]
                held[key] = [a + b for a, b in zip(held[key], new)] if key in held else new
            if len(held) > HELD:
                yield _frame(held, groups)
                held = {}
        if held:
            yield _frame(held, groups)

    limit_names = [f"{m}_ci_{side}" for m in ("med_ratio", "cod", "prd", "prb") for side in ("l", "u")]
    limits_schema = T.StructType(key_fields + [T.StructField(n, T.DoubleType()) for n in limit_names])

    def limits(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("bin")
        v = {name: np.stack(part[name].to_numpy()) for name in _VECTORS}
        total = v["w"].sum(axis=0)
        live = total > 0
        v = {name: a[:, live] for name, a in v.items()}
        total = total[live]
        upto = np.cumsum(v["w"], axis=0)
        middle = (upto >= total / 2).argmax(axis=0)
        cols = np.arange(len(total))
        mean_in_bin = v["r"][middle, cols] / np.maximum(v["w"][middle, cols], 1e-300)
        with np.errstate(all="ignore"):
            spread = np.abs(v["r"] - mean_in_bin * v["w"]).sum(axis=0)
            med = mean_in_bin
            cod = 100 * spread / total / med
            prd = (v["r"].sum(axis=0) / total) / (v["e"].sum(axis=0) / v["s"].sum(axis=0))
            sx, sy, sxx, sxy = (v[n].sum(axis=0) for n in ("x", "y", "xx", "xy"))
            prb = (total * sxy - sx * sy) / (total * sxx - sx * sx)
        head = part.iloc[:1][groups].copy()
        for name, values in (("med_ratio", med), ("cod", cod), ("prd", prd), ("prb", prb)):
            good = values[np.isfinite(values)]
            low, high = np.quantile(good, [0.025, 0.975]) if len(good) else (None, None)
            head[f"{name}_ci_l"], head[f"{name}_ci_u"] = low, high
        return head

    partial = rows.mapInPandas(accumulate, vectors)
    # First in lanes, so that a hot group's bin is many keys, then the lanes of each bin, then the fixed number of bins.
    lanes = _added_up(partial.withColumn("_lane", F.spark_partition_id() % LANES), [*groups, "bin", "_lane"], groups, vectors)
    bins = _added_up(lanes, [*groups, "bin"], groups, vectors)
    return bins.groupBy(*groups).applyInPandas(limits, limits_schema)


def _frame(held: dict[tuple, list[np.ndarray]], groups: list[str]) -> pd.DataFrame:
    return pd.DataFrame([[*key, *sums] for key, sums in held.items()], columns=[*groups, "bin", *_VECTORS])


def _added_up(partial: DataFrame, keys: list[str], groups: list[str], schema: T.StructType) -> DataFrame:
    """Vector sums by key over sorted rows: a task holds one row's vectors at a time, however many there are."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, {}
        for batch in batches:
            for row in batch.itertuples(index=False):
                full = tuple(None if pd.isna(v) else v for v in row[: len(keys)])
                key = full[: len(groups) + 1]
                sums = row[len(keys) :]
                if full == at:
                    held[key] = [a + b for a, b in zip(held[key], sums)]
                    continue
                if held:
                    yield _frame(held, groups)
                at, held = full, {key: [np.asarray(v) for v in sums]}
        if held:
            yield _frame(held, groups)

    dealt = partial.select(*keys, *_VECTORS).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(add, schema)


def ratio_statistics(
    df: DataFrame, groups: list[str], estimate: str, price: str,
    trim: tuple[float, float] = (0.05, 0.95), min_n: int = 20, nboot: int = 300, seed: int = 0,
) -> DataFrame:
    """The full table: point values, limits, met flags, chasing and equity flags, counts."""
    ratio = "_ratio"
    # Both are read by several statistics, so each is computed and written once.
    rows = settle(df.select(*groups, estimate, price, (F.col(estimate) / F.col(price)).alias(ratio)).where(F.col(ratio) > 0))
    whole = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("sale_n"), *within_counts(ratio))
    trimmed = settle(trim_between(rows, groups, ratio, *trim))
    points = point_statistics(trimmed, groups, estimate, price, ratio)
    index = kakwani_index(trimmed, groups, estimate, price)
    limits = bootstrap_limits(trimmed, points, groups, estimate, price, ratio, nboot, seed)
    chased = sales_chased(rows, groups, ratio)
    out = whole
    for part in (points, index, limits, chased):
        out = _same(out, part, groups)
    n = F.coalesce(F.col("n"), F.lit(0))
    enough = n >= min_n
    cols: list[Column] = [F.col(g) for g in groups] + [F.col("sale_n"), (F.col("sale_n") - n).alias("sales_excluded_n")]
    for name in ("med_ratio", "cod", "prd", "prb", "mki"):
        gate = (n >= 2) if name == "med_ratio" else enough
        value = F.col(name) if name == "med_ratio" else F.when(gate, F.col(name))
        cols.append(value.alias(name))
        for side in ("l", "u"):
            ci = F.lit(None).cast("double") if name == "mki" else F.when(gate, F.col(f"{name}_ci_{side}"))
            cols.append(ci.alias(f"{name}_ci_{side}"))
        cols.append(F.when(gate, met(F.col(name), name)).alias(f"{name}_met"))
        cols.append(n.alias(f"{name}_n"))
    equity = F.when(enough, met(F.col("prb"), "prb") | met(F.col("prd"), "prd"))
    cols.append(equity.alias("vertical_equity_met"))
    cols.append(F.when(F.col("sale_n") >= min_n, F.col("is_sales_chased")).alias("is_sales_chased"))
    cols += [F.col(f"within_{p}_pct") for p in ("20", "10", "05")]
    return out.select(*cols)


