"""Operators that depend on row order within a key.

Each takes an optional ``chunk``: a column that never decreases along the order (say, the month of a
timestamp). With it the work runs on two levels. Rows are ordered within (key, chunk), one summary row per
(key, chunk) carries state forward, and both are joined. A key that holds a large part of the table is then
spread over as many tasks as it has chunks. Without it a plain window is used, which suits short histories
such as one row per parcel and year.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

_CHUNK = "_chunk"


def _window(keys: list[str], order: list[str], descending: bool = False) -> WindowSpec:
    by = [F.col(o).desc() if descending else F.col(o).asc() for o in order]
    return Window.partitionBy(*keys).orderBy(*by)


def _carry(df: DataFrame, keys: list[str], order: list[str], chunk: Column, aggs: list[Column], carried, descending):
    """Summaries of each (key, chunk) and what the chunks before it hand over."""
    base = df.withColumn(_CHUNK, chunk)
    summary = base.groupBy(*keys, _CHUNK).agg(*aggs)
    before = _window(keys, [_CHUNK], descending)
    handed = summary.select(*keys, _CHUNK, *carried(before))
    return base, handed


def _attach(local: DataFrame, handed: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    names = [*keys, _CHUNK]
    right = handed.select(*[F.col(k).alias(f"_c_{k}") for k in names], *columns)
    cond = reduce(and_, [local[k].eqNullSafe(right[f"_c_{k}"]) for k in names])
    return local.join(right, cond, "left").drop(*[f"_c_{k}" for k in names])


def _position(order: list[str]) -> Column:
    return F.struct(*[F.col(o) for o in order])


def fill_forward(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    cols: dict[str, str],
    chunk: Column | None = None,
    backward: bool = False,
    include_current: bool = True,
) -> DataFrame:
    """Last known value up to each row (or before it); ``cols`` maps inputs to output names."""
    end = 0 if include_current else -1
    if chunk is None:
        w = _window(keys, order, backward).rowsBetween(Window.unboundedPreceding, end)
        return df.withColumns({n: F.last(c, ignorenulls=True).over(w) for c, n in cols.items()})
    pick = F.min_by if backward else F.max_by
    aggs = [
        pick(F.col(c), F.when(F.col(c).isNotNull(), _position(order))).alias(f"_s_{c}") for c in cols
    ]
    base, handed = _carry(
        df, keys, order, chunk, aggs,
        lambda w: [
            F.last(f"_s_{c}", ignorenulls=True)
            .over(w.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_h_{c}")
            for c in cols
        ],
        backward,
    )
    w = _window([*keys, _CHUNK], order, backward).rowsBetween(Window.unboundedPreceding, end)
    local = base.withColumns({f"_l_{c}": F.last(c, ignorenulls=True).over(w) for c in cols})
    joined = _attach(local, handed, keys, [f"_h_{c}" for c in cols])
    filled = joined.withColumns({n: F.coalesce(f"_l_{c}", f"_h_{c}") for c, n in cols.items()})
    return filled.drop(_CHUNK, *[f"_l_{c}" for c in cols], *[f"_h_{c}" for c in cols])


def fill_backward(df: DataFrame, keys: list[str], order: list[str], cols: dict[str, str], chunk: Column | None = None):
    """Next known value from each row on."""
    return fill_forward(df, keys, order, cols, chunk, backward=True)


def lag_known(df: DataFrame, keys: list[str], order: list[str], cols: dict[str, str], chunk: Column | None = None):
    """Last known value strictly before each row (lag that ignores nulls)."""
    return fill_forward(df, keys, order, cols, chunk, include_current=False)


def lag_values(
    df: DataFrame, keys: list[str], order: list[str], cols: dict[str, tuple[str, int]], chunk: Column | None = None
) -> DataFrame:
    """Values n rows earlier. ``cols`` maps output names to (input, n); rows must be unique in ``order``."""
    if chunk is None:
        w = _window(keys, order)
        return df.withColumns({out: F.lag(c, n).over(w) for out, (c, n) in cols.items()})
    deepest = max(n for _, n in cols.values())
    inputs = sorted({c for c, _ in cols.values()})
    base = df.withColumn(_CHUNK, chunk)
    by = [*keys, _CHUNK]
    tail_order = Window.partitionBy(*by).orderBy(*[F.col(o).desc() for o in order])
    tails = (
        base.select(*by, *order, *[c for c in inputs if c not in [*by, *order]])
        .withColumn("_rn", F.row_number().over(tail_order))
        .where(F.col("_rn") <= deepest)
        .groupBy(*by)
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("_rn")).alias("_p"), *inputs))).alias("_tail"))
    )
    # Each chunk has at least one row, so the last ``deepest`` chunks hold enough rows.
    earlier = _window(keys, [_CHUNK]).rowsBetween(-deepest, -1)
    handed = tails.select(*by, F.reverse(F.flatten(F.collect_list("_tail").over(earlier))).alias("_handed"))
    w = _window(by, order)
    local = base.withColumn("_pos", F.row_number().over(w))
    local = local.withColumns({f"_l_{out}": F.lag(c, n).over(w) for out, (c, n) in cols.items()})
    joined = _attach(local, handed, keys, ["_handed"])
    results = {
        out: F.when(F.col("_pos") > n, F.col(f"_l_{out}")).otherwise(
            F.get(F.col("_handed"), F.lit(n) - F.col("_pos"))[c]
        )
        for out, (c, n) in cols.items()
    }
    return joined.withColumns(results).drop(_CHUNK, "_pos", "_handed", *[f"_l_{o}" for o in cols])


def running_total(
    df: DataFrame, keys: list[str], order: list[str], cols: dict[str, str], chunk: Column | None = None
) -> DataFrame:
    """Sum of all rows up to each row."""
    if chunk is None:
        w = _window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({n: F.sum(c).over(w) for c, n in cols.items()})
    aggs = [F.sum(c).alias(f"_s_{c}") for c in cols]
    base, handed = _carry(
        df, keys, order, chunk, aggs,
        lambda w: [
            F.sum(f"_s_{c}").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_h_{c}") for c in cols
        ],
        False,
    )
    w = _window([*keys, _CHUNK], order).rowsBetween(Window.unboundedPreceding, 0)
    local = base.withColumns({f"_l_{c}": F.sum(c).over(w) for c in cols})
    joined = _attach(local, handed, keys, [f"_h_{c}" for c in cols])
    both = {
        n: F.coalesce(F.col(f"_l_{c}") + F.col(f"_h_{c}"), F.col(f"_l_{c}"), F.col(f"_h_{c}")) for c, n in cols.items()
    }
    return joined.withColumns(both).drop(_CHUNK, *[f"_l_{c}" for c in cols], *[f"_h_{c}" for c in cols])


def streak(
    df: DataFrame, keys: list[str], order: list[str], flag: Column, out: str, chunk: Column | None = None
) -> DataFrame:
    """Length of the run of true flags that ends at each row; 0 where the flag is false.

    The running count of true rows minus that count at the last false row. A null flag neither counts nor breaks: the
    row carries the run on, and has none (null) before the key's first known flag.
    """
    marked = df.withColumn("_on", flag.cast("long"))
    counted = running_total(marked, keys, order, {"_on": "_count"}, chunk)
    broken = counted.withColumn("_reset", F.when(F.col("_on") == 0, F.col("_count")))
    known = fill_forward(broken, keys, order, {"_reset": "_base"}, chunk)
    length = F.col("_count") - F.coalesce(F.col("_base"), F.lit(0))
    return known.withColumn(out, length).drop("_on", "_count", "_reset", "_base")


def repeat_within(
    df: DataFrame, keys: list[str], date: str, tie: list[str], days: int, out: str, chunk: Column | None = None
) -> DataFrame:
    """True when the key's previous row lies at most ``days`` days back."""
    before = lag_values(df, keys, [date, *tie], {"_previous": (date, 1)}, chunk)
    gap = F.datediff(F.col(date), F.col("_previous"))
    return before.withColumn(out, F.coalesce(gap <= days, F.lit(False))).drop("_previous")


def recent_change(
    df: DataFrame, keys: list[str], order: list[str], c: str, to, n: int, out: str, chunk: Column | None = None
) -> DataFrame:
    """True when ``c`` switched to ``to`` in this or one of the ``n-1`` rows before."""
    lags = {f"_p{i}": (c, i) for i in range(1, n + 1)}
    seen = lag_values(df, keys, order, lags, chunk)
    chain = [F.col(c), *[F.col(f"_p{i}") for i in range(1, n + 1)]]
    steps = [(now == to) & (before != to) for now, before in zip(chain, chain[1:])]
    hit = reduce(lambda a, b: a | b, [F.coalesce(s, F.lit(False)) for s in steps])
    return seen.withColumn(out, hit).drop(*lags)


def dedup_by_priority(
    df: DataFrame, partition: list[Column | str], order: list[Column], n: int = 1, rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows of each partition. Give a total order to get repeatable rows.

    Spark turns the filter into a group limit that runs before the shuffle as well, so no task ever has to
    sort a whole large group.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    kept = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return kept.withColumnRenamed("_rn", rank) if rank else kept.drop("_rn")


def top_with_ties(
    df: DataFrame, partition: list[Column | str], order: list[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """Rows of rank up to ``k``; equal rows share a rank, so more than ``k`` may come back."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank, F.rank().over(w)).where(F.col(rank) <= k)


def first_n_wide(
    df: DataFrame, keys: list[str], order: list[Column], n: int, cols: list[str]
) -> DataFrame:
    """The first ``n`` rows of each key side by side: ``<col>_1 .. <col>_n``."""
    ranked = dedup_by_priority(df, keys, order, n, rank="_rank")
    wide = [
        F.max(F.when(F.col("_rank") == i, F.col(c))).alias(f"{c}_{i}") for c in cols for i in range(1, n + 1)
    ]
    return ranked.groupBy(*keys).agg(*wide)
