"""Searches by distance over packed box trees.

Both sides of a search are put in Z-order and cut into leaves of ``LEAF`` consecutive rows; ``FAN`` consecutive leaves
make a node of the next level, and so on. Leaves are cut by rows, not by ground: a crowded place simply has more of them,
however close its rows lie, and no key holds more than ``LEAF`` rows or ``FAN`` children. A search goes down both trees at
once. Its state is one row per node of the near side with the nodes of the far side that may still matter, judged by the
distances between the boxes: at least the gap between them, at most the way between their far corners. Pairs of rows are
only compared where two leaves are left, so what is compared follows from the answers, not from the size of cells or
from how far apart the two sides lie.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from plotwise.session import LARGE_ROWS, stored

#: Rows of a leaf; bits of a node's number below its parent's.
LEAF = 16
FAN_BITS = 4
FAN = 1 << FAN_BITS
BOX = ("x0", "x1", "y0", "y1")
#: Levels below the root at which a search starts, with all far nodes there (at most FAN to this power) for each near one.
TOP_LEVELS = 2
#: Distances of boxes and of rows are rounded differently; pairs this near to a bound are kept.
SLACK = 1e-9


@dataclass
class Side:
    """One side: rows with ``by``, their leaf ``_code``, box and payload; the tree's height; sums that its nodes carry; whether rows are too many to broadcast; values of some one row, and distinct values of all rows, that nodes carry."""

    rows: DataFrame
    height: int
    by: list[str]
    sums: dict[str, Column]
    many: bool = False
    one: dict[str, Column] = field(default_factory=dict)
    sets: dict[str, Column] = field(default_factory=dict)

    def whole(self) -> DataFrame:
        """The rows; merged if they are many, as the stored file's length says little of their size in memory."""
        return self.rows.hint("merge") if self.many else self.rows

    def nodes(self, level: int) -> DataFrame:
        """by, _code, box and sums of the nodes of a level (0: leaves)."""
        code = F.shiftright("_code", FAN_BITS * level)
        box = [F.min("_x0").alias("x0"), F.max("_x1").alias("x1"), F.min("_y0").alias("y0"), F.max("_y1").alias("y1")]
        carried = [F.sum(c).alias(n) for n, c in self.sums.items()] + [F.first(c).alias(n) for n, c in self.one.items()]
        carried += [F.collect_set(c).alias(n) for n, c in self.sets.items()]
        return self.rows.groupBy(*self.by, code.alias("_code")).agg(*box, *carried)


def point_box(x: str, y: str) -> dict[str, Column]:
    return {"_x0": F.col(x), "_x1": F.col(x), "_y0": F.col(y), "_y1": F.col(y)}


def segment_box() -> dict[str, Column]:
    return {"_x0": F.least("x1", "x2"), "_x1": F.greatest("x1", "x2"), "_y0": F.least("y1", "y2"), "_y1": F.greatest("y1", "y2")}


#: Shifts and masks that put a zero before each of the lower 31 bits of a number.
_APART = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def zordered(df: DataFrame, edge: Row) -> DataFrame:
    """``df`` with ``_z``, the place of its boxes' middles in Z-order between the corners of ``edge`` (x0, x1, y0, y1).

    Each step is a column of its own: as one expression the number would be worked out anew at both of its places in every step.
    """
    steps = float((1 << 31) - 1)

    def cell(low: str, high: str, first: float | None, last: float | None) -> Column:
        width = (last - first if first is not None else 0.0) or 1.0
        return F.floor(((F.col(low) + F.col(high)) / 2 - F.lit(first or 0.0)) / F.lit(width) * F.lit(steps)).cast("long")

    out = df.withColumns({"_zx": cell("_x0", "_x1", edge.x0, edge.x1), "_zy": cell("_y0", "_y1", edge.y0, edge.y1)})
    for shift, mask in _APART:
        out = out.withColumns({c: F.col(c).bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask)) for c in ("_zx", "_zy")})
    return out.withColumn("_z", F.col("_zx").bitwiseOR(F.shiftleft("_zy", 1))).drop("_zx", "_zy")


def _digits(largest: int | None) -> int:
    return -(-(largest or 0).bit_length() // FAN_BITS)


def pack(near: DataFrame, far: DataFrame, by: list[str], sums: dict[str, Column] | None = None) -> tuple[Side, Side]:
    """Both sides in their trees, by one range sort and one stored table. Frames have ``by``, the columns of a box (``_x0`` ..) and others; rows with a null box or ``by`` are left out."""
    by = list(by)
    both = near.withColumn("_far", F.lit(False)).unionByName(far.withColumn("_far", F.lit(True)), allowMissingColumns=True)
    both = both.dropna(subset=["_x0", "_x1", "_y0", "_y1", *by])
    edge = both.agg(F.min("_x0").alias("x0"), F.max("_x1").alias("x1"), F.min("_y0").alias("y0"), F.max("_y1").alias("y1")).first()
    order = ["_far", *by, "_z"]
    sorted_ = zordered(both, edge).repartitionByRange(*order).sortWithinPartitions(*order).drop("_z")
    # a row's number within its partition, which the id holds in its lower 33 bits
    row = F.monotonically_increasing_id()
    numbered = sorted_.withColumn("_row", row).withColumns({"_part": F.shiftright("_row", 33), "_leaf": F.floor(F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) / LEAF)})
    table = stored(numbered.drop("_row"), "packed")
    most = table.groupBy("_far").agg(F.max("_part").alias("part"), F.max("_leaf").alias("leaf"), F.count(F.lit(1)).alias("n")).collect()
    sides = []
    for is_far, frame in ((False, near), (True, far)):
        here = next((r for r in most if r._far == is_far), None)
        low = _digits(here.leaf if here else 0)
        code = F.shiftleft("_part", FAN_BITS * low).bitwiseOR(F.col("_leaf"))
        rows = table.where(F.col("_far") == is_far).withColumn("_code", code).select(*frame.columns, "_code")
        sides.append(Side(rows, low + _digits(here.part if here else 0), by, (sums or {}) if is_far else {}, bool(here) and here.n > LARGE_ROWS))
    return sides[0], sides[1]


# Of a near node's box (x0, x1, y0, y1) and a far node c: the squared least distance, and the squared way between the far
# corners, beyond which no two of their points lie. SQL text, as it is built once for each level of a search.
_DX, _DY = "greatest(c.x0 - x1, x0 - c.x1, 0D)", "greatest(c.y0 - y1, y0 - c.y1, 0D)"
_WX, _WY = "greatest(c.x1 - x0, x1 - c.x0)", "greatest(c.y1 - y0, y1 - c.y0)"
GAP2, SPAN2 = f"({_DX} * {_DX} + {_DY} * {_DY})", f"({_WX} * {_WX} + {_WY} * {_WY})"

Prune = Callable[[DataFrame], DataFrame]


def _kept(bound: str) -> Column:
    """The far nodes whose gap is within a bound. The bound is an array's element here, so that it is computed once for a row, not once for each node."""
    return F.expr(f"transform(array({bound} * {1 + SLACK!r}D), b -> filter(_open, c -> {GAP2} <= b))[0]")


def keep_nearest(state: DataFrame) -> DataFrame:
    """Far nodes that may hold the nearest row of some point of the near node."""
    return state.withColumn("_open", _kept(f"array_min(transform(_open, c -> {SPAN2}))"))


def with_spot(far: Side, x: Column, y: Column) -> Side:
    """The far side with a point of some one of its rows in each node, for ``keep_nearest_spot``."""
    return replace(far, one={"px": x, "py": y})


# The squared way from a near node's box to its farthest corner from the point that a far node carries.
_PX, _PY = "greatest(abs(c.px - x0), abs(x1 - c.px))", "greatest(abs(c.py - y0), abs(y1 - c.py))"


def keep_nearest_spot(state: DataFrame) -> DataFrame:
    """``keep_nearest`` by a closer bound.

    Each far node carries a point of one of its rows (``with_spot``), so no nearest row lies beyond the nearest such point.
    This bounds better than far corners do: long rows make wide boxes, and in crowds the boxes of many overlap.
    """
    return state.withColumn("_open", _kept(f"array_min(transform(_open, c -> {_PX} * {_PX} + {_PY} * {_PY}))"))


def keep_k_nearest(k: int, radius: float) -> Prune:
    """Far nodes that may hold one of the ``k`` nearest rows that share neither x nor y; nodes carry ``n``, their rows."""
    apart = "(c.x0 > x1 OR c.x1 < x0) AND (c.y0 > y1 OR c.y1 < y0)"
    # rows that surely count, nearest corners first: the k-th of them bounds the k-th distance
    sure = f"array_sort(transform(_open, c -> struct({SPAN2} AS d, if({apart}, c.n, 0L) AS n)))"
    step = f"struct(a.n + s.n AS n, if(a.n < {k} AND a.n + s.n >= {k}, least(a.d, s.d), a.d) AS d)"
    bound = f"aggregate({sure}, struct(0L AS n, {float(radius) ** 2!r}D AS d), (a, s) -> {step}).d"
    return lambda state: state.withColumn("_open", _kept(bound))


def keep_within(radius: float) -> Prune:
    return lambda state: state.withColumn("_open", F.expr(f"filter(_open, c -> {GAP2} <= {float(radius) ** 2 * (1 + SLACK)!r}D)"))


def add_within(radius: float, names: list[str]) -> Prune:
    """Nodes that lie wholly within the radius add their sums at once; those that may do so in part stay."""
    whole = f"{SPAN2} <= {float(radius) ** 2 * (1 - SLACK)!r}D"

    def prune(state: DataFrame) -> DataFrame:
        state = state.withColumn("_whole", F.expr(f"filter(_open, c -> {whole})"))
        added = {f"_sum_{n}": F.expr(f"aggregate(_whole, _sum_{n}, (a, c) -> a + coalesce(c.{n}, a - a))") for n in names}
        left = F.expr(f"filter(_open, c -> NOT ({whole}) AND {GAP2} <= {float(radius) ** 2 * (1 + SLACK)!r}D)")
        return state.withColumns(added).withColumn("_open", left).drop("_whole")

    return prune


def with_values(far: Side, value: Column) -> Side:
    """The far side with the distinct values of its rows in each node, for ``meet_within``."""
    return replace(far, sets={"seen": value})


def meet_within(radius: float) -> Prune:
    """Distinct values within the radius, in ``_seen``: nodes wholly within it add theirs at once; those that may do so in part stay while they hold others."""
    whole = f"{SPAN2} <= {float(radius) ** 2 * (1 - SLACK)!r}D"

    def prune(state: DataFrame) -> DataFrame:
        added = F.expr(f"array_union(_seen, flatten(transform(filter(_open, c -> {whole}), c -> c.seen)))")
        new = "size(array_except(c.seen, _seen)) > 0"
        left = F.expr(f"filter(_open, c -> NOT ({whole}) AND {GAP2} <= {float(radius) ** 2 * (1 + SLACK)!r}D AND {new})")
        return state.withColumn("_seen", added).withColumn("_open", left)

    return prune


def descend(near: Side, far: Side, prune: Prune, carry: dict[str, Column] | None = None) -> DataFrame:
    """by, _code (near leaf), box, ``carry`` and _open: the far leaves left for each near leaf. Near leaves without any stay with an empty list."""
    by, up, down = near.by, near.height, far.height
    held = [*by, "_code", *BOX, *(carry or {})]
    inner = [*far.sums, *far.one, *far.sets]

    def as_struct(code: str) -> Column:
        return F.struct(F.col(code).alias("code"), *[F.col(f"f_{c}").alias(c) for c in (*BOX, *inner)])

    def far_nodes(level: int, name: str) -> DataFrame:
        rows = far.nodes(level)
        return rows.select(*by, F.col("_code").alias(name), *[F.col(c).alias(f"f_{c}") for c in (*BOX, *inner)])

    up, down = max(0, up - TOP_LEVELS), max(0, down - TOP_LEVELS)
    # codes below 2^62 all give 0 here: with no ``by`` everything meets the one list of top nodes
    every = F.shiftright("_code", 62).alias("_every")
    tops = far_nodes(down, "_code").groupBy(*by, every).agg(F.collect_list(as_struct("_code")).alias("_open"))
    state = near.nodes(up).withColumn("_every", every).join(tops, [*by, "_every"], "left").withColumns({n: c for n, c in (carry or {}).items()})
    state = prune(state.withColumn("_open", F.coalesce("_open", F.array().cast(dict(tops.dtypes)["_open"]))).select(*held, "_open"))
    while up or down:
        if down:
            down -= 1
            kids = far_nodes(down, "_kid").withColumn("_parent", F.shiftright("_kid", FAN_BITS))
            opened = state.select(*held, F.explode_outer("_open").alias("_o")).select(*held, F.col("_o.code").alias("_parent"))
            met = opened.join(kids, [*by, "_parent"], "left")
            found = F.collect_list(F.when(F.col("_kid").isNotNull(), as_struct("_kid"))).alias("_open")
            state = prune(met.groupBy(*by, "_code").agg(*[F.first(c).alias(c) for c in held if c not in (*by, "_code")], found))
        if up:
            up -= 1
            kids = near.nodes(up).withColumnRenamed("_code", "_kid").withColumn("_code", F.shiftright("_kid", FAN_BITS))
            state = state.drop(*BOX).join(kids, [*by, "_code"]).drop("_code").withColumnRenamed("_kid", "_code").select(*held, "_open")
            state = prune(state)
    return state


def candidates(near: Side, far: Side, prune: Prune, place: list[str], x: str, y: str, columns: dict[str, str], carry: dict[str, Column] | None = None) -> DataFrame:
    """place, carry, and the far rows' ``columns`` (renamed) that each near row has to be compared with; null columns for one without any."""
    by = near.by
    # Few bytes, but each row is about to become many: spread over all tasks, whatever the size. The lists are sent once for
    # each leaf, before they are copied to its points. One partition more than groupings have, as Spark leaves out a shuffle
    # that repeats the one of the search's last grouping, and merges that one's partitions by their bytes.
    spread = int(near.rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1
    leaves = descend(near, far, prune, carry).drop(*BOX).repartition(spread, *by, "_code")
    points = near.rows.select(*place, "_code").hint("merge").join(leaves, [*by, "_code"])
    points = points.withColumns({"x0": F.col(x), "x1": F.col(x), "y0": F.col(y), "y1": F.col(y)})
    # the lists of a leaf are cut once more for each of its points
    own = prune(points).select(*place, *(carry or {}), F.explode_outer("_open.code").alias("_code"))
    rows = far.whole().select(*by, "_code", F.lit(True).alias("_met"), *[F.col(c).alias(n) for c, n in columns.items()])
    return own.join(rows, [*by, "_code"], "left").drop("_code")
