"""Searches by distance in blocks of rows, which tasks compare as arrays.

Both sides are put in Z-order and cut into blocks of consecutive rows; a block is one stored row with its box and its rows
as Arrow bytes. Consecutive near blocks make a lot, which is the work of one task. Boxes say which far blocks a lot needs, so
each is sent once a lot, not once a place, and no list of pairs is ever sent. Within a lot far rows are cut into leaves again
and boxes judge blocks, then leaves, for a few near places at a time; only what is left is compared, place by row.
Blocks are cut by rows, not by ground: a crowded place simply has more of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plotwise.operators.packed import BOX, SLACK, zordered
from plotwise.session import LARGE_ROWS, stored

#: Near places judged together, and rows of a far leaf.
NEAR_LEAF, FAR_LEAF = 8, 16
#: Rows of a block at least, near and far; blocks of a side until they grow.
NEAR_ROWS, FAR_ROWS, MANY = 256, 1_024, 8_192
#: Places of a lot at most; lots at least.
LOT_ROWS, LOTS = 32_768, 32
#: Elements of one array of comparisons.
CHUNK = 1 << 16


@dataclass
class Blocks:
    """Both sides as blocks: near ones with their lot, far ones with a spot; ``by`` and box of each; whether far rows are many."""

    near: DataFrame
    far: DataFrame
    by: list[str]
    place: list[str]
    many: bool


def _as_bytes(table: pa.Table) -> bytes:
    # a far block is sent to many lots: packed once, and better than a shuffle does
    options = pa.ipc.IpcWriteOptions(compression="zstd" if pa.Codec.is_available("zstd") else None)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _as_table(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _narrow(table: pa.Table) -> pa.Table:
    """Long columns in the fewest bytes that hold them."""
    for i, f in enumerate(table.schema):
        if pa.types.is_int64(f.type):
            values = table.column(i).to_numpy()
            kind = np.result_type(np.min_scalar_type(values.min()), np.min_scalar_type(values.max()), np.int8)
            if np.issubdtype(kind, np.signedinteger):
                table = table.set_column(i, f.name, pa.array(values.astype(kind)))
    return table


def _cutter(by: list[str], near: list[str], far: list[str], spot: tuple[str, str], sizes: tuple[int, int, int], schema: pa.Schema, narrow: bool):
    """A function of Arrow batches in order that cuts them into blocks."""
    near_rows, lot_rows, far_rows = sizes

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        held: list[pa.RecordBatch] = []
        rows = block = lot = in_lot = 0
        key = None

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            is_far = key[0]
            low = {c: table.column(f"_{c}").to_numpy().min() if c in ("x0", "y0") else table.column(f"_{c}").to_numpy().max() for c in BOX}
            kept = table.select(far if is_far else near)
            at = [table.column(c)[0].as_py() if is_far else None for c in spot]
            values = {"_far": is_far, "_block": first + block, "_lot": None if is_far else first + lot, **low, "px": at[0], "py": at[1], "_rows": _as_bytes(_narrow(kept) if is_far and narrow else kept)}
            columns = [table.column(f.name).slice(0, 1).combine_chunks().cast(f.type) if f.name in by else pa.array([values[f.name]], f.type) for f in schema]
            return pa.RecordBatch.from_arrays([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns], schema=schema)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            change = np.zeros(batch.num_rows, bool)
            for c in ("_far", *by):
                column = batch.column(c)
                change[1:] |= np.asarray(pa.compute.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False), bool)
            ends = [*np.flatnonzero(change), batch.num_rows]
            start = 0
            for end in ends:
                now = tuple(batch.column(c)[start].as_py() for c in ("_far", *by))
                if now != key:
                    if held:
                        yield flush()
                        held, rows, block = [], 0, block + 1
                    key, lot, in_lot = now, lot + 1, 0
                while start < end:
                    most = far_rows if key[0] else min(near_rows, lot_rows)
                    take = min(most - rows, end - start)
                    held.append(batch.slice(start, take))
                    start, rows, in_lot = start + take, rows + take, in_lot + take
                    if rows == most:
                        yield flush()
                        held, rows, block = [], 0, block + 1
                        if in_lot + most > lot_rows:
                            lot, in_lot = lot + 1, 0
        if held:
            yield flush()

    return cut


def pack(near: DataFrame, far: DataFrame, by: list[str], place: list[str], spot: tuple[str, str], narrow: bool = False) -> Blocks:
    """Both sides in blocks. Frames have ``by``, the columns of a box (``_x0`` ..) and others; ``place`` names the near side's x and y, ``spot`` a point of far rows. Rows with a null box or ``by`` are left out."""
    by = list(by)
    box = [f"_{c}" for c in BOX]
    payload = [c for c in far.columns if c not in (*by, *box)]
    both = near.withColumn("_far", F.lit(False)).unionByName(far.withColumn("_far", F.lit(True)), allowMissingColumns=True)
    both = stored(both.dropna(subset=[*box, *by]), "rows")
    edge = both.agg(
        F.min("_x0").alias("x0"), F.max("_x1").alias("x1"), F.min("_y0").alias("y0"), F.max("_y1").alias("y1"),
        F.count_if(~F.col("_far")).alias("near"), F.count_if("_far").alias("far"),
    ).first()
    lot_rows = min(LOT_ROWS, max(64, -(-edge.near // LOTS)))
    sizes = (max(NEAR_ROWS, edge.near // MANY), lot_rows, max(FAR_ROWS, edge.far // MANY))
    kinds = {f.name: f for f in both.schema}
    schema = T.StructType(
        [T.StructField("_far", T.BooleanType()), *[kinds[b] for b in by], T.StructField("_block", T.LongType()), T.StructField("_lot", T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in (*BOX, "px", "py")] + [T.StructField("_rows", T.BinaryType())]
    )
    order = ["_far", *by, "_z"]
    in_order = zordered(both, edge).repartitionByRange(*order).sortWithinPartitions(*order).drop("_z")
    cut = _cutter(by, place, payload, spot, sizes, to_arrow_schema(schema), narrow)
    table = stored(in_order.mapInArrow(cut, schema), "blocks")
    return Blocks(
        table.where(~F.col("_far")).drop("_far", "px", "py"), table.where("_far").drop("_far", "_lot"), by, place, edge.far > LARGE_ROWS
    )


def _met(near: DataFrame, far: DataFrame, by: list[str]) -> DataFrame:
    """Boxes of both sides that share ``by``; the far ones, one for thousands of rows, under names that start with f_ and broadcast."""
    named = far.select(*by, F.col("_block").alias("f_block"), *[F.col(c).alias(f"f_{c}") for c in (*BOX, "px", "py")])
    return near.join(F.broadcast(named), by) if by else near.crossJoin(F.broadcast(named))


_DX, _DY = "greatest(f_x0 - x1, x0 - f_x1, 0D)", "greatest(f_y0 - y1, y0 - f_y1, 0D)"
_WX, _WY = "greatest(f_x1 - x0, x1 - f_x0)", "greatest(f_y1 - y0, y1 - f_y0)"
_PX, _PY = "greatest(abs(f_px - x0), abs(x1 - f_px))", "greatest(abs(f_py - y0), abs(y1 - f_py))"
GAP2, SPAN2, SPOT2 = (f"({a} * {a} + {b} * {b})" for a, b in ((_DX, _DY), (_WX, _WY), (_PX, _PY)))


def pairs_within(blocks: Blocks, radius: float) -> DataFrame:
    """Lots and the far blocks of which some row may be within the radius of some place."""
    near = blocks.near.groupBy(*blocks.by, "_lot").agg(*[(F.min if c in ("x0", "y0") else F.max)(c).alias(c) for c in BOX])
    met = _met(near, blocks.far, blocks.by).where(F.expr(f"{GAP2} <= {float(radius) ** 2 * (1 + SLACK)!r}D"))
    return met.select("_lot", "f_block")


def pairs_nearest(blocks: Blocks) -> DataFrame:
    """Lots and the far blocks that may hold the nearest row of some place: no nearest row lies beyond the nearest spot."""
    near = blocks.near.select(*blocks.by, "_block", "_lot", *BOX)
    bound = _met(near, blocks.far, blocks.by).groupBy(*blocks.by, "_block", "_lot", *BOX).agg(F.min(F.expr(SPOT2)).alias("_bound"))
    met = _met(bound, blocks.far, blocks.by).where(F.expr(f"{GAP2} <= _bound * {1 + SLACK!r}D"))
    return met.select("_lot", "f_block").distinct()


def compare(blocks: Blocks, pairs: DataFrame, kernel: Callable, schema: T.StructType) -> DataFrame:
    """Rows of ``kernel(x, y, far tables)`` for each lot, with ``by`` and the places' coordinates; ``schema`` is that of its other columns."""
    by, (x, y) = blocks.by, blocks.place
    near = blocks.near.select("_lot", F.lit(False).alias("_far"), *by, "_rows")
    far = blocks.far.select(F.col("_block").alias("f_block"), *by, "_rows")
    far = far.hint("merge") if blocks.many else far
    sent = near.unionByName(pairs.join(far, "f_block").select("_lot", F.lit(True).alias("_far"), *by, "_rows"))
    full = T.StructType([blocks.near.schema[b] for b in by] + [T.StructField(c, T.DoubleType()) for c in (x, y)] + schema.fields)
    arrow = to_arrow_schema(full)

    def of_lot(table: pa.Table) -> pa.Table:
        is_far = np.asarray(table.column("_far").to_numpy(), bool)
        rows = table.column("_rows")
        places = pa.concat_tables([_as_table(rows[i].as_py()) for i in np.flatnonzero(~is_far)])
        xs, ys = (places.column(c).to_numpy() for c in (x, y))
        at, columns = kernel(xs, ys, [_as_table(rows[i].as_py()) for i in np.flatnonzero(is_far)])
        keys = [pa.compute.take(table.column(b).slice(0, 1), pa.array(np.zeros(len(at), np.int64))) for b in by]
        out = [*keys, pa.array(xs[at]), pa.array(ys[at]), *columns]
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow)

    # few bytes, but much work: a task for each lot, whatever the size
    tasks = int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1
    return sent.repartition(max(tasks, LOTS), "_lot").groupBy("_lot").applyInArrow(of_lot, full)


def _spans(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Numbers first .. first + count - 1 of all pairs, one after the other."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - count), count)


class _Tree:
    """Far rows of a lot in blocks and leaves: where each starts, how many it holds, and boxes."""

    def __init__(self, sizes: list[int], x0: np.ndarray, x1: np.ndarray, y0: np.ndarray, y1: np.ndarray):
        sizes = np.array(sizes, np.int64)
        self.block_at = np.cumsum(sizes) - sizes
        self.leaves = -(-sizes // FAR_LEAF)
        self.leaf_of_block = np.cumsum(self.leaves) - self.leaves
        step = _spans(np.zeros(len(sizes), np.int64), self.leaves) * FAR_LEAF
        self.leaf_at = np.repeat(self.block_at, self.leaves) + step
        self.rows = np.minimum(FAR_LEAF, np.repeat(sizes, self.leaves) - step)
        self.blocks = self._boxes(self.block_at, x0, x1, y0, y1)
        self.boxes = self._boxes(self.leaf_at, x0, x1, y0, y1)

    @staticmethod
    def _boxes(at, x0, x1, y0, y1):
        return np.minimum.reduceat(x0, at), np.maximum.reduceat(x1, at), np.minimum.reduceat(y0, at), np.maximum.reduceat(y1, at)


def _gap2(b, x0, x1, y0, y1):
    dx = np.maximum(np.maximum(b[0] - x1, x0 - b[1]), 0.0)
    dy = np.maximum(np.maximum(b[2] - y1, y0 - b[3]), 0.0)
    return dx * dx + dy * dy


def _span2(b, x0, x1, y0, y1):
    dx, dy = np.maximum(b[1] - x0, x1 - b[0]), np.maximum(b[3] - y0, y1 - b[2])
    return dx * dx + dy * dy


def _at(boxes, which):
    return tuple(c[which] for c in boxes)


def _weights(values: list[np.ndarray]) -> np.ndarray:
    """Measures side by side in a type in which their sums are right: floats while whole numbers are small, longs else, decimals as objects."""
    if any(v.dtype == object for v in values):
        return np.stack([v.astype(object) for v in values], axis=1)
    if all(np.issubdtype(v.dtype, np.integer) for v in values):
        most = max(float(np.abs(v.astype(np.float64)).sum()) for v in values)
        return np.stack(values, axis=1).astype(np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64)
    return np.stack([v.astype(np.float64) for v in values], axis=1)


def _sums(inside: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each row of a table of marks the sum of the marked rows' weights."""
    if weights.dtype.kind == "f" and not np.isfinite(weights).all():
        return np.stack([weights[row].sum(axis=0) for row in inside])
    return inside.astype(weights.dtype) @ weights


def counter(radius: float, x: str, y: str, measures: list[str], kinds: list[pa.DataType]) -> Callable:
    """A kernel that sums the far rows' measures within a radius of each place; ``x`` and ``y`` name the far rows' coordinates."""
    r2 = float(radius) * float(radius)
    low, high = r2 * (1 - SLACK), r2 * (1 + SLACK)

    def kernel(xs: np.ndarray, ys: np.ndarray, tables: list[pa.Table]):
        at = np.arange(len(xs))
        if not tables:
            return at, [pa.array([0] * len(xs)).cast(k) for k in kinds]
        fx, fy = (np.concatenate([t.column(c).to_numpy() for t in tables]) for c in (x, y))
        weights = _weights([np.concatenate([t.column(m).to_numpy(zero_copy_only=False) for t in tables]) for m in measures])
        tree = _Tree([t.num_rows for t in tables], fx, fx, fy, fy)
        of_block, of_leaf = np.add.reduceat(weights, tree.block_at), np.add.reduceat(weights, tree.leaf_at)
        total = np.zeros((len(xs), len(measures)), weights.dtype)
        for s in range(0, len(xs), NEAR_LEAF):
            px, py = xs[s : s + NEAR_LEAF], ys[s : s + NEAR_LEAF]
            box = px.min(), px.max(), py.min(), py.max()
            whole = _span2(tree.blocks, *box) <= low
            some = ~whole & (_gap2(tree.blocks, *box) <= high)
            added = of_block[whole].sum(axis=0)
            leaves = _spans(tree.leaf_of_block[some], tree.leaves[some])
            boxes = _at(tree.boxes, leaves)
            whole = _span2(boxes, *box) <= low
            added = added + of_leaf[leaves[whole]].sum(axis=0)
            leaves = leaves[~whole & (_gap2(boxes, *box) <= high)]
            rows = _spans(tree.leaf_at[leaves], tree.rows[leaves])
            here = total[s : s + NEAR_LEAF]
            here += added
            for i in range(0, len(rows), CHUNK // NEAR_LEAF):
                part = rows[i : i + CHUNK // NEAR_LEAF]
                d2, dy = px[:, None] - fx[part], py[:, None] - fy[part]
                d2 *= d2
                dy *= dy
                d2 += dy
                here += _sums(d2 <= r2, weights[part])
        if weights.dtype != object:
            total = [np.rint(v).astype(np.int64) if pa.types.is_integer(k) else v.astype(np.float64) for v, k in zip(total.T, kinds)]
        else:
            total = [[type(w)(v) for v in column] for column, w in zip(total.T, weights[0])]
        return at, [pa.array(v).cast(k) for v, k in zip(total, kinds)]

    return kernel


def nearest_row(ends: list[str], features: list[str], kinds: list[pa.DataType]) -> Callable:
    """A kernel that finds the far segments (x1, y1, x2, y2 in ``ends``) nearest to each place: squared distance and features, a row for each that ties."""

    def kernel(xs: np.ndarray, ys: np.ndarray, tables: list[pa.Table]):
        if not tables:
            return np.zeros(0, np.int64), [pa.array([], pa.float64()), *[pa.array([], k) for k in kinds]]
        far = pa.concat_tables(tables)
        x1, y1, x2, y2 = (far.column(c).to_numpy() for c in ends)
        tree = _Tree([t.num_rows for t in tables], np.minimum(x1, x2), np.maximum(x1, x2), np.minimum(y1, y2), np.maximum(y1, y2))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for s in range(0, len(xs), NEAR_LEAF):
            px, py = xs[s : s + NEAR_LEAF], ys[s : s + NEAR_LEAF]
            box = px.min(), px.max(), py.min(), py.max()

            def reach(spots):
                sx, sy = x1[spots], y1[spots]
                dx, dy = np.maximum(np.abs(sx - box[0]), np.abs(box[1] - sx)), np.maximum(np.abs(sy - box[2]), np.abs(box[3] - sy))
                return (dx * dx + dy * dy).min() * (1 + SLACK)

            bound = reach(tree.block_at)
            some = _gap2(tree.blocks, *box) <= bound
            leaves = _spans(tree.leaf_of_block[some], tree.leaves[some])
            if not len(leaves):
                continue
            bound = min(bound, reach(tree.leaf_at[leaves]))
            leaves = leaves[_gap2(_at(tree.boxes, leaves), *box) <= bound]
            rows = _spans(tree.leaf_at[leaves], tree.rows[leaves])
            best = np.full(len(px), np.inf)
            ties = []
            for i in range(0, len(rows), CHUNK // NEAR_LEAF):
                part = rows[i : i + CHUNK // NEAR_LEAF]
                d2 = _segment_distance2(px[:, None], py[:, None], x1[part], y1[part], x2[part], y2[part])
                best = np.minimum(best, d2.min(axis=1))
                who, which = np.nonzero(d2 == best[:, None])
                ties.append((who, part[which], d2[who, which]))
            for who, which, d2 in ties:
                last = d2 == best[who]
                found.append((s + who[last], which[last], d2[last]))
        at, which, d2 = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
        columns = [pa.compute.take(far.column(c), pa.array(which.astype(np.int64))) for c in features]
        return at.astype(np.int64), [pa.array(d2.astype(np.float64)), *columns]

    return kernel


def _segment_distance2(px, py, x1, y1, x2, y2):
    """``geometry.point_segment_distance2`` on arrays, step by step the same."""
    dx, dy = x2 - x1, y2 - y1
    length2 = dx * dx + dy * dy
    flat = length2 == 0
    along = np.where(flat, 0.0, ((px - x1) * dx + (py - y1) * dy) / np.where(flat, 1.0, length2))
    t = np.minimum(np.maximum(along, 0.0), 1.0)
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return ex * ex + ey * ey
