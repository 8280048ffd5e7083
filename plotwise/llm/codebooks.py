"""Vector code compression: product codes whose codebooks are trained over metric trees of the anchors hierarchy.

Vectors become integers and are cut into equal parts; each part position has a codebook, refined by rounds of nearest
assignment and floored means. Every block of ``BLOCK`` vectors has one metric tree for each part position, built once
and stored. The tree is made from the middle out: about sqrt(n) anchors take each other's points, only those that the
triangle inequality can't rule out being measured; anchor balls are merged upwards, always the two that fit the smallest
ball, and built downwards from their own points in the same way. Each ball caches its centre, radius, count and sum.

A round walks the trees from the root with the list of entries that may still be nearest to some point of the ball. A
child inherits its parent's list and shortens it by its own bound; a ball whose list is down to one entry is wholly owned
and adds its cached sum and count without a look at its points. Only balls at the bottom compare points, exactly in
integers. So rounds read stored blocks, and send one sum for each entry and task to Spark's aggregate.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotwise.llm.common import stored

#: Vectors of a block (one stored row), points of a ball at the bottom.
BLOCK = 2048
LEAF = 24
#: Components are integers of ``SCALE`` times the value; beyond ``LIMIT`` they count as it, so that sums of squares fit a long.
SCALE = 1024
LIMIT = 1 << 26


@dataclass
class Tree:
    """Balls in an order where children come after their parent; ball b holds points[first[b] : end[b]]."""

    order: np.ndarray  # place of each point in the block
    points: np.ndarray
    first: np.ndarray
    end: np.ndarray
    left: np.ndarray  # -1 at the bottom
    right: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    sums: np.ndarray


def anchors(points: np.ndarray, wanted: int) -> np.ndarray:
    """The anchor that owns each point. Fewer anchors than wanted if all points lie on anchors."""
    owner = np.zeros(len(points), np.int64)
    places = [0]
    away = np.sqrt(((points - points[0]) ** 2).sum(1))
    while len(places) < wanted:
        new = int(away.argmax())
        if away[new] == 0:
            break
        between = np.sqrt(((points[places] - points[new]) ** 2).sum(1))
        # a point nearer to its anchor than half the way between the anchors stays; those on the line are measured
        maybe = np.flatnonzero(away * 2 >= between[owner] * (1 - 1e-12))
        measured = np.sqrt(((points[maybe] - points[new]) ** 2).sum(1))
        taken = measured < away[maybe]
        owner[maybe[taken]], away[maybe[taken]] = len(places), measured[taken]
        places.append(new)
    return owner


def _merges(centres: np.ndarray, radii: np.ndarray, counts: np.ndarray) -> list[tuple[int, int]]:
    """Which balls to merge, in order; the n-th merge makes ball len(centres) + n."""
    k = len(centres)
    centres, radii, counts = list(centres), list(radii), list(counts)
    size = 2 * k - 1
    cost = np.full((size, size), np.inf)
    at = np.stack(centres)
    apart = np.sqrt(((at[:, None] - at[None]) ** 2).sum(2))
    r = np.array(radii)
    ball = np.maximum((apart + r[:, None] + r[None]) / 2, np.maximum(r[:, None], r[None]))
    cost[:k, :k] = np.where(np.eye(k, dtype=bool), np.inf, ball)
    made, alive = [], np.zeros(size, bool)
    alive[:k] = True
    for new in range(k, size):
        a, b = divmod(int(cost[:new, :new].argmin()), new)
        made.append((a, b))
        n = counts[a] + counts[b]
        centre = (centres[a] * counts[a] + centres[b] * counts[b]) / n
        reach = max(float(np.sqrt(((centre - centres[i]) ** 2).sum())) + radii[i] for i in (a, b))
        centres.append(centre), radii.append(reach), counts.append(n)
        cost[[a, b], :] = cost[:, [a, b]] = np.inf
        alive[[a, b]] = False
        others = np.flatnonzero(alive)
        if len(others):
            way = np.sqrt(((np.stack([centres[i] for i in others]) - centre) ** 2).sum(1))
            rest = np.array([radii[i] for i in others])
            cost[new, others] = cost[others, new] = np.maximum((way + rest + reach) / 2, np.maximum(rest, reach))
        alive[new] = True
    return made


def build(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """The metric tree of a block's points (integers, one row each)."""
    exact = points.astype(np.int64)
    plain = exact.astype(np.float64)
    balls: list[list] = []  # left, right, places

    def grow(places: np.ndarray) -> int:
        """The ball of these points: its number."""
        if len(places) > leaf:
            owner = anchors(plain[places], max(2, isqrt(len(places))))
            groups = [g for g in (places[owner == a] for a in range(int(owner.max()) + 1)) if len(g)]
            if len(groups) > 1:
                centres = np.stack([plain[g].mean(0) for g in groups])
                radii = np.array([np.sqrt(((plain[g] - c) ** 2).sum(1).max()) for g, c in zip(groups, centres)])
                numbers = [grow(g) for g in groups]
                for a, b in _merges(centres, radii, np.array([len(g) for g in groups])):
                    balls.append([numbers[a], numbers[b], np.concatenate([balls[numbers[a]][2], balls[numbers[b]][2]])])
                    numbers.append(len(balls) - 1)
                return numbers[-1]
        balls.append([-1, -1, places])
        return len(balls) - 1

    top = grow(np.arange(len(exact)))
    order = balls[top][2]
    numbered, walk = [], [(top, 0)]  # from the top, left before right, so that a ball's points lie side by side
    number = {}
    while walk:
        ball, first = walk.pop()
        number[ball] = len(numbered)
        numbered.append((ball, first))
        left, right, places = balls[ball]
        if left >= 0:
            walk += [(left, first), (right, first + len(balls[left][2]))]
    first = np.array([f for _, f in numbered], np.int32)
    end = first + np.array([len(balls[b][2]) for b, _ in numbered], np.int32)
    child = np.array([[number[c] if c >= 0 else -1 for c in balls[b][:2]] for b, _ in numbered], np.int32)
    ordered = exact[order]
    sums = np.stack([ordered[a:b].sum(0) for a, b in zip(first, end)])
    centre = sums / (end - first)[:, None]
    radius = np.array([np.sqrt(((ordered[a:b] - c) ** 2).sum(1).max()) for a, b, c in zip(first, end, centre)])
    small = np.int16 if len(ordered) and np.abs(ordered).max() < 1 << 15 else np.int32
    return Tree(order.astype(np.int32), ordered.astype(small), first, end, child[:, 0], child[:, 1], centre, radius, sums)


def walk(tree: Tree, entries: np.ndarray) -> tuple[list[tuple[int, int]], list[tuple[int, np.ndarray]]]:
    """(ball, entry) for balls that one entry owns wholly, and (ball, entry of each point) for compared ones; ties go to the lower index."""
    plain = entries.astype(np.float64)
    _, distinct = np.unique(entries, axis=0, return_index=True)
    owned, compared = [], []
    ahead = [(0, np.sort(distinct))]  # of equal entries only the first is ever nearest
    while ahead:
        ball, list_ = ahead.pop()
        if len(list_) > 1:
            way = np.sqrt(((plain[list_] - tree.centre[ball]) ** 2).sum(1))
            reach = way.min() + 2 * tree.radius[ball]
            list_ = list_[way <= reach + 1e-9 * (reach + 1)]
        if len(list_) == 1:
            owned.append((ball, int(list_[0])))
        elif tree.left[ball] < 0:
            points = tree.points[tree.first[ball] : tree.end[ball]]
            compared.append((ball, list_[distances(points, entries[list_]).argmin(1)]))
        else:
            ahead += [(int(tree.left[ball]), list_), (int(tree.right[ball]), list_)]
    return owned, compared


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances less the points' own squares, exact: in doubles while all values are below 2^53, else in longs."""
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)), 1)
    kind = np.float64 if 4 * most * most * points.shape[1] < 1 << 53 else np.int64
    p, e = points.astype(kind), entries.astype(kind)
    return (e * e).sum(1)[None] - 2 * (p @ e.T)


class Sums:
    """Count and sum of the points of every entry, for one part position."""

    def __init__(self, entries: int, width: int):
        self.n, self.sums = np.zeros(entries, np.int64), np.zeros((entries, width), np.int64)

    def add(self, tree: Tree, entries: np.ndarray) -> None:
        owned, compared = walk(tree, entries)
        for ball, entry in owned:
            self.n[entry] += tree.end[ball] - tree.first[ball]
            self.sums[entry] += tree.sums[ball]
        for ball, chosen in compared:
            np.add.at(self.n, chosen, 1)
            np.add.at(self.sums, chosen, tree.points[tree.first[ball] : tree.end[ball]].astype(np.int64))


def chosen(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each point of the block, in the block's order: nearest entry and squared distance."""
    nearest = np.zeros(len(tree.order), np.int64)
    owned, compared = walk(tree, entries)
    for ball, entry in owned + compared:
        nearest[tree.first[ball] : tree.end[ball]] = entry
    away = ((tree.points.astype(np.int64) - entries[nearest]) ** 2).sum(1)
    back = np.argsort(tree.order)
    return nearest[back], away[back]


def kept_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label, v (array of int): rows whose vector is not null, not empty and all finite."""
    x = F.col(vector_col).cast("array<double>")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    integer = lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(float(-LIMIT))), F.lit(float(LIMIT)))).cast("int")
    return rows.where(F.coalesce(whole, F.lit(False)) & (F.size(vector_col) > 0)).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.transform(x, integer).alias("v")
    )


def _blocks(kept: DataFrame, parts: int, block: int) -> DataFrame:
    """One row per block: ids, labels, and the trees of all part positions."""
    label = kept.schema["label"].dataType
    schema = T.StructType([T.StructField("vec_id", T.ArrayType(T.LongType())), T.StructField("label", T.ArrayType(label)), T.StructField("trees", T.BinaryType())])

    def build_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in [*_slices(batches, block), None]:
            if batch is not None:
                held.append(batch)
                n += batch.num_rows
            if held and (batch is None or n >= block):
                rows = pa.Table.from_batches(held).combine_chunks()
                for start in range(0, n, block):
                    some = rows.slice(start, block)
                    if batch is not None and some.num_rows < block:
                        break
                    yield _block(some, parts)
                left = rows.slice(n - n % block) if batch is not None else rows.slice(n)
                held, n = left.to_batches(), left.num_rows

    def _block(rows: pa.Table, parts: int) -> pa.RecordBatch:
        vectors = rows.column("v").combine_chunks()
        points = vectors.flatten().to_numpy().reshape(rows.num_rows, parts, -1)
        trees = pickle.dumps([build(points[:, p]) for p in range(parts)], protocol=5)
        lists = [pa.ListArray.from_arrays([0, rows.num_rows], rows.column(c).combine_chunks()) for c in ("vec_id", "label")]
        return pa.RecordBatch.from_arrays([*lists, pa.array([trees], pa.binary())], names=["vec_id", "label", "trees"])

    return kept.mapInArrow(build_blocks, schema)


def _slices(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, block):
            yield batch.slice(start, block)


def _round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: floored means, unused entries as they were."""
    parts, entries, width = books.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [Sums(entries, width) for _ in range(parts)]
        for batch in batches:
            for trees in batch.column("trees"):
                for p, tree in enumerate(pickle.loads(trees.as_buffer())):
                    totals[p].add(tree, books[p])
        for p, total in enumerate(totals):
            used = np.flatnonzero(total.n)
            columns = [pa.array(np.full(len(used), p)), pa.array(used), pa.array(total.n[used]), *[pa.array(total.sums[used, i]) for i in range(width)]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["part", "entry", "n", *[f"s{i}" for i in range(width)]]
    partial = blocks.select("trees").mapInArrow(add_up, ", ".join(f"{n} long" for n in names))
    totals = partial.groupBy("part", "entry").agg(*[F.sum(n).alias(n) for n in names[2:]])
    books = books.copy()
    for row in totals.collect():  # as many rows as the codebooks have entries, at most
        books[row.part, row.entry] = [row[f"s{i}"] // row.n for i in range(width)]
    return books


def train(spark: SparkSession, rows: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block: int = BLOCK):
    """Stored blocks and codebooks [part, entry, component]; None and None for a table without usable rows.

    Codebooks start as the parts of the ``entries`` smallest kept ids, ascending (null ids last, equal ids by their
    vectors). The length of the first of these is the vectors' length; rows of another length are dropped.
    """
    kept = kept_vectors(rows, id_col, vector_col, label_col)
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    first = kept.orderBy(*order).select("v").first()
    if first is None:
        return None, None
    if len(first.v) % parts:
        raise ValueError(f"vectors of {len(first.v)} components can't be cut into {parts} equal parts")
    kept = kept.where(F.size("v") == len(first.v))
    start = np.array([r.v for r in kept.orderBy(*order).select("v").limit(entries).collect()], np.int64)
    books = np.ascontiguousarray(start.reshape(len(start), parts, -1).transpose(1, 0, 2))
    blocks = stored(_blocks(kept, parts, block), "vector-blocks")
    for _ in range(rounds):
        books = _round(blocks, books)
    return blocks, books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal integers, by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (index of each part's nearest entry, two hex digits each, four beyond 256 entries), error."""
    label = blocks.schema["label"].dataType.elementType
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", label), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    kind, digits = (np.uint8, 2) if books.shape[1] <= 256 else (np.dtype(">u2"), 4)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, trees in enumerate(batch.column("trees")):
                found = [chosen(tree, books[p]) for p, tree in enumerate(pickle.loads(trees.as_buffer()))]
                text = np.stack([f[0] for f in found], 1).astype(kind).tobytes().hex()
                step = digits * len(found)
                codes = pa.array([text[a : a + step] for a in range(0, len(text), step)], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("vec_id")[i].values, batch.column("label")[i].values, codes, pa.array(sum(f[1] for f in found))], names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(code, schema)


def compress(rows: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label, code, error, label_error (error summed over equal labels, nulls together), codebooks_sha256.

    Rows are dropped whose vector is null, empty, holds null, NaN or an infinity, or has another length than that of the
    smallest kept id; no other rows are. Components beyond ``LIMIT`` / ``SCALE`` count as that. Repeated rows and ids
    are coded each. With fewer than ``entries`` vectors the codebooks have one entry for each. An empty table gives no
    rows. Vectors whose length is no multiple of ``parts`` raise ValueError. Only the named columns are read.
    """
    spark = rows.sparkSession
    blocks, books = train(spark, rows, parts, entries, rounds, id_col, vector_col, label_col)
    if blocks is None:
        empty = T.StructType([T.StructField("vec_id", T.LongType()), rows.schema[label_col], T.StructField("code", T.StringType()), T.StructField("error", T.LongType()), T.StructField("label_error", T.LongType()), T.StructField("codebooks_sha256", T.StringType())])
        return spark.createDataFrame([], empty).withColumnRenamed(label_col, "label")
    coded = stored(encode(blocks, books), "vector-codes")
    totals = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of_label"))).select(*coded.columns, "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
