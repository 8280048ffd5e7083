"""Token ids in files: length-limited canonical Huffman codes from global counts, in independent blocks.

Layout below one folder, all written by Spark (so a lost executor or a repeated task leaves no half file):

* ``codebook``: token id and code length; canonical codes follow from them.
* ``blocks``: ascending doc_id over the part files and inside each. A block holds whole pieces of documents, each at a
  byte start, with a table of pieces (doc_id, row, first id, count, ids of the whole document) and bit offsets of every
  ``STEP``-th id of a piece. It is decoded without any other block, all its checkpoints side by side.
* ``manifest``: ids in each part, so that readers know where a part begins.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plotwise.llm.common import chunks, ragged, shared_path, stored
from plotwise.llm.tokens import ENCODE_BYTES, encoder

#: Ids of a block and of a document's longest piece; ids between two checkpoints; bits of the longest code.
BLOCK = 1 << 16
STEP = 256
MAX_BITS = 16


# ---- codes -------------------------------------------------------------------------------------------------------

def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` for positive counts, by package-merge; one symbol gets one bit."""
    n = len(counts)
    if n == 0:
        return np.zeros(0, np.int64)
    if n == 1:
        return np.ones(1, np.int64)
    max_bits = max(max_bits, int(n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    levels, packages = [], np.zeros(0)
    for _ in range(max_bits):
        weights = np.concatenate([leaves, packages])
        by_weight = np.argsort(weights, kind="stable")
        levels.append(by_weight < n)
        weights = weights[by_weight]
        packages = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        used = int(is_leaf[:take].sum())
        lengths[:used] += 1
        take = 2 * (take - used)
    out = np.zeros(n, np.int64)
    out[order] = lengths
    return out


class Codebook:
    """Canonical codes: shorter codes first, equal lengths by ascending id."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        self.bits = int(self.lengths.max()) if len(ids) else 1
        spans = np.int64(1) << (self.bits - self.lengths)
        first = np.cumsum(spans) - spans
        size = int(self.ids.max()) + 1 if len(ids) else 1
        self.code, self.size = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code[self.ids] = (first >> (self.bits - self.lengths)).astype(np.uint64)
        self.size[self.ids] = self.lengths
        # any bits.. window -> symbol and its length
        self.symbol_at = np.repeat(self.ids, spans).astype(np.uint32)
        self.length_at = np.repeat(self.lengths, spans)
        short = (1 << self.bits) - len(self.symbol_at)
        self.symbol_at = np.append(self.symbol_at, np.zeros(short, np.uint32))
        self.length_at = np.append(self.length_at, np.ones(short, np.int64))

    def encode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pieces (bounds in ``ids``) as bytes, each from a byte start: bytes, byte bounds, checkpoints (bits from the piece's start), their bounds."""
        sizes = self.size[ids]
        ends = np.append(0, np.cumsum(sizes))
        piece_bits = ends[bounds[1:]] - ends[bounds[:-1]]
        byte_bounds = np.append(0, np.cumsum((piece_bits + 7) >> 3))
        counts = np.diff(bounds)
        shift = byte_bounds[:-1] * 8 - ends[bounds[:-1]]
        at = ends[:-1] + np.repeat(shift, counts)
        words = np.zeros(int(byte_bounds[-1]) // 4 + 3)
        place = at >> 5
        wide = self.code[ids] << (64 - sizes - (at & 31)).astype(np.uint64)
        n = len(words)
        # fields never overlap, so sums are unions; each sum stays below 2^32 and is exact in a double
        words += np.bincount(place, (wide >> np.uint64(32)).astype(np.float64), n)
        words += np.bincount(place + 1, (wide & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
        data = words.astype(">u4").view(np.uint8)[: int(byte_bounds[-1])]
        marks = (counts + STEP - 1) // STEP
        mark_bounds = np.append(0, np.cumsum(marks))
        nth = np.arange(int(mark_bounds[-1])) - np.repeat(mark_bounds[:-1], marks)
        first = np.repeat(bounds[:-1], marks) + nth * STEP
        return data, byte_bounds, at[first] - np.repeat(byte_bounds[:-1] * 8, marks), mark_bounds

    def decode(self, data: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids from each bit offset (``starts``, ``counts`` of them), side by side through the table; in a row."""
        padded = np.zeros(len(data) + 4, np.uint32)
        padded[: len(data)] = data
        windows = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
        out_at = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.uint32)
        order = np.argsort(-counts, kind="stable")
        at, to, left = starts[order].copy(), out_at[order].copy(), counts[order]
        drop = 32 - self.bits
        for step in range(int(left[0]) if len(left) else 0):
            active = int(np.searchsorted(-left, -step, side="left"))
            here = at[:active]
            window = (windows[here >> 3] << (here & 7).astype(np.uint32)) >> np.uint32(drop)
            out[to[:active] + step] = self.symbol_at[window]
            at[:active] += self.length_at[window]
        return out


def _shifted(crc: int, n_bytes: int) -> int:
    """The share of a piece's crc32 in that of the whole, when ``n_bytes`` follow it: crc times x^(8 n) modulo the polynomial."""
    def times(a: int, b: int) -> int:
        product, bit = 0, 1 << 31
        while bit:
            if a & bit:
                product ^= b
            b = (b >> 1) ^ 0xEDB88320 if b & 1 else b >> 1
            bit >>= 1
        return product

    power, square, n = 1 << 31, 1 << 23, n_bytes  # 1 and x^8
    while n:
        if n & 1:
            power = times(square, power)
        square = times(square, square)
        n >>= 1
    return times(power, crc)


# ---- writing -----------------------------------------------------------------------------------------------------

def tokenize(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row (unique), n_tokens and ids (little-endian unsigned 32-bit) of every text, with the end id."""
    def run(batches):
        own, row = encoder(vocabulary), TaskContext.get().partitionId() << 33
        for batch in chunks(batches, "text", ENCODE_BYTES):
            ids, bounds = own.encode(batch.column("text"))
            ids = np.insert(ids, bounds[1:], end_id).astype("<u4")
            bounds = bounds + np.arange(len(bounds))
            n = batch.num_rows
            blob = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.arange(row, row + n)), pa.array(np.diff(bounds)), blob], ["doc_id", "row", "n_tokens", "ids"])
            row += n

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, row long, n_tokens long, ids binary")


def count_ids(tokens: DataFrame) -> DataFrame:
    """id and n over all documents; each task adds up its own first."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            raw = b"".join(batch.column("ids").drop_null().to_pylist())
            some = np.bincount(np.frombuffer(raw, "<u4")) if raw else total[:0]
            if len(some) > len(total):
                some, total = total, some.astype(np.int64)
            total[: len(some)] += some
        used = np.flatnonzero(total)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


_PIECES = "doc_id long, row long, piece long, total long, n long, payload binary, marks array<int>"
_BLOCKS = (
    "part int, block int, start long, n long, doc_ids array<long>, rows array<long>, froms array<long>, counts array<long>, totals array<long>, "
    "bytes array<int>, mark_counts array<int>, marks array<int>, payload binary"
)


def _pieces(tokens: DataFrame, book) -> DataFrame:
    def run(batches):
        codes = book.value
        for batch in chunks(batches, "ids", 4 << 20):
            blobs = batch.column("ids")
            width = np.diff(np.frombuffer(blobs.buffers()[1], np.int32)[blobs.offset : blobs.offset + len(blobs) + 1].astype(np.int64)) // 4
            ids = np.frombuffer(b"".join(blobs.to_pylist()), "<u4")
            starts = np.append(0, np.cumsum(width))
            pieces = np.maximum((width + BLOCK - 1) // BLOCK, 1)
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            bounds = np.append(np.repeat(starts[:-1], pieces) + nth * BLOCK, len(ids))
            data, byte_bounds, marks, mark_bounds = codes.encode(ids, bounds)
            take = pa.array(np.repeat(np.arange(batch.num_rows), pieces))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(take), batch.column("row").take(take), pa.array(nth), batch.column("n_tokens").take(take), pa.array(np.diff(bounds)),
                    pa.Array.from_buffers(pa.binary(), len(nth), [None, pa.py_buffer(byte_bounds.astype(np.int32)), pa.py_buffer(data.copy())]),
                    pa.ListArray.from_arrays(pa.array(mark_bounds.astype(np.int32)), pa.array(marks.astype(np.int32))),
                ],
                ["doc_id", "row", "piece", "total", "n", "payload", "marks"],
            )

    return tokens.mapInArrow(run, _PIECES)


def _blocks(pieces: DataFrame) -> DataFrame:
    """Pieces of a sorted partition joined to blocks of about ``BLOCK`` ids."""
    def run(batches):
        part, block, start = TaskContext.get().partitionId(), 0, 0
        held: list[dict] = []

        def emit():
            nonlocal block, start
            n = sum(p["n"] for p in held)
            row = {
                "part": part, "block": block, "start": start, "n": n, "doc_ids": [p["doc_id"] for p in held], "rows": [p["row"] for p in held],
                "froms": [p["piece"] * BLOCK for p in held], "counts": [p["n"] for p in held], "totals": [p["total"] for p in held],
                "bytes": [len(p["payload"]) for p in held], "mark_counts": [len(p["marks"]) for p in held],
                "marks": np.concatenate([p["marks"] for p in held]), "payload": b"".join(p["payload"] for p in held),
            }
            block, start = block + 1, start + n
            held.clear()
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK_SCHEMA)

        filled = 0
        for batch in batches:
            marks = batch.column("marks")
            flat, ends = marks.flatten().to_numpy(), np.asarray(marks.offsets)
            ends = ends - ends[0]
            for i, p in enumerate(batch.drop_columns(["marks"]).to_pylist()):
                if filled and filled + p["n"] > BLOCK:
                    yield emit()
                    filled = 0
                held.append(p | {"marks": flat[ends[i] : ends[i + 1]]})
                filled += p["n"]
        if held:
            yield emit()

    return pieces.mapInArrow(run, _BLOCKS)


def _schema(text: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in text.split(", "))])


_BLOCK_SCHEMA = _schema(_BLOCKS)


def write_tokens(docs: DataFrame, vocabulary: str, end_id: int, path: str | None = None, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the token ids of all documents in ascending doc_id order; gives the folder (a new shared one by default).

    Null text is empty (the end id alone). Rows that repeat a doc_id are kept, in any order among themselves; a null
    doc_id sorts first. Other columns are not read. An empty table gives an empty codebook and no block. The driver
    holds one count for each id of the vocabulary, never ids.
    """
    spark = docs.sparkSession
    path = path or shared_path(spark, "token-ids")
    tokens = stored(tokenize(docs, vocabulary, end_id, id_col, text_col), "tokens")
    counts = count_ids(tokens).toPandas().sort_values("id")
    ids, lengths = counts["id"].to_numpy(np.int64), code_lengths(counts["n"].to_numpy(), max_bits)
    table = pa.table({"id": pa.array(ids, pa.int64()), "length": pa.array(lengths, pa.int64())})
    spark.createDataFrame(table, schema="id long, length long").coalesce(1).write.parquet(f"{path}/codebook")
    book = spark.sparkContext.broadcast(Codebook(ids, lengths))  # bounded by the vocabulary
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = _pieces(tokens, book).repartitionByRange(parts, "doc_id", "row").sortWithinPartitions("doc_id", "row", "piece")
    _blocks(ordered).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    blocks.groupBy("part").agg(F.sum("n").alias("n")).coalesce(1).write.parquet(f"{path}/manifest")
    return path


# ---- reading -----------------------------------------------------------------------------------------------------

def _codebook(spark: SparkSession, path: str) -> Codebook:
    rows = spark.read.schema("id long, length long").parquet(f"{path}/codebook").toPandas()
    return Codebook(rows["id"].to_numpy(np.int64), rows["length"].to_numpy(np.int64))


def _decoded(spark: SparkSession, path: str, schema: str, build) -> DataFrame:
    book = spark.sparkContext.broadcast(_codebook(spark, path))

    def run(batches):
        codes = book.value
        for batch in chunks(batches, "payload", 1 << 20):
            lists = {c: batch.column(c).flatten().to_numpy() for c in ("doc_ids", "rows", "froms", "counts", "totals", "bytes", "mark_counts", "marks") if c != "doc_ids"}
            data = np.frombuffer(b"".join(batch.column("payload").to_pylist()), np.uint8)
            counts, marks = lists["counts"], lists["mark_counts"]
            piece_bits = (np.cumsum(lists["bytes"].astype(np.int64)) - lists["bytes"]) * 8
            starts = lists["marks"] + np.repeat(piece_bits, marks)
            lanes = np.full(len(starts), STEP, np.int64)
            last = np.cumsum(marks) - 1
            lanes[last[marks > 0]] = (counts - (marks - 1) * STEP)[marks > 0]
            ids = codes.decode(data, starts, lanes)
            in_block = np.diff(np.asarray(batch.column("counts").offsets))
            first = np.cumsum(counts) - counts
            block_first = first[np.cumsum(in_block) - in_block] if len(in_block) else first
            local = batch.column("start").to_numpy()
            position = first + np.repeat(local - block_first, in_block)
            yield build(batch, in_block, position, ids, np.append(0, np.cumsum(counts)), lists)

    return spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").mapInArrow(run, schema)


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """part and its first id's place among all ids; a row for each part file."""
    manifest = spark.read.schema("part int, n long").parquet(f"{path}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, row, from (first id's place in the document), start (among all ids) and ids, a row for each piece."""
    def build(batch, in_block, position, ids, bounds, lists):
        part = np.repeat(batch.column("part").to_numpy(), in_block)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_ids").flatten(), pa.array(lists["rows"]), pa.array(lists["froms"]), pa.array(part), pa.array(position), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int64)))],
            ["doc_id", "row", "from", "part", "position", "ids"],
        )

    rows = _decoded(spark, path, "doc_id long, row long, from long, part int, position long, ids array<long>", build)
    return rows.join(part_starts(spark, path), "part").select("doc_id", "row", "from", (F.col("part_start") + F.col("position")).alias("start"), "ids")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from its decoded ids; pieces' checksums are joined by exclusive or."""
    def build(batch, in_block, position, ids, bounds, lists):
        part = np.repeat(batch.column("part").to_numpy(), in_block)
        raw = memoryview(ids.astype("<u4").tobytes())
        after = (lists["totals"] - lists["froms"] - lists["counts"]) * 4
        crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        crcs = [_shifted(c, n) if n else c for c, n in zip(crcs, after.tolist())]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_ids").flatten(), pa.array(lists["rows"]), pa.array(part), pa.array(position), pa.array(lists["counts"]), pa.array(crcs, pa.int64())],
            ["doc_id", "row", "part", "position", "n", "crc"],
        )

    rows = _decoded(spark, path, "doc_id long, row long, part int, position long, n long, crc long", build)
    placed = rows.join(part_starts(spark, path), "part")
    return placed.groupBy("doc_id", "row").agg(
        F.min(F.col("part_start") + F.col("position")).alias("start"), F.sum("n").alias("n_tokens"), F.bit_xor("crc").alias("ids_crc32")
    ).drop("row")
