"""Vector best-fit packing of documents into training sequences.

Every piece has a size in three dimensions: tokens, one document, attention cost (tokens squared). A sequence has a
capacity in each. Pieces are taken from large to small; among the open sequences that have room in every dimension one
is chosen by the largest weighted dot product of the piece and the residual capacities, or by the smallest weighted
norm of what would be left (the default: with one tight dimension this is best fit).

Pieces are dealt to shards of about ``SHARD`` pieces, whatever the size of the corpus; a shard loses at most a few
part-filled sequences, and these are packed once more over fewer shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm.common import chunks, stored
from plotwise.llm.tokens import ENCODE_BYTES, encoder

#: Pieces packed together in one task.
SHARD = 16_384


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence and their weights; None is no limit."""

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "norm"  # or "dot"

    def capacities(self) -> np.ndarray:
        # pieces are never empty, so these bounds can't bind where no limit is given
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], np.float64)


def pieces(docs: DataFrame, vocabulary: str, end_id: int, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row, piece, start, length and ids_crc32 of each piece of at most ``limit`` ids; the first piece takes the remainder."""
    def run(batches):
        own, row = encoder(vocabulary), TaskContext.get().partitionId() << 33
        for batch in chunks(batches, "text", ENCODE_BYTES):
            ids, bounds = own.encode(batch.column("text"))
            ids = np.insert(ids, bounds[1:], end_id).astype("<u4")
            bounds = bounds + np.arange(len(bounds))
            totals = np.diff(bounds)
            counts = (totals + limit - 1) // limit
            nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            head = totals - (counts - 1) * limit
            starts = np.where(nth == 0, 0, np.repeat(head, counts) + (nth - 1) * limit)
            lengths = np.where(nth == 0, np.repeat(head, counts), limit)
            first = np.repeat(bounds[:-1], counts) + starts
            raw = memoryview(ids.tobytes())
            crcs = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), lengths.tolist())]
            take = np.repeat(np.arange(batch.num_rows), counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(take)), pa.array(row + take), pa.array(nth.astype(np.int32)), pa.array(starts), pa.array(lengths), pa.array(crcs, pa.int64())],
                ["doc_id", "row", "piece", "start", "length", "ids_crc32"],
            )
            row += batch.num_rows

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, row long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """The sequence of each piece and its offset there; pieces come in any order."""
    capacity = limits.capacities()
    scale = np.array(limits.weights) / capacity
    order = np.argsort(-lengths, kind="stable")
    n = len(lengths)
    sequence, offset = np.empty(n, np.int64), np.empty(n, np.int64)
    smallest = lengths.min() if n else 0
    # open sequences: residual capacities in rows, and the number of each
    residual, names, used = np.empty((64, 3)), np.empty(64, np.int64), 0
    made = 0
    for i in order.tolist():
        size = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])
        open_now = residual[:used]
        fits = np.flatnonzero((open_now >= size).all(axis=1))
        if len(fits):
            left = open_now[fits]
            if limits.rule == "dot":
                score = -(left * scale) @ (size * scale)
            else:
                score = (((left - size) * scale) ** 2).sum(axis=1)
            at = fits[int(np.argmin(score))]
        else:
            if used == len(residual):
                residual, names = np.concatenate([residual, np.empty_like(residual)]), np.concatenate([names, np.empty_like(names)])
            at, made, used = used, made + 1, used + 1
            residual[at], names[at] = capacity, made - 1
        sequence[i], offset[i] = names[at], limits.tokens - residual[at, 0]
        residual[at] -= size
        if residual[at, 0] < smallest or residual[at, 1] < 1:  # closed: nothing fits any more
            used -= 1
            residual[at], names[at] = residual[used], names[used]
    return sequence, offset


def _sharded(rows: DataFrame, shards: int, limits: Limits, salt: int, shift: int) -> DataFrame:
    """Rows packed within shards; sequence numbers are the shard's number behind ``shift`` and a running number."""
    def run(batches: Iterator[pa.RecordBatch]):
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks().sort_by([("row", "ascending"), ("piece", "ascending")])
        base = ((shift << 20) + TaskContext.get().partitionId()) << 24
        lengths = table.column("length").to_numpy()
        # one that is full by itself needs no search; the others fill up sequences together
        sequence, offset = np.arange(len(lengths)), np.zeros(len(lengths), np.int64)
        part = np.flatnonzero(lengths < limits.tokens)
        for at in range(0, len(part), 2 * SHARD):
            some = part[at : at + 2 * SHARD]
            sequence[some], offset[some] = best_fit(lengths[some], limits)
            sequence[some] += len(lengths) + at
        table = table.append_column("sequence_id", pa.array(base + sequence)).append_column("offset", pa.array(offset))
        yield from table.to_batches(max_chunksize=50_000)

    schema = "doc_id long, row long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return rows.repartition(shards, F.xxhash64("row", "piece", F.lit(salt))).mapInArrow(run, schema)


def pack(docs: DataFrame, vocabulary: str, end_id: int = 0, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents in sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset, a row for each piece.

    Null and empty text is one piece, the end id alone. Only documents longer than a sequence are cut. Repeated rows
    are packed as often as they stand; null ids stay null. An empty table gives no row. Only the three needed columns
    of the input are read, whatever others are called. Token ids never leave the task that makes them.
    """
    if limits.attention is not None and limits.attention < limits.tokens**2:
        raise ValueError("a full piece must fit a sequence: attention is at least tokens squared")
    made = stored(pieces(docs, vocabulary, end_id, limits.tokens, id_col, text_col), "pieces")
    total = made.count()
    first = stored(_sharded(made, max(1, -(-total // SHARD)), limits, 0, 0), "packed")
    filled = first.groupBy("sequence_id").agg(F.sum("length").alias("filled"))
    loose = filled.where(F.col("filled") < int(limits.tokens * 0.97)).select("sequence_id")
    # part-filled sequences of all shards meet again in fewer shards
    again = first.join(loose, "sequence_id", "left_semi").drop("sequence_id", "offset")
    left = again.count()
    second = _sharded(again, max(1, -(-left // SHARD)), limits, 1, 1)
    return first.join(loose, "sequence_id", "left_anti").unionByName(second).drop("row")
