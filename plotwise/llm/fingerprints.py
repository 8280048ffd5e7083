"""Document fingerprints: a homomorphic hash of the multiset of a text's paragraphs.

A paragraph is a line that isn't empty. Its vector has two parts, and a text's state is the sum of its paragraphs'
vectors, lane by lane, modulo powers of two:

* ``EQUAL`` lanes modulo 2^32, expanded from the paragraph's BLAKE2b digest: states agree if and only if, but for
  hash collisions, the multisets of paragraphs agree, in whatever order.
* ``ALIKE`` lanes modulo 2^16: each run of three words of the paragraph (all of a shorter one) adds 1 or -1 to one
  lane by its hash. The cosine of two such vectors estimates the share of common runs.

Sums are linear: ``add`` and ``remove`` bring in or take out paragraphs (or whole texts) without reading the rest.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotwise.llm.common import byte_table, chunks, mix, span_hashes, stored, words_of

EQUAL, ALIKE, RUN = 64, 512, 3
_WORD = byte_table(lambda b: b not in b"\t\n\x0b\x0c\r ")


class States:
    """States of some texts: ``equal`` (n, EQUAL) uint32 and ``alike`` (n, ALIKE) int16."""

    def __init__(self, equal: np.ndarray, alike: np.ndarray):
        self.equal, self.alike = equal, alike

    def add(self, other: States) -> States:
        return States(self.equal + other.equal, self.alike + other.alike)

    def remove(self, other: States) -> States:
        return States(self.equal - other.equal, self.alike - other.alike)

    def take(self, rows) -> States:
        return States(self.equal[rows], self.alike[rows])

    def bytes(self) -> list[bytes]:
        return [a.tobytes() + b.tobytes() for a, b in zip(self.equal.astype("<u4"), self.alike.astype("<i2"))]

    def hex(self) -> list[str]:
        return [hashlib.blake2b(x, digest_size=32).hexdigest() for x in self.bytes()]

    @staticmethod
    def of_bytes(rows: list[bytes]) -> States:
        cut = 4 * EQUAL
        equal = np.frombuffer(b"".join(r[:cut] for r in rows), "<u4").reshape(-1, EQUAL)
        return States(equal.copy(), np.frombuffer(b"".join(r[cut:] for r in rows), "<i2").reshape(-1, ALIKE).copy())


def states(texts: list[bytes]) -> States:
    """States of UTF-8 texts; a text without a paragraph has all lanes zero."""
    n = len(texts)
    lines = [[p for p in t.split(b"\n") if p] for t in texts]
    counts = np.array([len(x) for x in lines], np.int64)
    flat = [p for x in lines for p in x]
    equal, alike = np.zeros((n, EQUAL), np.uint32), np.zeros((n, ALIKE), np.int16)
    if not flat:
        return States(equal, alike)
    seeds = np.frombuffer(b"".join([hashlib.blake2b(p, digest_size=64).digest() for p in flat]), "<u8").reshape(-1, 8)
    some = np.flatnonzero(counts)
    first = (np.cumsum(counts) - counts)[some]
    for k in range(EQUAL // 16):
        lanes = mix(seeds + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)).view(np.uint32)
        equal[some, 16 * k : 16 * (k + 1)] = np.add.reduceat(lanes, first, axis=0, dtype=np.uint32)
    raw = np.frombuffer(b"".join(flat), np.uint8)
    bounds = np.append(0, np.cumsum([len(p) for p in flat]))
    starts, ends, at = words_of(raw, bounds, _WORD)
    words = np.diff(at)
    runs = np.where(words >= RUN, words - RUN + 1, np.minimum(words, 1))
    owner = np.repeat(np.repeat(np.arange(n), counts), runs)
    head = np.repeat(at[:-1], runs) + np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    tail = np.minimum(head + RUN, np.repeat(at[1:], runs)) - 1
    h = span_hashes(raw, starts[head], ends[tail])
    lane = owner * ALIKE + (h & np.uint64(ALIKE - 1)).astype(np.int64)
    sign = 1.0 - 2.0 * ((h >> np.uint64(32)) & np.uint64(1)).astype(np.float64)
    alike[:] = np.bincount(lane, sign, n * ALIKE).astype(np.int64).reshape(n, ALIKE).astype(np.int16)
    return States(equal, alike)


def likeness(a: States, b: States) -> np.ndarray:
    """0 to 1 for each pair of rows: 1 for equal states, else the cosine of the ``alike`` lanes, not below 0; 0 if one is empty."""
    x, y = a.alike.astype(np.float64), b.alike.astype(np.float64)
    norms = np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    cosine = (x * y).sum(axis=1) / np.where(norms > 0, norms, 1)
    same = (a.equal == b.equal).all(axis=1) & (a.alike == b.alike).all(axis=1)
    return np.where(same, 1.0, np.clip(cosine, 0.0, 1.0))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, state and fingerprint (hex digest of the state) of every whole text; null is empty. Repeated rows give repeated rows, an empty table none; no other column is read."""
    def run(batches):
        for batch in chunks(batches, "text"):
            got = states([(t or "").encode() for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got.bytes(), pa.binary()), pa.array(got.hex())], ["doc_id", "state", "fingerprint"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, state binary, fingerprint string")


# ---- each text against an edit of it and against the next document ------------------------------------------------

_PAIR = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(ids: list, texts: list[str], own: States, nexts: list[str], following: States) -> pa.RecordBatch:
    halves = [len(t) // 2 for t in texts]
    edited = [(t[: len(t) - k] + s[:k]).encode() for t, s, k in zip(texts, nexts, halves)]
    after = states(edited)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
            pa.array(own.hex(), pa.string()), pa.array(after.hex(), pa.string()), pa.array(likeness(own, after)), pa.array(likeness(own, following)),
        ],
        _PAIR_NAMES,
    )


_PAIR_NAMES = [x.split()[0] for x in _PAIR.split(", ")]


def edited_and_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text against its edit (its last half replaced by the start of the next document) and against that document.

    Documents stand in ascending doc_id (null first, ties by the text's hash) over range partitions; the last document
    of a partition is met with the first of the next one in a second step over one row for each partition, and the
    last of all with the first of all. A lone document follows itself. Null text is empty. No other column is read.
    """
    def run(batches):
        part = TaskContext.get().partitionId()
        held: tuple | None = None
        for batch in chunks(batches, "text"):
            ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            got = states([t.encode() for t in texts])
            if held is None:
                yield _edge(part, 0, ids[0], texts[0])
            else:
                ids, texts = [held[0], *ids], [held[1], *texts]
                got = States(np.concatenate([held[2].equal, got.equal]), np.concatenate([held[2].alike, got.alike]))
            if len(ids) > 1:
                done = _compared(ids[:-1], texts[:-1], got.take(slice(0, -1)), texts[1:], got.take(slice(1, None)))
                yield _plain(done)
            held = (ids[-1], texts[-1], got.take(slice(-1, None)))
        if held is not None:
            yield _edge(part, 1, held[0], held[1])

    spark = docs.sparkSession
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text")
    ordered = picked.repartitionByRange(parts, F.col("doc_id"), tie).sortWithinPartitions("doc_id", tie)
    rows = stored(ordered.mapInArrow(run, f"part int, edge int, edge_text string, {_PAIR}"), "fingerprints")
    # one first and one last document for each partition
    edges = rows.where("edge IS NOT NULL").select("part", "edge", "doc_id", "edge_text")
    firsts = edges.where("edge = 0").select(F.col("part").alias("next_part"), F.col("edge_text").alias("next_text"))
    order = Window.orderBy("part")
    used = rows.where("edge = 0").select("part")
    ring = used.select("part", F.coalesce(F.lead("part").over(order), F.min("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next_part"))
    pairs = edges.where("edge = 1").join(ring, "part").join(firsts, "next_part").select("doc_id", "edge_text", "next_text")

    def close(batches):
        for batch in batches:
            if batch.num_rows:
                ids, texts, nexts = (batch.column(c).to_pylist() for c in ("doc_id", "edge_text", "next_text"))
                yield _compared(ids, texts, states([t.encode() for t in texts]), nexts, states([t.encode() for t in nexts]))

    return rows.where("edge IS NULL").select(*_PAIR_NAMES).unionByName(pairs.mapInArrow(close, _PAIR))


_ROW = pa.schema(
    [("part", pa.int32()), ("edge", pa.int32()), ("edge_text", pa.string()), ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
     ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _edge(part: int, edge: int, doc_id, text: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"part": part, "edge": edge, "doc_id": doc_id, "edge_text": text}], schema=_ROW)


def _plain(done: pa.RecordBatch) -> pa.RecordBatch:
    n = done.num_rows
    empty = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())]
    return pa.RecordBatch.from_arrays([*empty, *done.columns], schema=_ROW)
