"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingles.

A benchmark item is a set of five-word shingles. It leaks into a document that holds a share of ``threshold`` or more
of the set, however long the document is. Of an item with n shingles at most n - ceil(threshold n) are missing from
such a document, so of any n - ceil(threshold n) + 1 of them one is there. Items are partitioned by size, and each
partition keeps the bottom of a MinHash order, as many as its largest size needs; a document whose shingles meet one of
these is a candidate, and exact shingles decide. No leak is missed, and the search reads each document once, in place.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm.common import LOWER, byte_table, chunks, mix, span_hashes, text_buffer, words_of

#: Words of a shingle, share of an item that counts as a leak.
WORDS = 5
THRESHOLD = 0.8
#: Bytes of benchmark text that are searched for in one pass over the documents; more items take more passes.
BLOCK_BYTES = 16 << 20

_INSIDE = byte_table(lambda b: b >= 0x80 or chr(b).isalnum())
_LOWER = np.frombuffer(LOWER, np.uint8)


def words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of any other characters, A-Z in lower case."""
    plain = text.translate(LOWER)
    starts, ends, _ = words_of(np.frombuffer(plain, np.uint8), np.array([0, len(plain)]), _INSIDE)
    return [plain[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def shingles(tokens: list[bytes], size: int) -> set[bytes]:
    return {b" ".join(tokens[i : i + size]) for i in range(len(tokens) - size + 1)}


def _run_hashes(of_words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words from the words' hashes."""
    n = len(of_words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + of_words[i : i + n]
    return mix(total)


class Index:
    """The sketches of a bounded block of items, and their shingles for the verification."""

    def __init__(self, items: list[tuple[int, str]], threshold: float):
        self.threshold = threshold
        self.items: list[tuple[int, int, set[bytes]]] = []  # id, words of a shingle, shingles
        by_size: dict[int, list[int]] = defaultdict(list)
        for item_id, text in items:
            tokens = words((text or "").encode())
            if tokens:
                size = min(WORDS, len(tokens))
                held = shingles(tokens, size)
                by_size[len(held).bit_length()].append(len(self.items))
                self.items.append((item_id, size, held))
        entries: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for members in by_size.values():
            largest = max(len(self.items[i][2]) for i in members)
            keep = largest - ceil(threshold * largest - 1e-9) + 1
            for i in members:
                size, held = self.items[i][1:]
                order = sorted(int(h) for h in _hashes_of(sorted(held), size))
                entries[size] += [(h, i) for h in order[:keep]]
        self.tables = {}
        for size, pairs in entries.items():
            pairs.sort()
            hashed = np.array([h for h, _ in pairs], np.uint64)
            seen = np.zeros(1 << 20, bool)
            seen[hashed & np.uint64((1 << 20) - 1)] = True
            self.tables[size] = (hashed, np.array([i for _, i in pairs]), seen)

    def leaks(self, batch_texts: pa.Array) -> list[tuple[int, int, int]]:
        """(text, item, shared shingles) for every item that leaks into a text."""
        raw, bounds = text_buffer(batch_texts)
        raw = _LOWER[raw]
        starts, ends, at = words_of(raw, bounds, _INSIDE)
        of_words = span_hashes(raw, starts, ends)
        candidates = set()
        for size, (hashed, owner, seen) in self.tables.items():
            h = _run_hashes(of_words, size)
            maybe = np.flatnonzero(seen[h & np.uint64((1 << 20) - 1)])
            lo = np.searchsorted(hashed, h[maybe], side="left")
            count = np.searchsorted(hashed, h[maybe], side="right") - lo
            maybe, lo, count = maybe[count > 0], lo[count > 0], count[count > 0]
            text = np.searchsorted(at, maybe, side="right") - 1
            whole = maybe + size <= at[text + 1]  # the run ends in the text it begins in
            for t, first, n in zip(text[whole].tolist(), lo[whole].tolist(), count[whole].tolist()):
                candidates.update((t, i) for i in owner[first : first + n].tolist())
        found, sets = [], {}
        for t, i in sorted(candidates):
            _, size, held = self.items[i]
            if (t, size) not in sets:
                sets = {k: v for k, v in sets.items() if k[0] == t}
                a, b = int(at[t]), int(at[t + 1])
                sets[t, size] = shingles([raw[s:e].tobytes() for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())], size)
            shared = len(held & sets[t, size])
            if shared >= self.threshold * len(held) - 1e-9:
                found.append((t, i, shared))
        return found


def _hashes_of(runs: list[bytes], size: int) -> np.ndarray:
    """The hashes that documents give to these runs of words."""
    raw = np.frombuffer(b" ".join(runs), np.uint8)
    starts, ends, _ = words_of(raw, np.array([0, len(raw)]), _INSIDE)
    return _run_hashes(span_hashes(raw, starts, ends), size)[::size]


def _indexes(benchmark: DataFrame, threshold: float, id_col: str, text_col: str) -> Iterator:
    """Broadcast indexes over blocks of the benchmark, each bounded by about BLOCK_BYTES of its text."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, ceil(total / BLOCK_BYTES))
    for block in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text")
        yield spark.sparkContext.broadcast(Index([(r.item_id, r.text) for r in some.collect()], threshold))


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, shared, shingles and containment of every benchmark item that leaks into a document.

    An item of fewer than five words is looked for as one run of all its words; an item without words (null ones too)
    and a null text are never found. Repeated documents and items give repeated rows; null ids stay null. An empty
    table on either side gives no row. Other columns are not read.
    """
    spark = docs.sparkSession
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, item_id long, shared long, shingles long, containment double"
    out = spark.createDataFrame([], schema)
    for index in _indexes(benchmark, threshold, item_col, item_text):
        def run(batches, index=index):
            own = index.value
            for batch in chunks(batches, "text"):
                ids = batch.column("doc_id")
                found = own.leaks(batch.column("text"))
                items = [own.items[i] for _, i, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array([t for t, _, _ in found], pa.int64())), pa.array([x[0] for x in items], pa.int64()), pa.array([s for _, _, s in found], pa.int64()),
                        pa.array([len(x[2]) for x in items], pa.int64()), pa.array([s / len(x[2]) for (_, _, s), x in zip(found, items)], pa.float64()),
                    ],
                    ["doc_id", "item_id", "shared", "shingles", "containment"],
                )

        out = out.unionByName(picked.mapInArrow(run, schema))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents, all columns as they are, into which no benchmark item leaks; rows never leave their task."""
    for index in _indexes(benchmark, threshold, item_col, item_text):
        def run(batches, index=index):
            for batch in chunks(batches, text_col):
                keep = np.ones(batch.num_rows, bool)
                keep[[t for t, _, _ in index.value.leaks(batch.column(text_col))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
