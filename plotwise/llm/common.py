"""Helpers that the operators share: stored tables, bounded batches, words and hashes of byte buffers."""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from plotwise.session import shared_path, stored  # noqa: F401 (shared by the operators)

#: Text bytes that are worked on at once in a task.
CHUNK_BYTES = 2 << 20

#: A-Z to a-z, other bytes as they are.
LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())

U64 = np.uint64


def held_out(doc_id: str = "doc_id"):
    """True for the fold that models never learn from: crc32 of the id's text leaves 0 modulo 5. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Regroup batches so that each holds about ``limit`` bytes of ``column`` (one longer row stays whole)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        start, n = 0, batch.num_rows
        if not n:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16
        ends = np.cumsum(lengths)
        while start < n:
            before = int(ends[start - 1]) if start else 0
            stop = int(np.searchsorted(ends, before + limit - size, side="right"))
            if stop <= start:
                if held:
                    yield _joined(held)
                    held, size = [], 0
                    continue
                stop = start + 1
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1]) - before
            start = stop
            if size >= limit:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(held) == 1:
        return held[0]
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row and each text's bounds in them; null counts as empty."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    return raw, offsets - (offsets[0] if len(offsets) else 0)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads 64-bit values."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, U64), np.ones(1, U64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            table = np.full(n, base, U64)
            table[0] = 1
            _powers[i] = np.cumprod(table, dtype=U64)
    return _powers[0], _powers[1]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal spans: a polynomial modulo 2^64, then mixed with the length."""
    n = len(raw)
    up, down = _power_tables(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum((raw.astype(U64) + U64(1)) * up[:n], out=sums[1:])
    poly = (sums[ends] - sums[starts]) * down[starts]
    return mix(poly + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def words_of(raw: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes for which the 256-entry table ``inside`` is true, never across texts: starts, ends, and the first word of each text (with the total at the end)."""
    flags = np.zeros(len(raw) + 2, np.int8)
    flags[1:-1] = inside[raw]
    at = np.flatnonzero(flags[1:] != flags[:-1])
    starts, ends = at[0::2], at[1::2]
    inner = bounds[1:-1]
    # a run that goes on over the end of a text is cut there
    cut = inner[(inner > 0) & (inner < len(raw))]
    cut = np.unique(cut[(flags[cut] == 1) & (flags[cut + 1] == 1)]) if len(cut) else cut
    if len(cut):
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
    return starts, ends, np.searchsorted(starts, bounds)


def byte_table(keep) -> np.ndarray:
    return np.array([bool(keep(b)) for b in range(256)])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... for each pair, all in a row."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
