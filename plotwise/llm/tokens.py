"""Token ids of texts by a public byte-level BPE vocabulary, for whole Arrow batches."""

from __future__ import annotations

import os
import re

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from plotwise.llm.common import byte_table, ragged, text_buffer

_SPACE = byte_table(lambda b: b in b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f ")
#: First bytes of characters that may be white space outside ASCII.
_WIDE_2 = byte_table(lambda b: b == 0xC2)
_WIDE_3 = byte_table(lambda b: b in (0xE1, 0xE2, 0xE3))
_NEXT_SPACE = _SPACE | _WIDE_2 | _WIDE_3
_ALNUM = byte_table(lambda b: chr(b).isascii() and chr(b).isalnum())
_MARK = byte_table(lambda b: 32 < b < 127 and not chr(b).isalnum())
_LATIN_TAIL = byte_table(lambda b: 0x80 <= b <= 0xBF and b not in (0x97, 0xB7))

#: Text bytes encoded at once; with ``max_units`` it bounds a Python worker's memory to about 300 MB.
ENCODE_BYTES = 3 << 20

#: A unit that is one run of letters, with or without a space before it.
_LETTERS = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def _byte_letters() -> np.ndarray:
    """The byte-level alphabet's code points: a byte that has no visible character of its own becomes the next one from 256 on."""
    table = np.arange(256, dtype="<u4")
    hidden = np.setdiff1d(table, [*range(33, 127), *range(161, 173), *range(174, 256)])
    table[hidden] = 256 + np.arange(len(hidden))
    return table


class BatchEncoder:
    """Encodes texts like ``Tokenizer.encode(text, add_special_tokens=False)``, each distinct unit once.

    A text is cut into units only where the vocabulary's pre-tokenizer always begins a new piece: before a single space
    between two other characters, between a letter or digit and a punctuation mark, around a single line end. So the
    ids of a text are those of its units in a row. The tokenizers library encodes each unit; up to ``max_units`` are
    kept for later batches, then the store starts anew. With ``added`` the strings of added tokens in a text are these
    tokens, as by the library's default, and each is a unit of its own; without it they are ordinary text.
    """

    def __init__(self, path: str, max_units: int = 250_000, added: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        own = list(self.tokenizer.get_added_tokens_decoder().values()) if added else []
        strings = sorted((t.content.encode() for t in own), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, strings))) if strings else None
        # tokens that take in what stands beside them: such a text is one unit
        self.whole = any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in own)
        self.words = Tokenizer(self.tokenizer.model)
        self.alphabet = _byte_letters()
        self.line = chr(self.alphabet[10])
        self.line_id = self.tokenizer.token_to_id(self.line)
        self.max_units = max_units
        self._reset()

    def _reset(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _letters(self, units: list[bytes]) -> tuple[list[int], np.ndarray]:
        """Ids and counts for units of letters: many in one call, parted by the line end, which no merge of the vocabulary joins with a letter."""
        shown = self.alphabet[np.frombuffer(b"\n".join(units), np.uint8)].tobytes().decode("utf-32-le").split(self.line)
        calls = [self.line.join(shown[at : at + 24]) + self.line for at in range(0, len(shown), 24)]
        ids = np.array([i for x in self.words.encode_batch_fast(calls, add_special_tokens=False) for i in x.ids], np.int64)
        ends = np.flatnonzero(ids == self.line_id)
        return ids[ids != self.line_id].tolist(), np.diff(np.append(-1, ends)) - 1

    def _learn(self, missing: list[bytes]) -> None:
        letters = _LETTERS.fullmatch
        plain = (lambda u: letters(u) and not self.added.search(u)) if self.added else letters
        words = [u for u in missing if plain(u)]
        other = [u for u in missing if not plain(u)]
        ids, counts = self._letters(words) if words else ([], [])
        got = [x.ids for x in self.tokenizer.encode_batch_fast([u.decode() for u in other], add_special_tokens=False)]
        ids += [i for x in got for i in x]
        units, lengths = words + other, [*counts, *map(len, got)]
        first, n = len(self.slots), len(units)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while first + n > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        sizes = np.array(lengths, np.int64)
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[first : first + n] = self.used + np.cumsum(sizes) - sizes
        self.length[first : first + n] = sizes
        self.used += len(ids)
        self.slots.update(zip(units, range(first, first + n)))

    def _around_added(self, raw: np.ndarray, bounds: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """The cuts with one before and behind each added token's string, and none inside."""
        buffer = raw.tobytes()
        if self.added is None or not self.added.search(buffer):
            return cuts
        found = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            spans = [m.span() for m in self.added.finditer(buffer, a, b)]
            found += [(a, b)] if spans and self.whole else spans
        first, behind = np.array(found, np.int64).reshape(-1, 2).T
        at = np.searchsorted(first, cuts, side="right") - 1
        inside = (at >= 0) & (cuts > first[at]) & (cuts < behind[at]) if len(first) else np.zeros(len(cuts), bool)
        return np.unique(np.concatenate([cuts[~inside], first, behind[behind < len(raw)]]))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the bounds of each text in them; null is empty."""
        raw, bounds = text_buffer(texts)
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        if len(self.slots) > self.max_units:
            self._reset()
        cuts = self._around_added(raw, bounds, unit_starts(raw, bounds))
        ends = np.append(cuts, len(raw)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(ends), pa.py_buffer(raw)]).dictionary_encode()
        units = coded.dictionary.to_pylist()
        missing = [u for u in units if u not in self.slots]
        if missing:
            self._learn(missing)
        slots = np.fromiter(map(self.slots.__getitem__, units), np.int64, len(units))[np.asarray(coded.indices)]
        lengths = self.length[slots]
        ids = self.flat[ragged(self.start[slots], lengths)]
        return ids, np.append(0, np.cumsum(lengths))[np.searchsorted(cuts, bounds)]


def unit_starts(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Byte positions at which a unit begins; each text that isn't empty begins one."""
    n = len(raw)
    before = np.empty_like(raw)
    before[0], before[1:] = 32, raw[:-1]
    # white space in front, ASCII or perhaps wider
    space_before = _SPACE[before]
    space_before[2:] |= _WIDE_2[raw[:-2]]
    space_before[3:] |= _WIDE_3[raw[:-3]]
    solid_before = ~space_before
    solid_after = np.zeros(n, bool)
    solid_after[:-1] = ~_NEXT_SPACE[raw[1:]]
    line = raw == 10
    alone = (line | (raw == 32)) & solid_before & solid_after
    wordy = _ALNUM[before]
    wordy[2:] |= (raw[:-2] == 0xC3) & _LATIN_TAIL[before[2:]]
    starts = alone | (wordy & _MARK[raw])
    starts[1:] |= (alone & line)[:-1]
    inner = bounds[:-1][np.diff(bounds) > 0]
    starts[inner] = True
    return np.flatnonzero(starts)


_encoders: dict[str, BatchEncoder] = {}


def encoder(path: str) -> BatchEncoder:
    """One encoder for each vocabulary file and Python worker, as the library encodes by default."""
    if path not in _encoders:
        _encoders[path] = BatchEncoder(path, added=True)
    return _encoders[path]
