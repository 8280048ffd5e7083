"""Language identification by unigram pieces, summed over all segmentations.

Words (runs of letters, lower case, with a mark in front) are made of pieces of a fixed public vocabulary. Each language
has a probability for every piece, fitted by expectation maximisation on a bounded sample of labelled documents. The
probability of a word is the sum over all its segmentations, by the forward algorithm, for all words of a batch and all
languages at once; pieces never cross words, so a text's likelihood is the product over its words. One more model gives
all pieces the same probability: where it wins, the text is in none of the learned languages and scores low.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotwise.llm.common import byte_table, chunks, span_hashes, stored, text_buffer, words_of

_INSIDE = byte_table(lambda b: b >= 0x80 or chr(b).isalpha())
_HEAD = byte_table(lambda b: b < 0x80 or b >= 0xC0)  # a character begins here
MARK = b"_"
#: Longer runs of letters are scored as runs of so many bytes.
LONGEST = 256
#: Words in one lattice and text bytes in one batch: they bound a task's memory.
WORDS = 16_000
TEXT_BYTES = 2 << 20
#: Factor for each byte that keeps sums within the range of doubles; it is taken out again.
SCALE = 8.0


@dataclass(frozen=True)
class Settings:
    examples: int = 1500  # labelled documents of each language that the fit reads at most
    rounds: int = 6  # of expectation maximisation
    smooth: float = 0.1  # added to each piece's expected count
    unknown: float = 1e-7  # probability of a character outside the vocabulary, in every language


def vocabulary(path: str) -> list[bytes]:
    """Pieces of a sentencepiece model that are letters in lower case; the mark stands for its word start."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    found = set()
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).lower()
        start = piece.startswith("▁")
        body = piece.replace("▁", "")
        if "▁" in piece[1:] or (body and not body.isalpha()):
            continue
        found.add(MARK * start + body.encode())
    found.discard(b"")
    return sorted(found | {MARK})


class Lattice:
    """All pieces in all places of some words: edges between byte positions, in the order of their ends."""

    def __init__(self, words: list[bytes], pieces: Pieces):
        raw = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.array([len(w) for w in words], np.int64)
        self.first = np.cumsum(sizes) - sizes  # of each word in raw
        self.sizes = sizes
        # position p of word i is node first[i] + i + p
        self.node = self.first + np.arange(len(words))
        self.nodes = int(sizes.sum()) + len(words)
        word_of = np.repeat(np.arange(len(words)), sizes)
        within = np.arange(len(raw)) - self.first[word_of]
        head = np.flatnonzero(_HEAD[raw])
        room = sizes[word_of] - within
        froms, spans, ids = [], [], []
        for n in range(1, pieces.longest + 1):
            at = head[room[head] >= n]
            got = pieces.find(raw, at, n)
            hit = got >= 0
            froms.append(at[hit])
            spans.append(np.full(int(hit.sum()), n))
            ids.append(got[hit])
        # a character that is no piece itself: an edge of its own
        single = np.zeros(len(raw), bool)
        ends = np.append(head[1:], len(raw))
        width = np.minimum(ends - head, room[head])
        for a, n in zip(froms, range(1, pieces.longest + 1)):
            of = np.searchsorted(head, a)
            single[a[width[of] == n]] = True
        lone = ~single[head]
        froms.append(head[lone])
        spans.append(width[lone])
        ids.append(np.full(int(lone.sum()), len(pieces.pieces)))
        at, span, self.piece = np.concatenate(froms), np.concatenate(spans), np.concatenate(ids)
        start, word = within[at], word_of[at]
        order = np.lexsort((word, start + span))
        self.piece, self.span = self.piece[order], span[order]
        self.start = (self.node[word] + start)[order]
        self.end = (self.node[word] + start + span)[order]
        self.reach = (start + span)[order]
        self.steps = np.searchsorted(self.reach, np.arange(1, int(sizes.max()) + 2 if len(words) else 2))

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Sums over all ways to each node, for each column of ``p`` (a row for each piece and one for unknown characters)."""
        alpha = np.zeros((self.nodes, p.shape[1]))
        alpha[self.node] = 1.0
        factor = SCALE ** self.span
        for a, b in zip(self.steps[:-1], self.steps[1:]):
            if b > a:
                flow = alpha[self.start[a:b]] * p[self.piece[a:b]] * factor[a:b, None]
                to = self.end[a:b]
                new = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
                alpha[to[new]] = np.add.reduceat(flow, new, axis=0)
        return alpha

    def backward(self, p: np.ndarray) -> np.ndarray:
        """Sums over all ways from each node to its word's end."""
        beta = np.zeros((self.nodes, p.shape[1]))
        beta[self.node + self.sizes] = 1.0
        factor = SCALE ** self.span
        for a, b in zip(self.steps[-2::-1], self.steps[:0:-1]):
            if b > a:
                np.add.at(beta, self.start[a:b], beta[self.end[a:b]] * p[self.piece[a:b]] * factor[a:b, None])
        return beta

    def log_words(self, p: np.ndarray) -> np.ndarray:
        """Log probability of each word for each column."""
        total = self.forward(p)[self.node + self.sizes]
        return np.log(np.maximum(total, 1e-300)) - (self.sizes * np.log(SCALE))[:, None]


class Pieces:
    """The vocabulary with a lookup of byte spans by hash."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.array([len(x) for x in pieces], np.int64)
        ends = np.cumsum(sizes)
        h = span_hashes(raw, ends - sizes, ends)
        self.order = np.argsort(h)
        self.hashes = h[self.order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[h & np.uint64((1 << 20) - 1)] = True
        self.used = set(sizes.tolist())

    def find(self, raw: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """The piece of ``n`` bytes at each place, -1 if there is none."""
        out = np.full(len(at), -1, np.int64)
        if n not in self.used or not len(at):
            return out
        h = span_hashes(raw, at, at + n)
        maybe = np.flatnonzero(self.seen[h & np.uint64((1 << 20) - 1)])
        place = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
        good = self.hashes[place] == h[maybe]
        out[maybe[good]] = self.order[place[good]]
        return out


def fit_pieces(words: list[bytes], counts: np.ndarray, pieces: Pieces, settings: Settings) -> np.ndarray:
    """Probabilities of all pieces from counted words of one language."""
    n = len(pieces.pieces)
    p = np.append(np.full(n, 1.0 / n), settings.unknown)[:, None]
    for _ in range(settings.rounds):
        expected = np.zeros(n + 1)
        for at in range(0, len(words), WORDS):
            lattice = Lattice(words[at : at + WORDS], pieces)
            alpha, beta = lattice.forward(p), lattice.backward(p)
            total = np.maximum(alpha[lattice.node + lattice.sizes, 0], 1e-300)
            word = np.searchsorted(lattice.node, lattice.start, side="right") - 1
            share = alpha[lattice.start, 0] * p[lattice.piece, 0] * SCALE**lattice.span * beta[lattice.end, 0] / total[word]
            expected += np.bincount(lattice.piece, share * counts[at : at + WORDS][word], n + 1)
        known = expected[:n] + settings.smooth
        p[:n, 0] = known / known.sum()
    return p[:n, 0]


def _distinct_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct marked words of the texts, which of them stands at each place, and the bounds of each text's places."""
    raw, bounds = text_buffer(pc.utf8_lower(pc.fill_null(texts, "")))
    starts, ends, at = words_of(raw, bounds, _INSIDE)
    if len(starts) and (ends - starts).max() > LONGEST:
        parts = (ends - starts + LONGEST - 1) // LONGEST
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        at = np.append(0, np.cumsum(parts))[at]
        starts = np.repeat(starts, parts) + nth * LONGEST
        ends = np.minimum(starts + LONGEST, np.repeat(ends, parts))
    if not len(starts):
        return [], np.zeros(0, np.int64), at
    # an array whose odd entries are the words and whose even entries are what lies between
    edges = np.empty(2 * len(starts) + 1, np.int32)
    edges[0:-1:2], edges[1::2], edges[-1] = starts, ends, len(raw)
    words = pa.Array.from_buffers(pa.binary(), 2 * len(starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(raw))])
    coded = words.take(pa.array(np.arange(0, 2 * len(starts), 2))).dictionary_encode()
    return [MARK + w for w in coded.dictionary.to_pylist()], np.asarray(coded.indices).astype(np.int64), at


@dataclass
class Model:
    languages: list[str]
    pieces: Pieces
    p: np.ndarray  # (pieces + 1, languages + 1): the last row is for unknown characters, the last column the even model

    def score_texts(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        """The likeliest language (ties: first by name) and its posterior against all models; ``und`` and 0 for texts without a letter."""
        n = len(texts)
        letters = np.asarray(pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False))
        words, index, at = _distinct_words(texts)
        total = np.zeros((n, self.p.shape[1]))
        if words and self.languages:
            logs = np.concatenate([Lattice(words[a : a + WORDS], self.pieces).log_words(self.p) for a in range(0, len(words), WORDS)])
            sums = np.zeros((len(index) + 1, logs.shape[1]))
            np.cumsum(logs[index], axis=0, out=sums[1:])
            total = sums[at[1:]] - sums[at[:-1]]
        if not self.languages:
            return ["und"] * n, [0.0] * n
        post = np.exp(total - total.max(axis=1, keepdims=True))
        post /= post.sum(axis=1, keepdims=True)
        best = total[:, :-1].argmax(axis=1)
        return [self.languages[b] if x else "und" for b, x in zip(best, letters)], [float(post[i, b]) if x else 0.0 for i, (b, x) in enumerate(zip(best, letters))]


def fit(docs: DataFrame, vocabulary_path: str, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from documents with a language; null texts and languages and texts without letters teach nothing.

    Each language's sample is the first ``examples`` rows by a hash of the id. Words are counted by Spark; each language
    is fitted in a task of its own from these bounded counts; the driver gets one number for each piece and language.
    """
    spark = docs.sparkSession
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    picked = picked.where("lang IS NOT NULL AND text IS NOT NULL")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = picked.select("doc_id", "lang").withColumn("place", F.row_number().over(order)).where(F.col("place") <= settings.examples).select("doc_id", "lang").distinct()
    sample = picked.join(F.broadcast(chosen), ["doc_id", "lang"])  # bounded by examples and languages

    def count(batches):
        for batch in chunks(batches, "text", TEXT_BYTES):
            langs = np.array(batch.column("lang").to_pylist())
            words, index, at = _distinct_words(batch.column("text"))
            names, code = np.unique(langs, return_inverse=True)
            owner = np.repeat(code, np.diff(at))
            pair, n = np.unique(owner * max(len(words), 1) + index, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[pair // max(len(words), 1)].tolist(), pa.string()), pa.array([words[i] for i in pair % max(len(words), 1)], pa.binary()), pa.array(n)], ["lang", "word", "n"]
            )

    pieces = Pieces(vocabulary(vocabulary_path))
    shared = spark.sparkContext.broadcast(pieces)

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("word")
        p = fit_pieces([bytes(w) for w in rows["word"]], rows["n"].to_numpy(float), shared.value, settings)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "p": [p.tobytes()]})

    counts = sample.select("lang", "text").mapInArrow(count, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    fitted = sorted(counts.groupBy("lang").applyInPandas(train, "lang string, p binary").collect(), key=lambda r: r.lang)
    columns = [np.frombuffer(r.p) for r in fitted] + [np.full(len(pieces.pieces), 1.0 / len(pieces.pieces))]
    p = np.vstack([np.stack(columns, axis=1), np.full((1, len(columns)), settings.unknown)])
    return Model([r.lang for r in fitted], pieces, p)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every whole text.

    ``und`` with score 0 if the text is null or has no letter, or nothing could be learned. Repeated rows are judged
    each, null ids stay, an empty table gives no row; only the id and the text are read.
    """
    own = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary and the languages

    def run(batches):
        for batch in chunks(batches, "text", TEXT_BYTES):
            langs, scores = own.value.score_texts(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, lang_pred string, score double")


def in_known_language(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, whose language is found with a score of ``least`` or more."""
    own = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in chunks(batches, text_col, TEXT_BYTES):
            langs, scores = own.value.score_texts(batch.column(text_col))
            yield batch.filter(pa.array([x != "und" and s >= least for x, s in zip(langs, scores)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
