"""Toxicity from the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms of a text are its words in lower case (A-Z) and the first 4 to 8 bytes of longer ones (many languages put the
stem first), each once more for every doubling of its count, so that how often a word stands is part of the direction.
From a bounded sample of labelled rows the terms that tell the classes apart are kept; examples are unit TF-IDF vectors
over these. Postings lie in blocks of examples, each block with the largest weight of a term in it. A text's blocks
are opened in the order of their upper bounds until none can reach the k-th best cosine, so neighbours are exact.
Votes are weighted by closeness; a logistic map fitted on the sample's own leave-one-out votes calibrates them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm.common import LOWER, byte_table, chunks, mix, ragged, span_hashes, stored, text_buffer, words_of

_INSIDE = byte_table(lambda b: b >= 0x80 or chr(b).isalnum())
_LOWER = np.frombuffer(LOWER, np.uint8)
_LOW = np.uint64((1 << 20) - 1)
#: Likelihood ratio from which a term counts as telling the classes apart (chance: 1 in 2,000 terms).
TELLING = 12.0


@dataclass(frozen=True)
class Settings:
    """Bounds of the fit and of the search."""

    examples: int = 8192  # labelled rows that the fit reads at most, spread evenly by hash
    terms: int = 4096  # terms kept
    neighbours: int = 16
    block: int = 64  # examples of a block
    prefixes: tuple[int, ...] = (4, 5, 6, 7, 8)
    sharpness: float = 4.0  # a vote weighs cosine to this power
    prior: float = 0.5  # votes' worth of the base rate


def features(texts: pa.Array, settings: Settings, seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted (text, term) pairs: text numbers and term hashes; of all words, or of those whose low bits are marked in ``seen``."""
    raw, bounds = text_buffer(texts)
    raw = _LOWER[raw]
    starts, ends, at = words_of(raw, bounds, _INSIDE)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(at))
    owners, hashes = [], []
    for n in (0, *settings.prefixes):
        longer = slice(None) if n == 0 else np.flatnonzero(ends - starts > n)
        h = span_hashes(raw, starts[longer], ends[longer] if n == 0 else starts[longer] + n)
        h = h if n == 0 else mix(h + np.uint64(n))
        use = slice(None) if seen is None else np.flatnonzero(seen[h & _LOW])
        owners.append(owner[longer][use])
        hashes.append(h[use])
    owner, h = np.concatenate(owners), np.concatenate(hashes)
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.append(True, (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])) if len(h) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(h)))
    levels = np.minimum(np.int64(1) + np.log2(np.maximum(count, 1)).astype(np.int64), 8)
    text = np.repeat(owner[first], levels)
    level = np.arange(levels.sum()) - np.repeat(np.cumsum(levels) - levels, levels)
    term = np.repeat(h[first], levels)
    # all levels of a word keep its low bits, by which words are looked up
    term = np.where(level > 0, (mix(term + level.astype(np.uint64)) & ~_LOW) | (term & _LOW), term)
    return text, term


class Model:
    """Kept terms, the block-max index of the examples and the calibration."""

    def __init__(self, settings: Settings, terms: np.ndarray, idf: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, columns: np.ndarray):
        """terms are sorted hashes; (rows, columns) say which example has which term."""
        self.settings, self.terms, self.idf, self.ids, self.labels = settings, terms, idf, ids, labels
        self.seen = np.zeros(1 << 20, bool)
        self.seen[terms & _LOW] = True
        n, size = len(ids), settings.block
        weight = idf[columns]
        norm = np.sqrt(np.bincount(rows, weight * weight, n))
        weight = weight / np.where(norm > 0, norm, 1)[rows]
        order = np.lexsort((rows, columns))
        self.examples, self.weights, columns = rows[order], weight[order], columns[order]
        self.blocks = max(1, -(-n // size))
        cell = columns * self.blocks + self.examples // size
        self.bounds = np.searchsorted(cell, np.arange(len(terms) * self.blocks + 1))
        self.most = np.zeros((len(terms), self.blocks))
        np.maximum.at(self.most.ravel(), cell, self.weights)
        self.empty_rate = self.base = float(labels.mean()) if n else 0.0
        bare = norm == 0
        if bare.any():
            self.empty_rate = float((labels[bare].sum() + self.base) / (bare.sum() + 1))
        self.slope, self.shift = 1.0, 0.0
        self._calibrate()

    def _calibrate(self) -> None:
        votes, labels = [], []
        by_example = np.lexsort((self.weights, self.examples))
        starts = np.searchsorted(self.examples[by_example], np.arange(len(self.ids) + 1))
        columns = np.repeat(np.arange(len(self.terms)), np.diff(self.bounds[:: self.blocks])) if len(self.terms) else np.zeros(0, int)
        for i in range(len(self.ids)):
            mine = by_example[starts[i] : starts[i + 1]]
            if len(mine):
                votes.append(self.vote(*self.nearest(columns[mine], self.weights[mine], without=i)))
                labels.append(self.labels[i])
        if not votes or min(labels) == max(labels):
            return
        x, y = _logit(np.array(votes)), np.array(labels, float)
        # logistic regression of the label on the vote's logit, a few Newton steps, slightly regularised
        w, design = np.array([1.0, 0.0]), np.stack([x, np.ones_like(x)], axis=1)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            gradient = design.T @ (p - y) + 0.1 * (w - [1.0, 0.0])
            w = w - np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2), gradient)
        self.slope, self.shift = float(max(w[0], 1e-3)), float(w[1])

    def nearest(self, columns: np.ndarray, weights: np.ndarray, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Examples of the k best cosines with a unit vector, best first (ties by the example's place); without those of cosine 0."""
        k, size = self.settings.neighbours, self.settings.block
        upper = weights @ self.most[columns]
        order = np.argsort(-upper, kind="stable")
        best, cosines = np.zeros(0, np.int64), np.zeros(0)
        at, width = 0, 16
        while at < len(order):
            some = order[at : at + width]
            kth = cosines[k - 1] if len(cosines) >= k else 0.0
            some = some[upper[some] > kth - 1e-12] if kth > 0 else some[upper[some] > 0]
            if not len(some):
                break
            cells = (columns[:, None] * self.blocks + some[None, :]).ravel()
            first, count = self.bounds[cells], self.bounds[cells + 1] - self.bounds[cells]
            post = ragged(first, count)
            slot = np.tile(np.arange(len(some)), len(columns))
            place = np.repeat(slot, count) * size + self.examples[post] % size
            score = np.bincount(place, np.repeat(np.repeat(weights, len(some)), count) * self.weights[post], len(some) * size)
            found = np.flatnonzero(score > 0)
            example = some[found // size] * size + found % size
            keep = example != without
            best, cosines = np.append(best, example[keep]), np.append(cosines, score[found][keep])
            top = np.lexsort((best, -cosines))[:k]
            best, cosines = best[top], cosines[top]
            at, width = at + width, width * 4
        return best, cosines

    def vote(self, examples: np.ndarray, cosines: np.ndarray) -> float:
        w = np.minimum(cosines, 1.0) ** self.settings.sharpness
        return float(((w * self.labels[examples]).sum() + self.settings.prior * self.base) / (w.sum() + self.settings.prior))

    def score(self, vote: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * _logit(np.array(vote)) + self.shift, -30, 30))))

    def score_texts(self, texts: pa.Array) -> tuple[list[float], list[list[int]], list[list[float]]]:
        """Score and evidence (examples' ids and cosines) of each text."""
        text, term = features(texts, self.settings, self.seen)
        scores, who, near = [], [], []
        if len(self.terms):
            place = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
            held = self.terms[place] == term
            text, place = text[held], place[held]
        else:
            text, place = text[:0], text[:0]
        bounds = np.searchsorted(text, np.arange(len(texts) + 1))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if a == b:
                scores.append(self.empty_rate)
                who.append([])
                near.append([])
                continue
            w = self.idf[place[a:b]]
            examples, cosines = self.nearest(place[a:b], w / np.sqrt((w * w).sum()))
            scores.append(self.score(self.vote(examples, cosines)))
            who.append(self.ids[examples].tolist())
            near.append(cosines.tolist())
        return scores, who, near


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def choose_terms(with_0: np.ndarray, with_1: np.ndarray, n_0: int, n_1: int, most: int) -> np.ndarray:
    """The terms that tell the classes apart best by the likelihood ratio, toxic ones only; those seen in fewer than three examples never."""
    a, b = with_1.astype(float), with_0.astype(float)
    total, share = n_0 + n_1, (a + b) / max(1, n_0 + n_1)

    def part(k, n, p):
        q = k / max(n, 1)
        return k * np.log(np.maximum(q, 1e-12) / np.maximum(p, 1e-12)) + (n - k) * np.log(np.maximum(1 - q, 1e-12) / np.maximum(1 - p, 1e-12))

    gain = 2 * (part(a, n_1, share) + part(b, n_0, share))
    good = np.flatnonzero((a + b >= 3) & (a / max(n_1, 1) > b / max(n_0, 1)) & (gain > TELLING))
    return good[np.lexsort((good, -gain[good]))][:most] if total else good[:0]


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """The model from labelled documents (label 0 or 1; others and nulls are left out).

    At most ``examples`` rows are read, the first by a hash of the id; the driver holds their kept terms only.
    """
    spark = docs.sparkSession
    marked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("label IN (0, 1) AND doc_id IS NOT NULL")
    marked = marked.groupBy("doc_id").agg(F.max("label").alias("label"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    chosen = marked.join(texts.select("doc_id").distinct(), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.examples)
    rows = spark.createDataFrame(chosen.toArrow(), "doc_id long, label int")  # at most ``examples`` pairs
    sample = texts.join(F.broadcast(rows), "doc_id").dropDuplicates(["doc_id"])

    def spread(batches):
        for batch in chunks(batches, "text"):
            text, term = features(batch.column("text"), settings)
            bounds = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.ListArray.from_arrays(pa.array(bounds), pa.array(term.view(np.int64)))], ["doc_id", "label", "terms"])

    held = stored(sample.select("doc_id", "label", "text").mapInArrow(spread, "doc_id long, label int, terms array<long>"), "toxic-terms")

    def tally(batches):
        seen, ones, zeros = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            lists = batch.column("terms")
            label = np.repeat(batch.column("label").to_numpy(), np.diff(np.asarray(lists.offsets)))
            term = np.append(seen, lists.flatten().to_numpy())
            one, zero = np.append(ones, label), np.append(zeros, 1 - label)
            seen, at = np.unique(term, return_inverse=True)
            ones, zeros = np.bincount(at, one, len(seen)).astype(np.int64), np.bincount(at, zero, len(seen)).astype(np.int64)
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(ones), pa.array(zeros)], ["term", "ones", "zeros"])

    counts = held.mapInArrow(tally, "term long, ones long, zeros long").groupBy("term").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    sizes = {r.label: r["count"] for r in held.groupBy("label").count().collect()}
    n_0, n_1 = sizes.get(0, 0), sizes.get(1, 0)
    # what can't pass the test below (seen in fewer than three examples, or no more often in toxic ones) stays where it is
    useful = counts.where((F.col("ones") + F.col("zeros") >= 3) & (F.col("ones") * max(n_0, 1) > F.col("zeros") * max(n_1, 1)))
    a, b = F.col("ones").cast("double"), F.col("zeros").cast("double")
    useful = useful.orderBy((a / max(n_1, 1) - b / max(n_0, 1)).desc(), "term").limit(16 * settings.terms).toPandas()
    picked = choose_terms(useful["zeros"].to_numpy(), useful["ones"].to_numpy(), n_0, n_1, settings.terms)
    terms = useful["term"].to_numpy(np.int64)[picked].view(np.uint64)
    df = (useful["ones"] + useful["zeros"]).to_numpy()[picked]
    order = np.argsort(terms)
    terms, idf = terms[order], np.log(1 + (n_0 + n_1) / np.maximum(df[order], 1))
    keep = spark.sparkContext.broadcast(terms)

    def project(batches):
        for batch in batches:
            lists = batch.column("terms")
            own = keep.value
            flat = lists.flatten().to_numpy().view(np.uint64)
            row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
            place = np.minimum(np.searchsorted(own, flat), max(len(own) - 1, 0))
            hit = own[place] == flat if len(own) else np.zeros(len(flat), bool)
            bounds = np.searchsorted(row[hit], np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.ListArray.from_arrays(pa.array(bounds), pa.array(place[hit].astype(np.int32)))], ["doc_id", "label", "terms"])

    got = held.mapInArrow(project, "doc_id long, label int, terms array<int>").orderBy("doc_id").toArrow().combine_chunks()
    if not got.num_rows:
        none = np.zeros(0, np.int64)
        return Model(settings, terms, idf, none, none, none, none)
    lists = got.column("terms").combine_chunks() if isinstance(got.column("terms"), pa.ChunkedArray) else got.column("terms")
    row = np.repeat(np.arange(got.num_rows), np.diff(np.asarray(lists.offsets)))
    label = got.column("label").to_numpy().astype(np.int64)
    return Model(settings, terms, idf, got.column("doc_id").to_numpy(), label, row, lists.flatten().to_numpy().astype(np.int64))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), predicted, and the evidence: the nearest examples and their cosines.

    Null and empty texts, and those without any kept term, score the rate of labelled texts without one. Repeated rows
    are scored each; no other column is read; an empty table gives no row.
    """
    own = docs.sparkSession.sparkContext.broadcast(model)  # bounded by Settings

    def run(batches):
        for batch in chunks(batches, "text"):
            scores, who, near = own.value.score_texts(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(who, pa.list_(pa.int64())), pa.array(near, pa.list_(pa.float64()))],
                ["doc_id", "score", "predicted", "evidence", "cosines"],
            )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, score double, predicted int, evidence array<long>, cosines array<double>")
