"""Ranked lexical search of many items at once by dual-tree search, exact.

Every document is read once: a stored forward index keeps its length and, of its terms, those that items ask for. Spark
counts documents, terms and document frequencies over it. A document's impact of a term is the term's part of its score,
an item's coordinate the term's repeats, and a score their dot product, all in integers.

A block of documents and a block of items each get a binary hierarchy that puts like rows side by side; its nodes hold
the maximum of each coordinate over their rows. The dot product of two nodes' maxima bounds every score between their
rows. From the roots, pairs of nodes are opened level by level; a pair ends where its bound lies below the weakest kth
score among the node's items, so whole batches are never compared. Of the pairs at the bottom those with the highest
bounds are compared first, which raises the kth scores for the rest. No pair that could enter a ranking is left out, ties
included. A task keeps the best of its documents for each item; a window over those gives the ranking.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotwise.llm.common import LOWER, byte_table, chunks, stored, text_buffer, words_of

#: Results for an item.
TOP = 20
#: Bytes of items that are searched for over one index; more items take more passes over the documents.
GROUP_BYTES = 16 << 20
#: Items and terms of a block of items; an item with more terms stands alone.
BLOCK_ITEMS, BLOCK_TERMS = 256, 8192
#: Documents of a block (fewer if their dense rows would have more than ``CELLS`` cells), rows at the bottom of the hierarchies.
BLOCK_DOCS, CELLS = 512, 4 << 20
DOC_LEAF, ITEM_LEAF = 16, 8
#: Bounds are sums of doubles; a pair is kept if it is this near to the score it has to reach.
_SLACK = 1 + 1e-9

_INSIDE = byte_table(lambda b: b >= 0x80 or chr(b).isalnum())
_LOWER = np.frombuffer(LOWER, np.uint8)


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of all texts as binary values, and the first term of each text (with the total at the end); A-Z in lower case, null has none."""
    raw, bounds = text_buffer(texts)
    raw = _LOWER[raw]
    starts, ends, at = words_of(raw, bounds, _INSIDE)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    data = raw[_INSIDE[raw]]  # without what lies between, terms lie one after the other
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]), at


def index(docs: DataFrame, vocabulary: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (terms), ids and counts (of its terms in the vocabulary, by place there): documents with a term, stored."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value, pa.large_binary())
        size = max(1, len(known))
        for batch in chunks(batches, "text"):
            terms, at = terms_of(batch.column("text"))
            n = np.diff(at)
            place = pc.fill_null(pc.index_in(terms, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            hit = np.flatnonzero(place >= 0)
            row = np.searchsorted(at, hit, side="right") - 1
            pairs, counts = np.unique(row * size + place[hit], return_counts=True)
            offsets = np.searchsorted(pairs, np.arange(len(n) + 1) * size).astype(np.int32)
            columns = [batch.column("doc_id"), pa.array(n), pa.ListArray.from_arrays(offsets, pa.array((pairs % size).astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(counts))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "ids", "counts"]).filter(pa.array(n > 0))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stored(rows.mapInArrow(lists, "doc_id long, n long, ids array<int>, counts array<long>"), "lexical-index")


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


def halves(rows: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows padded with zeros to leaf times a power of two, in an order that puts like rows side by side, and the row at each place (-1: padding)."""
    levels = max(0, math.ceil(math.log2(max(1, len(rows)) / leaf)))
    padded = np.zeros((leaf << levels, rows.shape[1]), rows.dtype)
    padded[: len(rows)] = rows
    plain = padded.astype(np.float32)
    plain /= np.maximum(np.sqrt((plain * plain).sum(1)), 1e-9)[:, None]
    order = np.arange(len(padded))
    for level in range(levels):
        step = len(order) >> level
        for start in range(0, len(order), step):
            places = order[start : start + step]
            some = plain[places]
            some = some - some.mean(0)
            along = some[int((some * some).sum(1).argmax())]
            for _ in range(6):  # towards the direction in which the rows differ most
                along = (some @ along) @ some
                along /= max(float(np.sqrt(along @ along)), 1e-9)
            order[start : start + step] = places[np.argsort(some @ along, kind="stable")]
    return padded[order], np.where(order < len(rows), order, -1)


def maxima(rows: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Coordinate maxima of the nodes of each level, from the root to the bottom."""
    levels = [rows.reshape(-1, leaf, rows.shape[1]).max(1)]
    while len(levels[0]) > 1:
        levels.insert(0, levels[0].reshape(-1, 2, rows.shape[1]).max(1))
    return levels


class Items:
    """A block of items with its hierarchy. ``members``: (number, repeats by place in the vocabulary); weights by place."""

    def __init__(self, members: list[tuple[int, dict[int, int]]], weights: np.ndarray):
        places = np.array(sorted({t for _, terms in members for t in terms}), np.int64)
        self.column = np.full(len(weights), -1, np.int64)
        self.column[places] = np.arange(len(places))
        # a term adds at most its weight times 10^6 for each repeat; while such sums are below 2^53 doubles are exact
        most = max(sum(k * int(weights[t]) for t, k in terms.items()) for _, terms in members) * 10**6
        self.kind = np.float64 if most < 1 << 53 else np.int64
        rows = np.zeros((len(members), len(places)), self.kind)
        for i, (_, terms) in enumerate(members):
            for t, k in terms.items():
                rows[i, self.column[t]] = k
        scaled = rows * np.maximum(weights[places], 1)
        _, order = halves(scaled, ITEM_LEAF)
        self.rows = np.where((order >= 0)[:, None], rows[order], rows.dtype.type(0))
        self.numbers = np.array([members[i][0] if i >= 0 else -1 for i in order])
        self.levels = maxima(self.rows, ITEM_LEAF)


class Best:
    """The highest scores of a block of items so far; equal scores by ascending document."""

    def __init__(self, items: Items, top: int):
        self.scores = np.zeros((len(items.numbers), top), np.int64)
        self.docs = np.full((len(items.numbers), top), np.iinfo(np.int64).max)
        self.known = np.zeros((len(items.numbers), top), bool)  # false: no document, or one with a null id
        self.kth = np.where(items.numbers >= 0, 0, np.iinfo(np.int64).max)

    def weakest(self, level: int) -> np.ndarray:
        """The weakest kth score of each node of a level."""
        return self.kth.reshape(1 << level, -1).min(1)

    def add(self, places: np.ndarray, scores: np.ndarray, docs: np.ndarray, known: np.ndarray) -> None:
        """Scores [item, document] of the items at these places."""
        wanted = ((scores >= self.kth[places][:, None]) & (scores > 0)).any(1)
        places, scores = places[wanted], scores[wanted].astype(np.int64)
        if not len(places):
            return
        spread = lambda x: np.broadcast_to(x, scores.shape)
        all_scores = np.concatenate([self.scores[places], scores], 1)
        all_docs = np.concatenate([self.docs[places], spread(docs)], 1)
        all_known = np.concatenate([self.known[places], spread(known)], 1)
        order = np.lexsort((all_docs, ~all_known, -all_scores), axis=-1)[:, : self.scores.shape[1]]
        self.scores[places], self.docs[places], self.known[places] = (np.take_along_axis(x, order, 1) for x in (all_scores, all_docs, all_known))
        self.kth[places] = self.scores[places, -1]


def search(items: Items, best: Best, rows: np.ndarray, docs: np.ndarray, known: np.ndarray) -> int:
    """Offer a block of documents (impacts by term, ids) to a block of items; returns how many scores were computed."""
    rows, order = halves(rows, DOC_LEAF)
    docs, known = docs[order], known[order] & (order >= 0)
    levels = maxima(rows, DOC_LEAF)
    alive = np.ones((1, 1), bool)
    for step in range(max(len(levels), len(items.levels))):
        d, q = levels[min(step, len(levels) - 1)], items.levels[min(step, len(items.levels) - 1)]
        alive = np.repeat(np.repeat(alive, len(d) // alive.shape[0], axis=0), len(q) // alive.shape[1], axis=1)
        at_docs, at_items = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
        bounds = np.zeros(alive.shape)
        bounds[np.ix_(at_docs, at_items)] = d[at_docs].astype(np.float64) @ q[at_items].T.astype(np.float64)
        alive &= (bounds > 0) & (bounds * _SLACK >= best.weakest(min(step, len(items.levels) - 1)))
    done, bottom = 0, len(items.levels) - 1
    bounds = np.where(alive, bounds, 0)
    for node in np.argsort(-bounds.max(1), kind="stable").tolist():
        open_ = np.flatnonzero((bounds[node] > 0) & (bounds[node] * _SLACK >= best.weakest(bottom)))
        if not len(open_):
            continue
        places = (open_[:, None] * ITEM_LEAF + np.arange(ITEM_LEAF)).ravel()
        here = slice(node * DOC_LEAF, (node + 1) * DOC_LEAF)
        scores = items.rows[places] @ rows[here].T
        done += scores.size
        best.add(places, scores, docs[here], known[here])
    return done


def _blocks(members: list[tuple[int, dict[int, int]]]) -> list[list[tuple[int, dict[int, int]]]]:
    blocks, held = [[]], set()
    for member in members:
        if blocks[-1] and (len(blocks[-1]) == BLOCK_ITEMS or len(held | member[1].keys()) > BLOCK_TERMS):
            blocks.append([])
            held = set()
        blocks[-1].append(member)
        held |= member[1].keys()
    return [b for b in blocks if b]


def _search_group(docs: DataFrame, texts: list[str | None], top: int, id_col: str, text_col: str) -> DataFrame | None:
    """item (place in ``texts``), doc_id, score: the best of each task's documents for each item."""
    terms, at = terms_of(pa.array(texts, pa.string()))
    listed = terms.to_pylist()
    vocabulary = sorted(set(listed))
    if not vocabulary:
        return None
    place = {t: i for i, t in enumerate(vocabulary)}
    members = [(i, dict(Counter(place[t] for t in listed[at[i] : at[i + 1]]))) for i in range(len(texts)) if at[i + 1] > at[i]]
    lists = index(docs, vocabulary, id_col, text_col)
    totals = lists.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
    weights = np.zeros(len(vocabulary), np.int64)
    for row in lists.select(F.explode("ids").alias("id")).groupBy("id").count().collect():  # one row per term of the items
        weights[row.id] = weight(totals.documents, row["count"])
    shared = docs.sparkSession.sparkContext.broadcast((_blocks(members), weights))
    n_docs, n_terms = totals.documents, totals.terms

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, weights = shared.value
        made, best = {}, {}
        for batch in batches:
            for b, block in enumerate(blocks):
                items = made.get(b) or Items(block, weights)
                if len(made) < 8:
                    made[b] = items
                if b not in best:
                    best[b] = Best(items, top)
                columns = int((items.column >= 0).sum())
                step = max(DOC_LEAF, min(BLOCK_DOCS, 1 << int(math.log2(max(1, CELLS // columns)))))
                for start in range(0, batch.num_rows, step):
                    some = batch.slice(start, step)
                    rows = impacts(some, items, weights, n_docs, n_terms, columns)
                    ids = some.column("doc_id")
                    known = pc.is_valid(ids).to_numpy(zero_copy_only=False)
                    search(items, best[b], rows, pc.fill_null(ids, np.iinfo(np.int64).max).to_numpy(zero_copy_only=False), known)
        for b, block in enumerate(blocks):
            if b in best:
                items = made.get(b) or Items(block, weights)
                found = best[b].scores > 0
                i = np.nonzero(found)[0]
                ids = pa.array(best[b].docs[found], mask=~best[b].known[found])
                yield pa.RecordBatch.from_arrays([pa.array(items.numbers[i]), ids, pa.array(best[b].scores[found])], names=["item", "doc_id", "score"])

    return lists.mapInArrow(find, "item long, doc_id long, score long")


def impacts(batch: pa.RecordBatch, items: Items, weights: np.ndarray, n_docs: int, n_terms: int, columns: int) -> np.ndarray:
    """What each term of the block's items adds to the score of each document, once."""
    lists, counts = batch.column("ids"), batch.column("counts")
    ids, tf = lists.flatten().to_numpy(), counts.flatten().to_numpy()
    row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy())
    used = items.column[ids] >= 0
    row, ids, tf = row[used], ids[used], tf[used]
    m = 75 + (25 * batch.column("n").to_numpy() * n_docs) // n_terms
    rows = np.zeros((batch.num_rows, columns), items.kind)
    rows[row, items.column[ids]] = weights[ids] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[row]))
    return rows


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``top`` documents of each item with a score above 0, highest first.

    Terms are runs of ASCII letters and digits and of any characters beyond ASCII, A-Z in lower case. Null and empty
    texts have none: such documents don't count in any statistic, such items give no rows. Equal scores go by ascending
    doc_id, null ids last; repeated rows of documents are ranked each, repeated rows of items each get a ranking. An
    empty table on either side gives no rows. Items are collected in groups of about ``GROUP_BYTES`` of text, each of
    which takes one pass over the documents. Only the named columns are read.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).where("text != ''")
    groups = max(1, math.ceil((asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / GROUP_BYTES))
    out = None
    for group in range(groups):
        some = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == group).orderBy("item_id", "text").collect()
        found = _search_group(docs, [r.text for r in some], top, id_col, text_col)
        if found is None:
            continue
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
        ids = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(some)], "item long, item_id long")
        ranked = ranked.join(ids, "item").select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.unionAll(ranked)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
