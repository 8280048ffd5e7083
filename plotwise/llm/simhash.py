"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints within ``bits`` differing bits share, in at least one of the partitions of the 64 bits, at most that
partition's threshold of differing bits, as long as the thresholds plus one add up to ``bits`` + 1. Partitions group
bits that go together; the thresholds (-1: not probed) come from a dynamic program over the estimated candidates and
the rows each choice costs. Equal fingerprints are first made one; each is put under its partition values with every
choice of up to the threshold's bits masked out, so two within the threshold meet in a bucket. Buckets verify all 64
bits and give links that span their components, never all pairs of a large bucket.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm.common import LOWER, chunks, ragged, stored
from plotwise.llm.components import components

#: Fingerprints from which pair distances are estimated; it only steers costs, never which links are found.
SAMPLE = 2048
#: Cost of a row in the shuffle, in compared pairs.
ROW_COST = 300.0
#: Buckets up to this size give all their links, larger ones links that span their components.
SMALL = 48


# ---- fingerprints ------------------------------------------------------------------------------------------------

def shingle_spans(text: bytes, words: int) -> tuple[bytes, list[int], list[int]]:
    """The text in lower case (A-Z) with single spaces between its words, and the bounds of its shingles there."""
    plain = b" ".join(text.translate(LOWER).split())
    if not plain:
        return plain, [], []
    gaps = np.flatnonzero(np.frombuffer(plain, np.uint8) == 32)
    starts = np.append(0, gaps + 1)
    ends = np.append(gaps, len(plain))
    if len(starts) <= words:
        return plain, [0], [len(plain)]
    return plain, starts[: len(starts) - words + 1].tolist(), ends[words - 1 :].tolist()


def hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle, repeats included."""
    plain, starts, ends = shingle_spans(text, words)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(plain[a:b], 42) for a, b in zip(starts, ends)), np.uint64, len(starts))


def simhash(h: np.ndarray) -> int:
    """Bit by bit the majority of the hashes; 0 without any."""
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(h)).astype(np.uint8), bitorder="little").view("<u8")[0])


def _picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash and fingerprint (the 64 bits as a signed long) of every whole text, over all shingles; null counts as a text without words."""
    def run(batches):
        for batch in chunks(batches, "text"):
            found = (hashes(t.encode(), words) for t in batch.column("text").to_pylist())
            prints = [simhash(h) for h in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(np.array(prints, np.uint64).view(np.int64))], ["doc_id", "text_hash", "fingerprint"])

    return _picked(docs, id_col, text_col).mapInArrow(run, "doc_id long, text_hash long, fingerprint long")


# ---- partitions and thresholds ------------------------------------------------------------------------------------

def bit_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and how often each two bits are set together, over all of them."""
    def run(batches):
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            x = batch.column("fingerprint").to_numpy().view(np.uint64)
            for at in range(0, len(x), 1 << 15):
                bits = ((x[at : at + (1 << 15), None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
                total += bits.T @ bits
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(4097)), pa.array(np.append(total.ravel(), n).astype(np.int64))], ["k", "n"])

    got = prints.select("fingerprint").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas().sort_values("k")["n"].to_numpy()
    return (int(got[-1]), got[:-1].reshape(64, 64).astype(float)) if len(got) else (0, np.zeros((64, 64)))


def grouped_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """The 64 bits in ``parts`` groups of nearly equal size: each group begins with the least settled free bit and takes those most correlated with it."""
    share = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    correlation = np.abs((together / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    free, groups = list(range(64)), []
    for left in range(parts, 0, -1):
        size = -(-len(free) // left)
        group = [max(free, key=lambda b: spread[b])]
        while len(group) < size:
            rest = [b for b in free if b not in group]
            group.append(max(rest, key=lambda b: (correlation[b, group].mean(), -b)))
        groups.append(sorted(group))
        free = [b for b in free if b not in group]
    return groups


def _close_share(sample: np.ndarray, group: list[int], most: int) -> np.ndarray:
    """Estimated share of pairs with at most e differing bits in the group, e = 0..most."""
    mask = np.uint64(sum(1 << b for b in group))
    # pairs of the sample, and for shares too small to be seen there, bits taken as independent
    d = np.bitwise_count((sample[:, None] ^ sample[None, :]) & mask)
    seen = np.array([(np.count_nonzero(d <= e) - len(sample)) / max(1, len(sample) * (len(sample) - 1)) for e in range(most + 1)])
    ones = np.array([((sample >> np.uint64(b)) & np.uint64(1)).mean() if len(sample) else 0.5 for b in group])
    chance = np.array([1.0])
    for p in 2 * ones * (1 - ones):
        chance = np.convolve(chance, [1 - p, p])
    return np.maximum(seen, np.cumsum(np.append(chance, np.zeros(most + 1)))[: most + 1])


def thresholds(n: int, sample: np.ndarray, groups: list[list[int]], bits: int) -> tuple[list[int], float]:
    """The cheapest thresholds (each -1 or more, with them plus one adding up to ``bits`` + 1) by dynamic programming, and their cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in groups:
        most = min(bits, len(group))
        close = _close_share(sample, group, most)
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for e in range(-1, most + 1):
                total = used + e + 1
                if total > bits + 1:
                    break
                # masking e bits: comb(size, e) rows each; a pair at distance d <= e meets in comb(size - d, e - d) buckets
                rows = comb(len(group), e) if e >= 0 else 0
                pairs = n * close[e] * comb(len(group), e) / 2 if e >= 0 else 0.0
                now = cost + n * (rows * ROW_COST + min(pairs, float(n) * rows))
                if total not in step or now < step[total][0]:
                    step[total] = (now, [*chosen, e])
        best = step
    cost, chosen = best[bits + 1]
    return chosen, cost


def plan(prints: DataFrame, bits: int) -> list[tuple[list[int], int]]:
    """Groups of bits with their thresholds: the cheapest over several numbers of groups."""
    n, together = bit_counts(prints)
    sample = prints.select("fingerprint").orderBy(F.xxhash64("fingerprint")).limit(SAMPLE).toPandas()["fingerprint"].to_numpy(np.int64).view(np.uint64)
    found = []
    for parts in range(2, min(bits + 2, 9)):
        groups = grouped_bits(n, together, parts)
        chosen, cost = thresholds(n, sample, groups, bits)
        found.append((cost, [(g, e) for g, e in zip(groups, chosen) if e >= 0]))
    return min(found, key=lambda x: x[0])[1]


# ---- buckets -----------------------------------------------------------------------------------------------------

def masked_keys(x: np.ndarray, choice: list[tuple[list[int], int]]) -> np.ndarray:
    """Bucket keys of each fingerprint, a column for each partition and choice of masked bits."""
    keys = []
    for i, (group, e) in enumerate(choice):
        whole = sum(1 << b for b in group)
        for k, out in enumerate(combinations(group, e)):
            mask = np.uint64(whole - sum(1 << b for b in out))
            salt = np.uint64((i << 32 | k) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            y = (x & mask) ^ salt
            # different buckets keep different keys: both steps can be undone, and the salt is part of what is mixed
            y = y * np.uint64(0xBF58476D1CE4E5B9)
            keys.append(y ^ (y >> np.uint64(31)))
    return np.stack(keys, axis=1)


def spanning_links(x: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between distinct fingerprints within ``bits`` that span the components they form; the larger part of a dense bucket is settled by its first few."""
    waiting = np.arange(len(x))
    heads, tails = [], []
    while len(waiting):
        frontier, waiting = [waiting[0]], waiting[1:]
        while frontier and len(waiting):
            at = frontier.pop()
            near = np.bitwise_count(x[waiting] ^ x[at]) <= bits
            if near.any():
                got = waiting[near]
                waiting = waiting[~near]
                heads.append(np.full(len(got), at))
                tails.append(got)
                frontier.extend(got.tolist())
    none = np.zeros(0, np.int64)
    return (np.concatenate(heads), np.concatenate(tails)) if heads else (none, none)


def bucket_links(keys: np.ndarray, x: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the buckets of sorted keys, as positions; of large buckets only links that span what is linked."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(first, len(keys)))
    heads, tails = [], []
    few = (sizes > 1) & (sizes <= SMALL)
    size = np.repeat(np.where(few, sizes, 0), sizes)
    place = np.arange(len(keys)) - np.repeat(first, sizes)
    for step in range(1, SMALL):
        a = np.flatnonzero(place + step < size)
        a = a[np.bitwise_count(x[a] ^ x[a + step]) <= bits]
        heads.append(a)
        tails.append(a + step)
    for at, n in zip(first[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        a, b = spanning_links(x[at : at + n], bits)
        heads.append(at + a)
        tails.append(at + b)
    return np.concatenate(heads), np.concatenate(tails)


def linked(prints: DataFrame, bits: int) -> DataFrame:
    """Links (x, y) between distinct fingerprints within ``bits`` differing bits; together they connect all that are linked."""
    choice = plan(prints, bits)

    def spread(batches):
        for batch in batches:
            x = batch.column("fingerprint").to_numpy().view(np.uint64)
            for at in range(0, len(x), 2048):
                some = x[at : at + 2048]
                keys = masked_keys(some, choice)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(some, keys.shape[1]).view(np.int64))], ["key", "fingerprint"]
                )

    def meet(batches):
        # rows come sorted by key; a bucket that goes on in the next batch is held over
        keys, x = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column("key").to_numpy()])
            x = np.concatenate([x, batch.column("fingerprint").to_numpy().view(np.uint64)])
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if cut:
                yield from out(keys[:cut], x[:cut])
                keys, x = keys[cut:], x[cut:]
        if len(keys):
            yield from out(keys, x)

    def out(keys, x):
        a, b = bucket_links(keys, x, bits)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x[a].view(np.int64), x[b].view(np.int64))), pa.array(np.maximum(x[a].view(np.int64), x[b].view(np.int64)))], ["x", "y"])

    rows = prints.select("fingerprint").mapInArrow(spread, "key long, fingerprint long")
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = rows.repartition(parts, "key").sortWithinPartitions("key", "fingerprint").mapInArrow(meet, "x long, y long")
    return met.distinct()


def near_duplicates(docs: DataFrame, bits: int = 4, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (long) and component_id of every document.

    Texts link at ``bits`` or fewer differing bits; component_id is the smallest doc_id that can be reached, the
    document's own included. Texts without words, null ones too, have fingerprint zero and link like any others. A
    null doc_id takes part, but never names a component unless there is no other. Repeated rows stay. An empty table
    gives none. Only the two needed columns are read. No link is lost: the pigeonhole is exact for every choice of
    partitions, and what a large bucket leaves out is joined by other links of the same bucket.
    """
    prints = stored(fingerprints(docs, words, id_col, text_col), "simhash")
    # copies count once from here on; ids below zero are fine
    distinct = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    links = linked(distinct, bits)
    labels = components(links, "x", "y").select(F.col("id").alias("fingerprint"), F.col("component").alias("label"))
    least = distinct.join(labels, "fingerprint", "left").withColumn("label", F.coalesce("label", "fingerprint"))
    least = stored(least, "simhash-labels")
    smallest = least.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named = least.join(smallest, "label").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


# ---- one document of each group ----------------------------------------------------------------------------------

def one_of_each(docs: DataFrame, bits: int = 4, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, without near copies: of each component of ``near_duplicates`` the one with the smallest doc_id stays.

    Null texts and texts without words are one group, with whatever else lies near fingerprint zero. Of repeated rows
    with the same id and text one stays; a null id loses to any other. An empty table stays empty. Other columns may
    have any names.
    """
    prints = stored(fingerprints(docs, words, id_col, text_col), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = prints.groupBy("fingerprint").agg(F.min(order).alias("first"))
    first = stored(first.select("fingerprint", "first.*"), "simhash-first")
    labels = components(linked(first, bits), "x", "y").select(F.col("id").alias("fingerprint"), F.col("component").alias("label"))
    grouped = first.join(labels, "fingerprint", "left").withColumn("label", F.coalesce("label", "fingerprint"))
    kept = stored(grouped.groupBy("label").agg(F.min(order).alias("kept")).select("kept.doc_id", "kept.text_hash"), "simhash-kept")
    own_hash = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    chosen = docs.join(kept, docs[id_col].cast("long").eqNullSafe(kept["doc_id"]) & (own_hash == kept["text_hash"]), "left_semi")
    repeated = prints.join(kept, prints["doc_id"].eqNullSafe(kept["doc_id"]) & (prints["text_hash"] == kept["text_hash"]), "left_semi")
    if not repeated.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        chosen = chosen.dropDuplicates([id_col, text_col])
    return chosen
