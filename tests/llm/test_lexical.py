"""Ranked search against scores of all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from plotwise.llm import lexical as X

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow(docs, items, top=20):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in held:
            m = 75 + (25 * n * n_docs) // n_terms
            scored.append((sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c), i))
        best = sorted((r for r in scored if r[0] > 0), key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:top]
        out += [(item, n + 1, i, s) for n, (s, i) in enumerate(best)]
    return sorted(out, key=repr)


def result(spark, docs, items, **settings):
    rows = X.rank(spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS item_id", "2 AS score"), spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "3 AS rank", "4 AS item"), **settings)
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows.collect()), key=repr)


def made(seed, docs, items, vocabulary=200):
    rng = random.Random(seed)
    words = [f"w{i}" if i % 3 else f"É{i}" for i in range(vocabulary)]
    text = lambda n: " ".join(words[min(int(rng.expovariate(0.03)), vocabulary - 1)] for _ in range(n))
    d = [(i, text(rng.randint(1, 60))) for i in range(docs)]
    return d + [(docs + i, d[3][1]) for i in range(40)], [(i, text(rng.randint(1, 12))) for i in range(items)]


@pytest.mark.parametrize("top", [1, 5, 20])
def test_same_as_all_pairs(spark, top):
    docs, items = made(top, 900, 60)
    assert result(spark, docs, items, top=top) == slow(docs, items, top)


def test_odd_rows(spark):
    docs = [(1, "Cat dog"), (1, "Cat dog"), (None, "cat cat"), (3, None), (4, ""), (5, "..!"), (6, "caté CAT"), (7, "lang " * 50_000 + "dog"), (8, "x\x00cat"), (9, "up")]
    items = [(1, "cat"), (1, "cat"), (2, None), (3, ""), (4, "?"), (None, "dog dog cat"), (6, "nowhere"), (7, "LANG caté")]
    assert result(spark, docs, items) == slow(docs, items)
    assert result(spark, docs, items[2:5]) == result(spark, [(3, None)], items) == []
    assert X.rank(spark.createDataFrame(docs, "doc_id long, text string").where("1 = 0"), spark.createDataFrame(items, "item_id long, text string")).collect() == []


def test_groups_and_blocks_of_items(spark, monkeypatch):
    docs, items = made(8, 300, 40)
    want = slow(docs, items)
    monkeypatch.setattr(X, "GROUP_BYTES", 400)
    assert result(spark, docs, items) == want


def test_bounds_hold_and_prune():
    """Blocks of many small item blocks; far fewer scores than pairs, the same best."""
    rng = np.random.default_rng(5)
    topics = rng.integers(0, 12, 512)
    rows = np.zeros((512, 240))
    for i, t in enumerate(topics):
        rows[i, t * 20 + rng.integers(0, 20, 8)] = rng.integers(1, 10**9, 8)
    members = [(i, {int(t): 1 for t in (i % 12) * 20 + rng.integers(0, 20, 5)}) for i in range(64)]
    items = X.Items(members, np.full(240, 1000))
    best = X.Best(items, 5)
    columns = np.flatnonzero(items.column >= 0)
    computed = X.search(items, best, rows[:, columns], np.arange(512), np.ones(512, bool))
    assert computed < 512 * 64 / 3
    for place, number in enumerate(items.numbers):
        if number >= 0:
            scores = rows[:, sorted(members[number][1])].sum(1)
            order = sorted(range(512), key=lambda d: (-scores[d], d))[:5]
            assert [(int(s), int(d)) for s, d in zip(best.scores[place], best.docs[place]) if s] == [(int(scores[d]), d) for d in order if scores[d]]


def test_sums_beyond_doubles_are_exact():
    items = X.Items([(0, {0: 1 << 20, 1: 1})], np.array([13_000, 1]))
    assert items.kind == np.int64
    best = X.Best(items, 2)
    X.search(items, best, np.array([[1 << 35, 0], [1 << 35, 1]]), np.array([7, 8]), np.ones(2, bool))
    place = int(np.flatnonzero(items.numbers == 0)[0])
    assert best.scores[place].tolist() == [(1 << 55) + 1, 1 << 55] and best.docs[place].tolist() == [8, 7]
