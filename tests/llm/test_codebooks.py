"""Vector codes against plain rounds over all pairs."""

import math

import numpy as np
import pytest

from plotwise.llm import codebooks as C


def slow(rows, parts=4, entries=256, rounds=4):
    """(vec_id, label, code, error) and codebooks from all distances, in Python integers."""
    kept = [(i, label, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, label, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept:
        return [], None
    width = len(kept[0][2]) // parts
    kept = [r for r in kept if len(r[2]) == width * parts]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, _, v in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(p):
        out = []
        for c in cut:
            d = [sum((a - b) ** 2 for a, b in zip(c[p], e)) for e in books[p]]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c, (e, _) in zip(cut, near(p)):
                groups.setdefault(e, []).append(c[p])
            books[p] = [[sum(x) // len(groups[e]) for x in zip(*groups[e])] if e in groups else old for e, old in enumerate(books[p])]
    last = [near(p) for p in range(parts)]
    rows = [(i, label, "".join(f"{last[p][n][0]:02x}" for p in range(parts)), sum(last[p][n][1] for p in range(parts))) for n, (i, label, _) in enumerate(kept)]
    return rows, books


def some_rows(rng, n, width=8):
    """Clusters, copies, one hot vector, unusable rows."""
    centres = rng.normal(size=(6, width))
    rows = [(i, int(rng.integers(3)) if rng.random() > 0.1 else None, (centres[rng.integers(6)] + rng.normal(scale=0.05, size=width)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n + i, 1, rows[0][2]) for i in range(n // 3)] + [(5, 1, rows[5][2]), (5, 2, rows[6][2]), (None, 0, rows[7][2])]
    bad = [None, [], [1.0] * (width - 1) + [float("nan")], [float("inf")] * width, [None] * width, [0.5] * (width + 4)]
    return rows + [(2000 + i, 0, v) for i, v in enumerate(bad)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr("*", "'x' AS v", "1 AS code", "2 AS error", "3 AS trees")


@pytest.mark.parametrize("n, entries, block", [(300, 16, 64), (40, 256, 2048), (500, 7, 128)])
def test_same_as_all_pairs(spark, n, entries, block, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", block)
    rows = some_rows(np.random.default_rng(n), n)
    want, books = slow(rows, entries=entries)
    spark_blocks, got = C.train(spark, frame(spark, rows), entries=entries, block=block)
    assert got.tolist() == books
    coded = C.encode(spark_blocks, got).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.vec_id, r.label, r.code, r.error) for r in coded), key=key) == sorted(want, key=key)
    if block == 2048:
        out = C.compress(frame(spark, rows), entries=entries).collect()
        totals = {}
        for _, label, _, error in want:
            totals[label] = totals.get(label, 0) + error
        assert len(out) == len(want) and all(r.label_error == totals[r.label] and r.codebooks_sha256 == C.digest(got) for r in out)


@pytest.mark.parametrize("kind", ["spread", "copies", "far"])
def test_trees(kind):
    rng = np.random.default_rng(3)
    points = {"spread": rng.integers(-300, 300, (1500, 4)), "copies": np.repeat(rng.integers(-9, 9, (5, 4)), 200, axis=0), "far": rng.integers(-C.LIMIT, C.LIMIT, (200, 4))}[kind]
    tree = C.build(points)
    assert sorted(tree.order.tolist()) == list(range(len(points))) and (tree.points == points[tree.order]).all()
    for b in range(len(tree.first)):
        inside = tree.points[tree.first[b] : tree.end[b]].astype(np.int64)
        assert (inside.sum(0) == tree.sums[b]).all() and (np.sqrt(((inside - tree.centre[b]) ** 2).sum(1)) <= tree.radius[b] + 1e-6).all()
        if tree.left[b] >= 0:
            assert (tree.first[tree.left[b]], tree.end[tree.left[b]], tree.end[tree.right[b]]) == (tree.first[b], tree.first[tree.right[b]], tree.end[b])
    entries = np.concatenate([points[:20], points[:5]])
    all_pairs = ((points[:, None].astype(object) - entries[None]) ** 2).sum(2)
    nearest, away = C.chosen(tree, entries.astype(np.int64))
    assert nearest.tolist() == [r.index(min(r)) for r in all_pairs.tolist()] and away.tolist() == [min(r) for r in all_pairs.tolist()]


def test_balls_are_owned_without_a_look_at_their_points():
    rng = np.random.default_rng(1)
    centres = rng.integers(-100_000, 100_000, (8, 4))
    points = np.concatenate([c + rng.integers(-5, 5, (200, 4)) for c in centres])
    owned, compared = C.walk(C.build(points), centres)
    assert len(owned) < 40 and compared == []


def test_no_rows(spark):
    assert C.compress(frame(spark, [(1, 2, None), (2, None, [])])).collect() == []
    assert C.compress(frame(spark, []).where("1 = 0")).collect() == []
    with pytest.raises(ValueError):
        C.compress(frame(spark, [(1, 2, [1.0, 2.0])]))
