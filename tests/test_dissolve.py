"""Dissolved areas against areas and rings worked out by hand and by flooding a grid."""

import random

import pytest
from pyspark.sql import functions as F

from plotwise.functions import geometry as geo
from plotwise.operators.dissolve import dissolve, dissolved_rings


def squares(spark, cells):
    rows = spark.createDataFrame([(k, x, y, n) for n, (k, x, y) in enumerate(cells)], "k string, x int, y int, n long")
    return rows.withColumn("rings", geo.rectangle(F.col("x"), F.col("y"), F.col("x") + 1, F.col("y") + 1))


def flood(cells, steps):
    left, parts = set(cells), []
    while left:
        part, todo = set(), [left.pop()]
        while todo:
            at = todo.pop()
            part.add(at)
            for dx, dy in steps:
                if (at[0] + dx, at[1] + dy) in left:
                    left.remove((at[0] + dx, at[1] + dy))
                    todo.append((at[0] + dx, at[1] + dy))
        parts.append(part)
    return parts


SIDES = [(1, 0), (-1, 0), (0, 1), (0, -1)]
CORNERS = SIDES + [(1, 1), (1, -1), (-1, 1), (-1, -1)]


@pytest.mark.parametrize("share", [0.4, 0.7, 0.95])
def test_random_grids(spark, share):
    rng = random.Random(int(share * 100))
    cells = [(k, x, y) for k in "ab" for x in range(9) for y in range(9) if rng.random() < share]
    got = {r.k: r for r in dissolve(squares(spark, cells), ["k"], [], "n").collect()}
    area = {(r.k): r.area for r in dissolved_rings(squares(spark, cells), ["k"]).groupBy("k").agg(F.sum("area").alias("area")).collect()}
    for k in "ab":
        own = {(x, y) for kk, x, y in cells if kk == k}
        empty = {(x, y) for x in range(-1, 10) for y in range(-1, 10)} - own
        assert got[k].num_parts == area[k] == len(own)
        assert got[k].num_outlines == len(flood(own, SIDES)) and got[k].num_holes == len(flood(empty, CORNERS)) - 1
        edges = sum((x + dx, y + dy) not in own for x, y in own for dx, dy in SIDES)
        assert sum(len(r) - 1 for r in got[k].rings) == edges
        for ring in got[k].rings:
            assert ring[0] == ring[-1] and all(abs(a.x - b.x) + abs(a.y - b.y) == 1 for a, b in zip(ring, ring[1:]))


def test_holes_turned_rings_and_odd_rows(spark):
    """A frame with a square in its hole, its rings turned either way, closes to one square; null and empty rings and null keys have defined results."""
    outer, hole = [(0, 0), (3, 0), (3, 3), (0, 3), (0, 0)], [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]
    kind = "k string, name string, n int, rings array<array<struct<x:double,y:double>>>"
    rows = [("a", "x", 1, [outer, hole[::-1]]), ("a", "y", 2, [hole]), ("b", "z", 1, [outer[::-1], hole]), (None, "q", 1, [outer]), ("c", "n", 1, None), ("d", "e", 1, [])]
    rows = [(k, name, n, None if r is None else [[(float(x), float(y)) for x, y in ring] for ring in r]) for k, name, n, r in rows]
    got = {r.k: r for r in dissolve(spark.createDataFrame(rows, kind), ["k"], ["name"], "n").collect()}
    assert (got["a"].num_parts, got["a"].num_outlines, got["a"].num_holes, got["a"].name) == (2, 1, 0, "x")
    assert (got["b"].num_outlines, got["b"].num_holes) == (1, 1) and (got[None].num_outlines, got[None].num_holes) == (1, 0)
    assert got["c"].rings is None and got["d"].rings is None and got["d"].num_outlines == 0
    assert sorted(r.area for r in dissolved_rings(spark.createDataFrame(rows, kind).where("k = 'b'"), ["k"]).collect()) == [-1.0, 9.0]
    assert dissolve(spark.createDataFrame(rows, kind).where("1 = 0"), ["k"], ["name"], "n").collect() == []


def test_one_key_with_all_parts(spark):
    """A strip of many squares of one key is one ring; its edges were never one row before."""
    got = dissolve(squares(spark, [("a", x, 0) for x in range(600)]), ["k"], [], "n").first()
    assert (got.num_parts, got.num_outlines, got.num_holes, len(got.rings[0])) == (600, 1, 0, 1203)
