"""Searches in blocks: far rows are sent once a lot, sums and ties are right for every kind of measure."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plotwise.operators import blocks, packed, spatial
from plotwise.plans import proximity
from plotwise.plans.warehouse import Warehouse


def scattered(n, seed, width=1000.0):
    rng = random.Random(seed)
    return [(round(rng.uniform(0, width), 1), round(rng.uniform(0, width), 1)) for _ in range(n)]


def boxed(spark, rows, x, y):
    frame = spark.createDataFrame(rows, f"{x} double, {y} double")
    return frame.withColumns(packed.point_box(x, y))


def test_far_blocks_are_sent_once_a_lot(spark, monkeypatch):
    monkeypatch.setattr(blocks, "FAR_ROWS", 100)
    near, far = scattered(900, 1), scattered(3000, 2)
    met = blocks.pack(boxed(spark, near, "x", "y"), boxed(spark, far, "u", "v"), [], ["x", "y"], ("u", "v"))
    lots, sent = met.near.select("_lot").distinct().count(), met.far.count()
    assert 1 < lots <= 2 * blocks.LOTS and 30 <= sent <= 40
    within, close = blocks.pairs_within(met, 60.0), blocks.pairs_nearest(met)
    # lists of places and leaves had thousands of rows
    assert within.count() == within.distinct().count() < lots * sent
    assert close.count() == close.distinct().count() < lots * sent


def test_sums_of_all_kinds(spark):
    rng = random.Random(3)
    places, things = scattered(300, 4), [(x, y, rng.randint(-9, 9), rng.choice([None, 0.25, -1.5]), Decimal(rng.randint(-500, 500)) / 100, 2**40 + i) for i, (x, y) in enumerate(scattered(2500, 5))]
    a = spark.createDataFrame([*places, (None, 1.0), (1e7, 1e7)], "x double, y double")
    b = spark.createDataFrame(things, "x double, y double, n int, d double, m decimal(9,2), big long")
    measures = {c: F.col(c) for c in ("n", "d", "m", "big")}
    numbers = {(r.x, r.y): r for r in spatial.count_within_radius(a, b, 150.0, {c: measures[c] for c in ("n", "d", "big")}).collect()}
    money = {(r.x, r.y): r for r in spatial.count_within_radius(a, b, 150.0, {"m": measures["m"]}).collect()}
    assert numbers[None, 1.0].n is None and (numbers[1e7, 1e7].n, numbers[1e7, 1e7].d, money[1e7, 1e7].m) == (0, 0.0, 0)
    for x, y in places:
        near = [t for t in things if (x - t[0]) ** 2 + (y - t[1]) ** 2 <= 150.0**2]
        got = numbers[x, y]
        assert (got.n, got.big) == (sum(t[2] for t in near), sum(t[5] for t in near))
        assert math.isclose(got.d, sum(t[3] or 0 for t in near), abs_tol=1e-9) and money[x, y].m == sum(t[4] for t in near)


def test_a_measure_that_is_not_finite_stays_with_its_circle(spark):
    a = spark.createDataFrame([(0.0, 0.0), (500.0, 500.0)], "x double, y double")
    b = spark.createDataFrame([(1.0, 0.0, math.inf), (500.0, 501.0, 2.0), (530.0, 500.0, 3.0)], "x double, y double, v double")
    assert {r.x: r.v for r in spatial.count_within_radius(a, b, 40.0, {"v": F.col("v")}).collect()} == {0.0: math.inf, 500.0: 5.0}


def test_ties_go_to_the_lowest_feature(spark):
    a = spark.createDataFrame([(0.0, 0.0)], "x double, y double")
    b = spark.createDataFrame([("b", 1, 3.0, 4.0), ("a", 2, -3.0, 4.0), ("a", None, 5.0, 0.0), ("c", 0, 0.0, 9.0)], "name string, k int, x double, y double")
    (row,) = spatial.nearest(a, spatial.point_segments(b).drop("x", "y"), ["name", "k"]).collect()
    assert (row.name, row.k, row.dist) == ("a", None, 5.0)


@pytest.fixture()
def parcels(spark):
    places = scattered(120, 6, 12_000.0)
    rows = [(f"{i:03d}", x, y, str(year)) for i, (x, y) in enumerate(places) for year in range(2018, 2024) if (i + year) % 5]
    frame = spark.createDataFrame([*rows, rows[0], ("x", None, 1.0, "2020"), ("y", 1.0, 1.0, None)], "pin10 string, x_3435 double, y_3435 double, year string")
    rng = random.Random(7)
    sales = [(f"{rng.randint(2012, 2024)}-05-0{1 + i % 9}" if i % 11 else None, x, y) for i, (x, y) in enumerate(scattered(400, 8, 12_000.0))]
    events = spark.createDataFrame(sales, "day string, x double, y double").select(F.to_date("day").alias("foreclosure_recording_date"), "x", "y")
    return frame, rows, events, sales


def test_foreclosures_search_each_place_once(spark, parcels, monkeypatch):
    frame, rows, events, sales = parcels
    searches = []
    count = proximity.count_within_radius
    monkeypatch.setattr(proximity, "count_within_radius", lambda a, b, r, m, by=(), *xy: searches.append(list(by)) or count(a, b, r, m, by, *xy))
    out = proximity.cnt_pin_num_foreclosure(Warehouse(spark, {"spatial.parcel": frame, "sale.foreclosure": events})).collect()
    assert searches == [[]]  # before: two, with each place once for each year and each sale six times
    assert len(out) == len(rows) + 3
    got = {(r.pin10, r.year): r for r in out}
    everyone = [*rows, rows[0]]
    for pin, x, y, year in rows:
        sold = sum(d is not None and 0 <= int(year) - int(d[:4]) <= 5 and (x - u) ** 2 + (y - v) ** 2 <= 2640.0**2 for d, u, v in sales)
        others = sum(z == year and (x - u) ** 2 + (y - v) ** 2 <= 2640.0**2 for _, u, v, z in everyone)
        r = got[pin, year]
        assert (r.num_foreclosure_in_half_mile_past_5_years, r.num_pin_in_half_mile) == (sold, others)
        assert math.isclose(r.num_foreclosure_per_1000_pin_past_5_years, sold / (others / 1000), abs_tol=0.006)
    lost = got["x", "2020"]
    assert (lost.num_foreclosure_in_half_mile_past_5_years, lost.num_pin_in_half_mile, lost.num_foreclosure_per_1000_pin_past_5_years) == (0, 1, None)
