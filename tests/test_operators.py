"""Operators against brute force on small rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from plotwise.functions import geometry as geo
from plotwise.functions.logic import extra_columns
from plotwise.functions.text import insert_hyphens, slugify
from plotwise.operators import network, ordered, quantiles, ratio, shapes, spatial


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(3)
    rows = [(k, i, rng.choice([None, rng.randint(0, 9)]), i // 7) for k in range(4) for i in range(60)]
    return spark.createDataFrame(rows, "k int, t int, v int, block int")


@pytest.mark.parametrize("n", [1, 3, 9])
def test_chunked_lag_equals_window(history, n):
    cols = {"p": ("v", n)}
    plain = ordered.lag_values(history, ["k"], ["t"], cols).select("k", "t", "p")
    split = ordered.lag_values(history, ["k"], ["t"], cols, F.col("block")).select("k", "t", "p")
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, split.collect()), key=repr)


@pytest.mark.parametrize("backward", [False, True])
def test_chunked_fill_equals_window(history, backward):
    args = (["k"], ["t"], {"v": "f"})
    plain = ordered.fill_forward(history, *args, backward=backward).select("k", "t", "f")
    split = ordered.fill_forward(history, *args, F.col("block"), backward).select("k", "t", "f")
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, split.collect()), key=repr)


def test_chunked_streak_equals_window(history):
    flag = F.col("v") > 2
    plain = ordered.streak(history, ["k"], ["t"], flag, "n").select("k", "t", "n")
    split = ordered.streak(history, ["k"], ["t"], flag, "n", F.col("block")).select("k", "t", "n")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.collect()))


def test_exact_quantiles_of_a_large_group(spark):
    values = [math.sin(i) * (i % 97) for i in range(45_000)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 1.0)], "g string, v double")
    got = {r.g: r for r in quantiles.exact_quantiles(df, ["g"], "v", {"q": 0.05, "m": 0.5}, accuracy=1000).collect()}
    ordered_values = sorted(values)

    def expected(q):
        pos = (len(values) - 1) * q
        low = math.floor(pos)
        return ordered_values[low] + (ordered_values[low + 1] - ordered_values[low]) * (pos - low)

    assert got["a"].q == pytest.approx(expected(0.05), abs=1e-12)
    assert got["a"].m == pytest.approx(expected(0.5), abs=1e-12)
    assert got["b"].q == 1.0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (7, 7), (200, 200)]
    got = {r.node: r.component for r in network.connected_components(spark.createDataFrame(edges, "src int, dst int")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 200: 200}


def test_polygon_with_hole(spark):
    outer, inner = geo.rectangle(0, 0, 10, 10), geo.rectangle(4, 4, 6, 6)
    area = spark.range(1).select(F.lit("z").alias("z"), F.concat(outer, inner).alias("rings"))
    points = spark.createDataFrame([("in", 1.0, 1.0), ("hole", 5.0, 5.0), ("out", 11.0, 5.0)], "id string, x double, y double")
    got = {r.id: r.z for r in spatial.points_in_polygons(points, area, ["z"], 3.0).collect()}
    assert got == {"in": "z", "hole": None, "out": None}


def test_corner_lots(spark):
    x, y = F.col("x"), F.col("y")
    lots = spark.createDataFrame([("corner", 10.0, 10.0), ("middle", 40.0, 10.0)], "pin string, x double, y double")
    lots = lots.withColumn("rings", geo.rectangle(x - 5, y - 5, x + 5, y + 5))
    streets = spark.createDataFrame([(-50.0, 0.0, 100.0, 0.0), (0.0, -50.0, 0.0, 100.0)], "x1 double, y1 double, x2 double, y2 double")
    got = {r.pin: (r.is_corner_lot, r.num_cross_branch) for r in shapes.corner_lots(lots, streets, "pin", 20.0, 25.0).collect()}
    assert got == {"corner": (True, 2), "middle": (False, None)}


def test_shape_of_a_rectangle(spark):
    df = spark.range(1).select(geo.polygon((0, 0), (4, 0), (8, 0), (8, 2), (0, 2)).alias("rings"))
    row = shapes.shape_features(df).first()
    # The vertex on the straight edge is dropped.
    assert row.shp_parcel_num_vertices == 4
    assert row.shp_parcel_interior_angle_sd == pytest.approx(0)
    assert row.shp_parcel_edge_len_ft_sd == pytest.approx(math.sqrt(12))
    assert row.shp_parcel_mrr_area_ratio == pytest.approx(1)


def test_ratio_statistics_gates_and_limits(spark):
    rng = random.Random(1)
    rows = [("big", 100.0 * rng.uniform(0.8, 1.2), 100.0) for _ in range(400)] + [("few", 90.0 + i, 100.0) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, e double, p double")
    got = {r.g: r for r in ratio.ratio_statistics(df, ["g"], "e", "p", nboot=100).collect()}
    big, few = got["big"], got["few"]
    assert big.med_ratio_ci_l <= big.med_ratio <= big.med_ratio_ci_u and big.cod_ci_l <= big.cod <= big.cod_ci_u
    assert big.med_ratio_met and big.sale_n == 400 and big.sales_excluded_n == 400 - big.cod_n
    assert few.cod is None and few.cod_met is None and few.med_ratio == pytest.approx(0.92)


def test_text_helpers(spark):
    got = spark.range(1).select(insert_hyphens(F.lit("12345678901234"), 2, 4, 7, 10).alias("p")).first().p
    assert got == "12-34-567-890-1234"
    assert slugify("Tax Year/Parcel-Id") == "tax_year_parcel_id"
    with pytest.raises(ValueError):
        extra_columns([{"alias": "x"}])


def test_streak_carries_on_over_nulls(spark):
    rows = [(1, t, f) for t, f in enumerate([None, 1, None, 1, 0, None, 1])]
    df = spark.createDataFrame(rows, "k int, t int, f int").withColumn("block", F.col("t") / 3)
    for chunk in (None, F.floor("block")):
        got = ordered.streak(df, ["k"], ["t"], F.col("f") == 1, "n", chunk).orderBy("t").collect()
        assert [r.n for r in got] == [None, 1, 1, 2, 0, 0, 1]


def test_neighbour_fill_takes_the_fullest_donor(spark):
    from plotwise.operators.joins import neighbour_fill

    rows = spark.createDataFrame([("a", "2020", None, "b", 1.0), ("b", "2020", None, "a", 1.0), ("b", "2020", 7, "a", 1.0), ("b", "2020", 9, "a", 1.0)], "pin string, year string, v int, near string, dist double")
    for _ in range(2):
        got = neighbour_fill(rows.repartition(3), ["pin"], [("near", "dist")], "year", ["v"], 10.0).where("pin = 'a'").collect()
        assert [r.v for r in got] == [7]


def test_unknown_predictor_is_refused():
    import pytest
    from plotwise.plans.predictors import predictors

    with pytest.raises(ValueError):
        predictors(["char_beds"], exclude=("char_bed",))


def test_long_chains_settle(spark):
    from plotwise.operators.network import connected_components

    edges = spark.createDataFrame([(f"{i:05d}", f"{i + 1:05d}") for i in range(300)], "src string, dst string")
    assert {r.component for r in connected_components(edges).collect()} == {"00000"}


def test_queries_are_listed_without_a_session():
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0 and int(done.stdout.split()[-1]) > 300
