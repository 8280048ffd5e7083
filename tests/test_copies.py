"""Chains are not copied by joins with their own aggregates, and pairs of places and schools are not listed."""

import random

from pyspark.sql import functions as F

from plotwise.catalog.registry import Tables
from plotwise.catalog.standins import warehouse
from plotwise.functions import geometry as geo
from plotwise.operators import packed
from plotwise.operators.spatial import values_within_radius
from plotwise.plans.warehouse import Warehouse


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sales_go_through_their_joins_a_few_times(spark, root):
    w = warehouse(Tables(spark, root))
    for name in ("default.vw_pin_sale_combined", "default.vw_pin_sale"):
        assert plan(w.ref(name)).count("BroadcastExchange") + plan(w.ref(name)).count("Exchange hashpartitioning") <= 32, name


def test_land_lines_are_read_once(spark):
    columns = "parid string, taxyr string, lline int, sf bigint, influ double, allocpct double, infl1 string, cur string, deactivat string"

    def line(pin, number, sf, influ=None, mark=None):
        return (pin, "2020", number, sf, influ, None, mark, "Y", None)

    land = spark.createDataFrame(
        [
            line("sum", 1, 10), line("sum", 2, 20), line("equal", 1, 7, 1.0), line("equal", 2, 7, 1.0), line("split", 1, 5, mark="35"), line("split", 3, 9),
            line("twice", 2, 4, mark="35"), line("twice", 2, 4), line("twice", 6, 1), line("none", None, 3), line("gone", 1, 3),
        ],
        columns,
    )
    par = spark.createDataFrame([(p, "2020", "Y", None) for p in ("sum", "equal", "split", "twice", "none")], "parid string, taxyr string, cur string, deactivat string")
    rows = Warehouse(spark, {"land": land, "pardat": par}).ref("default.vw_pin_land")
    assert plan(rows).count("Scan ExistingRDD") == 2
    assert sorted((r.pin, r.num_landlines, r.sf) for r in rows.collect()) == [("equal", 2, 7), ("split", 2, 5), ("sum", 2, 30), ("twice", 3, 4), ("twice", 3, 9)]


def test_values_within_radius(spark):
    r = random.Random(3)
    near = [(float(r.randrange(60)), float(r.randrange(60)), str(r.randrange(2))) for _ in range(150)]
    far = [(float(r.randrange(60)), float(r.randrange(60)), str(r.randrange(2)), r.choice([None, 1, 2, 3, 9])) for _ in range(200)]
    a, b = spark.createDataFrame(near, "x double, y double, d string"), spark.createDataFrame(far, "x double, y double, d string, v int")
    got = {(s.x, s.y, s.d): {v.value for v in s.found} for s in values_within_radius(a, b, 5.0, "v", "found", ["d"]).collect()}
    assert got == {(x, y, d): {v for p, q, e, v in far if e == d and (p - x) ** 2 + (q - y) ** 2 <= 25} for x, y, d in near}


def test_crowds_of_few_values_are_not_compared(spark):
    places = spark.range(300).select((F.col("id") % 20).cast("double").alias("x"), F.floor(F.col("id") / 20).cast("double").alias("y"))
    near, far = packed.pack(places.withColumns(packed.point_box("x", "y")), places.select(F.col("x").alias("bx"), F.col("y").alias("by"), F.lit(1).alias("v")).withColumns(packed.point_box("bx", "by")), [])
    met = packed.candidates(near, packed.with_values(far, F.struct("v")), packed.meet_within(1000.0), ["x", "y"], "x", "y", {"v": "v"}, {"_seen": F.array().cast("array<struct<v:int>>")})
    assert met.count() == 300 and met.where("size(_seen) = 1 AND v IS NULL").count() == 300


def test_schools_of_the_district_count_once_for_each_rating(spark):
    r = random.Random(5)
    spots = [(str(i), y, float(r.randrange(8000)), float(r.randrange(8000))) for i in range(40) for y in ("2018", "2019", "2020", "2021")]
    spots = [(p, y, float(int(p) * 197 % 8000), float(int(p) * 331 % 8000)) for p, y, _, _ in spots]
    schools = [(y, float(r.randrange(8000)), float(r.randrange(8000)), r.choice([None, 1.0, 2.0, 7.0]), r.choice(["public", "private", None]), r.choice(["L", "R", None])) for y in ("2019", "2021") for _ in range(60)]
    box = [("L", 0.0, 3999.5), ("R", 3999.5, 9000.0)]
    shapes = spark.createDataFrame(box, "geoid string, x0 double, x1 double").select("geoid", geo.rectangle(F.col("x0") - 0.25, F.lit(-1.25), F.col("x1") - 0.25, F.lit(9000.0)).alias("rings"))
    w = Warehouse(spark, {
        "spatial.parcel": spark.createDataFrame(spots, "pin10 string, year string, x_3435 double, y_3435 double"), "spatial.school_district": shapes,
        "other.great_schools_rating": spark.createDataFrame(schools, "year string, x double, y double, rating double, type string, district_geoid string"),
    })
    got = {(s.pin10, s.year): tuple(s)[1:-1] for s in w.ref("proximity.cnt_pin_num_school").collect()}
    want = {}
    for pin, year, x, y in spots:
        if year >= "2019":
            of = "2021" if year == "2021" else "2019"
            here = next((g for g, x0, x1 in box if x0 - 0.25 <= x < x1 - 0.25), None)
            close = [s for s in schools if s[0] == of and (s[1] - x) ** 2 + (s[2] - y) ** 2 <= 2640**2]
            ratings = [*{s[3] for s in close if s[4] == "public" and s[5] == here}, *[s[3] for s in close if s[4] == "private"]]
            known = [v for v in ratings if v is not None]
            want[pin, year] = (len(ratings), len(known), sum(known) / len(known) if known else None, of if ratings else None, of if ratings else None)
    assert got == want
