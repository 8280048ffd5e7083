"""Stored tables of many rows are never broadcast, however short their files; code lists always are."""

from pyspark.sql import functions as F

from plotwise import session
from plotwise.catalog.registry import Tables
from plotwise.catalog.standins import warehouse
from plotwise.functions import geometry as geo
from plotwise.operators import packed, spatial
from plotwise.plans.build import Build
from plotwise.plans.characteristics import condo_cards
from plotwise.plans.warehouse import MODELS, Warehouse
from plotwise.session import shared_path, sized, stored


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_short_files_of_many_rows(spark):
    big = spark.range(session.LARGE_ROWS + 1).select("id", *[F.lit("a constant").alias(f"c{i}") for i in range(60)])
    path = shared_path(spark, "sized")
    big.write.parquet(path)
    read = spark.read.parquet(path)
    left = spark.range(10).withColumnRenamed("id", "k")
    assert "BroadcastExchange" in plan(left.join(read.select("id"), F.col("k") == F.col("id"), "left"))
    joined = left.join(sized(read).select("id", "c1").where("id % 2 = 0"), F.col("k") == F.col("id"), "left")
    assert "BroadcastExchange" not in plan(joined) and joined.where("c1 IS NOT NULL").count() == 5
    few = sized(stored(spark.range(20), "few"))
    assert "BroadcastExchange" in plan(sized(read).join(few, "id"))


def test_tables_of_a_build_and_code_lists(spark, monkeypatch):
    monkeypatch.setattr(session, "LARGE_ROWS", 50)
    monkeypatch.setattr(session, "SMALL_ROWS", 5)
    monkeypatch.setitem(MODELS, "t.big", lambda w: w.src("raw"))
    raw = stored(spark.range(100), "raw")
    frame = Build(spark, {"raw": raw}, folder=shared_path(spark, "tables")).ref("t.big")
    assert "BroadcastExchange" not in plan(spark.range(7).join(frame, "id", "left"))
    codes = Warehouse(spark, {"class_dict": spark.range(3)}).src("class_dict")
    assert "BroadcastExchange" in plan(frame.join(codes, "id", "left"))


def test_packed_rows_of_many(spark, monkeypatch):
    monkeypatch.setattr(packed, "LARGE_ROWS", 50)
    points = spark.range(200).select((F.col("id") * 37 % 101).cast("double").alias("x"), (F.col("id") * 53 % 103).cast("double").alias("y")).withColumns(packed.point_box("x", "y"))
    near, far = packed.pack(points, points.select(F.col("x").alias("bx"), F.col("y").alias("by"), "_x0", "_x1", "_y0", "_y1").limit(20), [])
    assert near.many and not far.many and "ResolvedHint" in near.whole()._jdf.queryExecution().analyzed().toString()


def test_groups_of_joined_rows_are_merged(spark, root):
    cards = condo_cards(warehouse(Tables(spark, root)))
    assert not [line for line in plan(cards).splitlines() if "BroadcastHashJoin" in line and "pin10" in line]


def test_areas_meet_places_by_numbers(spark, monkeypatch):
    places = stored(spark.range(20).select((F.col("id") * 10.0 + 5).alias("x"), F.lit(5.0).alias("y")), "places")
    box = geo.rectangle(F.col("id") * 10.0, F.lit(0.0), F.col("id") * 10.0 + 10, F.lit(10.0))
    areas = stored(spark.range(1000).select(F.col("id").alias("area"), box.alias("rings")), "areas")
    few = spatial.points_in_polygons(places, areas, ["area"], 100.0, "inner")
    assert [line for line in plan(few).splitlines() if "BroadcastHashJoin" in line and "_cx" in line and "BuildRight" in line]
    assert not [line for line in plan(few).splitlines() if "BroadcastHashJoin" in line and "_cx" not in line]
    monkeypatch.setattr(spatial, "FEW_EDGES", 10)
    many = spatial.points_in_polygons(places, areas, ["area"], 100.0, "inner")
    assert not [line for line in plan(many).splitlines() if "BroadcastHashJoin" in line and "_cx" in line]
    assert sorted(r.area for r in few.collect()) == sorted(r.area for r in many.collect()) == list(range(20))


def test_lists_are_sent_once_for_each_leaf(spark):
    points = spark.range(200).select((F.col("id") * 37 % 101).cast("double").alias("x"), (F.col("id") * 53 % 103).cast("double").alias("y")).withColumns(packed.point_box("x", "y"))
    near, far = packed.pack(points, points.select(F.col("x").alias("bx"), F.col("y").alias("by"), "_x0", "_x1", "_y0", "_y1"), [])
    met = packed.candidates(near, far, packed.keep_within(5.0), ["x", "y"], "x", "y", {"bx": "bx"})
    sent = [line for line in plan(met).splitlines() if "REPARTITION_BY_NUM" in line]
    assert sent and all("hashpartitioning(_code" in line for line in sent)
