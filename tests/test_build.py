"""A build stores each table once and rebuilds what a change reaches, nothing else."""

import time

import pytest
from pyspark.sql import functions as F

from plotwise.plans import warehouse
from plotwise.plans.build import Build
from plotwise.session import shared_path


@pytest.fixture()
def graph(monkeypatch):
    """raw_a, raw_b -> t.one, t.two -> t.vw_mid -> t.three; calls counts how often each model ran."""
    calls = []

    def model(name, fn):
        def run(w):
            calls.append(name)
            return fn(w)

        monkeypatch.setitem(warehouse.MODELS, name, run)

    model("t.one", lambda w: w.src("raw_a").withColumn("a", F.col("id") * 2))
    model("t.two", lambda w: w.src("raw_b").select("id", (F.col("id") + 1).alias("b"), F.lit(None).alias("nothing")))
    model("t.vw_mid", lambda w: w.ref("t.one").join(w.ref("t.two"), "id"))
    model("t.three", lambda w: w.ref("t.vw_mid").groupBy().agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    model("t.four", lambda w: w.ref("t.vw_mid").select("id"))
    return calls


def build(spark, folder, raw, **kwargs):
    sources = {n: spark.read.schema("id long").parquet(f"{raw}/{n}") for n in ("raw_a", "raw_b")}
    return Build(spark, sources, folder=folder, **kwargs)


def test_only_what_changed(spark, graph):
    raw, folder = shared_path(spark, "raw"), shared_path(spark, "tables")
    spark.range(10).write.parquet(f"{raw}/raw_a")
    spark.range(5).write.parquet(f"{raw}/raw_b")
    first = build(spark, folder, raw)
    assert first.ref("t.three").first().asDict() == {"a": 20, "b": 15} and first.ref("t.four").count() == 5
    assert sorted(first.rebuilt) == ["t.four", "t.one", "t.three", "t.two"] and first.ref("t.two").schema["nothing"].dataType.simpleString() == "string"
    graph.clear()
    again = build(spark, folder, raw)
    assert again.ref("t.three").first().b == 15 and again.ref("t.four").count() == 5
    assert graph == [] and again.rebuilt == [] and set(again.reused) == {"t.three", "t.four"}
    files = again.ref("t.three").inputFiles()
    assert files and all(f"/t.three/{again.key('t.three')}/" in f for f in files)
    time.sleep(1.1)
    spark.range(5, 7).write.mode("append").parquet(f"{raw}/raw_b")
    graph.clear()
    changed = build(spark, folder, raw)
    assert changed.ref("t.three").first().asDict() == {"a": 42, "b": 28}
    assert changed.rebuilt == ["t.two", "t.three"] and changed.reused == ["t.one"] and graph == ["t.three", "t.vw_mid", "t.two"]
    graph.clear()
    newer = build(spark, folder, raw, version="2")
    assert newer.ref("t.three").first().a == 42 and sorted(newer.rebuilt) == ["t.one", "t.three", "t.two"]
    old = build(spark, folder, raw)
    assert old.ref("t.three").first().a == 42 and old.rebuilt == []  # the earlier version is still there


def test_stored_views_and_shared_views(spark, graph):
    raw, folder = shared_path(spark, "raw"), shared_path(spark, "tables")
    for n in ("raw_a", "raw_b"):
        spark.range(3).write.parquet(f"{raw}/{n}")
    one = build(spark, folder, raw, stored_views=("t.vw_mid",))
    one.ref("t.three"), one.ref("t.four")
    assert graph.count("t.vw_mid") == 1 and "t.vw_mid" in one.rebuilt
    # without a stored view, both tables know what the shared view read
    other = build(spark, shared_path(spark, "tables"), raw)
    other.ref("t.three"), other.ref("t.four")
    graph.clear()
    assert other.key("t.four") and other.key("t.three") and other._key_of("t.four", other._read["t.vw_mid"]) == other.key("t.four")
