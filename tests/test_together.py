"""Tables that are built at the same time, and wide joins in stages."""

from threading import Barrier

from pyspark.sql import Row
from pyspark.sql import functions as F

from plotwise.operators.yearfill import fill_join, year_fill_crosswalk
from plotwise.plans import proximity, warehouse
from plotwise.plans.build import Build
from plotwise.plans.warehouse import Warehouse
from plotwise.session import STAGE_JOINS, in_stages, shared_path


def test_tables_are_built_at_the_same_time(spark, monkeypatch):
    both, calls = Barrier(2, timeout=60), []

    def base(w):
        calls.append("t.base")
        return w.src("raw").withColumn("a", F.col("id") + 1)

    def waiting(w):
        rows = w.ref("t.base")
        both.wait()  # passed only while the other one is built
        return rows

    monkeypatch.setitem(warehouse.MODELS, "t.base", base)
    for name in ("t.left", "t.right"):
        monkeypatch.setitem(warehouse.MODELS, name, waiting)
    monkeypatch.setitem(warehouse.MODELS, "t.vw_top", lambda w: (w.prepare(["t.left", "t.right"]), w.ref("t.left").join(w.ref("t.right"), "id"))[1])
    folder = shared_path(spark, "raw")
    spark.range(4).write.parquet(folder)
    built = Build(spark, {"raw": spark.read.parquet(folder)}, folder=shared_path(spark, "tables"))
    assert built.ref("t.vw_top").count() == 4
    assert calls == ["t.base"] and sorted(built.rebuilt) == ["t.base", "t.left", "t.right"]
    assert built._read["t.vw_top"].tables == {"t.left", "t.right"}


def test_a_place_is_searched_once_for_the_years_of_a_source_year(spark, monkeypatch):
    parcels = spark.createDataFrame([Row(pin10=p, year=str(y), x_3435=float(x), y_3435=0.0) for p, x in (("a", 0), ("b", 0), ("c", 50)) for y in (2019, 2020, 2021, 2022)])
    stores = spark.createDataFrame([Row(year=y, x=float(x), y=0.0, name=f"s{x}") for y, x in (("2019", 10), ("2022", 60))])
    searched, real = [], proximity.nearest

    def counted(points, *rest):
        searched.append(points.count())
        return real(points, *rest)

    monkeypatch.setattr(proximity, "nearest", counted)
    w = Warehouse(spark, {"spatial.parcel": parcels, "spatial.grocery_store": stores})
    rows = w.ref("proximity.dist_pin_to_grocery_store")
    assert rows.columns == ["year", "pin10", "nearest_grocery_store_name", "nearest_grocery_store_dist_ft", "nearest_grocery_store_data_year"]
    found = {(r.pin10, r.year): tuple(r[c] for c in rows.columns if c not in ("pin10", "year")) for r in rows.collect()}
    assert searched == [4]  # two places in two source years, not in four years
    assert found[("a", "2021")] == ("s10", 10.0, "2019") and found[("b", "2022")] == ("s60", 60.0, "2022") and found[("c", "2020")] == ("s10", 40.0, "2019")
    assert len(found) == 12


def _layers(spark, n):
    one = spark.createDataFrame([("a", "2020", 1), ("a", "2020", 2), ("b", "2021", 3), (None, "2021", 4)], "pin10 string, year string, v int")
    return {f"l{i}": one.select("pin10", "year", (F.col("v") * i).alias(f"f{i}_v"), F.col("year").alias(f"f{i}_data_year")) for i in range(n)}


def test_joins_by_the_same_keys_are_cut_into_stages(spark):
    base = spark.createDataFrame([("a", "2020"), ("b", "2021"), ("b", "2021"), ("c", "2020")], "pin10 string, year string")
    n = 2 * STAGE_JOINS + 1
    layers = [f.where("f%d_v != %d" % (i, 2 * i) if i else "true").dropDuplicates(["pin10", "year"]).select("pin10", "year", f"f{i}_v") for i, f in enumerate(_layers(spark, n).values())]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = in_stages(base, [lambda r, f=f: r.join(f, ["pin10", "year"], "left") for f in layers], "pin10", "year")
    assert rows.columns == ["pin10", "year", *[f"f{i}_v" for i in range(n)]]
    assert rows.count() == 4 and rows.where("pin10 = 'b'").select(f"f{n - 1}_v").collect() == [Row(**{f"f{n - 1}_v": 3 * (n - 1)})] * 2
    plan = rows._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == n and plan.count("REPARTITION_BY_NUM") == 2


def test_fields_are_joined_by_the_keys_of_the_base(spark):
    base = spark.createDataFrame([("a", "2019"), ("a", "2020"), ("b", "2021"), ("c", "2021"), (None, "2020")], "pin10 string, year string")
    layers = {k: (f, [f"f{k[1:]}"]) for k, f in _layers(spark, 3).items()}
    crosswalk = year_fill_crosswalk(base, layers)
    taken = {k: (f, {n: [f"{n}_v"] for n in names}) for k, (f, names) in layers.items()}
    filled = fill_join(base, crosswalk, taken)
    # the joins as they were: by the key and each field's own year
    dated = base.join(crosswalk, "year", "left")
    for f, fields in taken.values():
        for n, columns in fields.items():
            dated = dated.join(f.select("pin10", F.col("year").alias(f"{n}_fill_year"), *columns), ["pin10", f"{n}_fill_year"], "left")
    assert filled.columns == dated.columns
    assert sorted(map(str, filled.collect())) == sorted(map(str, dated.collect())) and filled.count() > base.count()
    joined = filled._jdf.queryExecution().optimizedPlan().toString()
    assert all("fill_year#" not in line for line in joined.splitlines() if "Join LeftOuter, " in line and "pin10" in line)
