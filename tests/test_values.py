"""Values of a parcel-year: one pass over the assessments, in tasks of a bounded number of rows."""

import random

from plotwise import session
from plotwise.plans.values import named_stages, stage_values
from plotwise.plans.warehouse import Warehouse
from plotwise.session import stored

NUMBERS = ("valasm1", "valasm2", "valasm3", "ovrvalasm1", "ovrvalasm2", "ovrvalasm3", "valapr1", "valapr2", "valapr3", "tot30")


def assessed(spark, rows):
    columns = "parid string, taxyr string, class string, rolltype string, valclass string, procname string, cur string, deactivat string, "
    asmt = spark.createDataFrame([(p, y, c, "RP", None, proc, cur, None, *[v] * 10) for p, y, c, proc, cur, v in rows], columns + ", ".join(f"{n} bigint" for n in NUMBERS))
    keys = sorted({(p, y) for p, y, *_ in rows if p and y})
    par = spark.createDataFrame([(p, y, "Y", None) for p, y in keys], "parid string, taxyr string, cur string, deactivat string")
    return Warehouse(spark, {"asmt_all": stored(asmt, "asmt"), "pardat": stored(par, "par")}, today="2025-01-01")


def test_stages_as_by_hand(spark):
    rng = random.Random(3)
    procs = ("ASSRVALUE", "ASSRFINAL", "BORVALUE", "FINALEAV", None, None)
    rows = [(rng.choice("abcdefgh"), rng.choice(("2021", "2024", "2025", None)), rng.choice(("2-02", "203", None)), rng.choice(procs), rng.choice(("Y", "N", None)), rng.randrange(99)) for _ in range(70)]
    rows += [("z", "2025", "1-00", None, "Y", 5), ("y", "2024", "1-00", None, "Y", 6), ("x", "2024", "1-00", "FINALEAV", "Y", 7)]
    rows = [r for r in rows if r[2] is not None]
    w = assessed(spark, rows)
    got = {(r.pin, r.year): r for r in stage_values(w).collect()}
    want = {}
    for pin, year, class_, proc, cur, value in rows:
        named = {p for a, b, _, p, _, _ in rows if (a, b) == (pin, year) and p in ("ASSRVALUE", "ASSRFINAL", "BORVALUE")}
        stage = {"ASSRVALUE": "mailed", "ASSRFINAL": "certified", "BORVALUE": "board"}.get(proc)
        if proc is None and cur == "Y":
            stage = "pre_certified" if named and "ASSRFINAL" not in named else "pre_mailed" if not named and year == "2025" else None
        if stage and year:
            one = want.setdefault((pin, year), {})
            one[stage] = max(one.get(stage, (-1, "")), (value, ""))[0], max(one.get(stage, (-1, ""))[1], class_.replace("-", ""))
    stages = ("pre_mailed", "mailed", "pre_certified", "certified", "board")
    assert {k: {s: (r[f"{s}_tot"], r[f"{s}_class"]) for s in stages if r[f"{s}_tot"] is not None} for k, r in got.items()} == want


def test_one_pass_in_tasks_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    w = assessed(spark, [(f"p{i}", "2024", "202", "ASSRVALUE", "N", i) for i in range(95)])
    plan = stage_values(w)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("valasm1") and len([line for line in plan.splitlines() if "FileScan" in line and "procname" in line]) == 1
    assert "hashpartitioning(parid" in plan and ", 10), REPARTITION_BY_NUM" in plan
    marks = named_stages(w)._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in marks and "HashAggregate" in marks


def test_histories_in_tasks_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    w = assessed(spark, [(f"p{i % 50}", str(2023 + i // 50), "202", "ASSRVALUE", "N", i) for i in range(95)])
    par = spark.sql("SELECT 'p' || id % 50 AS parid, CAST(2023 + id DIV 50 AS STRING) AS taxyr, 'Y' AS cur, CAST(NULL AS STRING) AS deactivat, '202' AS class, '10001' AS nbhd FROM range(95)")
    legal = spark.sql("SELECT 'p' || id % 50 AS parid, CAST(2023 + id DIV 50 AS STRING) AS taxyr, 'Y' AS cur, CAST(NULL AS STRING) AS deactivat, '10' AS user1 FROM range(95)")
    towns = spark.sql("SELECT '10' AS township_code, 'TOWN' AS township_name")
    reasons = spark.createDataFrame([], "parid string, taxyr string, reascd string, procname string, cur string")
    names = spark.createDataFrame([], "reascd string, description string")
    w = Warehouse(spark, {**w.sources, "pardat": par, "legdat": legal, "spatial.township": towns, "aprval": reasons, "aprval_reascd": names}, today="2025-01-01")
    rows = w.ref("default.vw_pin_history")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert len([line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line and ", 10)" in line]) == 3
    got = {(r.pin, r.year): (r.mailed_tot, r.oneyr_pri_mailed_tot, r.township_name) for r in rows.collect()}
    assert len(got) == 95 and got["p3", "2023"] == (3, None, "TOWN") and got["p3", "2024"] == (53, 3, "TOWN")
