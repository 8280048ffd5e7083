"""Results of a run of checks as tables: run, result per test and township, failing rows."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotwise.sources.writers import write_partitioned


def failing_rows(
    failures: dict[str, DataFrame], about: dict[str, dict], run_id: str, run_year: str, township: str | None = None
) -> DataFrame:
    """All failing rows of a run. ``about`` gives table, column, category and description of each test.

    The failing row itself is kept as JSON text, so tests with different columns fit one table.
    """
    parts = []
    for name, df in failures.items():
        info = about.get(name, {})
        town = F.col(township).cast("string") if township and township in df.columns else F.lit(None).cast("string")
        parts.append(
            df.select(
                F.lit(run_id).alias("run_id"),
                F.lit(run_year).alias("run_year"),
                F.lit(name).alias("test_name"),
                F.lit(info.get("table")).cast("string").alias("table_name"),
                F.lit(info.get("column")).cast("string").alias("column_name"),
                F.lit(info.get("category")).cast("string").alias("category"),
                F.lit(info.get("description")).cast("string").alias("description"),
                town.alias("township_code"),
                F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("problem"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def suite_rows(found: dict[str, DataFrame], about: dict[str, dict], run_id: str, run_year: str) -> DataFrame:
    """All failing rows of the suites of several tables (``suite.run`` by table name), with what is known about each test."""
    fields = ("column", "category", "description")
    parts = []
    for table, rows in found.items():
        details = F.create_map(*[x for n, a in about.items() if a.get("table") == table for x in (F.lit(n), F.struct(*[F.lit(a.get(f)).cast("string").alias(f) for f in fields]))])
        named = rows.withColumn("_about", F.try_element_at(details, F.col("test_name")))
        parts.append(named.select(
            F.lit(run_id).alias("run_id"), F.lit(run_year).alias("run_year"), "test_name", F.lit(table).alias("table_name"), F.col("_about.column").alias("column_name"),
            F.col("_about.category").alias("category"), F.col("_about.description").alias("description"), "township_code", "problem",
        ))
    return reduce(DataFrame.unionByName, parts)


def write_run(path: str, record: DataFrame, rows: DataFrame, about: dict[str, dict], run_id: str, run_year: str) -> None:
    """Append a run to its three tables below ``path``, each partitioned by run_year: ``run``, ``result`` and ``failing_row``.

    Failing rows are written first and read back for the results, so checks run once.
    """
    spark = rows.sparkSession
    write_partitioned(rows, f"{path}/failing_row", ["run_year"], mode="append")
    written = spark.read.schema(rows.schema).parquet(f"{path}/failing_row").where(F.col("run_id") == run_id)
    write_partitioned(results(written, spark, about, run_id, run_year), f"{path}/result", ["run_year"], mode="append")
    write_partitioned(record, f"{path}/run", ["run_year"], mode="append")


def results(rows: DataFrame, spark: SparkSession, about: dict[str, dict], run_id: str, run_year: str) -> DataFrame:
    """One row per test, category and township with its status; tests without failures pass."""
    keys = ["run_id", "run_year", "test_name", "table_name", "column_name", "category", "description", "township_code"]
    failed = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_failing_rows")).withColumn("status", F.lit("fail"))
    tests = spark.createDataFrame(
        [
            (run_id, run_year, n, a.get("table"), a.get("column"), a.get("category"), a.get("description"))
            for n, a in about.items()
        ],
        ", ".join(f"{k} string" for k in keys[:-1]),
    )
    passed = tests.join(rows.select("test_name").distinct(), "test_name", "left_anti")
    passed = passed.withColumns(
        {"township_code": F.lit(None).cast("string"), "num_failing_rows": F.lit(0).cast("long"), "status": F.lit("pass")}
    )
    return failed.unionByName(passed)


def run_record(
    spark: SparkSession, run_id: str, started: dt.datetime, elapsed: float, run_by: str,
    year_start: str, year_end: str, revision: str, branch: str, author: str,
) -> DataFrame:
    row = (
        run_id, started.strftime("%Y-%m-%d %H:%M:%S"), str(started.year), run_by, round(elapsed, 2), year_start,
        year_end, revision, branch, author,
    )
    raw = spark.createDataFrame(
        [row],
        "run_id string, run_date string, run_year string, run_by string, elapsed double, var_year_start string, "
        "var_year_end string, git_sha string, git_ref string, git_author string",
    )
    return raw.withColumn("elapsed_time", F.col("elapsed").cast("decimal(10,2)")).drop("elapsed")
