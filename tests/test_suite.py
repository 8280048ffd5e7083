"""Fused checks give the rows of single ones in one scan; writes follow bytes; bucketed joins shuffle nothing."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from plotwise.checks import generic, suite
from plotwise.session import shared_path
from plotwise.sources import writers


@pytest.fixture(scope="module")
def table(spark, root):
    orders = spark.read.parquet(f"{root}/orders.parquet")
    odd = orders.withColumns({"word": F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(" "), "o_orderpriority")).when(F.col("o_orderkey") % 3 == 1, F.lit("a  b")), "town": (F.col("o_custkey") % 7).cast("string")})
    return odd.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 11 > 0, F.col("o_totalprice")))


def reported(df):
    return sorted(json.dumps(json.loads(r.j), sort_keys=True) for r in df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("j")).collect())


def test_same_rows_as_single_checks(spark, root, table):
    parents = spark.read.parquet(f"{root}/customer.parquet").where("c_custkey % 2 = 0").withColumn("c_custkey", F.when(F.col("c_custkey") % 10 > 0, F.col("c_custkey")))
    key = ["o_orderkey"]
    pairs = [
        (suite.in_range("a", "o_totalprice", 1000, 100000, extra=key), generic.accepted_range(table, "o_totalprice", 1000, 100000, extra=key)),
        (suite.in_range("a2", "o_totalprice", 1000, inclusive=False, extra=key), generic.accepted_range(table, "o_totalprice", 1000, inclusive=False, extra=key)),
        (suite.one_of("b", "o_orderstatus", ["O", "it's"], key), generic.accepted_values(table, "o_orderstatus", ["O", "it's"], key)),
        (suite.none_of("c", "o_orderstatus", ["O"], key), generic.not_accepted_values(table, "o_orderstatus", ["O"], key)),
        (suite.known("d", "o_totalprice", key), generic.not_null(table, "o_totalprice", key)),
        (suite.unknown("e", "o_totalprice", key), generic.is_null(table, "o_totalprice", key)),
        (suite.at_most("f", ["word", "town"], 4, key), generic.column_length(table, ["word", "town"], 4, key)),
        (suite.tidy("g", ["word"]), generic.no_extra_whitespace(table, ["word"])),
        (suite.tidy("g2", ["word"], True), generic.no_extra_whitespace(table, ["word"], True)),
        (suite.holds("h", "o_totalprice > 50000", key), generic.expression_is_true(table, "o_totalprice > 50000", key)),
        (suite.matches_one("i", "town", ["o_orderstatus"], key), generic.columns_match(table, "town", ["o_orderstatus"], key)),
        (suite.ParentCheck("j", "o_custkey", parents, "c_custkey", {"o_custkey": "o_custkey", "o_orderkey": "o_orderkey"}), generic.relationships(table, "o_custkey", parents, "c_custkey", key)),
        (suite.unique_by("k", ["o_custkey"], 1, {"top": "max(o_totalprice)"}), generic.unique_combination(table, ["o_custkey"], 1, [{"column": "o_totalprice", "agg_func": "max", "alias": "top"}])),
        (suite.counted_between("l", "o_custkey", "town", 1, 5), generic.count_is_consistent(table, "o_custkey", "town", 1, 5)),
        (suite.rows_above("m", 10**6), generic.row_count(table, above=10**6)),
        (suite.present("n", "o_totalprice < 0"), generic.value_is_present(table, "o_totalprice < 0")),
    ]
    got = {}
    for r in suite.run(table, [c for c, _ in pairs], "town").collect():
        got.setdefault(r.test_name, []).append(json.dumps(json.loads(r.problem), sort_keys=True))
    for check, single in pairs:
        assert sorted(got.get(check.name, [])) == reported(single), check.name
    assert sum(bool(v) for v in got.values()) > 12


def test_one_scan_for_all_row_checks(spark, root):
    orders = spark.read.parquet(f"{root}/orders.parquet")
    rows = [suite.in_range(f"r{i}", "o_totalprice", i, extra=["o_orderkey"]) for i in range(40)]
    scans = lambda checks: suite.run(orders, checks)._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
    assert scans(rows) == 1
    assert scans([*rows, suite.unique_by("u", ["o_custkey"]), suite.unique_by("v", ["o_custkey"], 3), suite.rows_above("w", 5), suite.present("x", "o_orderkey > 0")]) == 3


def test_no_failure_and_empty_tables(spark, table):
    empty = table.where("1 = 0")
    checks = [suite.known("a", "o_orderkey"), suite.unique_by("b", ["o_orderkey"]), suite.rows_above("c", 1), suite.present("d", "o_orderkey > 0")]
    assert suite.run(table, checks, "town").collect() == []
    assert {r.test_name for r in suite.run(empty, checks, "town").collect()} == {"c", "d"}


def test_files_follow_bytes(spark):
    """One partition with nine tenths of the rows takes several files, most small ones one."""
    rows = spark.range(200_000, numPartitions=16).select(F.when(F.col("id") % 10 > 0, F.lit(0)).otherwise(F.col("id") % 90 + 1).alias("year"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    path = shared_path(spark, "files")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        writers.write_partitioned(rows, path, ["year"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = {r.year: r.n for r in spark.read.parquet(path).select("year", F.input_file_name().alias("f")).distinct().groupBy("year").agg(F.count("f").alias("n")).collect()}
    small = [n for year, n in files.items() if year]
    # a small one that shares the large one's task is split with it
    assert 3 <= files[0] <= 16 and sum(small) <= len(small) + 2 * files[0]
    assert spark.read.parquet(path).count() == 200_000


def test_bucketed_join_has_no_exchange(spark, root):
    orders = spark.read.parquet(f"{root}/orders.parquet")
    names = [f"buckets_{uuid.uuid4().hex}" for _ in range(2)]
    for n in names:
        writers.write_bucketed(orders, n, ["o_custkey", "o_orderstatus"], 4, shared_path(spark, "buckets"))
    left, right = (spark.table(n) for n in names)
    joined = writers.bucketed_join(left.select("o_custkey", "o_orderstatus", "o_totalprice"), right.select("o_custkey", "o_orderstatus", "o_orderdate"), ["o_custkey", "o_orderstatus"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
    writers.dropped(spark, *names)
    assert not any(spark.catalog.tableExists(n) for n in names)
    assert joined.count() == orders.alias("a").join(orders.alias("b"), ["o_custkey", "o_orderstatus"]).count()
