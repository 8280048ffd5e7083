"""Data-quality checks over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from plotwise.catalog.registry import query
from plotwise.checks import generic as check
from plotwise.checks import rollup, suite
from plotwise.session import shared_path


@query("t01_accepted_range", "SELECT c_acctbal, c_custkey FROM customer WHERE NOT c_acctbal >= 0 OR NOT c_acctbal <= 9000")
def accepted_range(t):
    return check.accepted_range(t.customer, "c_acctbal", 0, 9000, extra=["c_custkey"])


@query("t02_accepted_values", "SELECT o_orderstatus, o_orderkey AS id FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def accepted_values(t):
    return check.accepted_values(t.orders, "o_orderstatus", ["F", "O"], [{"column": "o_orderkey", "alias": "id"}])


@query("t03_not_accepted_values", "SELECT p_type, p_partkey FROM part WHERE p_type IN ('ECONOMY', 'PROMO')")
def not_accepted_values(t):
    return check.not_accepted_values(t.part, "p_type", ["ECONOMY", "PROMO"], ["p_partkey"])


@query("t04_subset_of", """
SELECT k, c_custkey FROM (SELECT c_custkey, CASE WHEN c_custkey % 9 != 0 THEN c_custkey END AS k FROM customer)
LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 200000) o ON k = o_custkey WHERE o_custkey IS NULL""")
def subset_of(t):
    rows = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 9 != 0, F.col("c_custkey")).alias("k"))
    return check.subset_of(rows, "k", t.orders.where("o_totalprice > 200000"), "o_custkey", ["c_custkey"])


@query("t05_column_length", """
SELECT length(p_name) AS len_p_name, length(p_type) AS len_p_type, p_partkey FROM part WHERE length(p_name) > 9 OR length(p_type) > 9""")
def column_length(t):
    out = check.column_length(t.part, ["p_name", "p_type"], 9, ["p_partkey"])
    return out.select(F.col("len_p_name").cast("long").alias("len_p_name"), F.col("len_p_type").cast("long").alias("len_p_type"), "p_partkey")


@query("t06_columns_match", "SELECT l_discount, l_tax, l_quantity, l_orderkey FROM lineitem WHERE l_discount != l_tax AND l_discount != l_quantity")
def columns_match(t):
    return check.columns_match(t.lineitem, "l_discount", ["l_tax", "l_quantity"], ["l_orderkey"])


@query("t07_count_is_consistent", """
SELECT pin, count FROM (SELECT *, RANK() OVER (ORDER BY count DESC) AS r FROM (SELECT pin, COUNT(DISTINCT year) AS count FROM sale GROUP BY pin)) WHERE r > 1""")
def count_is_consistent(t):
    return check.count_is_consistent(t.sale, "year", "pin")


@query("t07_count_in_bounds", "SELECT pin, COUNT(DISTINCT status) AS count FROM sale GROUP BY pin HAVING NOT COUNT(DISTINCT status) BETWEEN 3 AND 4")
def count_in_bounds(t):
    return check.count_is_consistent(t.sale, "status", "pin", 3, 4)


@query("t08_expression_is_true", "SELECT salekey, cents FROM sale WHERE NOT (cents > 2000000 AND status != 'P')")
def expression_is_true(t):
    return check.expression_is_true(t.sale, "cents > 2000000 AND status != 'P'", ["salekey"], ["cents"])


@query("t09_expression_is_false", "SELECT 1 AS fail FROM sale WHERE (cents < 2000000)")
def expression_is_false(t):
    return check.expression_is_false(t.sale, "cents < 2000000")


@query("t10_is_null", "SELECT salekey, v FROM (SELECT salekey, CASE WHEN cents > 49000000 THEN cents END AS v FROM sale) WHERE v IS NOT NULL")
def is_null(t):
    rows = t.sale.select("salekey", F.when(F.col("cents") > 49000000, F.col("cents")).alias("v"))
    return check.is_null(rows, "v", ["salekey"])


@query("t11_not_null", "SELECT salekey FROM (SELECT salekey, CASE WHEN cents < 49000000 THEN cents END AS v FROM sale) WHERE v IS NULL")
def not_null(t):
    rows = t.sale.select("salekey", F.when(F.col("cents") < 49000000, F.col("cents")).alias("v"))
    return check.not_null(rows, "v", ["salekey"])


SPACED = """
SELECT a FROM (SELECT CASE c_custkey % 4 WHEN 0 THEN c_name || ' ' WHEN 1 THEN ' ' || c_name WHEN 2 THEN c_name || '  x' ELSE c_name END AS a FROM customer)
WHERE a LIKE '% ' OR a LIKE ' %'"""


def _spaced(t):
    key = F.col("c_custkey") % 4
    a = (
        F.when(key == 0, F.concat("c_name", F.lit(" "))).when(key == 1, F.concat(F.lit(" "), "c_name"))
        .when(key == 2, F.concat("c_name", F.lit("  x"))).otherwise(F.col("c_name"))
    )
    return t.customer.select(a.alias("a"))


@query("t12_no_extra_whitespace", SPACED + " OR a LIKE '%  %'")
def no_extra_whitespace(t):
    return check.no_extra_whitespace(_spaced(t), ["a"])


@query("t12_interior_allowed", SPACED)
def interior_allowed(t):
    return check.no_extra_whitespace(_spaced(t), ["a"], allow_interior=True)


@query("t13_relationships", """
SELECT k, c_custkey FROM (SELECT c_custkey, CASE WHEN c_custkey % 9 != 0 THEN c_custkey END AS k FROM customer)
LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 200000) o ON k = o_custkey WHERE o_custkey IS NULL AND k IS NOT NULL""")
def relationships(t):
    rows = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 9 != 0, F.col("c_custkey")).alias("k"))
    return check.relationships(rows, "k", t.orders.where("o_totalprice > 200000"), "o_custkey", ["c_custkey"])


@query("t14_class_matches_parcel", """
WITH m AS (SELECT pin, year, substr(priority, 1, 1) || status || '0' AS class FROM sale WHERE (pin, year) NOT IN (SELECT (pin, year) FROM parcel_year WHERE n > 2)),
p AS (SELECT pin, year, CASE WHEN exe = 1 THEN '1F0' ELSE '5P0' END AS pc FROM parcel_year)
SELECT m.pin, m.year, string_agg(DISTINCT class, ',' ORDER BY class) AS class, MAX(pc) AS pardat_class FROM m LEFT JOIN p ON m.pin = p.pin AND m.year = p.year
GROUP BY m.pin, m.year HAVING SUM(CASE WHEN substr(pc, 1, 1) = substr(class, 1, 1) THEN 1 ELSE 0 END) = 0""")
def class_matches_parcel(t):
    rows = t.sale.select("pin", "year", F.concat(F.substring("priority", 1, 1), "status", F.lit("0")).alias("class"))
    parcels = t.parcel_year.select(
        F.col("pin").alias("parid"), F.col("year").alias("taxyr"), F.when(F.col("exe") == 1, "1F0").otherwise("5P0").alias("class")
    )
    exempt = t.parcel_year.where("n > 2").select(F.col("pin").alias("parid"), F.col("year").alias("taxyr"))
    out = check.class_matches_parcel(rows, "class", parcels, exempt, ["pin", "year"], ["parid", "taxyr"], major_only=True)
    return out.withColumn("class", F.array_join("class", ","))


@query("t15_row_count", "SELECT row_count FROM (SELECT COUNT(*) AS row_count FROM orders) WHERE row_count != 3")
def row_count(t):
    return check.row_count(t.orders, equals=3)


@query("t15_row_count_above", "SELECT row_count FROM (SELECT COUNT(*) AS row_count FROM nation) WHERE row_count < 1000000")
def row_count_above(t):
    return check.row_count(t.nation, above=1_000_000)


@query("t16_values_match", """
SELECT s.pin, s.year, string_agg(DISTINCT CAST(s.exe2 AS VARCHAR), ',' ORDER BY CAST(s.exe2 AS VARCHAR)) AS model_col,
 string_agg(DISTINCT CAST(p.exe AS VARCHAR), ',' ORDER BY CAST(p.exe AS VARCHAR)) AS external_model_col
FROM (SELECT pin, year, CASE WHEN status = 'F' THEN 1 ELSE 0 END AS exe2 FROM sale) s JOIN parcel_year p ON s.pin = p.pin AND s.year = p.year
GROUP BY s.pin, s.year HAVING SUM(CASE WHEN s.exe2 = p.exe THEN 1 ELSE 0 END) = 0""")
def values_match(t):
    rows = t.sale.select("pin", "year", F.when(F.col("status") == "F", 1).otherwise(0).alias("exe2"))
    out = check.values_match_after_join(rows, "exe2", t.parcel_year, "exe", ["pin", "year"], ["pin", "year"])
    return out.withColumns({c: F.array_join(c, ",") for c in ("model_col", "external_model_col")})


@query("t16_values_match_rows", """
SELECT s.exe2 AS model_col, p.exe AS external_model_col FROM (SELECT pin, year, CASE WHEN status = 'F' THEN 1 ELSE 0 END AS exe2 FROM sale) s
JOIN parcel_year p ON s.pin = p.pin AND s.year = p.year WHERE s.exe2 != p.exe""")
def values_match_rows(t):
    rows = t.sale.select("pin", "year", F.when(F.col("status") == "F", 1).otherwise(0).alias("exe2"))
    return check.values_match_after_join(rows, "exe2", t.parcel_year, "exe", ["pin", "year"])


@query("t17_sequential_values", """
SELECT pin, y, b AS previous_y FROM (SELECT pin, CAST(year AS INT) AS y, LAG(CAST(year AS INT)) OVER (PARTITION BY pin ORDER BY CAST(year AS INT)) AS b FROM parcel_year)
WHERE NOT (y = b + 1)""")
def sequential_values(t):
    rows = t.parcel_year.select("pin", F.col("year").cast("int").alias("y"))
    return check.sequential_values(rows, "y", 1, ["pin"])


@query("t17_sequential_dates", """
SELECT k, d, b AS previous_d FROM (SELECT k, d, LAG(d) OVER (PARTITION BY k ORDER BY d) AS b FROM (SELECT DISTINCT priority AS k, sale_date AS d FROM sale))
WHERE NOT (CAST(d AS TIMESTAMP) = CAST(b AS TIMESTAMP) + INTERVAL 1 DAY)""")
def sequential_dates(t):
    rows = t.sale.select(F.col("priority").alias("k"), F.col("sale_date").alias("d")).distinct()
    return check.sequential_values(rows, "d", 1, ["k"], unit="DAY", chunk=F.date_trunc("month", "d"))


@query("t18_unique_combination", "SELECT pin, year, COUNT(*) AS num_duplicates, MAX(cents) AS top FROM sale GROUP BY pin, year HAVING COUNT(*) > 2")
def unique_combination(t):
    return check.unique_combination(t.sale, ["pin", "year"], 1, [{"column": "cents", "agg_func": "max", "alias": "top"}])


@query("t19_value_is_present", "SELECT row_count FROM (SELECT COUNT(*) AS row_count FROM orders WHERE o_totalprice < 0) WHERE row_count = 0")
def value_is_present(t):
    return check.value_is_present(t.orders, "o_totalprice < 0")


@query("t20_unique", "SELECT pin, COUNT(*) AS num_duplicates FROM sale WHERE pin IS NOT NULL GROUP BY pin HAVING COUNT(*) > 1")
def unique(t):
    return check.unique(t.sale, "pin")


ABOUT = {
    "large_sale": {"table": "sale", "column": "cents", "category": "incorrect_values", "description": "price over bound"},
    "pending": {"table": "sale", "column": "status", "category": "incorrect_values", "description": "still pending"},
    "negative": {"table": "sale", "column": "cents", "category": "incorrect_values", "description": "below zero"},
}


def _failures(t):
    sale = t.sale.withColumn("town", (F.col("pin") % 25).cast("string"))
    return {
        "large_sale": check.accepted_range(sale, "cents", high=45000000, extra=["salekey", "town"]),
        "pending": check.not_accepted_values(sale, "status", ["P"], ["salekey", "town"]),
        "negative": check.accepted_range(sale, "cents", low=0, extra=["salekey", "town"]),
    }


@query("t21_rollup", """
SELECT 'large_sale' AS test_name, CAST(pin % 25 AS VARCHAR) AS township_code, COUNT(*) AS num_failing_rows, 'fail' AS status FROM sale WHERE cents > 45000000 GROUP BY 2
UNION ALL SELECT 'pending', CAST(pin % 25 AS VARCHAR), COUNT(*), 'fail' FROM sale WHERE status = 'P' GROUP BY 2
UNION ALL SELECT 'negative', NULL, 0, 'pass'""")
def rolled_up(t):
    rows = rollup.failing_rows(_failures(t), ABOUT, "run", "2024", "town")
    return rollup.results(rows, t.spark, ABOUT, "run", "2024").select("test_name", "township_code", "num_failing_rows", "status")


@query("s16_failing_rows", """
SELECT 'run' AS run_id, '2024' AS run_year, 'large_sale' AS test_name, CAST(pin % 25 AS VARCHAR) AS township_code,
 '{"cents":' || cents || ',"salekey":' || salekey || ',"town":"' || (pin % 25) || '"}' AS problem FROM sale WHERE cents > 45000000
UNION ALL SELECT 'run', '2024', 'pending', CAST(pin % 25 AS VARCHAR), '{"status":"P","salekey":' || salekey || ',"town":"' || (pin % 25) || '"}' FROM sale WHERE status = 'P'""")
def failing_rows(t):
    out = rollup.failing_rows(_failures(t), ABOUT, "run", "2024", "town")
    return out.select("run_id", "run_year", "test_name", "township_code", "problem")


SUITE = [
    suite.in_range("large_sale", "cents", high=45000000, extra=["salekey", "town"]),
    suite.none_of("pending", "status", ["P"], ["salekey", "town"]),
    suite.in_range("negative", "cents", low=0, extra=["salekey", "town"]),
    suite.one_of("year_known", "year", ["1995", "1996", "1997", "1998"], ["salekey"]),
    suite.known("pin_known", "pin", ["salekey"]),
    suite.holds("even_or_small", "salekey % 2 = 0 OR cents < 20000000", ["salekey", "cents"]),
    suite.at_most("short_status", ["status"], 0, ["salekey"]),
    suite.unique_by("one_a_year", ["pin", "year"], 1),
    suite.unique_by("ten_in_town", ["town"], 9, {"top": "max(cents)"}),
    suite.counted_between("years_in_town", "year", "town", 1, 6),
    suite.rows_above("enough_rows", 10),
    suite.present("some_below_zero", "cents < 0"),
]


def _suite_rows(t):
    sale = t.sale.withColumn("town", (F.col("pin") % 25).cast("string"))
    parent = suite.ParentCheck("pin_in_nation", "town", t.nation.select((F.col("n_nationkey") * 2).cast("string").alias("n")), "n", {"salekey": "salekey"})
    return suite.run(sale, [*SUITE, parent], "town")


@query("t22_fused_checks", """
WITH s AS (SELECT *, CAST(pin % 25 AS VARCHAR) AS town FROM sale),
fails AS (
 SELECT 'large_sale' AS test_name, town AS township_code, CAST(salekey AS VARCHAR) AS subject FROM s WHERE cents > 45000000
 UNION ALL SELECT 'pending', town, CAST(salekey AS VARCHAR) FROM s WHERE status = 'P' UNION ALL SELECT 'negative', town, CAST(salekey AS VARCHAR) FROM s WHERE cents < 0
 UNION ALL SELECT 'year_known', town, CAST(salekey AS VARCHAR) FROM s WHERE year NOT IN ('1995', '1996', '1997', '1998') UNION ALL SELECT 'pin_known', town, CAST(salekey AS VARCHAR) FROM s WHERE pin IS NULL
 UNION ALL SELECT 'even_or_small', town, CAST(salekey AS VARCHAR) FROM s WHERE NOT (salekey % 2 = 0 OR cents < 20000000) UNION ALL SELECT 'short_status', town, CAST(salekey AS VARCHAR) FROM s WHERE length(status) > 0
 UNION ALL SELECT 'one_a_year', NULL, pin || '/' || year FROM s GROUP BY pin, year HAVING COUNT(*) > 2
 UNION ALL SELECT 'ten_in_town', town, town || ':' || MAX(cents) FROM s GROUP BY town HAVING COUNT(*) > 10
 UNION ALL SELECT 'years_in_town', town, town FROM s GROUP BY town HAVING NOT (COUNT(DISTINCT year) BETWEEN 1 AND 6)
 UNION ALL SELECT 'enough_rows', NULL, '' FROM s HAVING COUNT(*) < 10 UNION ALL SELECT 'some_below_zero', NULL, '' FROM s HAVING COUNT(CASE WHEN cents < 0 THEN 1 END) = 0
 UNION ALL SELECT 'pin_in_nation', town, CAST(salekey AS VARCHAR) FROM s WHERE CAST(town AS INT) % 2 = 1 OR CAST(town AS INT) > 48)
SELECT * FROM fails""")
def fused_checks(t):
    p = lambda name: F.get_json_object("problem", f"$.{name}")
    subject = (
        F.when(F.col("test_name") == "one_a_year", F.concat(p("pin"), F.lit("/"), p("year"))).when(F.col("test_name") == "ten_in_town", F.concat(p("town"), F.lit(":"), p("top")))
        .when(F.col("test_name") == "years_in_town", p("town")).when(F.col("test_name").isin("enough_rows", "some_below_zero"), F.lit("")).otherwise(p("salekey"))
    )
    return _suite_rows(t).select("test_name", "township_code", subject.alias("subject"))


@query("s16_run_tables", """
WITH s AS (SELECT *, CAST(pin % 25 AS VARCHAR) AS town FROM sale),
r AS (SELECT 'large_sale' AS test_name, town, COUNT(*) AS n FROM s WHERE cents > 45000000 GROUP BY town UNION ALL SELECT 'pending', town, COUNT(*) FROM s WHERE status = 'P' GROUP BY town),
kept AS (SELECT * FROM r UNION ALL SELECT 'negative', NULL, 0)
SELECT 'first' AS run_id, '2024' AS run_year, 'result' AS table_name, test_name, town AS township_code, n FROM kept
UNION ALL SELECT 'first', '2024', 'failing_row', test_name, town, n FROM r UNION ALL SELECT 'first', '2024', 'run', NULL, NULL, 1
UNION ALL SELECT 'second', '2025', 'result', 'negative', NULL, 0 UNION ALL SELECT 'second', '2025', 'run', NULL, NULL, 1""")
def run_tables(t):
    """Two runs of different years in the three tables, read back."""
    path = shared_path(t.spark, "check-runs")
    sale = t.sale.withColumn("town", (F.col("pin") % 25).cast("string"))
    for run_id, year, names in (("first", 2024, ("large_sale", "pending", "negative")), ("second", 2025, ("negative",))):
        about = {n: ABOUT[n] for n in names}
        rows = rollup.suite_rows({"sale": suite.run(sale, [c for c in SUITE if c.name in names], "town")}, about, run_id, str(year))
        record = rollup.run_record(t.spark, run_id, dt.datetime(year, 3, 1), 1.5, "tests", "2020", str(year), "0", "main", "tests")
        rollup.write_run(path, record, rows, about, run_id, str(year))
    read = lambda name: t.spark.read.parquet(f"{path}/{name}").withColumns({"run_year": F.col("run_year").cast("string"), "table_name": F.lit(name)})
    keys = ["run_id", "run_year", "table_name"]
    tests = [*keys, "test_name", "township_code"]
    failing = read("failing_row").groupBy(*tests).agg(F.count(F.lit(1)).alias("n"))
    results = read("result").select(*tests, F.col("num_failing_rows").alias("n"))
    runs = read("run").select(*keys, F.lit(None).cast("string").alias("test_name"), F.lit(None).cast("string").alias("township_code"), F.lit(1).cast("long").alias("n"))
    return results.unionByName(failing).unionByName(runs)
