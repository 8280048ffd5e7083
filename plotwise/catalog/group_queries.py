"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.catalog.registry import query
from plotwise.operators import grouped, ordered, quantiles


@query("a01_basic", """
SELECT l_returnflag, l_linestatus, COUNT(*) AS n, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty, MIN(l_discount) AS lo,
 MAX(l_extendedprice) AS hi, ROUND(AVG(l_extendedprice), 2) AS mean, ROUND(SUM(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1, 2""")
def basic(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("qty"), F.min("l_discount").alias("lo"),
        F.max("l_extendedprice").alias("hi"), F.round(F.avg("l_extendedprice"), 2).alias("mean"),
        F.round(F.sum("l_extendedprice"), 2).alias("total"),
    )


@query("a02_count_distinct", "SELECT year, COUNT(DISTINCT pin) AS pins, COUNT(DISTINCT status) AS stages FROM sale GROUP BY year")
def count_distinct(t):
    return t.sale.groupBy("year").agg(F.countDistinct("pin").alias("pins"), F.countDistinct("status").alias("stages"))


@query("a03_percentile", """
SELECT status, quantile_disc(cents, 0.5) AS median, quantile_disc(cents, 0.95) AS p95 FROM sale GROUP BY status""")
def percentile(t):
    return t.sale.groupBy("status").agg(
        grouped.approx_quantile("cents", 0.5, grouped.FINE).alias("median"),
        grouped.approx_quantile("cents", 0.95, grouped.FINE).alias("p95"),
    )


@query("a04_arbitrary", """
SELECT pin, MAX(CASE WHEN status = 'F' THEN cents END) AS f, MAX(CASE WHEN status = 'O' THEN cents END) AS o FROM sale GROUP BY pin""")
def arbitrary(t):
    return grouped.pivot_values(t.sale, ["pin"], "status", {"F": "f", "O": "o"}, "cents")


@query("a05_pivot", """
SELECT pin, CAST(SUM(CASE WHEN year = '1996' THEN cents END) AS BIGINT) AS y1996, CAST(SUM(CASE WHEN year = '1997' THEN cents END) AS BIGINT) AS y1997,
 CAST(SUM(CASE WHEN year = '1998' THEN cents END) AS BIGINT) AS y1998 FROM sale GROUP BY pin""")
def pivot(t):
    return grouped.pivot_values(t.sale, ["pin"], "year", {y: f"y{y}" for y in ("1996", "1997", "1998")}, "cents", "sum")


@query("a06_conditional_count", """
SELECT year, COUNT(CASE WHEN cents > 30000000 THEN 1 END) AS large, COUNT(CASE WHEN status = 'P' THEN 1 END) AS pending FROM sale GROUP BY year""")
def conditional_count(t):
    return t.sale.groupBy("year").agg(
        F.count_if(F.col("cents") > 30000000).alias("large"), F.count_if(F.col("status") == "P").alias("pending")
    )


@query("a07_array_collect", """
SELECT pin, array_to_string(list_sort(list(DISTINCT priority)), '|') AS kinds FROM sale WHERE priority != '5-LOW' GROUP BY pin""")
def array_collect(t):
    kept = t.sale.withColumn("p", F.when(F.col("priority") != "5-LOW", F.col("priority"))).where("p IS NOT NULL")
    return grouped.collect_sorted(kept, ["pin"], "p", "kinds").withColumn("kinds", F.array_join("kinds", "|"))


@query("a08_array_with_nulls", """
SELECT pin, COUNT(DISTINCT COALESCE(p, '-')) AS n_members, MAX(CASE WHEN p IS NULL THEN 1 ELSE 0 END) = 1 AS has_null FROM
(SELECT pin, CASE WHEN status = 'F' THEN NULL ELSE status END AS p FROM sale) GROUP BY pin""")
def array_with_nulls(t):
    rows = t.sale.select("pin", F.when(F.col("status") != "F", F.col("status")).alias("p"))
    out = grouped.collect_sorted(rows, ["pin"], "p", "members", keep_nulls=True)
    return out.select(
        "pin", F.size("members").cast("long").alias("n_members"), F.exists("members", lambda m: m.isNull()).alias("has_null")
    )


@query("a09_distinct_join", """
SELECT pin, string_agg(p, ', ' ORDER BY p) AS kinds FROM (SELECT DISTINCT pin, upper(substr(priority, 3)) AS p FROM sale) GROUP BY pin""")
def distinct_join(t):
    return grouped.distinct_join(t.sale, ["pin"], F.upper(F.expr("substr(priority, 3)")), "kinds")


@query("a10_bool_or", "SELECT pin, year, bool_or(status = 'F') AS any_final, bool_or(cents > 45000000) AS any_large FROM sale GROUP BY pin, year")
def bool_or(t):
    return t.sale.groupBy("pin", "year").agg(
        F.max(F.col("status") == "F").alias("any_final"), F.bool_or(F.col("cents") > 45000000).alias("any_large")
    )


@query("a11_mode", """
SELECT pin, priority FROM (SELECT pin, priority, ROW_NUMBER() OVER (PARTITION BY pin ORDER BY COUNT(*) DESC, priority) AS r FROM sale
GROUP BY pin, priority) WHERE r = 1""")
def mode(t):
    return grouped.mode_lowest(t.sale, ["pin"], "priority", "priority")


@query("a12_first_five_wide", """
WITH r AS (SELECT l_orderkey, l_quantity, l_returnflag, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey) AS n FROM lineitem)
SELECT l_orderkey, MAX(CASE WHEN n = 1 THEN l_quantity END) AS l_quantity_1, MAX(CASE WHEN n = 2 THEN l_quantity END) AS l_quantity_2,
 MAX(CASE WHEN n = 3 THEN l_quantity END) AS l_quantity_3, MAX(CASE WHEN n = 4 THEN l_quantity END) AS l_quantity_4,
 MAX(CASE WHEN n = 5 THEN l_quantity END) AS l_quantity_5, MAX(CASE WHEN n = 1 THEN l_returnflag END) AS l_returnflag_1,
 MAX(CASE WHEN n = 2 THEN l_returnflag END) AS l_returnflag_2, MAX(CASE WHEN n = 3 THEN l_returnflag END) AS l_returnflag_3,
 MAX(CASE WHEN n = 4 THEN l_returnflag END) AS l_returnflag_4, MAX(CASE WHEN n = 5 THEN l_returnflag END) AS l_returnflag_5
FROM r WHERE n <= 5 GROUP BY l_orderkey""")
def first_five_wide(t):
    order = [F.col("l_extendedprice").desc(), F.col("l_linenumber"), F.col("l_partkey")]
    return ordered.first_n_wide(t.lineitem, ["l_orderkey"], order, 5, ["l_quantity", "l_returnflag"])


@query("a12_count_map", """
SELECT pin, COUNT(CASE WHEN status = 'F' THEN 1 END) AS n_f, COUNT(DISTINCT status) AS n_keys FROM sale GROUP BY pin""")
def count_map(t):
    out = grouped.value_counts_map(t.sale, ["pin"], "status", "counts")
    n_f = F.coalesce(F.try_element_at("counts", F.lit("F")), F.lit(0))
    return out.select("pin", n_f.cast("long").alias("n_f"), F.size("counts").cast("long").alias("n_keys"))


@query("a13_having", "SELECT pin, year, COUNT(*) AS n FROM sale GROUP BY pin, year HAVING COUNT(*) > 3")
def having(t):
    return t.sale.groupBy("pin", "year").agg(F.count(F.lit(1)).alias("n")).where("n > 3")


@query("a14_stacked_groups", """
WITH b AS (SELECT s.*, CAST(c_nationkey AS VARCHAR) AS town, c_mktsegment AS seg FROM sale s JOIN customer ON pin = c_custkey)
SELECT year, 'Town' AS geography_type, town AS geography_id, status, COUNT(*) AS n, quantile_disc(cents, 0.5) AS med FROM b GROUP BY ALL
UNION ALL SELECT year, 'Town', town, 'ALL', COUNT(*), quantile_disc(cents, 0.5) FROM b GROUP BY ALL
UNION ALL SELECT year, 'Segment', seg, status, COUNT(*), quantile_disc(cents, 0.5) FROM b GROUP BY ALL
UNION ALL SELECT year, 'Segment', seg, 'ALL', COUNT(*), quantile_disc(cents, 0.5) FROM b GROUP BY ALL""")
def stacked_groups(t):
    rows = t.sale.join(t.customer, F.col("pin") == F.col("c_custkey"))
    aggs = [F.count(F.lit(1)).alias("n"), grouped.approx_median("cents", grouped.FINE).alias("med")]
    return grouped.stacked_groups(rows, ["year"], [("Town", "c_nationkey"), ("Segment", "c_mktsegment")], "status", aggs, "ALL")


@query("a15_by_geographies", """
WITH b AS (SELECT s.*, n_name, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS seg FROM sale s JOIN customer ON pin = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT 'Nation' AS geo_type, n_name AS geo_id, year, COUNT(*) AS n, CAST(SUM(cents) AS BIGINT) AS total FROM b GROUP BY n_name, year
UNION ALL SELECT 'Segment', seg, year, COUNT(*), CAST(SUM(cents) AS BIGINT) FROM b WHERE seg != '' GROUP BY seg, year""")
def by_geographies(t):
    rows = t.sale.join(t.customer, F.col("pin") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.withColumn("seg", F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.col("c_mktsegment")))
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("cents").alias("total")]
    return grouped.by_geographies(rows, {"Nation": "n_name", "Segment": "seg"}, ["year"], aggs)


@query("a16_stddev", "SELECT l_returnflag, ROUND(STDDEV_SAMP(l_quantity), 6) AS sd FROM lineitem GROUP BY l_returnflag")
def stddev(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.stddev_samp("l_quantity"), 6).alias("sd"))


@query("a17_code_contained", "SELECT pin, bool_or(substr(priority, 1, 1) = '5') AS has_five FROM sale GROUP BY pin")
def code_contained(t):
    return t.sale.groupBy("pin").agg(F.bool_or(F.substring("priority", 1, 1) == "5").alias("has_five"))


@query("a18_distinct_pairs", """
SELECT l_orderkey, COUNT(*) AS n FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey FROM lineitem) GROUP BY l_orderkey""")
def distinct_pairs(t):
    return grouped.count_distinct_pairs(t.lineitem, ["l_orderkey"], ["l_partkey", "l_suppkey"], "n")


@query("a19_percent_complete", """
SELECT year, ROUND(COUNT(CASE WHEN status = 'F' THEN 1 END) / CAST(COUNT(*) AS DOUBLE), 4) AS pct FROM sale GROUP BY year""")
def percent_complete(t):
    return t.sale.groupBy("year").agg(
        grouped.percent_complete(F.count_if(F.col("status") == "F"), F.count(F.lit(1))).alias("pct")
    )


@query("a20_year_span", """
SELECT pin, CASE WHEN MIN(year) = MAX(year) THEN MIN(year) ELSE MIN(year) || ' and ' || MAX(year) END AS span FROM sale GROUP BY pin""")
def year_span(t):
    return t.sale.groupBy("pin").agg(grouped.year_span_label(F.min("year"), F.max("year")).alias("span"))


@query("a22_quantile_trim", """
WITH q AS (SELECT status, quantile_cont(CAST(cents AS DOUBLE), 0.05) AS lo, quantile_cont(CAST(cents AS DOUBLE), 0.95) AS hi FROM sale GROUP BY status)
SELECT s.status, salekey FROM sale s JOIN q ON s.status = q.status WHERE cents > lo AND cents < hi""")
def quantile_trim(t):
    return quantiles.trim_between(t.sale, ["status"], "cents").select("status", "salekey")


@query("a22_exact_quantiles", """
SELECT brand, ROUND(quantile_cont(fmv / sale_price, 0.25), 8) AS q25, ROUND(quantile_cont(fmv / sale_price, 0.5), 8) AS q50,
 ROUND(quantile_cont(fmv / sale_price, 0.9), 8) AS q90 FROM ratio_row GROUP BY brand""")
def exact_quantiles(t):
    rows = t.ratio_row.withColumn("r", F.col("fmv") / F.col("sale_price"))
    out = quantiles.exact_quantiles(rows, ["brand"], "r", {"q25": 0.25, "q50": 0.5, "q90": 0.9})
    return out.select("brand", *[F.round(q, 8).alias(q) for q in ("q25", "q50", "q90")])


@query("a23_min_sample", """
SELECT pin, COUNT(*) AS n, CASE WHEN COUNT(*) >= 12 THEN ROUND(AVG(cents), 3) END AS mean FROM sale GROUP BY pin""")
def min_sample(t):
    return t.sale.groupBy("pin").agg(
        F.count(F.lit(1)).alias("n"), F.when(F.count(F.lit(1)) >= 12, F.round(F.avg("cents"), 3)).alias("mean")
    )


@query("a25_set_or_marker", """
SELECT pin, CASE WHEN COUNT(CASE WHEN cents > 40000000 THEN 1 END) = 0 THEN 'NULL' ELSE
 string_agg(DISTINCT CASE WHEN cents > 40000000 THEN status END, ',' ORDER BY CASE WHEN cents > 40000000 THEN status END) END AS codes FROM sale GROUP BY pin""")
def set_or_marker(t):
    out = grouped.filtered_set_or_marker(t.sale, ["pin"], "status", F.col("cents") > 40000000, "codes")
    return out.select("pin", F.array_join("codes", ",").alias("codes"))


@query("m11_row_count_by_group", "SELECT priority, COUNT(*) AS count FROM sale WHERE status = 'F' GROUP BY priority ORDER BY priority DESC")
def row_count_by_group(t):
    return grouped.row_count_by_group(t.sale, "priority", ascending=False, where=F.col("status") == "F")
