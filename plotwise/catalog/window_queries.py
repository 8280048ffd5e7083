"""Window-like operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.catalog.registry import query
from plotwise.operators import grouped, ordered, reshape



# Events of one user are spread over days.
def day():
    return F.to_date("ts")



@query("w01_dedup", """
SELECT pin, sale_date, salekey, cents FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY pin, sale_date ORDER BY cents DESC, salekey) AS r FROM sale) WHERE r = 1""")
def dedup(t):
    order = [F.col("cents").desc(), F.col("salekey")]
    return ordered.dedup_by_priority(t.sale, ["pin", "sale_date"], order).select("pin", "sale_date", "salekey", "cents")


@query("w02_boolean_partition", """
SELECT pin, salekey, cents FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY pin, year, cents > 20000000 ORDER BY sale_date DESC, salekey) AS r FROM sale) WHERE r = 1""")
def boolean_partition(t):
    order = [F.col("sale_date").desc(), F.col("salekey")]
    out = ordered.dedup_by_priority(t.sale, ["pin", "year", F.col("cents") > 20000000], order)
    return out.select("pin", "salekey", "cents")


@query("w03_priority_nulls_last", """
SELECT pin, salekey FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY pin, year ORDER BY CASE status WHEN 'F' THEN 1 WHEN 'O' THEN 2 END ASC NULLS LAST,
 CASE WHEN cents > 20000000 THEN sale_date END DESC NULLS LAST, salekey) AS r FROM sale) WHERE r = 1""")
def priority_nulls_last(t):
    stage = F.when(F.col("status") == "F", 1).when(F.col("status") == "O", 2)
    late = F.when(F.col("cents") > 20000000, F.col("sale_date"))
    order = [stage.asc_nulls_last(), late.desc_nulls_last(), F.col("salekey")]
    return ordered.dedup_by_priority(t.sale, ["pin", "year"], order).select("pin", "salekey")


@query("w04_rank_top", """
SELECT pin, cents, rnk FROM (SELECT pin, cents, CAST(RANK() OVER (PARTITION BY pin % 25 ORDER BY n DESC) AS INT) AS rnk FROM parcel_year) WHERE rnk <= 5""")
def rank_top(t):
    out = ordered.top_with_ties(t.parcel_year, [F.col("pin") % 25], [F.col("n").desc()], 5, "rnk")
    return out.select("pin", "cents", "rnk")


@query("w05_distinct_in_window", """
SELECT salekey, DENSE_RANK() OVER (PARTITION BY pin ORDER BY status) + DENSE_RANK() OVER (PARTITION BY pin ORDER BY status DESC) - 1 AS n FROM sale""")
def distinct_in_window(t):
    return grouped.distinct_in_group(t.sale, ["pin"], "status", "n").select("salekey", "n")


LAGS = {"back_1": ("value", 1), "back_2": ("value", 2), "back_3": ("value", 3)}


@query("w06_lag", """
SELECT event_id, LAG(value, 1) OVER w AS back_1, LAG(value, 2) OVER w AS back_2, LAG(value, 3) OVER w AS back_3
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def lag(t):
    out = ordered.lag_values(t.events, ["user_id"], ["ts", "event_id"], LAGS, day())
    return out.select("event_id", *LAGS)


@query("w07_lag_ignore_nulls", """
SELECT event_id, LAG(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM
(SELECT *, CASE WHEN event_type = 'purchase' THEN value END AS v FROM events)""")
def lag_ignore_nulls(t):
    rows = t.events.withColumn("v", F.when(F.col("event_type") == "purchase", F.col("value")))
    return ordered.lag_known(rows, ["user_id"], ["ts", "event_id"], {"v": "before"}, day()).select("event_id", "before")


@query("w08_fill_forward", """
SELECT event_id, LAST_VALUE(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS filled FROM
(SELECT *, CASE WHEN event_type = 'signup' THEN value END AS v FROM events)""")
def fill_forward(t):
    rows = t.events.withColumn("v", F.when(F.col("event_type") == "signup", F.col("value")))
    return ordered.fill_forward(rows, ["user_id"], ["ts", "event_id"], {"v": "filled"}, day()).select("event_id", "filled")


@query("w09_fill_backward", """
SELECT event_id, LAST_VALUE(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS filled FROM
(SELECT *, CASE WHEN event_type = 'error' THEN value END AS v FROM events)""")
def fill_backward(t):
    rows = t.events.withColumn("v", F.when(F.col("event_type") == "error", F.col("value")))
    return ordered.fill_backward(rows, ["user_id"], ["ts", "event_id"], {"v": "filled"}, day()).select("event_id", "filled")


@query("w10_first_value", """
SELECT event_id, FIRST_VALUE(v) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS first_v FROM
(SELECT *, CASE WHEN event_id % 3 != 0 THEN value END AS v FROM events)""")
def first_value(t):
    rows = t.events.withColumn("v", F.when(F.col("event_id") % 3 != 0, F.col("value")))
    return grouped.first_in_group(rows, ["user_id"], ["ts", "event_id"], {"v": "first_v"}).select("event_id", "first_v")


@query("w11_group_values", """
SELECT l_orderkey, l_linenumber, l_partkey, COUNT(*) OVER w AS n, CAST(SUM(CAST(l_quantity AS BIGINT)) OVER w AS BIGINT) AS qty, MIN(l_discount) OVER w AS lo, MAX(l_tax) OVER w AS hi
FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)""")
def group_values(t):
    aggs = [
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("qty"),
        F.min("l_discount").alias("lo"), F.max("l_tax").alias("hi"),
    ]
    out = grouped.with_group_values(t.lineitem, ["l_orderkey"], aggs)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "n", "qty", "lo", "hi")


@query("w12_share_of_total", """
SELECT pin, year, ROUND(cents / NULLIF(SUM(cents) OVER (PARTITION BY year), 0), 12) AS share FROM parcel_year""")
def share_of_total(t):
    out = grouped.share_of_total(t.parcel_year, ["year"], "cents", "share")
    return out.select("pin", "year", F.round("share", 12).alias("share"))


@query("w13_window_over_aggregate", """
SELECT year, status, COUNT(*) AS n, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY year), 8) AS share,
 COUNT(*) - LAG(COUNT(*)) OVER (PARTITION BY status ORDER BY year) AS drift FROM sale GROUP BY year, status""")
def window_over_aggregate(t):
    counts = t.sale.groupBy("year", "status").agg(F.count(F.lit(1)).alias("n"))
    shared = grouped.share_of_total(counts, ["year"], "n", "share")
    out = ordered.lag_values(shared, ["status"], ["year"], {"before": ("n", 1)})
    drift = (F.col("n") - F.col("before")).alias("drift")
    return out.select("year", "status", "n", F.round("share", 8).alias("share"), drift)


@query("w14_zscore", """
SELECT p_partkey, ROUND((p_retailprice - AVG(p_retailprice) OVER w) / NULLIF(STDDEV_SAMP(p_retailprice) OVER w, 0), 6) AS z FROM part WINDOW w AS (PARTITION BY p_brand)""")
def zscore(t):
    return grouped.zscore(t.part, ["p_brand"], "p_retailprice", "z").select("p_partkey", F.round("z", 6).alias("z"))


STREAK = """
WITH f AS (SELECT {id} AS id, {key} AS k, {order}, CASE WHEN {flag} THEN 1 ELSE 0 END AS a FROM {t}),
g AS (SELECT *, SUM(1 - a) OVER (PARTITION BY k ORDER BY {order}) AS grp FROM f)
SELECT id, CAST(SUM(a) OVER (PARTITION BY k, grp ORDER BY {order}) AS BIGINT) AS run FROM g"""


@query("w15_streak_events", STREAK.format(id="event_id", key="user_id", order="ts, event_id", flag="value > 10", t="events"))
def streak_events(t):
    out = ordered.streak(t.events, ["user_id"], ["ts", "event_id"], F.col("value") > 10, "run", day())
    return out.select(F.col("event_id").alias("id"), "run")


@query("w15_streak_years", STREAK.format(id="pin * 10000 + CAST(year AS BIGINT)", key="pin", order="year", flag="exe = 1", t="parcel_year"))
def streak_years(t):
    out = ordered.streak(t.parcel_year, ["pin"], ["year"], F.col("exe") == 1, "run")
    return out.select((F.col("pin") * 10000 + F.col("year").cast("long")).alias("id"), "run")


@query("w16_repeat_within_year", """
SELECT salekey, COALESCE(date_diff('day', LAG(sale_date) OVER (PARTITION BY pin, priority ORDER BY sale_date, salekey), sale_date) <= 365, FALSE) AS repeated FROM sale""")
def repeat_within_year(t):
    chunk = F.year("sale_date")
    out = ordered.repeat_within(t.sale, ["pin", "priority"], "sale_date", ["salekey"], 365, "repeated", chunk)
    return out.select("salekey", "repeated")


@query("w17_recent_change", """
WITH l AS (SELECT pin, year, exe AS e0, LAG(exe, 1) OVER w AS e1, LAG(exe, 2) OVER w AS e2, LAG(exe, 3) OVER w AS e3 FROM parcel_year WINDOW w AS (PARTITION BY pin ORDER BY year))
SELECT pin, year, COALESCE(e0 = 1 AND e1 != 1, FALSE) OR COALESCE(e1 = 1 AND e2 != 1, FALSE) OR COALESCE(e2 = 1 AND e3 != 1, FALSE) AS changed FROM l""")
def recent_change(t):
    return ordered.recent_change(t.parcel_year, ["pin"], ["year"], "exe", 1, 3, "changed").select("pin", "year", "changed")


@query("w18_largest_member", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey) = 1 AS is_largest,
 CAST(SUM(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_orderkey) AS BIGINT) AS total FROM lineitem""")
def largest_member(t):
    rank = F.struct(-F.col("l_extendedprice"), "l_linenumber", "l_partkey")
    aggs = [F.min(rank).alias("_top"), F.sum(F.col("l_quantity").cast("long")).alias("total")]
    out = grouped.with_group_values(t.lineitem, ["l_orderkey"], aggs)
    mine = F.struct((-F.col("l_extendedprice")).alias("col1"), "l_linenumber", "l_partkey")
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", (mine == F.col("_top")).alias("is_largest"), "total"
    )


@query("w19_phase_lag", """
SELECT pin, year, stage_num, v, LAG(v) OVER (PARTITION BY pin ORDER BY year, stage_num) AS before FROM (
 SELECT pin, year, 1 AS stage_num, cents AS v FROM parcel_year UNION ALL SELECT pin, year, 2, cents + n FROM parcel_year)""")
def phase_lag(t):
    wide = t.parcel_year.withColumn("later", F.col("cents") + F.col("n"))
    stages = {"mailed": {"stage_num": 1}, "certified": {"stage_num": 2}}
    rows = reshape.wide_to_long(wide, ["pin", "year"], stages, {"v": ["cents", "later"]}).drop("stage")
    return ordered.lag_values(rows, ["pin"], ["year", "stage_num"], {"before": ("v", 1)})


@query("w20_repeat_across_sources", """
WITH u AS (SELECT salekey AS id, pin, priority, sale_date, 'a' AS source FROM sale WHERE status = 'F' UNION ALL
 SELECT salekey, pin, priority, sale_date, 'b' FROM sale WHERE status = 'P')
SELECT id, source, COALESCE(date_diff('day', LAG(sale_date) OVER (PARTITION BY pin, priority ORDER BY sale_date, id), sale_date) <= 365, FALSE) AS repeated FROM u""")
def repeat_across_sources(t):
    def part(status, source):
        return t.sale.where(F.col("status") == status).select(
            F.col("salekey").alias("id"), "pin", "priority", "sale_date", F.lit(source).alias("source")
        )

    both = part("F", "a").unionByName(part("P", "b"))
    out = ordered.repeat_within(both, ["pin", "priority"], "sale_date", ["id"], 365, "repeated", F.year("sale_date"))
    return out.select("id", "source", "repeated")
