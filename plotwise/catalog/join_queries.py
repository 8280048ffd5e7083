"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.catalog.registry import query
from plotwise.functions import geometry as geo
from plotwise.operators import joins, spatial, yearfill


def zones(t, keep_year: bool = False):
    cols = ["zone_id", "zone_name", *(["year"] if keep_year else [])]
    return t.zone.select(*cols, geo.rectangle(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("rings"))


@query("j01_inner", """
SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'""")
def inner(t):
    final = t.orders.where("o_orderstatus = 'F'")
    return final.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "o_totalprice")


@query("j02_left_filtered", """
SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 400000""")
def left_filtered(t):
    large = t.orders.where("o_totalprice > 400000")
    return t.customer.join(large, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey")


@query("j03_full_coalesced", """
SELECT COALESCE(a.pin, b.pin) AS pin, a.cents AS cents_a, b.cents AS cents_b, a.pin IS NOT NULL AS in_left, b.pin IS NOT NULL AS in_right
FROM (SELECT pin, cents FROM parcel_year WHERE year = '1997' AND exe = 1) a
FULL JOIN (SELECT pin, cents FROM parcel_year WHERE year = '1998' AND exe = 1) b ON a.pin = b.pin""")
def full_coalesced(t):
    def one(year, name):
        return t.parcel_year.where((F.col("year") == year) & (F.col("exe") == 1)).select("pin", F.col("cents").alias(name))

    return joins.full_coalesced(one("1997", "cents_a"), one("1998", "cents_b"), ["pin"])


@query("j04_unmatched_counts", """
SELECT COUNT(CASE WHEN b.pin IS NULL THEN 1 END) AS only_left, COUNT(CASE WHEN a.pin IS NULL THEN 1 END) AS only_right
FROM (SELECT pin FROM parcel_year WHERE year = '1997') a FULL JOIN (SELECT pin FROM parcel_year WHERE year = '1998') b
ON a.pin = b.pin WHERE a.pin IS NULL OR b.pin IS NULL""")
def unmatched_counts(t):
    years = t.parcel_year
    return joins.unmatched_counts(
        years.where("year = '1997'").select("pin"), years.where("year = '1998'").select("pin"), ["pin"]
    )


@query("j05_anti", """
SELECT c_custkey, c_name FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 300000) o
ON c_custkey = o_custkey WHERE o_custkey IS NULL""")
def anti(t):
    large = t.orders.where("o_totalprice > 300000")
    return t.customer.join(large, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("j06_semi_or_latest", """
SELECT pin, year, cents FROM parcel_year p WHERE EXISTS (SELECT 1 FROM sale s WHERE s.pin = p.pin AND s.year = p.year AND s.status = 'F')
OR year = (SELECT MAX(year) FROM parcel_year)""")
def semi_or_latest(t):
    return joins.trim_universe(t.parcel_year, t.sale.where("status = 'F'"), ["pin", "year"], "year").select("pin", "year", "cents")


@query("j07_scaffold", """
SELECT pin, year, stage_name, stage_num FROM parcel_year CROSS JOIN
(VALUES ('mailed', 1), ('certified', 2), ('appealed', 3)) s(stage_name, stage_num)""")
def scaffold(t):
    stages = [("mailed", 1), ("certified", 2), ("appealed", 3)]
    return joins.scaffold(t.parcel_year.select("pin", "year"), stages, ["stage_name", "stage_num"])


@query("j08_listed_or_equal", """
SELECT l_orderkey, l_linenumber, s_suppkey, l_returnflag AS flag FROM lineitem
JOIN (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'A' ELSE 'R' END AS main,
 CASE WHEN s_suppkey % 3 = 0 THEN ['N', 'A'] ELSE ['N'] END AS more FROM supplier) s
ON l_suppkey = s_suppkey AND (l_returnflag = main OR list_contains(more, l_returnflag))""")
def listed_or_equal(t):
    left = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("s_suppkey"), F.col("l_returnflag").alias("flag"))
    right = t.supplier.select(
        "s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, "A").otherwise("R").alias("main"),
        F.when(F.col("s_suppkey") % 3 == 0, F.array(F.lit("N"), F.lit("A"))).otherwise(F.array(F.lit("N"))).alias("more"),
    )
    out = joins.listed_or_equal_join(left, right, ["s_suppkey"], "flag", "more", "main")
    return out.select("l_orderkey", "l_linenumber", "s_suppkey", "flag")


@query("j09_lagged_year", """
SELECT s.salekey, s.year, p.cents AS value_before FROM sale s LEFT JOIN parcel_year p
ON s.pin = p.pin AND CAST(s.year AS INT) = CAST(p.year AS INT) + 1""")
def lagged_year(t):
    values = t.parcel_year.select("pin", "year", F.col("cents").alias("value_before"))
    return joins.lag_join(t.sale, values, ["pin"], "year", 1).select("salekey", "year", "value_before")


@query("j10_prior_year", """
SELECT a.pin, a.year, a.cents, b.cents AS prior_cents FROM parcel_year a JOIN parcel_year b
ON a.pin = b.pin AND CAST(a.year AS INT) - 1 = CAST(b.year AS INT)""")
def prior_year(t):
    prior = t.parcel_year.select("pin", "year", F.col("cents").alias("prior_cents"))
    return joins.lag_join(t.parcel_year, prior, ["pin"], "year", 1, "inner").select("pin", "year", "cents", "prior_cents")


TRAILING = """
SELECT p.pin, p.year, COUNT(s.salekey) AS n_events, CAST(SUM(s.cents) AS BIGINT) AS cents_events FROM parcel_year p
JOIN sale s ON p.pin = s.pin AND CAST(s.year AS INT) BETWEEN CAST(p.year AS INT) - {n} AND CAST(p.year AS INT) AND s.status = '{s}'
GROUP BY p.pin, p.year"""


def _trailing(t, status, n):
    events = t.sale.where(F.col("status") == status).select("pin", "year", "cents")
    # One row per parcel and year before years are copied.
    yearly = events.groupBy("pin", "year").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))
    aggs = [F.sum("n").alias("n_events"), F.sum("cents").alias("cents_events")]
    out = joins.trailing_years_join(t.parcel_year.select("pin", "year"), yearly, ["pin"], "year", n, aggs)
    return out.where("n_events IS NOT NULL")


@query("j11_trailing_range", TRAILING.format(n=5, s="F"))
def trailing_range(t):
    return _trailing(t, "F", 5)


@query("j12_trailing_count", TRAILING.format(n=3, s="P"))
def trailing_count(t):
    return _trailing(t, "P", 3)


@query("j13_clamp_year", """
SELECT a.pin, a.year, b.source_year, b.v FROM parcel_year a LEFT JOIN
(SELECT pin, year AS source_year, cents AS v FROM parcel_year WHERE year <= '1999') b ON a.pin = b.pin AND
 b.source_year = CASE WHEN a.year > '1999' THEN '1999' ELSE a.year END WHERE b.v IS NOT NULL""")
def clamp_year(t):
    old = t.parcel_year.where("year <= '1999'").select("pin", "year", F.col("cents").alias("v"))
    out = joins.clamp_year_join(t.parcel_year.select("pin", "year"), old, ["pin"], "year")
    return out.where("v IS NOT NULL").select("pin", "year", "source_year", "v")


def _asof_sql(direction):
    bound, pick = ("<=", "MAX") if direction == "backward" else (">=", "MIN")
    return f"""
WITH layer AS (SELECT n_nationkey AS nation, CASE n_nationkey % 3 WHEN 0 THEN '1996' WHEN 1 THEN '1998' ELSE '2000' END AS year,
 n_name AS zone FROM nation),
walk AS (SELECT y.year, {pick}(l.year) AS source_year FROM (SELECT DISTINCT year FROM sale) y JOIN layer l ON l.year {bound} y.year GROUP BY y.year)
SELECT s.salekey, s.year, j.source_year, j.zone FROM (SELECT salekey, year, pin % 25 AS nation FROM sale) s
LEFT JOIN (SELECT walk.year, walk.source_year, l.nation, l.zone FROM walk JOIN layer l ON l.year = walk.source_year) j
ON s.year = j.year AND s.nation = j.nation"""


def _asof(t, direction):
    year = F.when(F.col("n_nationkey") % 3 == 0, "1996").when(F.col("n_nationkey") % 3 == 1, "1998").otherwise("2000")
    layer = t.nation.select(F.col("n_nationkey").cast("long").alias("nation"), year.alias("year"), F.col("n_name").alias("zone"))
    rows = t.sale.select("salekey", "year", (F.col("pin") % 25).alias("nation"))
    out = joins.asof_join(rows, layer, ["nation"], "year", direction)
    return out.select("salekey", "year", "source_year", "zone")


@query("j14_asof_backward", _asof_sql("backward"))
def asof_backward(t):
    return _asof(t, "backward")


@query("j15_asof_forward", _asof_sql("forward"))
def asof_forward(t):
    return _asof(t, "forward")


@query("j16_upto_year", """
SELECT a.pin, a.year, b.year AS source_year, b.cents AS cents_then FROM parcel_year a JOIN parcel_year b
ON a.pin = b.pin AND b.year <= a.year""")
def upto_year(t):
    then = t.parcel_year.select("pin", "year", F.col("cents").alias("cents_then"))
    out = joins.upto_year_join(t.parcel_year.select("pin", "year"), then, ["pin"])
    return out.select("pin", "year", "source_year", "cents_then")


@query("j17_wildcard_member", """
WITH runs AS (SELECT n_nationkey AS run_id, CASE WHEN n_nationkey % 4 = 0 THEN ['all'] ELSE
 ['FURNITURE', CASE WHEN n_nationkey % 2 = 0 THEN 'MACHINERY' ELSE 'BUILDING' END] END AS towns FROM nation)
SELECT c_custkey, run_id, c_mktsegment AS town FROM customer JOIN (SELECT run_id, unnest(towns) AS town FROM runs) r
ON c_nationkey = run_id AND (c_mktsegment = r.town OR r.town = 'all')""")
def wildcard_member(t):
    two = F.array(F.lit("FURNITURE"), F.when(F.col("n_nationkey") % 2 == 0, "MACHINERY").otherwise("BUILDING"))
    runs = t.nation.select(
        F.col("n_nationkey").alias("run_id"),
        F.when(F.col("n_nationkey") % 4 == 0, F.array(F.lit("all"))).otherwise(two).alias("towns"),
    )
    rows = t.customer.select("c_custkey", F.col("c_nationkey").alias("run_id"), F.col("c_mktsegment").alias("town"))
    return joins.explode_join(rows, runs, ["run_id"], "towns", "town").select("c_custkey", "run_id", "town")


@query("j18_latest_version", """
SELECT salekey, s.pin, cents FROM sale s JOIN (SELECT pin, MAX(year) AS top FROM sale GROUP BY pin) m ON s.pin = m.pin AND s.year = m.top""")
def latest_version(t):
    return joins.latest_version(t.sale, ["pin"], "year").select("salekey", "pin", "cents")


@query("j19_point_in_polygon", """
SELECT pin, zone_id, zone_name FROM parcel_point LEFT JOIN zone ON x > x0 AND x < x1 AND y > y0 AND y < y1""")
def point_in_polygon(t):
    out = spatial.points_in_polygons(t.parcel_point, zones(t), ["zone_id", "zone_name"], 500.0)
    return out.select("pin", "zone_id", "zone_name")


@query("j20_within_radius", """
SELECT pin, stop_id, p.year FROM parcel_point p JOIN stop_point s ON p.year = s.year
AND (p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y) <= 1000000""")
def within_radius(t):
    out = spatial.within_radius(t.parcel_point, t.stop_point, 1000.0, {"stop_id": "stop_id"}, ["year"])
    return out.select("pin", "stop_id", "year")


@query("j20_count_within_radius", """
SELECT p.pin, COALESCE(c.n, 0) AS n, COALESCE(c.weight, 0) AS weight FROM parcel_point p LEFT JOIN (SELECT pin, COUNT(*) AS n,
 CAST(SUM(stop_id) AS BIGINT) AS weight FROM parcel_point p JOIN stop_point s ON p.year = s.year
 AND (p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y) <= 4000000 GROUP BY pin) c ON p.pin = c.pin""")
def count_within_radius(t):
    measures = {"n": F.lit(1).cast("long"), "weight": F.col("stop_id")}
    out = spatial.count_within_radius(t.parcel_point, t.stop_point, 2000.0, measures, ["year"])
    return out.select("pin", "n", "weight")


@query("j21_nearest", """
SELECT pin, stop_id, ROUND(SQRT(d2), 4) AS dist FROM (SELECT pin, stop_id, d2, ROW_NUMBER() OVER (PARTITION BY pin ORDER BY d2, stop_id) AS r
FROM (SELECT p.pin, s.stop_id, (p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y) AS d2 FROM parcel_point p JOIN stop_point s ON p.year = s.year)) WHERE r = 1""")
def nearest(t):
    stops = spatial.point_segments(t.stop_point).drop("x", "y")
    out = spatial.nearest(t.parcel_point, stops, ["stop_id"], ["year"])
    return out.select("pin", "stop_id", F.round("dist", 4).alias("dist"))


KNN = """
SELECT pin, neighbour, ROUND(SQRT(d2), 4) AS dist, CAST(r AS INT) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY pin ORDER BY d2, neighbour) AS r,
 COUNT(*) OVER (PARTITION BY pin) AS c FROM (SELECT a.pin, b.pin AS neighbour, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2
 FROM parcel_point a JOIN parcel_point b ON a.year = b.year AND a.x != b.x AND a.y != b.y) WHERE d2 <= {r2}) WHERE r <= 3"""


@query("j22_knn", KNN.format(r2=1500 * 1500))
def knn(t):
    out = spatial.knn(t.parcel_point, t.parcel_point, "pin", 3, 1500.0, ["year"])
    return out.select("pin", "neighbour", F.round("dist", 4).alias("dist"), "rank")


@query("j23_knn_escalating", KNN.format(r2=20000 * 20000))
def knn_escalating(t):
    # The last radius spans all points, so every parcel gets its three neighbours.
    out = spatial.knn_escalating(t.parcel_point, t.parcel_point, "pin", 3, [500.0, 2500.0, 20000.0], ["year"])
    return out.select("pin", "neighbour", F.round("dist", 4).alias("dist"), "rank")


@query("j24_neighbour_fill", """
WITH base AS (SELECT c_custkey AS pin, '2024' AS year, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS v,
 (c_custkey + 1) AS n1, CAST(c_custkey % 900 AS DOUBLE) AS d1, (c_custkey + 2) AS n2, CAST(c_custkey % 700 AS DOUBLE) AS d2 FROM customer)
SELECT a.pin, COALESCE(a.v, b.v, c.v) AS v FROM base a LEFT JOIN base b ON a.n1 = b.pin AND a.year = b.year AND a.d1 <= 500
LEFT JOIN base c ON a.n2 = c.pin AND a.year = c.year AND a.d2 <= 500""")
def neighbour_fill(t):
    key = F.col("c_custkey")
    base = t.customer.select(
        key.cast("string").alias("pin"), F.lit("2024").alias("year"), F.when(key % 3 != 0, F.col("c_acctbal")).alias("v"),
        (key + 1).cast("string").alias("n1"), (key % 900).cast("double").alias("d1"),
        (key + 2).cast("string").alias("n2"), (key % 700).cast("double").alias("d2"),
    )
    out = joins.neighbour_fill(base, ["pin"], [("n1", "d1"), ("n2", "d2")], "year", ["v"], 500.0)
    return out.select(F.col("pin").cast("long").alias("pin"), "v")


@query("j25_most_recent_boundary", """
SELECT pin, z.zone_id AS zone_id, q.quad AS quad FROM parcel_point LEFT JOIN (SELECT * FROM zone WHERE year = (SELECT MAX(year) FROM zone)) z
 ON x > x0 AND x < x1 AND y > y0 AND y < y1 LEFT JOIN (SELECT r_regionkey AS quad, r_regionkey * 2000 - 0.5 AS a FROM region WHERE r_regionkey >= 2) q
 ON x > q.a AND x < q.a + 2000 AND y > -0.5 AND y < 11999.5""")
def most_recent_boundary(t):
    west = F.col("r_regionkey") * 2000 - 0.5
    quads = t.region.select(
        F.col("r_regionkey").alias("quad"), F.when(F.col("r_regionkey") < 2, "2010").otherwise("2012").alias("year"),
        geo.rectangle(west, F.lit(-0.5), west + 2000, F.lit(11999.5)).alias("rings"),
    )
    layers = {"zone": (zones(t, keep_year=True), ["zone_id"]), "quad": (quads, ["quad"])}
    return spatial.most_recent_boundaries(t.parcel_point, layers, 1000.0).select("pin", "zone_id", "quad")


@query("j26_role_joins", """
SELECT l_orderkey, l_linenumber, a.n_name AS buyer_nation, b.n_name AS seller_nation FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation a ON c_nationkey = a.n_nationkey
LEFT JOIN nation b ON s_nationkey = b.n_nationkey""")
def role_joins(t):
    rows = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    roles = {"c_nationkey": "buyer_nation", "s_nationkey": "seller_nation"}
    return joins.role_joins(rows, t.nation, "n_nationkey", "n_name", roles).select(
        "l_orderkey", "l_linenumber", "buyer_nation", "seller_nation"
    )


@query("m06_year_fill_crosswalk", """
WITH layer AS (SELECT DISTINCT year, CASE WHEN year >= '1998' THEN '1997' END AS a_data_year, year AS b_data_year FROM parcel_year WHERE year >= '1997'),
un AS (SELECT p.year, MAX(a_data_year) AS ad, MAX(CASE WHEN a_data_year IS NOT NULL THEN l.year END) AS af, MAX(b_data_year) AS bd,
 MAX(CASE WHEN b_data_year IS NOT NULL THEN l.year END) AS bf FROM (SELECT DISTINCT year FROM parcel_year) p LEFT JOIN layer l ON p.year = l.year GROUP BY p.year)
SELECT year, LAST_VALUE(af IGNORE NULLS) OVER w AS a_fill_year, LAST_VALUE(ad IGNORE NULLS) OVER w AS a_data_year,
 LAST_VALUE(bf IGNORE NULLS) OVER w AS b_fill_year, LAST_VALUE(bd IGNORE NULLS) OVER w AS b_data_year FROM un WINDOW w AS (ORDER BY year DESC)""")
def year_fill_crosswalk(t):
    layer = t.parcel_year.where("year >= '1997'").select(
        "year", F.when(F.col("year") >= "1998", "1997").alias("a_data_year"), F.col("year").alias("b_data_year")
    )
    return yearfill.year_fill_crosswalk(t.parcel_year, {"layer": (layer, ["a", "b"])})


@query("m06_fill_join", """
WITH layer AS (SELECT pin, year, cents AS a FROM parcel_year WHERE year >= '1998')
SELECT p.pin, p.year, CASE WHEN p.year < '1998' THEN '1998' ELSE p.year END AS a_fill_year, l.a FROM parcel_year p LEFT JOIN layer l
ON p.pin = l.pin AND l.year = CASE WHEN p.year < '1998' THEN '1998' ELSE p.year END""")
def fill_join(t):
    layer = t.parcel_year.where("year >= '1998'").select("pin", "year", F.col("cents").alias("a"), F.col("year").alias("a_data_year"))
    crosswalk = yearfill.year_fill_crosswalk(t.parcel_year, {"layer": (layer, ["a"])})
    out = yearfill.fill_join(t.parcel_year.select("pin", "year"), crosswalk, {"layer": (layer, {"a": ["a"]})}, key="pin")
    return out.select("pin", "year", "a_fill_year", "a")
