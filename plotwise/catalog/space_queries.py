"""Geometry, ratio statistics and the graph job."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.catalog.join_queries import zones
from plotwise.catalog.registry import query
from plotwise.functions import geometry as geo
from plotwise.functions import projection
from plotwise.operators import dissolve as dissolving
from plotwise.operators import filling, network, ratio, shapes, spatial

# Parcels as right-angled quadrilaterals around their point; widths depend on the key.


def parcels(t):
    x, y = F.col("x"), F.col("y")
    skew = F.col("pin") % 3
    half = F.col("pin") % 7 + 3
    ring = geo.polygon((x - half, y - half), (x + half, y - half), (x + half + skew, y + half), (x - half, y + half))
    return t.parcel_point.withColumn("rings", ring)


@query("g01_points", "SELECT pin, x, y, year FROM parcel_point")
def points(t):
    return t.parcel_point.select("pin", "x", "y", "year")


@query("g02_wkb", """
SELECT pin, x, y, (pin % 7 + 3) * 2.0 * (2.0 * (pin % 7 + 3) + (pin % 3) / 2.0) AS area, 5 AS n FROM parcel_point""")
def wkb(t):
    rows = parcels(t).select("pin", geo.wkb_polygon(F.col("rings")).alias("shape"), geo.wkb_point(F.col("x"), F.col("y")).alias("spot"))
    back = rows.select("pin", geo.rings_from_wkb("shape").alias("rings"), geo.rings_from_wkb("spot").alias("spot"))
    return back.select(
        "pin", F.col("spot")[0][0]["x"].alias("x"), F.col("spot")[0][0]["y"].alias("y"),
        geo.ring_area(F.col("rings")).alias("area"), F.size(F.col("rings")[0]).alias("n"),
    )


@query("g03_contains", """
SELECT pin, zone_id FROM parcel_point JOIN zone ON x > x0 AND x < x1 AND y > y0 AND y < y1 WHERE x + y < x0 + y0 + 2000""")
def contains(t):
    # The lower-left half of each zone: a triangle.
    half = t.zone.select("zone_id", geo.polygon((F.col("x0"), F.col("y0")), (F.col("x0") + 2000, F.col("y0")), (F.col("x0"), F.col("y0") + 2000)).alias("rings"))
    return spatial.points_in_polygons(t.parcel_point, half, ["zone_id"], 250.0, "inner").select("pin", "zone_id")


@query("g05_distance", """
SELECT pin, ROUND(SQRT((x - 5000) * (x - 5000) + (y - 4000) * (y - 4000)), 6) AS dist FROM parcel_point""")
def distance(t):
    d = geo.distance(F.col("x"), F.col("y"), F.lit(5000.0), F.lit(4000.0))
    return t.parcel_point.select("pin", F.round(d, 6).alias("dist"))


ROAD_DIST = """
WITH d AS (SELECT pin, road_name, CASE WHEN t <= 0 THEN (x - x1) * (x - x1) + (y - y1) * (y - y1) WHEN t >= 1 THEN (x - x2) * (x - x2) + (y - y2) * (y - y2)
 ELSE (x - x1 - t * (x2 - x1)) * (x - x1 - t * (x2 - x1)) + (y - y1 - t * (y2 - y1)) * (y - y1 - t * (y2 - y1)) END AS d2 FROM
 (SELECT *, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS t FROM parcel_point CROSS JOIN road))
SELECT pin, {cols}ROUND(SQRT(MIN(d2)), 4) AS dist FROM d GROUP BY pin"""


@query("g06_nearest_line", ROAD_DIST.format(cols=""))
def nearest_line(t):
    lines = t.road.select("road_id", "x1", "y1", "x2", "y2")
    return spatial.nearest(t.parcel_point, lines, ["road_id"]).select("pin", F.round("dist", 4).alias("dist"))


@query("g07_nearest_feature", ROAD_DIST.format(cols="arg_min(road_name, (CAST(d2 AS DOUBLE), road_name)) AS road_name, "))
def nearest_feature(t):
    lines = t.road.select("road_name", "x1", "y1", "x2", "y2")
    out = spatial.nearest(t.parcel_point, lines, ["road_name"])
    return out.select("pin", "road_name", F.round("dist", 4).alias("dist"))


@query("g06_nearest_area", """
SELECT pin, ROUND(MIN(SQRT(GREATEST(x0 - x, x - x1, 0) * GREATEST(x0 - x, x - x1, 0) + GREATEST(y0 - y, y - y1, 0) * GREATEST(y0 - y, y - y1, 0))), 6) AS dist
FROM parcel_point CROSS JOIN (SELECT * FROM zone WHERE zone_id % 6 = 1) GROUP BY pin""")
def nearest_area(t):
    some = zones(t).where("zone_id % 6 = 1")
    out = spatial.nearest_area(t.parcel_point, some, ["zone_id"], 500.0)
    return out.select("pin", F.round("dist", 6).alias("dist"))


@query("g08_area_filter", """
SELECT pin, area FROM (SELECT pin, (pin % 7 + 3) * 2.0 * (2.0 * (pin % 7 + 3) + (pin % 3) / 2.0) AS area FROM parcel_point) WHERE area >= 150""")
def area_filter(t):
    return parcels(t).select("pin", geo.ring_area(F.col("rings")).alias("area")).where("area >= 150")


@query("g09_noise", """
SELECT pin, ROUND(a, 6) AS north_dnl, ROUND(b, 6) AS south_dnl, ROUND(a + b + 50, 6) AS total_dnl FROM (SELECT pin,
 GREATEST(0, 10 * LOG(10, 0.00582564978995262 / (d1 * d1) / 1e-12)) AS a, GREATEST(0, 10 * LOG(10, 0.00297149980129393 / (d2 * d2) / 1e-12)) AS b FROM
 (SELECT pin, SQRT((x - 5000.5) * (x - 5000.5) + y * y) AS d1, SQRT((x - 2000.5) * (x - 2000.5) + y * y) AS d2 FROM parcel_point))""")
def noise(t):
    from plotwise.plans.proximity import AIRPORT_STRENGTH

    x, y, zero = F.col("x"), F.col("y"), F.lit(0.0)
    rows = t.parcel_point.withColumns({
        "d1": geo.distance(x, y, F.lit(5000.5), zero), "d2": geo.distance(x, y, F.lit(2000.5), zero),
    })
    levels = spatial.noise_decibels({"north": ("d1", AIRPORT_STRENGTH["ohare"]), "south": ("d2", AIRPORT_STRENGTH["midway"])})
    return rows.select("pin", *[F.round(c, 6).alias(n) for n, c in levels.items()])


@query("g10_shape_features", """
WITH s AS (SELECT pin, (pin % 7 + 3) * 2.0 AS w, pin % 3 AS k FROM parcel_point),
e AS (SELECT pin, w, k, SQRT(w * w + k * k) AS slant FROM s),
m AS (SELECT pin, w, k, slant, (w + slant + (w + k) + w) / 4 AS em FROM e)
SELECT pin, CAST(4 AS BIGINT) AS vertices, ROUND(SQRT(((w - em) * (w - em) * 2 + (slant - em) * (slant - em) + (w + k - em) * (w + k - em)) / 3), 6) AS edge_sd FROM m""")
def shape_features(t):
    out = shapes.shape_features(parcels(t))
    return out.select(
        "pin", F.col("shp_parcel_num_vertices").alias("vertices"), F.round("shp_parcel_edge_len_ft_sd", 6).alias("edge_sd")
    )


@query("g10_shape_rectangle")
def shape_rectangle(t):
    return shapes.shape_features(parcels(t)).drop("rings")


@query("g11_corner_lots")
def corner_lots(t):
    return shapes.corner_lots(parcels(t), t.road.select("x1", "y1", "x2", "y2"), "pin", 100.0, 200.0)


@query("g12_raster", """
SELECT pin, COALESCE(v, 52.5) AS noise FROM parcel_point LEFT JOIN (SELECT cx, cy, MAX(v) AS v FROM (SELECT CAST(FLOOR(x1 / 250) AS BIGINT) AS cx, CAST(FLOOR(y1 / 250) AS BIGINT) AS cy, speed AS v FROM road)
 GROUP BY cx, cy) ON CAST(FLOOR(x / 250) AS BIGINT) = cx AND CAST(FLOOR(y / 250) AS BIGINT) = cy""")
def raster(t):
    cells = t.road.groupBy(F.floor(F.col("x1") / 250).alias("cell_x"), F.floor(F.col("y1") / 250).alias("cell_y")).agg(F.max("speed").alias("noise"))
    return spatial.raster_lookup(t.parcel_point, cells, 250.0, "noise", 52.5).select("pin", "noise")


@query("g13_dissolve", """
SELECT n_regionkey AS region, arg_min(zone_name, zone_id) AS first_name, COUNT(*) AS num_parts, CAST(COUNT(*) * 4000000 AS DOUBLE) AS area
FROM zone JOIN nation ON zone_id = n_nationkey GROUP BY n_regionkey""")
def dissolve(t):
    rows = zones(t).join(t.nation, F.col("zone_id") == F.col("n_nationkey"))
    out = dissolving.dissolve(rows, ["n_regionkey"], ["zone_name"], "zone_id")
    return out.select(
        F.col("n_regionkey").alias("region"), F.col("zone_name").alias("first_name"), "num_parts",
        geo.ring_area(F.col("rings")).alias("area"),
    )


@query("g14_centroid", """
SELECT pin, ROUND(x + CASE WHEN k = 0 THEN 0 ELSE (w / 2 * w * 0 + (k * w / 2) * (w / 2 + k / 3.0)) / (w * w + k * w / 2) END, 6) AS cx,
 ROUND(y + CASE WHEN k = 0 THEN 0 ELSE ((k * w / 2) * (w / 6)) / (w * w + k * w / 2) END, 6) AS cy
FROM (SELECT pin, x, y, (pin % 7 + 3) * 2.0 AS w, pin % 3 AS k FROM parcel_point)""")
def centroid(t):
    out = parcels(t).withColumn("c", geo.centroid(F.col("rings")))
    return out.select("pin", F.round("c.x", 6).alias("cx"), F.round("c.y", 6).alias("cy"))


@query("g15_years_open", """
SELECT s_suppkey, y.year FROM supplier JOIN (SELECT DISTINCT year FROM sale) y ON CAST(1995 + s_suppkey % 7 AS VARCHAR) <= y.year""")
def years_open(t):
    from plotwise.plans.spatial_layers import expand_open_years

    places = t.supplier.select("s_suppkey", (1995 + F.col("s_suppkey") % 7).cast("string").alias("opened"))
    return expand_open_years(places, t.sale, "opened").select("s_suppkey", "year")


TRIM = """
WITH r AS (SELECT *, fmv / sale_price AS ratio FROM ratio_row WHERE fmv / sale_price > 0),
q AS (SELECT brand, quantile_cont(ratio, 0.05) AS lo, quantile_cont(ratio, 0.95) AS hi FROM r GROUP BY brand),
k AS (SELECT r.* FROM r JOIN q USING (brand) WHERE ratio > lo AND ratio < hi),
m AS (SELECT brand, median(ratio) AS med FROM k GROUP BY brand)
"""


@query("a21_ratio_points", TRIM + """
, p AS (SELECT brand, fmv, sale_price, ratio, med, ROW_NUMBER() OVER (PARTITION BY brand ORDER BY sale_price, fmv) AS rk FROM k JOIN m USING (brand))
SELECT brand, COUNT(*) AS n, ROUND(MAX(med), 8) AS med_ratio, ROUND(100 * AVG(ABS(ratio - med)) / MAX(med), 6) AS cod, ROUND(AVG(ratio) / (SUM(fmv) / SUM(sale_price)), 8) AS prd,
 ROUND(REGR_SLOPE((ratio - med) / med, LOG2((fmv / med + sale_price) / 2)), 8) AS prb,
 ROUND((2 * SUM(fmv * rk) / SUM(fmv) - (COUNT(*) + 1)) / (2 * SUM(sale_price * rk) / SUM(sale_price) - (COUNT(*) + 1)), 8) AS mki FROM p GROUP BY brand""")
def ratio_points(t):
    rows = t.ratio_row.withColumn("ratio", F.col("fmv") / F.col("sale_price")).where("ratio > 0")
    kept = ratio.trim_between(rows, ["brand"], "ratio")
    points = ratio.point_statistics(kept, ["brand"], "fmv", "sale_price", "ratio")
    out = points.join(ratio.kakwani_index(kept, ["brand"], "fmv", "sale_price"), "brand")
    digits = {"med_ratio": 8, "cod": 6, "prd": 8, "prb": 8, "mki": 8}
    return out.select("brand", "n", *[F.round(c, d).alias(c) for c, d in digits.items()])


@query("a21_ratio_statistics")
def ratio_statistics(t):
    return ratio.ratio_statistics(t.ratio_row, ["brand"], "fmv", "sale_price", nboot=300)


@query("a21_ratio_flags", TRIM + """
, a AS (SELECT brand, COUNT(*) AS sale_n, AVG(CASE WHEN ratio BETWEEN 0.98 AND 1.02 THEN 1.0 ELSE 0.0 END) AS share, AVG(ratio) AS mu, STDDEV_SAMP(ratio) AS sd,
 COUNT(CASE WHEN ABS(1 - ratio) <= 0.2 THEN 1 END) AS within_20_pct, COUNT(CASE WHEN ABS(1 - ratio) <= 0.05 THEN 1 END) AS within_05_pct FROM r GROUP BY brand),
b AS (SELECT brand, ratio, COUNT(*) AS c, LAG(ratio) OVER (PARTITION BY brand ORDER BY ratio) AS before FROM r GROUP BY brand, ratio),
jump AS (SELECT brand, MAX(c) AS c, (list(before ORDER BY c DESC, before))[1] AS place FROM b WHERE before IS NOT NULL GROUP BY brand),
p AS (SELECT brand, fmv, sale_price, ratio, med, ROW_NUMBER() OVER (PARTITION BY brand ORDER BY sale_price, fmv) AS rk FROM k JOIN m USING (brand)),
v AS (SELECT brand, COUNT(*) AS n, MAX(med) AS med, 100 * AVG(ABS(ratio - med)) / MAX(med) AS cod, AVG(ratio) / (SUM(fmv) / SUM(sale_price)) AS prd, REGR_SLOPE((ratio - med) / med, LOG2((fmv / med + sale_price) / 2)) AS prb,
 (2 * SUM(fmv * rk) / SUM(fmv) - (COUNT(*) + 1)) / (2 * SUM(sale_price * rk) / SUM(sale_price) - (COUNT(*) + 1)) AS mki FROM p GROUP BY brand),
x AS (SELECT *, CASE WHEN sd > 0 THEN list_sum(list_transform(range(401), lambda i: (CASE WHEN i IN (0, 400) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * EXP(-POW((0.98 + 0.0001 * i - mu) / sd, 2) / 2) / sd / SQRT(2 * PI()))) * 0.0001 / 3 END AS normal FROM a)
SELECT brand, sale_n, sale_n - COALESCE(n, 0) AS sales_excluded_n, COALESCE(n, 0) AS med_ratio_n, CASE WHEN n >= 2 THEN med BETWEEN 0.9 AND 1.1 END AS med_ratio_met, CASE WHEN n >= 20 THEN ROUND(cod, 6) END AS cod, CASE WHEN n >= 20 THEN cod BETWEEN 5 AND 15 END AS cod_met,
 CASE WHEN n >= 20 THEN prd BETWEEN 0.98 AND 1.03 END AS prd_met, CASE WHEN n >= 20 THEN prb BETWEEN -0.05 AND 0.05 END AS prb_met, CASE WHEN n >= 20 THEN ROUND(mki, 8) END AS mki, CASE WHEN n >= 20 THEN mki BETWEEN 0.95 AND 1.05 END AS mki_met,
 CASE WHEN n >= 20 THEN prb BETWEEN -0.05 AND 0.05 OR prd BETWEEN 0.98 AND 1.03 END AS vertical_equity_met,
 CASE WHEN sale_n >= 20 THEN COALESCE(jump.c / CAST(sale_n AS DOUBLE) > 0.03 AND place > 0.98 AND place < 1.02, FALSE) AND COALESCE(share > normal, FALSE) END AS is_sales_chased, within_20_pct, within_05_pct
FROM x LEFT JOIN v USING (brand) LEFT JOIN jump USING (brand)""")
def ratio_flags(t):
    # Point values, gates, accepted ranges and chasing; the bootstrap's limits are random and have tests of their own.
    out = ratio.ratio_statistics(t.ratio_row, ["brand"], "fmv", "sale_price", nboot=20)
    plain = ["sale_n", "sales_excluded_n", "med_ratio_n", "med_ratio_met", "cod_met", "prd_met", "prb_met", "mki_met", "vertical_equity_met", "is_sales_chased", "within_20_pct", "within_05_pct"]
    return out.select("brand", *plain, F.round("cod", 6).alias("cod"), F.round("mki", 8).alias("mki"))


@query("a24_within_tolerance", """
SELECT brand, COUNT(CASE WHEN ABS(1 - fmv / sale_price) <= 0.2 THEN 1 END) AS within_20_pct, COUNT(CASE WHEN ABS(1 - fmv / sale_price) <= 0.1 THEN 1 END) AS within_10_pct,
 COUNT(CASE WHEN ABS(1 - fmv / sale_price) <= 0.05 THEN 1 END) AS within_05_pct FROM ratio_row GROUP BY brand""")
def within_tolerance(t):
    rows = t.ratio_row.withColumn("r", F.col("fmv") / F.col("sale_price"))
    return rows.groupBy("brand").agg(*ratio.within_counts("r"))


@query("e18_most_complete", """
WITH s AS (SELECT p_partkey, p_brand, CASE WHEN p_size > 10 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END + 1 AS k FROM part)
SELECT p_brand, p_partkey FROM (SELECT *, RANK() OVER (PARTITION BY p_brand ORDER BY k DESC) AS r FROM s) WHERE r = 1""")
def most_complete(t):
    rows = t.part.select(
        "p_brand", "p_partkey", F.when(F.col("p_size") > 10, F.col("p_size")).alias("a"), F.when(F.col("p_partkey") % 3 == 0, F.lit("x")).alias("b"),
        F.col("p_name").alias("c"),
    )
    return filling.most_complete(rows, ["p_brand"], ["a", "b", "c"]).select("p_brand", "p_partkey")


@query("e19_nearest_fill", """
WITH b AS (SELECT pin, x, y, CASE WHEN pin % 4 != 0 THEN CAST(pin % 10 AS DOUBLE) END AS v FROM parcel_point),
d AS (SELECT a.pin, b.v, ROW_NUMBER() OVER (PARTITION BY a.pin ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.pin) AS r FROM b a JOIN b ON a.v IS NULL AND b.v IS NOT NULL)
SELECT pin, v FROM b WHERE v IS NOT NULL UNION ALL SELECT pin, v FROM d WHERE r = 1""")
def nearest_fill(t):
    rows = t.parcel_point.withColumn("v", F.when(F.col("pin") % 4 != 0, (F.col("pin") % 10).cast("double")))
    return filling.nearest_fill(rows, "pin", ["v"]).select("pin", "v")


@query("e20_touching_mean", """
WITH c AS (SELECT a.road_id, AVG(b.speed) AS m FROM road a JOIN road b ON a.road_name = b.road_name AND a.road_id != b.road_id AND a.speed IS NULL
 AND GREATEST(a.x1, a.x2) >= LEAST(b.x1, b.x2) AND GREATEST(b.x1, b.x2) >= LEAST(a.x1, a.x2) AND GREATEST(a.y1, a.y2) >= LEAST(b.y1, b.y2) AND GREATEST(b.y1, b.y2) >= LEAST(a.y1, a.y2)
 AND SIGN((b.x2 - b.x1) * (a.y1 - b.y1) - (b.y2 - b.y1) * (a.x1 - b.x1)) * SIGN((b.x2 - b.x1) * (a.y2 - b.y1) - (b.y2 - b.y1) * (a.x2 - b.x1)) <= 0
 AND SIGN((a.x2 - a.x1) * (b.y1 - a.y1) - (a.y2 - a.y1) * (b.x1 - a.x1)) * SIGN((a.x2 - a.x1) * (b.y2 - a.y1) - (a.y2 - a.y1) * (b.x2 - a.x1)) <= 0 GROUP BY a.road_id)
SELECT road.road_id, ROUND(COALESCE(speed, m), 6) AS speed FROM road LEFT JOIN c ON road.road_id = c.road_id""")
def touching_mean(t):
    # Stretch the segments' names to few groups so that touching ones exist.
    out = filling.touching_mean_fill(t.road, "road_id", "road_name", ["speed"], 300.0)
    return out.select("road_id", F.round("speed", 6).alias("speed"))


def order_links(t):
    """Every order tied to its customer."""
    return t.orders.select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("src"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("dst")
    )


@query("e21_components", """
SELECT DISTINCT 'c' || o_custkey AS node, 'c' || o_custkey AS component FROM orders UNION ALL SELECT DISTINCT 'o' || o_orderkey, 'c' || o_custkey FROM orders""")
def components(t):
    return network.connected_components(order_links(t))


@query("e21_drop_small_components", """
SELECT 'c' || o_custkey AS component, 'o' || o_orderkey AS src, 'c' || o_custkey AS dst, edge_count
FROM (SELECT o_orderkey, o_custkey, COUNT(*) OVER (PARTITION BY o_custkey) AS edge_count FROM orders) WHERE edge_count > 2""")
def drop_small_components(t):
    return network.drop_small_components(order_links(t), 2)


_DEGREES = "SELECT pin, -88.4 + x / 10000 AS lon, 41.4 + y / 10000 AS lat FROM parcel_point"
_GRID_X, _GRID_Y = projection.forward_sql("lon", "lat")


def _in_degrees(t):
    return t.parcel_point.select("pin", (F.lit(-88.4) + F.col("x") / 10000).alias("lon"), (F.lit(41.4) + F.col("y") / 10000).alias("lat"))


@query("g14_to_grid", f"SELECT pin, ROUND({_GRID_X}, 3) AS x, ROUND({_GRID_Y}, 3) AS y FROM ({_DEGREES})")
def to_grid(t):
    x, y = projection.to_grid(F.col("lon"), F.col("lat"))
    return _in_degrees(t).select("pin", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("g14_from_grid", f"SELECT pin, ROUND(lon, 8) AS lon, ROUND(lat, 8) AS lat FROM ({_DEGREES})")
def from_grid(t):
    # Forth and back: the places themselves are the result to match.
    x, y = projection.to_grid(F.col("lon"), F.col("lat"))
    placed = _in_degrees(t).select("pin", x.alias("x"), y.alias("y"))
    lon, lat = projection.from_grid(F.col("x"), F.col("y"))
    return placed.select("pin", F.round(lon, 8).alias("lon"), F.round(lat, 8).alias("lat"))


@query("g14_simplify", """
SELECT pin, CAST(CASE WHEN pin % 7 > 2.5 THEN 3 ELSE 2 END AS INT) AS points, CASE WHEN pin % 7 > 2.5 THEN 2 * SQRT(16 + (pin % 7) * (pin % 7)) ELSE 8.0 END AS length FROM parcel_point""")
def simplify(t):
    # A flat line with one peak in its middle, of a height that the key sets; slopes are straight.
    height = (F.col("pin") % 7).cast("double")
    line = F.transform(F.sequence(F.lit(0), F.lit(8)), lambda i: F.struct((F.col("x") + i).alias("x"), (F.col("y") + height * (1 - F.abs(i - 4) / 4)).alias("y")))
    kept = t.parcel_point.withColumn("line", line).select("pin", projection.simplify_line("line", 2.5).alias("s"))
    length = F.aggregate(geo.ring_edges(F.col("s")), F.lit(0.0), lambda a, e: a + geo.distance(e["x1"], e["y1"], e["x2"], e["y2"]))
    return kept.select("pin", F.size("s").alias("points"), length.alias("length"))
