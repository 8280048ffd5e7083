"""Sources, sinks, deltas and batch jobs over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plotwise.catalog.join_queries import zones
from plotwise.catalog.registry import query
from plotwise.functions import geometry as geo
from plotwise.functions.logic import today_column
from plotwise.jobs import cleaning, layers
from plotwise.session import ensure_checkpoint_dir
from plotwise.sources import publish, readers, writers


def scratch(t, name: str) -> str:
    """A fresh folder in the place all executors share."""
    ensure_checkpoint_dir(t.spark)
    return f"{t.spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


# Dissolved squares of a grid: parts that share sides hang together (edges), and the Euler number (squares less sides
# plus full corners) is outlines less holes.
SQUARE_RINGS = """
WITH RECURSIVE cell AS (SELECT DISTINCT * FROM ({cells})),
side AS (SELECT a.k, a.x, a.y, b.x AS u, b.y AS v FROM cell a JOIN cell b ON a.k = b.k AND ABS(a.x - b.x) + ABS(a.y - b.y) = 1),
reach(k, x, y, u, v) AS (SELECT k, x, y, x, y FROM cell UNION SELECT r.k, r.x, r.y, s.u, s.v FROM reach r JOIN side s ON s.k = r.k AND s.x = r.u AND s.y = r.v),
heads AS (SELECT k, COUNT(*) AS c FROM (SELECT k, x, y, MIN((u, v)) AS low FROM reach GROUP BY k, x, y) WHERE low = (x, y) GROUP BY k),
corner AS (SELECT a.k, COUNT(*) AS c FROM cell a JOIN cell b ON a.k = b.k AND b.x = a.x + 1 AND b.y = a.y JOIN cell d ON a.k = d.k AND d.x = a.x AND d.y = a.y + 1
 JOIN cell e ON a.k = e.k AND e.x = a.x + 1 AND e.y = a.y + 1 GROUP BY a.k),
pairs AS (SELECT k, COUNT(*) // 2 AS c FROM side GROUP BY k)
SELECT k, COUNT(*) AS num_parts, MAX(heads.c) AS num_outlines, MAX(heads.c) - (COUNT(*) - COALESCE(MAX(pairs.c), 0) + COALESCE(MAX(corner.c), 0)) AS num_holes,
 CAST(COUNT(*) * {unit} AS DOUBLE) AS area{extra} FROM cell JOIN heads USING (k) LEFT JOIN pairs USING (k) LEFT JOIN corner USING (k) {more} GROUP BY k"""


@query("s01_table_scan", "SELECT p_partkey, p_name FROM part WHERE p_size > 10")
def table_scan(t):
    return readers.table(t.spark, t.root, "part").where("p_size > 10").select("p_partkey", "p_name")


@query("s02_seed", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def seed(t):
    path = scratch(t, "seed")
    t.nation.write.csv(path, header=True)
    return readers.seed(t.spark, path, "n_nationkey int, n_name string, n_regionkey int")


@query("s03_landed_json", "SELECT salekey, cents, status FROM sale")
def landed_json(t):
    path = scratch(t, "json")
    t.sale.select("salekey", "cents", "status").write.json(path)
    return readers.landed_json(t.spark, path, "salekey long, cents long, status string")


@query("s04_partitioned_scan", "SELECT pin, cents, year FROM parcel_year WHERE year IN ('1997', '1998')")
def partitioned_scan(t):
    path = scratch(t, "hive")
    writers.write_partitioned(t.parcel_year.select("pin", "cents", "year"), path, ["year"])
    out = readers.partitioned(t.spark, path, "year=1997", "year=1998")
    return out.withColumn("year", F.col("year").cast("string"))


@query("s05_tagged_files", """
SELECT pin, cents, n, 'first' AS run_id FROM parcel_year WHERE year = '1997' UNION ALL SELECT pin, cents, NULL, 'second' FROM parcel_year WHERE year = '1998'""")
def tagged_files(t):
    a, b = scratch(t, "a"), scratch(t, "b")
    t.parcel_year.where("year = '1997'").select("pin", "cents", "n").write.parquet(a)
    t.parcel_year.where("year = '1998'").select("pin", "cents").write.parquet(b)
    return readers.tagged_files(t.spark, {"first": a, "second": b})


@query("s06_partitioned_sink", "SELECT salekey, cents, year, status FROM sale")
def partitioned_sink(t):
    path = scratch(t, "sink")
    writers.write_partitioned(t.sale.select("salekey", "cents", "year", "status"), path, ["year", "status"])
    return t.spark.read.parquet(path).withColumn("year", F.col("year").cast("string"))


@query("s07_bucketed_sink", "SELECT a.pin, a.cents AS cents, b.n AS n FROM parcel_year a JOIN parcel_year b ON a.pin = b.pin AND a.year = b.year")
def bucketed_sink(t):
    names = [f"bucketed_{uuid.uuid4().hex}" for _ in range(2)]
    for name, column in zip(names, ("cents", "n")):
        writers.write_bucketed(t.parcel_year.select("pin", "year", column), name, ["pin", "year"], 4, scratch(t, "buckets"))
    left, right = (t.spark.table(n) for n in names)
    joined = writers.bucketed_join(left, right, ["pin", "year"]).select("pin", "cents", "n")
    joined.columns  # resolved, so the tables may leave the catalogue
    writers.dropped(t.spark, *names)
    return joined


@query("s08_incremental", """
SELECT salekey, year, cents FROM sale WHERE year <= '1998' UNION ALL SELECT salekey, year, cents + 1 FROM sale WHERE year > '1998'""")
def incremental(t):
    path = scratch(t, "incremental")
    rows = t.sale.select("salekey", "cents", "year")
    writers.write_dynamic(rows.where("year <= '1998'"), path, ["year"])
    have = writers.existing_or_none(t.spark, path)
    new = writers.incremental_new(rows.withColumn("cents", F.col("cents") + 1), have.withColumn("year", F.col("year").cast("string")), "year")
    writers.write_dynamic(new, path, ["year"])
    return t.spark.read.parquet(path).withColumn("year", F.col("year").cast("string"))


@query("s09_partition_writer", """
SELECT salekey, cents, part, TRUE AS loaded FROM (SELECT salekey, CASE WHEN year = '1996' THEN 0 ELSE cents END AS cents, CASE WHEN year >= '2000' THEN NULL ELSE year END AS part FROM sale)""")
def partition_writer(t):
    path = scratch(t, "writer")
    rows = t.sale.select("salekey", "cents", F.when(F.col("year") < "2000", F.col("year")).alias("part"))
    zero = rows.where("part = '1996'").withColumn("cents", F.lit(0).cast("long"))
    writers.write_partitions(zero, path, ["part"])
    # 1996 is there already and stays as it is; the null partition is written.
    writers.write_partitions(rows, path, ["part"])
    writers.write_partitions(rows.withColumn("cents", F.lit(-1).cast("long")), path, ["part"])
    out = t.spark.read.parquet(path)
    return out.select("salekey", "cents", F.col("part").cast("string").alias("part"), F.col("loaded_at").isNotNull().alias("loaded"))


@query("s10_view", "SELECT pin, COUNT(*) AS n FROM sale GROUP BY pin")
def view(t):
    # A lazy frame is the view: nothing runs until it is read.
    return t.sql("SELECT pin, COUNT(*) AS n FROM sale GROUP BY pin")


PUBLISHED = "SELECT salekey AS row_id, CAST(CAST(year AS DOUBLE) AS VARCHAR) AS year FROM sale WHERE salekey % 3 != 0 AND year != '1999'"


def _published(t):
    kept = t.sale.where("salekey % 3 != 0 AND year != '1999'")
    return kept.select(F.col("salekey").alias("row_id"), F.col("year").cast("double").cast("string").alias("year"))


@query("s11_publish_delta", """
WITH cur AS (SELECT salekey AS row_id, year FROM sale WHERE salekey % 2 = 0 AND year != '1997'),
pub AS (SELECT salekey AS row_id FROM sale WHERE salekey % 3 != 0 AND year NOT IN ('1999', '1997'))
SELECT COALESCE(cur.row_id, pub.row_id) AS row_id, year, CASE WHEN cur.row_id IS NULL THEN TRUE END AS ":deleted" FROM cur FULL JOIN pub ON cur.row_id = pub.row_id""")
def publish_delta(t):
    current = t.sale.where("salekey % 2 = 0 AND year != '1997'").select(F.col("salekey").alias("row_id"), "year")
    return publish.publish_delta(current, _published(t))


@query("s12_dropped_years", """SELECT salekey AS row_id, TRUE AS ":deleted" FROM sale WHERE salekey % 3 != 0 AND year = '1997'""")
def dropped_years(t):
    current = t.sale.where("year != '1997'").select(F.col("salekey").alias("row_id"), "year")
    return publish.dropped_years(current, _published(t))


@query("s13_export_by_year", "SELECT salekey, cents, CASE WHEN year = '1998' THEN NULL ELSE year END AS year FROM sale")
def export_by_year(t):
    path = scratch(t, "export")
    rows = t.sale.select("salekey", "cents", F.when(F.col("year") != "1998", F.col("year")).alias("year"))
    writers.export_by_year(rows, path)
    return t.spark.read.schema("salekey long, cents long, year string").csv(path, header=True)


@query("s14_fixed_chunks", "SELECT COUNT(*) AS rows_total, 0 AS over_size FROM lineitem")
def fixed_chunks(t):
    path = scratch(t, "chunks")
    t.lineitem.select("l_orderkey", "l_linenumber").write.option("maxRecordsPerFile", 10_000).parquet(path)
    files = t.spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.sum("n").alias("rows_total"), F.count_if(F.col("n") > 10_000).cast("int").alias("over_size"))


@query("s15_report_extract", "SELECT salekey, pin, cents FROM sale WHERE year IN ('1998') AND status IN ('F', 'O')")
def report_extract(t):
    path = scratch(t, "report")
    writers.extract_report(t.sale, path, "year", ["1998"], "status", ["F", "O"])
    return t.spark.read.csv(path, header=True, schema=t.sale.schema).select("salekey", "pin", "cents")


@query("s17_freshness", """
SELECT MAX(ts) AS max_loaded_at, 'warn' AS status FROM events WHERE event_type = 'click'""")
def freshness(t):
    # "Now" is 30 hours after the last click, between the warn and the error age.
    now = t.events.where("event_type = 'click'").agg(F.max("ts") + F.expr("INTERVAL 30 HOURS")).scalar()
    out = publish.freshness(t.events, "ts", now, where=F.col("event_type") == "click")
    return out.select(F.col("max_loaded_at").cast("timestamp_ntz").alias("max_loaded_at"), "status")


@query("s18_wide_rates", """
SELECT p_partkey, '2019' AS year, p_retailprice AS rate FROM part UNION ALL SELECT p_partkey, '2022', CAST(p_size AS DOUBLE) FROM part""")
def wide_rates(t):
    wide = t.part.select("p_partkey", F.col("p_retailprice").alias("rate_2019"), F.col("p_size").cast("double").alias("rate_2022"))
    return readers.wide_rates(wide, ["p_partkey"], {"rate_2019": "2019", "rate_2022": "2022"}, "rate")


@query("e01_declarations", """
WITH r AS (SELECT CAST(l_orderkey AS VARCHAR) AS document_number, l_partkey AS pin, l_suppkey, l_shipdate, CAST(l_orderkey % 3 + 1 AS INT) AS total, year(l_shipdate) AS y,
 CAST(l_shipdate AS DATE) AS d, l_linenumber FROM lineitem WHERE l_orderkey > 0),
g AS (SELECT document_number, MAX(total) AS total, COUNT(*) AS n, COUNT(DISTINCT d) AS nd FROM r GROUP BY document_number)
SELECT document_number, CAST(COUNT(DISTINCT pin) AS BIGINT) AS pins, bool_or(g.n > 1 OR g.total > 1) AS is_multisale FROM r JOIN g USING (document_number)
WHERE (g.n = 1 OR g.total = g.n) AND g.nd = 1 GROUP BY document_number""")
def declarations(t):
    raw = t.lineitem.where("l_orderkey > 0").select(
        F.concat(F.lit("D-"), F.col("l_orderkey").cast("string")).alias("doc"), F.col("l_partkey").cast("string").alias("pin"),
        (F.col("l_orderkey") % 3 + 1).cast("string").alias("parcels"), F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm").alias("day"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("rec"), F.year("l_shipdate").cast("string").alias("year"),
    )
    crosswalk = {
        "doc": ("document_number", "string"), "pin": ("line_1_primary_pin", "string"), "parcels": ("line_2_total_parcels", "int"),
        "day": ("line_4_instrument_date", "date"), "rec": ("date_recorded", "date"), "absent": ("line_10a", "flag"),
    }
    out = cleaning.sale_declarations(raw, crosswalk)
    return out.groupBy("document_number").agg(F.count("line_1_primary_pin").alias("pins"), F.max("is_multisale").alias("is_multisale"))


@query("e02_reviews", """
SELECT o_orderkey AS doc_no, o_orderstatus = 'F' AS is_arms_length, FALSE AS is_flip, o_orderstatus = 'O' AS has_class_change, FALSE AS requires_field_check,
 CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'yes_major' WHEN '2' THEN 'yes_minor' WHEN '3' THEN 'yes_major' ELSE 'no' END AS has_characteristic_change FROM orders
WHERE NOT (o_orderstatus = 'P' AND substr(o_orderpriority, 1, 1) = '5')""")
def reviews(t):
    code = F.substring("o_orderpriority", 1, 1)
    change = F.when(code == "1", " yes - MAJOE").when(code == "2", "YES/Minot ").when(code == "3", "YES-FIRE").when(code == "4", "NO")
    raw = t.orders.select(
        F.col("o_orderkey").alias("doc_no"), F.when(F.col("o_orderstatus") == "F", " Yes").alias("sale_is_arms_length"),
        change.alias("characteristic_change"), F.when(F.col("o_orderstatus") == "O", "YES").alias("class_change"),
        F.lit("").alias("flip"), F.lit(None).cast("string").alias("field_check"),
    )
    return cleaning.sale_reviews(raw, {"characteristic_change": {"YES-FIRE": "YES-MAJOR"}})


@query("e03_land_rates", """
WITH c AS (SELECT * FROM (VALUES ('202'), ('210'), ('295')) v(class)),
b AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 5, '0') AS town_nbhd, CASE WHEN p_size > 25 THEN 'small' ELSE 'other' END AS label, CAST(p_size AS DOUBLE) AS a, p_retailprice AS z FROM part)
SELECT substr(town_nbhd, 1, 2) AS township_code, town_nbhd, class, year, rate AS land_rate_per_sqft, '2023' AS data_year FROM
(SELECT town_nbhd, label, '2020' AS year, a AS rate FROM b UNION ALL SELECT town_nbhd, label, '2023', z FROM b) r, c
WHERE (label = 'small' AND class IN ('210', '295')) OR (label = 'other' AND class NOT IN ('210', '295'))""")
def land_rates(t):
    code = F.lpad(F.col("p_partkey").cast("string"), 5, "0")
    raw = t.part.select(
        F.concat(F.substring(code, 1, 2), F.lit("-"), F.substring(code, 3, 3)).alias("town_nbhd"),
        F.when(F.col("p_size") > 25, "small").otherwise("other").alias("label"),
        F.concat(F.lit("$"), F.col("p_size").cast("string")).alias("r2020"), F.col("p_retailprice").alias("r2023"),
    )
    only = {"small": (True, ["210", "295"]), "other": (False, ["210", "295"])}
    return cleaning.land_rates(raw, {"r2020": "2020", "r2023": "2023"}, "2023", ["202", "210", "295"], only_classes=only, label="label")


@query("e04_site_rates", """
SELECT CAST(p_partkey AS VARCHAR) AS pin, replace(p_brand, 'Brand#', '2') AS class, CAST(FLOOR(p_retailprice) AS INT) AS land_rate_per_pin, '2022' AS year FROM part WHERE p_size > 3""")
def site_rates(t):
    raw = t.part.select(
        F.when(F.col("p_size") > 3, F.col("p_partkey").cast("string")).alias("PARID"), F.regexp_replace("p_brand", "Brand#", "2-").alias("cls"),
        F.floor("p_retailprice").cast("string").alias("rate"),
    )
    names = {"PARID": ("pin", "string"), "cls": ("class", "string"), "rate": ("land_rate_per_pin", "int")}
    return cleaning.land_site_rates(raw, names, "2022")


@query("e05_flagged_units", """
SELECT lpad(CAST(pin AS VARCHAR), 14, '0') AS pin, year, CASE WHEN exe = 1 THEN 'questionable' ELSE '399 GR' END AS flag FROM parcel_year WHERE exe = 1 OR n > 2""")
def flagged_units(t):
    rows = t.parcel_year
    return cleaning.flagged_units({"questionable": rows.where("exe = 1"), "399 GR": rows.where("n > 2")})


@query("e06_workbooks", """
SELECT CAST(pin AS VARCHAR) AS pin, CAST(cents AS VARCHAR) AS value, NULL AS extra, '1997' AS year FROM parcel_year WHERE year = '1997'
UNION ALL SELECT CAST(pin AS VARCHAR), NULL, CAST(n AS VARCHAR), '1998' FROM parcel_year WHERE year = '1998'""")
def workbooks(t):
    def sheet(year, **cols):
        return t.parcel_year.where(F.col("year") == year).select(F.col("pin").cast("string").alias("pin"), *[c.alias(n) for n, c in cols.items()])

    return cleaning.stack_workbooks({
        "1997": sheet("1997", value=F.concat(F.lit("  "), F.col("cents").cast("string"))),
        "1998": sheet("1998", value=F.lit("NULL"), extra=F.col("n").cast("string")),
    })


@query("e07_fixed_width", "SELECT lpad(CAST(salekey AS VARCHAR), 10, '0') AS id, year, NULLIF(CASE WHEN status = 'P' THEN '' ELSE status END, '') AS code FROM sale")
def fixed_width(t):
    path = scratch(t, "fixed")
    code = F.when(F.col("status") == "P", " ").otherwise(F.col("status"))
    line = F.concat(F.lpad(F.col("salekey").cast("string"), 10, "0"), "year", F.lit("  "), code)
    t.sale.select(line.alias("value")).write.text(path)
    return readers.fixed_width(t.spark, path, {"id": (1, 10), "year": (11, 4), "code": (17, 1)})


@query("e08_zoning", """
SELECT pin, string_agg(DISTINCT priority, ', ' ORDER BY priority) AS zoning_code, MAX(sale_date) AS zoning_date, '2025' AS year FROM sale GROUP BY pin""")
def zoning(t):
    return cleaning.zoning(t.sale, "pin", "priority", "sale_date", "2025")


@query("e09_appeals", """
SELECT CAST(o_orderkey AS VARCHAR) AS appeal_id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS result, CAST(FLOOR(o_totalprice) AS INT) AS board_total_value,
 CAST(year(o_orderdate) AS VARCHAR) AS taxyr FROM orders""")
def appeals(t):
    raw = t.orders.select(
        F.col("o_orderkey").cast("string").alias("appealid"), F.when(F.col("o_orderstatus") == "P", "N/A").otherwise(F.col("o_orderstatus")).alias("result"),
        F.floor("o_totalprice").cast("string").alias("totalvalue"), F.year("o_orderdate").cast("string").alias("tax_year"),
    )
    return cleaning.appeals(raw, {"appealid": "appeal_id", "result": "result", "totalvalue": "board_total_value", "tax_year": "taxyr"})


@query("e10_census_table", "SELECT CAST(c_custkey AS VARCHAR) AS GEOID, c_acctbal AS P2_001N FROM customer WHERE c_custkey % 10 != 0")
def census_table(t):
    geoid = F.when(F.col("c_custkey") % 10 == 0, "Z").otherwise(F.col("c_custkey").cast("string"))
    return layers.census_table(t.customer.select(geoid.alias("GEOID"), F.col("c_acctbal").alias("PL002001")), {"PL002001": "P2_001N", "absent": "x"})


@query("e10_census_dictionary", """
SELECT 'acs' AS survey, name AS variable_name, p_type AS variable_label, CASE WHEN name LIKE 'Brand#1%' THEN substr(name, 1, 7) ELSE substr(name, 1, 6) END AS variable_table_code FROM
(SELECT p_brand || '_x' AS name, p_type, ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS r FROM part) WHERE r = 1 AND (name LIKE 'Brand#1%' OR name LIKE 'Brand#2%')""")
def census_dictionary(t):
    rows = t.part.select(F.concat("p_brand", F.lit("_x")).alias("name"), F.concat(F.lit(" "), "p_type").alias("label"), F.col("p_partkey").alias("order"))
    return layers.census_dictionary(rows, ["Brand#1", "Brand#2"], "acs", ("Brand#1",))


@query("e11_quarterly_index", """
SELECT '170' || CAST(p_partkey AS VARCHAR) AS geoid, '2019' AS year, '1' AS quarter, p_retailprice AS ihs_index FROM part UNION ALL SELECT '170' || CAST(p_partkey AS VARCHAR), '2019', '2', CAST(p_size AS DOUBLE) FROM part""")
def quarterly_index(t):
    wide = t.part.select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("geoid"), F.col("p_retailprice").alias("2019Q1"), F.col("p_size").cast("double").alias("2019Q2"),
    )
    return layers.quarterly_index(wide, ["geoid"], ["2019Q1", "2019Q2"], "ihs_index")


@query("e12_road_segments", """
SELECT trim(split_part(p_brand, '#', 2)) || ' ave' AS road_name, CASE WHEN p_size > 10 THEN p_size END AS lanes, COUNT(*) AS n_lines FROM part GROUP BY ALL""")
def road_segments(t):
    raw = t.part.select(
        F.concat(F.element_at(F.split("p_brand", "#"), 2), F.lit("   Avenue ")).alias("road_name"),
        F.when(F.col("p_size") > 10, F.col("p_size")).otherwise(0).alias("lanes"), F.col("p_partkey").alias("x1"), F.lit(0).alias("y1"),
        F.col("p_partkey").alias("x2"), F.lit(1).alias("y2"),
    )
    out = layers.road_segments(raw, "road_name", ["lanes"])
    return out.select("road_name", "lanes", F.size("lines").cast("long").alias("n_lines"))


@query("e13_transit_stops", """
SELECT DISTINCT s_suppkey AS stop_id, CAST(l_linenumber % 2 AS INT) AS route_type, 'bus' AS agency, '2023' AS year FROM supplier JOIN lineitem ON s_suppkey = l_suppkey""")
def transit_stops(t):
    stops = t.supplier.select(F.col("s_suppkey").alias("stop_id"))
    times = t.lineitem.select(F.col("l_suppkey").alias("stop_id"), F.col("l_linenumber").alias("trip_id"))
    trips = t.lineitem.select(F.col("l_linenumber").alias("trip_id"), (F.col("l_linenumber") % 2).alias("route_id")).distinct()
    routes = trips.select("route_id", F.col("route_id").cast("int").alias("route_type")).distinct()
    return layers.transit_stops(stops, times, trips, routes, "bus", "2023")


@query("e14_layer_export", "SELECT zone_id, year FROM zone WHERE year = (SELECT MAX(year) FROM zone)")
def layer_export(t):
    path = scratch(t, "layer")
    layers.latest_layer(zones(t, keep_year=True)).write.json(path)
    return t.spark.read.schema("zone_id int, year string").json(path)


@query("e15_validation_history", "SELECT salekey AS document, status AS run_id, cents FROM sale")
def validation_history(t):
    path = scratch(t, "history")
    writers.write_partitions(t.sale.select(F.col("salekey").alias("document"), "cents", F.col("status").alias("run_id")), path, ["run_id"])
    return t.spark.read.parquet(path).select("document", "run_id", "cents")


@query("e16_rename_cast", "SELECT CAST(c_custkey AS VARCHAR) AS pin, CAST(FLOOR(c_acctbal) AS INT) AS value, c_nationkey < 5 AS hidden FROM customer")
def rename_cast(t):
    raw = t.customer.select(
        "c_custkey", F.floor("c_acctbal").cast("string").alias("VAL"), F.when(F.col("c_nationkey") < 5, "Y").otherwise("N").alias("HIDE"),
    )
    return readers.typed(raw, {"c_custkey": ("pin", "string"), "VAL": ("value", "int"), "HIDE": ("hidden", "flag")})


@query("e17_foreclosures", """
SELECT CAST(o_orderkey AS VARCHAR) AS case_number, CASE o_orderpriority WHEN '1-URGENT' THEN 'ARM' WHEN '2-HIGH' THEN 'CONVENTIONAL' WHEN '3-MEDIUM' THEN 'REVERSE' ELSE 'OTHER' END AS mortgage_type,
 CAST(year(o_orderdate) AS VARCHAR) AS year_of_sale FROM orders WHERE o_custkey % 10007 BETWEEN 100 AND 900 AND year(o_orderdate) >= 1997 AND CAST(o_orderdate AS DATE) < DATE '2001-01-01'""")
def foreclosures(t):
    code = F.substring("o_orderpriority", 1, 1)
    kind = F.when(code == "1", "arm").when(code == "2", "Conventional loan").when(code == "3", "res mtg").otherwise("odd")
    raw = t.orders.select(
        F.col("o_orderkey").cast("string").alias("case_number"), F.concat(F.lit("PIN "), F.col("o_custkey").cast("string")).alias("pin"),
        F.lit("sold").alias("sale_results"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_of_sale"), kind.alias("mortgage_type"),
        (F.col("o_custkey") % 10007).cast("double").alias("global_x"), F.lit(1.0).alias("global_y"),
    )
    out = cleaning.foreclosures(raw, (100.0, 0.0, 900.0, 2.0), today_column("2001-01-01"), "1997")
    return out.select("case_number", "mortgage_type", "year_of_sale")


@query("e22_road_stack", "SELECT pin AS osm_id, MIN(year) AS year FROM parcel_year WHERE year IN ('1996', '1997', '1998') GROUP BY pin")
def road_stack(t):
    years = {y: t.parcel_year.where(F.col("year") == y).select(F.col("pin").alias("osm_id"), "n") for y in ("1998", "1996", "1997")}
    return layers.road_stack(years).select("osm_id", "year")


@query("e23_district_ids", """
WITH d AS (SELECT pin, CASE WHEN pin % 2 = 0 THEN 'elementary' ELSE 'secondary' END AS district_type, year, x, y FROM parcel_point),
z AS (SELECT *, CASE WHEN zone_id % 2 = 0 THEN 'elementary' ELSE 'secondary' END AS kind FROM zone)
SELECT d.pin, CASE WHEN d.pin = 7 THEN 'manual' ELSE CAST(z.zone_id AS VARCHAR) END AS geoid FROM d LEFT JOIN z ON x > x0 AND x < x1 AND y > y0 AND y < y1 AND d.year = z.year AND d.district_type = z.kind""")
def district_ids(t):
    kind = F.when(F.col("pin") % 2 == 0, "elementary").otherwise("secondary")
    districts = t.parcel_point.select(F.col("pin").alias("district_id"), kind.alias("district_type"), "year", "x", "y")
    area_kind = F.when(F.col("zone_id") % 2 == 0, "elementary").otherwise("secondary")
    areas = zones(t, keep_year=True).select(F.col("zone_id").cast("string").alias("geoid"), "year", area_kind.alias("district_type"), "rings")
    out = layers.district_ids(districts, areas, 500.0, [(F.col("district_id") == 7, "manual")])
    return out.select(F.col("district_id").alias("pin"), "geoid")


@query("e24_dissolve", SQUARE_RINGS.format(
    cells="SELECT n_regionkey AS k, n_nationkey % 5 AS x, n_nationkey // 5 AS y FROM nation", extra=", arg_min(n_name, n_nationkey) AS zone_name", more="JOIN nation ON n_regionkey = k AND n_nationkey = x + 5 * y", unit="4000000"))
def dissolve_layer(t):
    rows = zones(t).join(t.nation, F.col("zone_id") == F.col("n_nationkey"))
    out = layers.dissolve_layer(rows, ["n_regionkey"], ["zone_name"], "zone_id")
    return out.select(F.col("n_regionkey").alias("k"), "num_parts", "num_outlines", "num_holes", geo.ring_area(F.col("rings")).alias("area"), "zone_name")


@query("e25_monitors", """
SELECT s_suppkey AS site, '2019' AS year, s_acctbal AS noise, n_name AS place FROM supplier LEFT JOIN nation ON s_suppkey = n_nationkey WHERE s_acctbal IS NOT NULL
UNION ALL SELECT s_suppkey, '2020', CASE WHEN s_acctbal > 0 THEN s_acctbal END, n_name FROM supplier LEFT JOIN nation ON s_suppkey = n_nationkey WHERE s_acctbal > 0""")
def monitors(t):
    wide = t.supplier.select(F.col("s_suppkey").alias("site"), F.col("s_acctbal").alias("2019"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("2020"))
    sites = t.nation.select(F.col("n_nationkey").cast("long").alias("site"), F.col("n_name").alias("place"))
    return layers.monitor_readings(wide, sites, "site", ["2019", "2020"])


@query("e26_outlines", SQUARE_RINGS.format(cells="SELECT c_nationkey AS k, c_custkey % 97 AS x, c_custkey // 97 AS y FROM customer", extra="", more="", unit="100"))
def outlines(t):
    # Lots of ten by ten feet, side by side: neighbourhoods are blocks of them with corners and courts.
    lots = t.customer.select(F.col("c_nationkey").alias("k"), (F.col("c_custkey") % 97 * 10).alias("x"), (F.floor(F.col("c_custkey") / 97) * 10).alias("y"), "c_custkey")
    rows = lots.withColumn("rings", geo.rectangle(F.col("x"), F.col("y"), F.col("x") + 10, F.col("y") + 10))
    out = layers.dissolve_layer(rows, ["k"], [], "c_custkey")
    return out.select("k", "num_parts", "num_outlines", "num_holes", geo.ring_area(F.col("rings")).alias("area"))


@query("e27_landed_layer", "SELECT zone_id AS id, zone_name AS name, '2023' AS year, CAST(4000000 AS DOUBLE) AS area FROM zone")
def landed_layer(t):
    path = scratch(t, "landed")
    raw = zones(t).withColumn("shape", geo.wkb_polygon(F.col("rings")))
    writers.write_partitions(layers.layer_rows(raw, {"zone_id": "id", "zone_name": "name"}, "shape", "2023"), path, ["year"])
    back = t.spark.read.parquet(path).withColumn("year", F.col("year").cast("string"))
    return back.select("id", "name", "year", geo.ring_area(geo.rings_from_wkb("geometry_3435")).alias("area"))
