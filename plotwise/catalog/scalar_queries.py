"""Scalar functions and the small macros."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.catalog.registry import query
from plotwise.functions import logic, text
from plotwise.operators import grouped


@query("fn_string", """
SELECT c_custkey, upper(c_name) AS up, lower(c_mktsegment) AS low, length(c_name) AS len, replace(c_name, '#', '-') AS rep, substr(c_name, 3, 5) AS mid,
 concat_ws('/', c_mktsegment, c_name) AS joined, strpos(c_name, '#') AS pos, split_part(c_name, '#', 2) AS tail, trim('  ' || c_mktsegment || ' ') AS t FROM customer""")
def fn_string(t):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return t.customer.select(
        "c_custkey", F.upper(name).alias("up"), F.lower(segment).alias("low"), F.length(name).cast("long").alias("len"),
        F.replace(name, F.lit("#"), F.lit("-")).alias("rep"), F.substring(name, 3, 5).alias("mid"),
        F.concat_ws("/", segment, name).alias("joined"), F.instr(name, "#").cast("long").alias("pos"),
        logic.at(F.split(name, "#"), 2).alias("tail"), F.trim(F.concat(F.lit("  "), segment, F.lit(" "))).alias("t"),
    )


@query("fn_regex", """
SELECT doc_id, regexp_replace(lang || '-' || source || ' (' || CAST(n_chars AS VARCHAR) || ')', '[^a-zA-Z0-9]', '', 'g') AS alnum,
 NULLIF(regexp_replace(source, '[^0-9]', '', 'g'), '') AS digits, len(regexp_extract_all(text, '[0-9]+')) AS n_numbers FROM documents""")
def fn_regex(t):
    raw = F.concat("lang", F.lit("-"), "source", F.lit(" ("), F.col("n_chars").cast("string"), F.lit(")"))
    return t.documents.select(
        "doc_id", text.alnum_only(raw).alias("alnum"), text.digits_only("source").alias("digits"),
        F.regexp_count("text", F.lit("[0-9]+")).cast("long").alias("n_numbers"),
    )


@query("fn_null", """
SELECT salekey, COALESCE(CASE WHEN status = 'F' THEN cents END, -1) AS a, NULLIF(status, 'O') AS b, CASE WHEN cents > 100 THEN 'x' ELSE 'y' END AS c FROM sale""")
def fn_null(t):
    return t.sale.select(
        "salekey", F.coalesce(F.when(F.col("status") == "F", F.col("cents")), F.lit(-1)).alias("a"),
        F.nullif("status", F.lit("O")).alias("b"), F.when(F.col("cents") > 100, "x").otherwise("y").alias("c"),
    )


@query("fn_conversion", """
SELECT p_partkey, TRY_CAST(replace(p_brand, 'Brand#', '') AS INT) AS brand_no, TRY_CAST(p_type AS INT) AS bad, CAST(p_size AS VARCHAR) AS size_text,
 CAST(p_retailprice AS BIGINT) AS whole FROM part WHERE p_retailprice = FLOOR(p_retailprice)""")
def fn_conversion(t):
    return t.part.where(F.col("p_retailprice") == F.floor("p_retailprice")).select(
        "p_partkey", F.replace("p_brand", F.lit("Brand#"), F.lit("")).try_cast("int").alias("brand_no"),
        F.col("p_type").try_cast("int").alias("bad"), F.col("p_size").cast("string").alias("size_text"),
        F.col("p_retailprice").cast("long").alias("whole"),
    )


@query("fn_date", """
SELECT salekey, strftime(sale_date, '%Y%m%d') AS compact, strftime(sale_date, '%-m/%-d/%Y') AS us, date_diff('day', sale_date, DATE '2002-01-01') AS age,
 year(sale_date) AS y, month(sale_date) AS m, day(sale_date) AS d, strptime(strftime(sale_date, '%-m/%-d/%Y'), '%m/%d/%Y')::DATE AS back FROM sale""")
def fn_date(t):
    us = F.date_format("sale_date", "M/d/yyyy")
    return t.sale.select(
        "salekey", F.date_format("sale_date", "yyyyMMdd").alias("compact"), us.alias("us"),
        F.datediff(logic.today_column("2002-01-01"), "sale_date").cast("long").alias("age"),
        F.year("sale_date").cast("long").alias("y"), F.month("sale_date").cast("long").alias("m"),
        F.dayofmonth("sale_date").cast("long").alias("d"), F.to_date(us, "M/d/yyyy").alias("back"),
    )


@query("fn_today", "SELECT salekey, year = '2001' AS is_current FROM sale")
def fn_today(t):
    today = logic.today_column("2001-06-30")
    return t.sale.select("salekey", (F.col("year") == F.year(today).cast("string")).alias("is_current"))


@query("fn_math", """
SELECT l_orderkey, l_linenumber, l_partkey, ROUND(l_extendedprice / 7, 3) AS r, ABS(l_discount - l_tax) AS a, CAST(l_orderkey % 7 AS BIGINT) AS m, POWER(l_quantity, 2) AS p,
 ROUND(LOG(10, l_extendedprice), 8) AS lg, l_orderkey // 7 AS q, SIGN(l_discount - 0.05) AS s,
 CASE WHEN l_tax > 0.02 THEN GREATEST(l_tax, l_discount) END AS g FROM lineitem""")
def fn_math(t):
    tax = F.when(F.col("l_tax") > 0.02, F.col("l_tax"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(F.col("l_extendedprice") / 7, 3).alias("r"),
        F.abs(F.col("l_discount") - F.col("l_tax")).alias("a"), (F.col("l_orderkey") % 7).alias("m"),
        F.pow("l_quantity", F.lit(2)).alias("p"), F.round(F.log(10.0, F.col("l_extendedprice")), 8).alias("lg"),
        logic.int_div("l_orderkey", F.lit(7)).alias("q"),
        F.signum(F.col("l_discount") - 0.05).cast("int").alias("s"), logic.greatest_strict(tax, "l_discount").alias("g"),
    )


@query("fn_array", """
WITH b AS (SELECT o_orderkey, [o_orderstatus, substr(o_orderpriority, 3), NULL, o_orderstatus] AS a FROM orders)
SELECT o_orderkey, a[2] AS second, array_to_string(list_sort(list_distinct(a)), '+') AS members, len(a) AS n, list_contains(a, 'F') AS has_f,
 list_position(a, 'LOW') AS pos, list_max(a) AS hi, len(list_filter(a, lambda x: x IS NOT NULL)) AS known,
 array_to_string(list_filter(a, lambda x: x != 'F'), '+') AS no_f FROM b""")
def fn_array(t):
    a = F.array("o_orderstatus", F.expr("substr(o_orderpriority, 3)"), F.lit(None).cast("string"), "o_orderstatus")
    rows = t.orders.select("o_orderkey", a.alias("a"))
    known = F.filter("a", lambda x: x.isNotNull())
    return rows.select(
        "o_orderkey", logic.at("a", 2).alias("second"),
        F.array_join(F.array_sort(F.array_distinct(known)), "+").alias("members"),
        F.size("a").cast("long").alias("n"), F.coalesce(F.array_contains(known, "F"), F.lit(False)).alias("has_f"),
        F.nullif(F.array_position("a", "LOW"), F.lit(0)).alias("pos"), F.array_max("a").alias("hi"),
        F.size(known).cast("long").alias("known"), F.array_join(F.array_remove(known, "F"), "+").alias("no_f"),
    )


@query("fn_map", """
SELECT event_type, MAX(CASE WHEN h = 0 THEN n END) AS midnight, COUNT(*) AS hours, MAX(n) AS busiest FROM
(SELECT event_type, hour(ts) AS h, COUNT(*) AS n FROM events GROUP BY ALL) GROUP BY event_type""")
def fn_map(t):
    maps = grouped.value_counts_map(t.events.withColumn("h", F.hour("ts")), ["event_type"], "h", "m")
    return maps.select(
        "event_type", F.try_element_at("m", F.lit(0)).alias("midnight"), F.size(F.map_keys("m")).cast("long").alias("hours"),
        F.array_max(F.map_values("m")).alias("busiest"),
    )


@query("fn_json_in", "SELECT event_id, CAST(props->>'k' AS INT) AS k FROM events")
def fn_json_in(t):
    return t.events.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("fn_json_out", """
SELECT salekey, '{"code":"' || status || '","cents":' || CASE WHEN cents > 20000000 THEN CAST(cents AS VARCHAR) ELSE 'null' END || '}' AS doc FROM sale""")
def fn_json_out(t):
    return t.sale.select(
        "salekey", logic.json_object(code=F.col("status"), cents=F.when(F.col("cents") > 20000000, F.col("cents"))).alias("doc")
    )


@query("fn_json_list", "SELECT salekey, 2 AS n, status AS second FROM sale")
def fn_json_list(t):
    parsed = logic.json_list(F.concat(F.lit('["'), "priority", F.lit('","'), "status", F.lit('"]')))
    return t.sale.select("salekey", F.size(parsed).alias("n"), logic.at(parsed, 2).alias("second"))


@query("m01_aggregate_codes", """
SELECT o_custkey, string_agg(DISTINCT upper(o_orderstatus), ', ' ORDER BY upper(o_orderstatus)) AS code,
 string_agg(DISTINCT d, ', ' ORDER BY d) AS description FROM orders LEFT JOIN (VALUES ('F', 'Final'), ('O', 'Open')) c(k, d) ON upper(o_orderstatus) = k
WHERE o_totalprice > 100000 GROUP BY o_custkey""")
def aggregate_codes(t):
    kept = t.orders.where("o_totalprice > 100000")
    described = kept.withColumn("d", logic.decode(F.upper("o_orderstatus"), {"F": "Final", "O": "Open"}))
    pairs = described.select("o_custkey", F.upper("o_orderstatus").alias("code"), "d").distinct()
    return pairs.groupBy("o_custkey").agg(
        F.array_join(F.array_sort(F.collect_set("code")), ", ").alias("code"),
        F.nullif(F.array_join(F.array_sort(F.collect_set("d")), ", "), F.lit("")).alias("description"),
    )


@query("m02_predictor_columns", """
SELECT p_partkey AS meta_pin, p_size AS char_yrblt, p_retailprice AS other_tax_bill_rate, p_brand AS meta_nbhd_code FROM part""")
def predictor_columns(t):
    from plotwise.plans.predictors import predictors

    named = t.part.selectExpr(
        "p_partkey as meta_pin", "p_size as char_yrblt", "p_retailprice as other_tax_bill_rate", "p_brand as meta_nbhd_code",
        "p_type as char_class", "p_name as unrelated",
    )
    return named.select("meta_pin", *predictors(named.columns, exclude=("char_class",)))


@query("m03_array_join", "SELECT o_orderkey, concat_ws(' | ', o_orderstatus, o_orderpriority) AS both_codes FROM orders")
def array_join(t):
    return t.orders.select("o_orderkey", F.array_join(F.array("o_orderstatus", "o_orderpriority"), " | ").alias("both_codes"))


@query("m05_concat_address", """
SELECT c_custkey, NULLIF(trim(regexp_replace(regexp_replace(concat_ws(' ', NULLIF(c_name, 'x'), CASE WHEN c_custkey % 2 = 0 THEN '  ' || c_mktsegment || chr(9) END,
 CASE WHEN c_custkey % 3 = 0 THEN ' APT  ' || CAST(c_nationkey AS VARCHAR) END), '[[:cntrl:]]', '', 'g'), '\\s+', ' ', 'g')), '') AS address FROM customer""")
def concat_address(t):
    unit = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(" APT  "), F.col("c_nationkey").cast("string")))
    street = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("  "), "c_mktsegment", F.lit("\t")))
    return t.customer.select("c_custkey", text.concat_address("c_name", street, unit).alias("address"))


@query("m09_stage_filters", """
WITH r AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS procname, 'Y' AS cur FROM orders),
s AS (SELECT o_custkey, COUNT(procname) AS n, COALESCE(bool_or(procname = '1-URGENT'), FALSE) AS final FROM r GROUP BY o_custkey)
SELECT o_orderkey, n = 0 AS pre_mailed, n > 0 AND NOT final AS pre_certified FROM r JOIN s USING (o_custkey) WHERE procname IS NULL""")
def stage_filters(t):
    rows = t.orders.select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("procname"), F.lit("Y").alias("cur")
    )
    stages = grouped.collect_sorted(rows.where("procname IS NOT NULL"), ["o_custkey"], "procname", "stages")
    joined = rows.where("procname IS NULL").join(stages, "o_custkey", "left")
    names = F.coalesce("stages", F.array().cast("array<string>"))
    proc, cur = F.col("procname"), F.col("cur")
    return joined.select(
        "o_orderkey", logic.pre_mailed(proc, cur, names).alias("pre_mailed"),
        logic.pre_certified(proc, cur, names, "1-URGENT").alias("pre_certified"),
    )


@query("m12_insert_hyphens", """
SELECT c_custkey, substr(p, 1, 2) || '-' || substr(p, 3, 2) || '-' || substr(p, 5, 3) || '-' || substr(p, 8, 3) || '-' || substr(p, 11) AS pin FROM
(SELECT c_custkey, lpad(CAST(c_custkey * 7919 AS VARCHAR), 14, '0') AS p FROM customer)""")
def insert_hyphens(t):
    pin = F.lpad((F.col("c_custkey") * 7919).cast("string"), 14, "0")
    return t.customer.select("c_custkey", text.hyphenated_pin(pin).alias("pin"))
