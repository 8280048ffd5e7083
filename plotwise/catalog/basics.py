"""Projections, filters and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.catalog.registry import query
from plotwise.functions import logic, text
from plotwise.operators import filters, ordered, reshape


@query("p01_active", """
SELECT c_custkey, c_name FROM (SELECT *, CASE WHEN c_acctbal >= 0 THEN 'Y' ELSE 'N' END AS cur,
  CASE WHEN c_nationkey % 7 = 0 THEN 'x' END AS deactivat, c_mktsegment AS class FROM customer)
WHERE cur = 'Y' AND deactivat IS NULL AND class NOT IN ('MACHINERY')""")
def active(t):
    marked = t.customer.withColumns({
        "cur": F.when(F.col("c_acctbal") >= 0, "Y").otherwise("N"),
        "deactivat": F.when(F.col("c_nationkey") % 7 == 0, "x"),
        "class": F.col("c_mktsegment"),
    })
    return filters.active(marked, class_col="class", drop_class=("MACHINERY",)).select("c_custkey", "c_name")


@query("p02_case_decode", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE 'other' END AS stage,
  CASE WHEN year(o_orderdate) >= 1999 THEN 'new era' WHEN o_totalprice > 100000 THEN 'old large' END AS era
FROM orders""")
def case_decode(t):
    era = F.when(F.year("o_orderdate") >= 1999, "new era").when(F.col("o_totalprice") > 100000, "old large")
    stage = logic.decode("o_orderstatus", {"F": "final", "O": "open"}, F.lit("other"))
    return t.orders.select("o_orderkey", stage.alias("stage"), era.alias("era"))


@query("p03_yes_no", """
SELECT l_orderkey, l_linenumber, CASE WHEN f = 'Y' THEN TRUE WHEN f = 'N' THEN FALSE END AS flag FROM (
  SELECT *, CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'N' THEN 'N' ELSE l_returnflag END AS f FROM lineitem)""")
def yes_no(t):
    mapped = logic.decode("l_returnflag", {"A": "Y", "N": "N"}, F.col("l_returnflag"))
    return t.lineitem.select("l_orderkey", "l_linenumber", logic.yes_no(mapped).alias("flag"))


@query("p04_lookup_decode", """
SELECT c_custkey, n_name AS nation, r_name AS region FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def lookup_decode(t):
    out = filters.lookup(
        t.customer, "c_nationkey", t.nation, "n_nationkey", {"n_name": "nation", "n_regionkey": "regionkey"}
    )
    return filters.lookup(out, "regionkey", t.region, "r_regionkey", {"r_name": "region"}).select(
        "c_custkey", "nation", "region"
    )


@query("p05_numbered_decode", """
SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'first' WHEN '2' THEN 'second' END AS d_1,
  CASE o_orderstatus WHEN 'F' THEN 'filed' WHEN 'O' THEN 'opened' END AS d_2,
  CASE CAST(o_orderkey % 3 AS VARCHAR) WHEN '0' THEN 'zero' WHEN '1' THEN 'one' END AS d_3 FROM orders""")
def numbered_decode(t):
    coded = t.orders.select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("c1"), F.col("o_orderstatus").alias("c2"),
        (F.col("o_orderkey") % 3).cast("string").alias("c3"),
    )
    names = {"1": "first", "2": "second", "F": "filed", "O": "opened", "0": "zero"}
    # "1" means "one" in the third column, so that column has a map of its own.
    out = reshape.decode_numbered(coded, "c", 2, names, "d_")
    return out.withColumn("d_3", logic.decode("c3", {"0": "zero", "1": "one"})).select("o_orderkey", "d_1", "d_2", "d_3")


@query("p06_known_true", """
SELECT p_partkey, COALESCE(s > 25, FALSE) AS is_large FROM
(SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size END AS s FROM part)""")
def known_true(t):
    size = F.when(F.col("p_partkey") % 5 != 0, F.col("p_size"))
    return t.part.select("p_partkey", logic.known_true(size > 25).alias("is_large"))


@query("p07_predicates", """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linestatus NOT IN ('O')
AND l_discount BETWEEN 0.03 AND 0.07 AND CAST(l_orderkey AS VARCHAR) LIKE '1%'""")
def predicates(t):
    return t.lineitem.where(
        F.col("l_returnflag").isin("A", "R") & ~F.col("l_linestatus").isin("O")
        & F.col("l_discount").between(0.03, 0.07) & F.col("l_orderkey").cast("string").like("1%")
    ).select("l_orderkey", "l_linenumber")


@query("p08_scalar_subquery", """
SELECT salekey, year FROM sale WHERE year = (SELECT MAX(year) FROM parcel_year)""")
def scalar_subquery(t):
    return filters.equals_extreme(t.sale, "year", t.parcel_year, "year").select("salekey", "year")


@query("p09_distinct", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct(t):
    return t.customer.select("c_nationkey", "c_mktsegment").distinct()


@query("p10_empty_to_null", """
SELECT p_partkey, NULLIF(trim(regexp_replace(p_name, '[a-z]+ ', '')), 'widget') AS noun,
  NULLIF(CASE WHEN p_size > 25 THEN p_brand ELSE '' END, '') AS brand FROM part""")
def empty_to_null(t):
    noun = F.nullif(F.trim(F.regexp_replace("p_name", "^[a-z]+ ", "")), F.lit("widget"))
    brand = text.empty_to_null(F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise(""))
    return t.part.select("p_partkey", noun.alias("noun"), brand.alias("brand"))


@query("p11_flag_comments", """
SELECT l_orderkey, l_linenumber, NULLIF(concat_ws(', ', CASE WHEN l_quantity > 40 THEN 'large' END,
 CASE WHEN l_discount > 0.08 THEN 'cheap' END, CASE WHEN l_tax = 0 THEN 'untaxed' END), '') AS comment FROM lineitem""")
def flag_comments(t):
    flags = [(F.col("l_quantity") > 40, "large"), (F.col("l_discount") > 0.08, "cheap"), (F.col("l_tax") == 0, "untaxed")]
    return t.lineitem.select("l_orderkey", "l_linenumber", logic.flag_comments(flags).alias("comment"))


@query("p12_extra_columns", """
SELECT c_nationkey, count(c_custkey) AS count_c_custkey, max(c_acctbal) AS top, min(c_mktsegment) AS min_c_mktsegment
FROM customer GROUP BY c_nationkey""")
def extra_columns(t):
    spec = [
        {"column": "c_custkey", "agg_func": "count"}, {"column": "c_acctbal", "agg_func": "max", "alias": "top"},
        {"column": "c_mktsegment", "agg_func": "min"},
    ]
    return t.customer.groupBy("c_nationkey").agg(*logic.extra_columns(spec))


@query("p13_fallback", """
SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN COALESCE(a, b) ELSE COALESCE(b, a, -1) END AS size FROM
(SELECT p_partkey, p_type, CASE WHEN p_partkey % 2 = 0 THEN p_size END AS a,
 CASE WHEN p_partkey % 3 = 0 THEN p_size * 10 END AS b FROM part)""")
def fallback(t):
    a = F.when(F.col("p_partkey") % 2 == 0, F.col("p_size"))
    b = F.when(F.col("p_partkey") % 3 == 0, F.col("p_size") * 10)
    size = F.when(F.col("p_type") == "ECONOMY", F.coalesce(a, b)).otherwise(F.coalesce(b, a, F.lit(-1)))
    return t.part.select("p_partkey", size.alias("size"))


@query("p14_row_id", """
SELECT CAST(l_orderkey AS VARCHAR) || CAST(l_linenumber AS VARCHAR) || l_returnflag AS row_id, l_quantity FROM lineitem""")
def row_id(t):
    return t.lineitem.select(text.row_id("l_orderkey", "l_linenumber", "l_returnflag").alias("row_id"), "l_quantity")


@query("p15_mirrored", """
SELECT l_orderkey, l_linenumber, status FROM (SELECT *, CASE WHEN l_returnflag = 'N' THEN 'no change' ELSE 'change' END AS status
 FROM lineitem) WHERE (status = 'no change' AND (l_quantity != 25 OR l_tax != l_discount))
 OR (status = 'change' AND (l_quantity = 25 AND l_tax = l_discount))""")
def mirrored(t):
    pairs = [(F.col("l_quantity"), F.lit(25)), (F.col("l_tax"), F.col("l_discount"))]
    status = F.when(F.col("l_returnflag") == "N", "no change").otherwise("change")
    moved = logic.any_of([a != b for a, b in pairs])
    still = logic.all_of([a == b for a, b in pairs])
    rows = t.lineitem.withColumn("status", status)
    bad = ((F.col("status") == "no change") & moved) | ((F.col("status") == "change") & still)
    return rows.where(bad).select("l_orderkey", "l_linenumber", "status")


@query("p16_suppress", """
SELECT c_custkey, CASE WHEN h.k IS NULL THEN c_name END AS c_name, CASE WHEN h.k IS NULL THEN c_mktsegment END AS c_mktsegment
FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_totalprice > 400000) h ON c_custkey = h.k""")
def suppress(t):
    hidden = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return filters.suppress(t.customer, hidden, "c_custkey", ["c_name", "c_mktsegment"]).select(
        "c_custkey", "c_name", "c_mktsegment"
    )


@query("o01_order_by", """
SELECT c_nationkey, c_mktsegment, c_custkey FROM customer
ORDER BY c_nationkey DESC, c_mktsegment ASC NULLS LAST, c_custkey""")
def order_by(t):
    return t.customer.select("c_nationkey", "c_mktsegment", "c_custkey").orderBy(
        F.col("c_nationkey").desc(), F.col("c_mktsegment").asc_nulls_last(), "c_custkey"
    )


@query("o02_top_k", """
SELECT status, year, salekey, rnk FROM (SELECT status, year, salekey,
 CAST(RANK() OVER (PARTITION BY status, year ORDER BY cents DESC) AS INT) AS rnk FROM sale) WHERE rnk <= 10""")
def top_k(t):
    return ordered.top_with_ties(t.sale, ["status", "year"], [F.col("cents").desc()], 10, "rnk").select(
        "status", "year", "salekey", "rnk"
    )


@query("o03_first_n", """
SELECT o_custkey, o_orderkey, n FROM (SELECT o_custkey, o_orderkey,
 CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INT) AS n FROM orders) WHERE n <= 5""")
def first_n(t):
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    return ordered.dedup_by_priority(t.orders, ["o_custkey"], order, 5, rank="n").select("o_custkey", "o_orderkey", "n")


@query("u01_union_all", """
SELECT c_nationkey AS nation, 'customer' AS kind FROM customer UNION ALL SELECT s_nationkey, 'supplier' FROM supplier""")
def union_all(t):
    left = t.customer.select(F.col("c_nationkey").alias("nation"), F.lit("customer").alias("kind"))
    return left.unionByName(t.supplier.select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("kind")))


@query("u02_union", """
SELECT c_nationkey AS nation, c_mktsegment AS label FROM customer UNION SELECT s_nationkey, 'SUPPLIER' FROM supplier""")
def union(t):
    left = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("label"))
    return left.union(t.supplier.select("s_nationkey", F.lit("SUPPLIER"))).distinct()


@query("u03_except", """
SELECT pin, cents FROM (SELECT pin, cents FROM sale WHERE year >= '1998') EXCEPT
SELECT pin, cents FROM sale WHERE status = 'F'""")
def except_history(t):
    return reshape.current_minus_history(t.sale.where("year >= '1998'"), t.sale.where("status = 'F'"), ["pin", "cents"])


@query("u04_union_by_name", """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS INT) AS size FROM customer
UNION ALL SELECT p_partkey, p_name, NULL, p_size FROM part""")
def union_by_name(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = t.part.select(F.col("p_size").alias("size"), F.col("p_name").alias("name"), F.col("p_partkey").alias("id"))
    return reshape.union_missing([a, b])


@query("u05_wide_to_long", """
SELECT l_orderkey, l_linenumber, 'first' AS stage, 1 AS stage_num, l_quantity AS a, l_discount AS b FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'second', 2, l_extendedprice, l_tax FROM lineitem""")
def wide_to_long(t):
    return reshape.wide_to_long(
        t.lineitem, ["l_orderkey", "l_linenumber"], {"first": {"stage_num": 1}, "second": {"stage_num": 2}},
        {"a": ["l_quantity", "l_extendedprice"], "b": ["l_discount", "l_tax"]},
    )


@query("u06_numbered_to_long", """
SELECT o_orderkey, number, comp_pin, comp_score FROM (
 SELECT o_orderkey, 1 AS number, o_custkey AS comp_pin, CAST(o_orderkey % 10 AS INT) AS comp_score FROM orders
 UNION ALL SELECT o_orderkey, 2, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey + 1 END, CAST(o_orderkey % 7 AS INT) FROM orders
 UNION ALL SELECT o_orderkey, 3, o_custkey + 2, CAST(o_orderkey % 5 AS INT) FROM orders)
WHERE comp_pin IS NOT NULL""")
def numbered_to_long(t):
    wide = t.orders.select(
        "o_orderkey", F.col("o_custkey").alias("comp_pin_1"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey") + 1).alias("comp_pin_2"),
        (F.col("o_custkey") + 2).alias("comp_pin_3"),
        *[(F.col("o_orderkey") % m).cast("int").alias(f"comp_score_{i}") for i, m in ((1, 10), (2, 7), (3, 5))],
    )
    return reshape.numbered_to_long(wide, ["o_orderkey"], ["comp_pin", "comp_score"], 3, keep_null=False)
