"""Assessment-like tables derived from the given ones, in SQL common to Spark and DuckDB."""

from plotwise.catalog.registry import DERIVED

DERIVED.update(
    {
        # One row per parcel (customer) and year with a value, a count and a 0/1 exemption mark.
        "parcel_year": """
SELECT o_custkey AS pin, CAST(year(o_orderdate) AS STRING) AS year, COUNT(*) AS n,
       CAST(ROUND(SUM(o_totalprice) * 100) AS BIGINT) AS cents,
       MAX(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS exe
FROM orders GROUP BY o_custkey, CAST(year(o_orderdate) AS STRING)""",
        # Sales: one row per order, with text years and a price in cents.
        "sale": """
SELECT o_orderkey AS salekey, o_custkey AS pin, CAST(o_orderdate AS DATE) AS sale_date,
       CAST(year(o_orderdate) AS STRING) AS year, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents,
       o_orderstatus AS status, o_orderpriority AS priority
FROM orders""",
        # Parcel points on whole coordinates.
        "parcel_point": """
SELECT c_custkey AS pin, CAST((c_custkey * 7919) % 10007 AS DOUBLE) AS x,
       CAST((c_custkey * 10273) % 10009 AS DOUBLE) AS y, CAST(1995 + c_custkey % 7 AS STRING) AS year
FROM customer""",
        # Stops: points of suppliers.
        "stop_point": """
SELECT s_suppkey AS stop_id, CAST((s_suppkey * 6007) % 10007 AS DOUBLE) AS x,
       CAST((s_suppkey * 9001) % 10009 AS DOUBLE) AS y, CAST(1995 + s_suppkey % 7 AS STRING) AS year
FROM supplier""",
        # Zones: rectangles of nations whose borders lie between whole coordinates.
        "zone": """
SELECT n_nationkey AS zone_id, n_name AS zone_name,
       (n_nationkey % 5) * 2000 - 0.5 AS x0, (n_nationkey % 5) * 2000 + 1999.5 AS x1,
       CAST(FLOOR(n_nationkey / 5) AS INT) * 2000 - 0.5 AS y0,
       CAST(FLOOR(n_nationkey / 5) AS INT) * 2000 + 1999.5 AS y1,
       CAST(1995 + 2 * (n_nationkey % 3) AS STRING) AS year
FROM nation""",
        # Roads: short segments of parts.
        "road": """
SELECT p_partkey AS road_id, p_brand AS road_name,
       CAST((p_partkey * 4001) % 10007 AS DOUBLE) AS x1, CAST((p_partkey * 3001) % 10009 AS DOUBLE) AS y1,
       CAST((p_partkey * 4001) % 10007 + 60 AS DOUBLE) AS x2,
       CAST((p_partkey * 3001) % 10009 + (p_partkey % 3) * 40 AS DOUBLE) AS y2,
       CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS speed
FROM part""",
        # Ratio rows: estimate from the list price, price from the line.
        "ratio_row": """
SELECT p_brand AS brand, l_quantity * p_retailprice AS fmv, l_extendedprice AS sale_price, l_orderkey, l_linenumber
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    }
)
