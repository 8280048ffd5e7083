"""Assessment-system tables derived from the given tables.

Customers stand for parcels, their orders for sales and yearly values, lineitems for cards, lines and details.
The SQL is common to Spark and DuckDB, so that models can be checked on the same inputs. Years are moved by 24 so
that rules that start in 2020, 2021 or 2024 take part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.catalog.registry import DERIVED, Tables
from plotwise.functions import geometry as geo
from plotwise.plans.warehouse import Warehouse

TODAY = "2025-06-30"

DERIVED.update(
    {
        "w_parcel": """
SELECT c_custkey AS k, c_name AS name, c_acctbal AS bal, c_mktsegment AS seg, CAST(10 + c_nationkey AS STRING) AS town,
 lpad(CAST(CASE WHEN c_custkey % 10 >= 8 THEN c_custkey - c_custkey % 10 + 8 ELSE c_custkey END AS STRING), 10, '0') AS pin10,
 lpad(CAST(CASE WHEN c_custkey % 10 >= 8 THEN c_custkey - c_custkey % 10 + 8 ELSE c_custkey END AS STRING), 10, '0')
  || CASE WHEN c_custkey % 10 >= 8 THEN '100' || CAST(c_custkey % 10 AS STRING) ELSE '0000' END AS parid,
 CASE c_custkey % 10 WHEN 0 THEN '202' WHEN 1 THEN '2-03' WHEN 2 THEN '211' WHEN 3 THEN '218' WHEN 4 THEN '100' WHEN 5 THEN '500'
  WHEN 6 THEN 'EX' WHEN 7 THEN '234' WHEN 8 THEN '299' ELSE '399' END AS class FROM customer""",
        "w_py": """
SELECT p.*, CAST(o.y AS STRING) AS taxyr, o.y, o.v, o.n, o.first_order FROM w_parcel p JOIN
(SELECT o_custkey, CAST(year(o_orderdate) + 24 AS INT) AS y, CAST(ROUND(SUM(o_totalprice)) AS BIGINT) AS v, COUNT(*) AS n, MIN(o_orderkey) AS first_order
 FROM orders GROUP BY o_custkey, CAST(year(o_orderdate) + 24 AS INT)) o ON p.k = o.o_custkey""",
        "w_order": """
SELECT o_orderkey AS ok, p.*, CAST(ROUND(o_totalprice) AS BIGINT) AS price, o_orderstatus AS status, substr(o_orderpriority, 1, 1) AS prio,
 CAST(year(o_orderdate) + 24 AS STRING) || substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 5) AS day,
 CAST(year(o_orderdate) + 24 AS STRING) AS yr FROM orders JOIN w_parcel p ON o_custkey = p.k""",
        "w_line": """
SELECT w.*, l_linenumber AS ln, l_partkey AS part, l_suppkey AS supp, CAST(l_quantity AS BIGINT) AS qty, CAST(ROUND(l_extendedprice) AS BIGINT) AS amount, l_returnflag AS flag,
 l_linestatus AS lstatus FROM w_order w JOIN (SELECT l_orderkey, l_linenumber, MIN(l_partkey) AS l_partkey, MIN(l_suppkey) AS l_suppkey, MIN(l_quantity) AS l_quantity,
 MIN(l_extendedprice) AS l_extendedprice, MIN(l_returnflag) AS l_returnflag, MIN(l_linestatus) AS l_linestatus FROM lineitem GROUP BY l_orderkey, l_linenumber) l ON w.ok = l.l_orderkey""",
        "w_pardat": """
SELECT parid, taxyr, class, town || lpad(CAST(k % 100 AS STRING), 3, '0') AS nbhd, 'Y' AS cur, CASE WHEN k % 97 = 5 THEN 'x' END AS deactivat,
 CASE WHEN k % 11 = 0 THEN lpad(CAST(k AS STRING), 14, '9') END AS tieback, CASE WHEN k % 3 = 0 THEN 50.0 END AS tiebldgpct,
 CASE k % 7 WHEN 0 THEN 'P-1' WHEN 1 THEN 'PH-2' WHEN 2 THEN 'GAR4' ELSE '12' END AS unitno,
 CASE WHEN k % 13 = 0 AND y > 2021 THEN 'PARKING/STORAGE/COMMON UNIT' END AS note2, CASE WHEN k % 5 = 0 THEN '202' ELSE class END AS luc, '0' AS jur,
 'R1' AS zoning, seg AS note1, 'u' AS user1 FROM w_py""",
        "w_legdat": """
SELECT parid, taxyr, town AS user1, town || '001' AS taxdist, CASE WHEN k % 4 = 0 THEN '00000' ELSE '60' || town || '1' END AS zip1, '0000' AS zip2, CAST(k % 900 AS INT) AS adrno,
 'N' AS adrdir, 'STREET' || CAST(k % 50 AS STRING) AS adrstr, 'AVE' AS adrsuf, CAST(NULL AS STRING) AS adrsuf2, CAST(NULL AS STRING) AS adrpre, CAST(NULL AS STRING) AS adradd,
 CASE WHEN k % 9 = 0 THEN 'UNIT' END AS unitdesc, CASE WHEN k % 9 = 0 THEN '3' END AS unitno, 'CITY' || town AS cityname, 'IL' AS statecode, 'Y' AS cur, CAST(NULL AS STRING) AS deactivat FROM w_py""",
        "w_sales": """
SELECT ok AS salekey, parid, day || ' 00:00:00.0' AS saledt, CASE WHEN ok % 50 = 0 THEN NULL WHEN ok % 17 = 0 THEN 9000 WHEN ok % 6 = 0 THEN 150000 ELSE price END AS price,
 CASE WHEN ok % 41 = 0 THEN NULL ELSE 'D' || lpad(CAST(ok + CASE WHEN ok % 4 = 0 THEN 1 ELSE 0 END AS STRING), 10, '0') END AS instruno,
 CASE prio WHEN '1' THEN '01' WHEN '2' THEN '02' WHEN '3' THEN '03' WHEN '4' THEN '05' END AS instrtyp, CASE WHEN ok % 29 = 0 THEN 3 ELSE 1 END AS nopar,
 CASE WHEN ok % 3 = 0 THEN 'MISSING SELLER NAME' ELSE 'SELLER ' || seg END AS oldown, CASE WHEN ok % 8 = 0 THEN ' ' ELSE name END AS own1,
 CASE WHEN ok % 2 = 0 THEN '0' ELSE '1' END AS saletype, 'Y' AS cur, CASE WHEN ok % 23 = 0 THEN 'x' END AS deactivat, 'staff' AS who, day || ' 10:00:00.0' AS wen FROM w_order""",
        "w_mydec": """
SELECT lpad(CAST(ok AS STRING), 10, '0') AS document_number, substr(parid, 1, 2) || '-' || substr(parid, 3) AS line_1_primary_pin, CAST(1 + ok % 2 AS INT) AS line_2_total_parcels,
 CASE WHEN ok % 5 = 0 THEN substr(day, 1, 8) || '15' ELSE day END AS line_4_instrument_date, 'Warranty' AS line_5_instrument_type, seg AS seller_name, ' ' AS buyer_name,
 yr AS year_of_sale, ok % 9 = 0 AS is_multisale, price AS line_11_full_consideration, CASE WHEN ok % 7 = 0 THEN NULL ELSE 'addr' END AS full_address, ok % 12 = 0 AS b FROM w_order WHERE ok % 3 = 0""",
        "w_flag": """
SELECT lpad(CAST(ok AS STRING), 10, '0') AS meta_sale_document_num, ok % 4 = 0 AS sv_is_outlier, ok % 8 = 0 AS sv_is_ptax_outlier, ok % 12 = 0 AS sv_is_heuristic_outlier,
 CASE ok % 5 WHEN 0 THEN 'High price' WHEN 1 THEN 'Low price per square foot' WHEN 2 THEN 'PTAX' END AS sv_outlier_reason1, CASE WHEN ok % 10 = 0 THEN 'Low price' END AS sv_outlier_reason2,
 CAST(NULL AS STRING) AS sv_outlier_reason3, 'run' || CAST(v AS STRING) AS run_id, v AS version, 'g' || town AS grp, CAST(price AS DOUBLE) AS meta_sale_price_original, FALSE AS ptax_flag_original
 FROM w_order JOIN (SELECT 1 AS v UNION ALL SELECT 2) n ON ok % 2 = 0 OR v = 1 WHERE ok % 5 != 3""",
        "w_review": """
SELECT lpad(CAST(ok AS STRING), 10, '0') AS doc_no, CASE WHEN ok % 9 < 8 THEN ok % 3 != 0 END AS is_arms_length, CASE WHEN ok % 9 < 8 THEN ok % 5 = 0 END AS is_flip,
 CASE WHEN ok % 9 < 8 THEN ok % 11 = 0 END AS has_class_change, CASE WHEN ok % 9 < 8 THEN CASE ok % 4 WHEN 0 THEN 'yes_major' WHEN 1 THEN 'yes_minor' ELSE 'no' END END AS has_characteristic_change
 FROM w_order WHERE ok % 7 < 3""",
        "w_asmt_all": """
SELECT parid, taxyr, class, CASE WHEN k % 31 = 6 THEN 'RR' ELSE 'RP' END AS rolltype, CAST(NULL AS STRING) AS valclass, s.procname, CASE WHEN s.procname IS NULL THEN 'Y' ELSE CASE WHEN s.stage = 3 THEN 'Y' ELSE 'N' END END AS cur,
 CAST(NULL AS STRING) AS deactivat, v % 10000 + s.stage AS valasm1, v % 70000 AS valasm2, v % 10000 + s.stage + v % 70000 AS valasm3, v % 10000 * 10 AS valapr1, v % 70000 * 10 AS valapr2,
 (v % 10000 + v % 70000) * 10 AS valapr3, v % 9000 AS ovrvalasm1, v % 60000 AS ovrvalasm2, v % 9000 + v % 60000 AS ovrvalasm3, v % 100000 AS tot13, CASE WHEN k % 2 = 0 THEN v % 50 END AS tot30, v % 200000 AS tot51,
 'staff' AS who, taxyr || '-03-01 00:00:00.0' AS wen, 'w' AS wencalc, 'x' AS whocalc, v % 90 - 5 AS val01, v % 80 AS val14, v % 70 AS val30
 FROM w_py JOIN (SELECT 1 AS stage, 'ASSRVALUE' AS procname UNION ALL SELECT 2, 'ASSRFINAL' UNION ALL SELECT 3, 'BORVALUE' UNION ALL SELECT 4, 'FINALEAV' UNION ALL SELECT 5, NULL) s
 ON s.stage = 5 OR (y < 2025 AND s.stage <= 4) OR s.stage <= k % 3""",
        "w_land": """
SELECT parid, yr AS taxyr, CAST(ln AS INT) AS lline, qty * 100 AS sf, CASE WHEN ln % 2 = 0 THEN 1.0 END AS influ, CASE WHEN ln % 3 = 0 THEN 0.5 END AS allocpct, CASE WHEN part % 19 = 0 THEN '35' WHEN part % 23 = 0 THEN '30' END AS infl1,
 CAST(NULL AS STRING) AS infl2, 'SAPx' AS user7, 'Y' AS cur, CAST(NULL AS STRING) AS deactivat, CASE WHEN part % 5 = 0 THEN 'A' ELSE 'S' END AS ltype, CASE WHEN part % 4 = 0 THEN '900' ELSE '0' END AS code,
 CASE WHEN part % 2 = 0 THEN '200' ELSE '100' END AS class, 2.0 AS brate, 1.0 AS acres, 1.0 AS orate, 5.0 AS price, CAST(NULL AS DOUBLE) AS ovrprice, 'n' AS note1, CAST(NULL AS DOUBLE) AS influ2, 0 AS oincr, 0 AS odecr, 0 AS exmppct, 0 AS osize
 FROM w_line""",
        "w_dweldat": """
SELECT parid, taxyr, CAST(c.card AS INT) AS card, CAST(c.card AS INT) AS seq, class, 'who' AS who, taxyr || '-02-03 11:12:13.0' AS wen, CASE WHEN k % 3 = 0 THEN 'AV' ELSE 'AI' END AS cdu, '100' AS user24, CAST(k % 2 AS DOUBLE) * 40 AS external_propct,
 CAST(1900 + k % 120 AS INT) AS yrblt, CAST(500 + v % 3000 AS BIGINT) AS sfla, CAST(1 + v % 5 AS INT) AS rmbed, 6 AS rmtot, CAST(1 + v % 3 AS INT) AS fixbath, CAST(v % 2 AS INT) AS fixhalf, 1 AS wbfp_o, CAST(1 + k % 9 AS INT) AS stories, '2' AS grade,
 CASE WHEN (k + y) % 4 < 2 THEN '1' ELSE '2' END AS user3, CASE WHEN k % 6 = 0 THEN 'AI' WHEN k % 6 = 1 THEN 'gr' END AS user16, '1' AS user1, '2' AS user2, '1' AS user4, '0' AS user5, '3' AS user6, '1' AS user7, '3' AS user12, '1' AS user13, '6' AS user14, '1' AS user15, '20' AS user17,
 '0' AS user20, '0' AS user30, '1' AS user31, '2' AS user32, CAST(1 + k % 8 AS STRING) AS user33, '1' AS user34, '3' AS attic, '1' AS bsmt, '2' AS extwall, '1' AS heat, CASE WHEN k % 5 = 0 THEN '5B' WHEN k % 5 = 1 THEN '5' END AS mktrsn,
 CAST(v % 5000 AS BIGINT) AS adjrcnld, 80.0 AS external_occpct, 90.0 AS mktadj, CAST(v % 7000 AS BIGINT) AS external_rcnld, CAST(v % 6000 AS BIGINT) AS external_calc_rcnld, CASE WHEN k % 4 = 0 THEN CAST(v % 6000 AS BIGINT) ELSE CAST(v % 100 AS BIGINT) END AS ovrrcnld,
 'Y' AS cur, CAST(NULL AS STRING) AS deactivat FROM w_py JOIN (SELECT 1 AS card UNION ALL SELECT 2 UNION ALL SELECT 3) c ON c.card <= 1 + k % 3 WHERE k % 10 IN (0, 1, 2, 3, 7)""",
        "w_oby": """
SELECT parid, taxyr, 1 AS card, CAST(c.card AS INT) AS lline, CASE WHEN k % 10 >= 8 THEN '299' WHEN k % 10 = 5 THEN '289' ELSE '2-90' END AS class, '297' AS code, CASE WHEN k % 4 = 0 THEN '13' END AS user1, 'SAP' AS user3, CAST(v % 9 AS STRING) AS user10, CASE WHEN k % 6 = 0 THEN 'GR' ELSE 'AV' END AS user16,
 'h' AS user18, '25' AS user20, CAST(1950 + k % 70 AS INT) AS yrblt, CAST(NULL AS INT) AS effyr, CASE WHEN k % 5 = 0 THEN '5' ELSE '2' END AS chgrsn, CAST(v % 4000 AS BIGINT) AS adjrcnld, 70.0 AS external_occpct, 50.0 AS external_propct, 90.0 AS mktadj, 1 AS convoby, 'm' AS calc_meth,
 CAST(v % 7000 AS BIGINT) AS external_rcnld, CAST(v % 6000 AS BIGINT) AS external_calc_rcnld, CAST(v % 90 AS BIGINT) AS ovrrcnld, 'who' AS who, taxyr || '-02-03 11:12:13.0' AS wen, 'Y' AS cur, CAST(NULL AS STRING) AS deactivat
 FROM w_py JOIN (SELECT 1 AS card UNION ALL SELECT 2) c ON c.card <= 1 + k % 2 WHERE k % 10 IN (2, 5, 8)""",
        "w_comdat": """
SELECT parid, taxyr, 1 AS card, CASE WHEN k % 10 >= 8 THEN '399' ELSE class END AS class, 1 AS bldnum, CASE WHEN k % 6 = 0 THEN 'AI' ELSE 'AV' END AS user16, 'SAP' AS user4, CASE WHEN k % 8 = 1 THEN '49' END AS user13, '30' AS user24, CAST(1960 + k % 60 AS INT) AS yrblt, CAST(1990 AS INT) AS effyr,
 CASE WHEN k % 5 = 0 THEN '5' ELSE '5B' END AS chgrsn, CAST(v % 8000 AS BIGINT) AS bldgval, 60.0 AS external_occpct, 40.0 AS external_propct, 90.0 AS mktadj, CAST(v % 7000 AS BIGINT) AS external_rcnld, CAST(v % 6000 AS BIGINT) AS external_calc_rcnld, CAST(v % 90 AS BIGINT) AS ovrrcnld, 'm' AS calc_meth,
 'who' AS who, taxyr || '-02-03 11:12:13.0' AS wen, 'Y' AS cur, CAST(NULL AS STRING) AS deactivat FROM w_py WHERE k % 10 IN (5, 9)""",
        "w_exdet": """
SELECT parid, yr AS taxyr, 'C' || CAST(ok AS STRING) AS caseno, CASE supp % 8 WHEN 0 THEN 'HO' WHEN 1 THEN 'C-HO' WHEN 2 THEN 'SR' WHEN 3 THEN 'DV1' WHEN 4 THEN 'I-X' WHEN 5 THEN 'SF' WHEN 6 THEN 'WW2' ELSE 'LT1' END AS excode,
 CAST(MAX(qty * 100) AS STRING) AS apother, 'Y' AS cur, CAST(NULL AS STRING) AS deactivat FROM w_line GROUP BY 1, 2, 3, 4""",
        "w_exadmn": """
SELECT DISTINCT parid, yr AS taxyr, 'C' || CAST(ok AS STRING) AS caseno, CASE supp % 8 WHEN 0 THEN 'HO' WHEN 1 THEN 'C-HO' WHEN 2 THEN 'SR' WHEN 3 THEN 'DV1' WHEN 4 THEN 'I-X' WHEN 5 THEN 'SF' WHEN 6 THEN 'WW2' ELSE 'LT1' END AS excode,
 CASE ok % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'No' END AS user126, CASE WHEN ok % 2 = 0 THEN day || ' 00:00:00' END AS udate9, CASE WHEN ok % 7 = 0 THEN 'D' ELSE 'A' END AS exstat, 'Y' AS cur, CAST(NULL AS STRING) AS deactivat FROM w_line""",
        "w_excode": """
SELECT excode, taxyr, 'Y' AS cur, CAST(NULL AS STRING) AS deactivat FROM (SELECT DISTINCT taxyr FROM w_py) y CROSS JOIN (SELECT 'HO' AS excode UNION ALL SELECT 'C-HO' UNION ALL SELECT 'SR' UNION ALL SELECT 'DV1' UNION ALL SELECT 'SF' UNION ALL SELECT 'WW2' UNION ALL SELECT 'I-X') c""",
        "w_htpar": """
SELECT parid, yr AS taxyr, CASE WHEN ok % 13 = 0 THEN 'COE' || CAST(ok AS STRING) ELSE 'A' || CAST(ok AS STRING) END AS caseno, CASE WHEN ok % 5 = 0 THEN 'C' WHEN ok % 5 = 1 THEN 'X' ELSE 'A' END AS heartyp, 1 AS subkey,
 CASE ok % 4 WHEN 0 THEN 'CC' WHEN 1 THEN 'RS' WHEN 2 THEN 'IC' ELSE 'LD' END AS user38, 'Y' AS user19, 'N' AS user20, CAST(NULL AS STRING) AS user21, 'Y' AS user22, 'N' AS user23, 'Y' AS user24, 'N' AS user25, 'Y' AS user109, 'N' AS user110, 'Y' AS user40, 'other' AS user81,
 CASE WHEN ok % 2 = 0 THEN ' Decrease' WHEN ok % 3 = 0 THEN 'NO CHANGE' ELSE 'Change' END AS user104, 'C' AS resact, CASE status WHEN 'F' THEN 'C' ELSE status END AS hrstatus, 'AG' || CAST(ok % 9 AS STRING) AS cpatty, 'v' AS user125, '1:x' AS user42, '0' AS user43, '2 y' AS user44,
 '1-' AS user89, '2' AS user100, CAST(NULL AS STRING) AS user101, 'Y' AS cur, CAST(NULL AS STRING) AS deactivat FROM w_order""",
        "w_owndat": """
SELECT parid, taxyr, name AS own1, CAST(NULL AS STRING) AS own2, CASE WHEN k % 3 = 0 THEN '' ELSE 'PO BOX ' || CAST(k AS STRING) END AS addr1, CASE WHEN k % 6 = 0 THEN 'SUITE' END AS addr2, CAST(k % 90 AS INT) AS adrno, 'S' AS adrdir, 'OAK' AS adrstr, 'ST' AS adrsuf, CAST(NULL AS STRING) AS unitdesc,
 CAST(NULL AS STRING) AS unitno, 'TOWN' AS cityname, 'IL' AS statecode, '60000' AS zip1, '0000' AS zip2, CASE WHEN k % 4 = 0 THEN CAST(k AS STRING) END AS ownnum, 'Y' AS cur, CAST(NULL AS STRING) AS deactivat FROM w_py""",
        "w_maildat": """
SELECT parid, taxyr, CAST(m.seq AS INT) AS mailseq, name || '  ' AS mail1, seg AS mail2, '1  MAIN ST' AS maddr1, CAST(NULL AS STRING) AS maddr2, 'MCITY' AS mcityname, 'IL' AS mstatecode, '60001' AS mzip1, '0000' AS mzip2, 'Y' AS cur, CAST(NULL AS STRING) AS deactivat
 FROM w_py JOIN (SELECT 1 AS seq UNION ALL SELECT 2) m ON m.seq <= 1 + k % 2""",
        "w_permit": """
SELECT parid, CAST(ok AS STRING) AS iasw_id, CAST(ok AS STRING) AS num, day AS permdt, day AS certdate, CASE WHEN ok % 2 = 0 THEN 'A' ELSE 'N' END AS user18, CAST(price AS DOUBLE) AS amount, status AS flag, '(20' || substr(yr, 3) || ')' AS user11, 'L' AS user28, yr AS user31, CAST(NULL AS STRING) AS udate3, day AS wen,
 day AS udate2, CAST(k % 90 AS INT) AS adrno, CAST(NULL AS STRING) AS adrdir, CASE WHEN ok % 3 = 0 THEN 'N' ELSE 'NW' END AS adradd, 'ELM' AS adrstr, 'ST' AS adrsuf, CAST(NULL AS STRING) AS adrsuf2, 'A,,B,,' AS note2, name AS user21, '1' AS why, '111' AS user42, 'roof' AS user43, '390' AS user6, '900' AS user7,
 CAST(NULL AS STRING) AS user8, CAST(NULL AS STRING) AS user9, 'f' AS id1, 'n' AS note3, 'Y' AS cur, CAST(NULL AS STRING) AS deactivat FROM w_order""",
        "w_aprval": """
SELECT parid, taxyr, CAST(k % 30 AS STRING) AS reascd, 'ASSRFINAL' AS procname, CASE WHEN k % 40 = 0 THEN 1.0 END AS ecf, 'staff' AS who, taxyr || '-04-05 08:09:10.0' AS wen, 'w' AS wencalc, 'x' AS whocalc, 'n' AS spcflg, CASE WHEN k % 2 = 0 THEN '1' END AS revcode, taxyr || '-04-05 00:00:00.0' AS revdt, v % 900 AS comval,
 v % 800 AS obyval, v % 10000 * 10 AS aprland, v % 70000 * 10 AS aprbldg, (v % 10000 + v % 70000) * 10 AS aprtot, v % 60000 AS dwelval, 0 AS exmppct, 'Y' AS cur, CAST(NULL AS STRING) AS deactivat FROM w_py""",
        "w_class": """
SELECT class_code, modeling_group, major AS reporting_class_code, 'class ' || class_code AS class_desc, regression_class FROM
(SELECT '202' AS class_code, 'SF' AS modeling_group, '2' AS major, TRUE AS regression_class UNION ALL SELECT '203', 'SF', '2', TRUE UNION ALL SELECT '211', 'MF', '2', TRUE UNION ALL SELECT '218', 'BB', '2', TRUE UNION ALL
 SELECT '234', 'SF', '2', TRUE UNION ALL SELECT '299', 'CONDO', '2', FALSE UNION ALL SELECT '399', 'CONDO', '3', FALSE UNION ALL SELECT '100', NULL, '1', FALSE UNION ALL SELECT '500', NULL, '5B', FALSE) c
 WHERE EXISTS (SELECT 1 FROM region)""",
        "w_township": """
SELECT CAST(10 + n_nationkey AS STRING) AS township_code, n_name AS township_name, CASE n_nationkey % 3 WHEN 0 THEN 'City' WHEN 1 THEN 'North' ELSE 'South' END AS triad_name, CAST(1 + n_nationkey % 3 AS STRING) AS triad_code FROM nation""",
        "w_spot": """
SELECT pin10, taxyr AS year, MIN(town) AS town_code, MIN(town) || '001' AS tax_code, CAST((CAST(pin10 AS BIGINT) * 7919) % 10007 AS DOUBLE) AS x_3435, CAST((CAST(pin10 AS BIGINT) * 10273) % 10009 AS DOUBLE) AS y_3435,
 CASE WHEN CAST(pin10 AS BIGINT) % 5 != 0 OR taxyr > '2022' THEN CAST(CAST(pin10 AS BIGINT) % 1000 AS DOUBLE) / 1000 - 88 END AS lon, CAST(CAST(pin10 AS BIGINT) % 777 AS DOUBLE) / 1000 + 41 AS lat FROM w_py WHERE taxyr < '2025' GROUP BY pin10, taxyr""",
        "w_layer": """
SELECT n_nationkey AS n, n_name AS name, (n_nationkey % 5) * 2000 - 0.5 AS x0, (n_nationkey % 5) * 2000 + 1999.5 AS x1, CAST(FLOOR(n_nationkey / 5) AS INT) * 2000 - 0.5 AS y0, CAST(FLOOR(n_nationkey / 5) AS INT) * 2000 + 1999.5 AS y1, yr AS year
 FROM nation CROSS JOIN (SELECT '2019' AS yr UNION ALL SELECT '2022') y""",
        "w_taxpin": """
SELECT parid AS pin, taxyr AS year, class, CASE WHEN k % 9 = 0 THEN 0.0 ELSE CAST(v % 9000 AS DOUBLE) END AS tax_bill_total, town || '001' AS tax_code_num, v % 50000 AS av_mailed, v % 50000 AS av_certified, v % 49000 AS av_board, CASE WHEN (k + y) % 4 = 0 THEN 0 ELSE 1000 END AS exe_homeowner,
 0 AS exe_senior, 0 AS exe_freeze, 0 AS exe_longtime_homeowner, 0 AS exe_disabled, 0 AS exe_vet_returning, 0 AS exe_vet_dis_lt50, 0 AS exe_vet_dis_50_69, 0 AS exe_vet_dis_ge70, 0 AS exe_abate FROM w_py WHERE taxyr < '2025'""",
        "w_taxcode": """
SELECT y.year, t.township_code || '001' AS tax_code_num, 5.5 AS tax_code_rate, a.agency_num FROM (SELECT DISTINCT taxyr AS year FROM w_py WHERE taxyr < '2025') y CROSS JOIN w_township t JOIN w_agency a ON a.town = t.township_code OR a.town = 'all'""",
        "w_agency": """
SELECT township_code AS town, 'M' || township_code AS agency_num, 'VILLAGE ' || township_name AS agency_name, 'MUNICIPALITY' AS major_type, 'MUNI' AS minor_type FROM w_township UNION ALL
SELECT township_code, 'S' || township_code, 'SCHOOL ' || township_name, 'SCHOOL', CASE WHEN triad_name = 'City' THEN 'UNIFIED' ELSE 'ELEMENTARY' END FROM w_township UNION ALL
SELECT 'all', 'T1', 'TIF ONE', 'MISC', 'TIF' FROM region WHERE r_regionkey = 0""",
        "w_final_raw": """
SELECT '2024' AS year, '2024-02-0' || CAST(r_regionkey AS STRING) || '-' || lower(r_name) AS run_id, CASE r_regionkey % 3 WHEN 0 THEN 'City' WHEN 1 THEN 'North' ELSE 'South' END AS triad_name, 'res' AS type, r_regionkey = 0 AS is_final, '2/1/2024' AS date_chosen, '2/2/2024' AS date_emailed, '12/13/2024' AS date_finalized,
 'best' AS reason_chosen, '["1' || CAST(r_regionkey AS STRING) || '","2' || CAST(r_regionkey AS STRING) || '"]' AS township_code_coverage, CAST(NULL AS STRING) AS reference_run_id, 't' AS email_title, 'n' AS note FROM region""",
        "w_run": """
SELECT '2024-02-0' || CAST(r_regionkey AS STRING) || '-' || lower(r_name) AS run_id, '2024' AS assessment_year, '2023' AS assessment_data_year, CASE r_regionkey % 3 WHEN 0 THEN 'city' WHEN 1 THEN 'north' ELSE 'south' END AS assessment_triad, 'all' AS model_predictor_all_name FROM region""",
        "w_card": """
SELECT p.parid AS meta_pin, CAST(c.card AS INT) AS meta_card_num, '2023' AS meta_year, r.run_id, p.town AS township_code, p.town AS meta_township_code, t.triad_code AS meta_triad_code, replace(p.class, '-', '') AS char_class, CAST(400 + p.v % 2000 + c.card AS BIGINT) AS char_bldg_sf, CAST(p.v * 1.1 AS DOUBLE) AS pred_card_initial_fmv, p.town || '001' AS meta_nbhd_code,
 CAST(p.k % 25 AS STRING) AS loc_school_elementary_district_geoid, CAST(NULL AS STRING) AS loc_school_secondary_district_geoid, 1900 AS char_yrblt, p.v FROM w_py p JOIN w_township t ON p.town = t.township_code JOIN (SELECT 1 AS card UNION ALL SELECT 2) c ON c.card <= 1 + p.k % 2 JOIN w_run r ON TRUE WHERE p.taxyr = '2023' AND p.k % 10 IN (0, 1, 2, 3, 7)""",
        "w_apin": """
SELECT meta_pin, run_id, '2024' AS year, MAX(char_class) AS meta_class, MAX(township_code) AS township_code, MAX(meta_triad_code) AS meta_triad_code, CAST(NULL AS INT) AS meta_pin_num_cards, 'addr' AS loc_property_address, 'city' AS loc_property_city, 1.0 AS meta_tieback_proration_rate, CAST(NULL AS STRING) AS meta_tieback_key_pin,
 CAST(ROUND(SUM(v) * 1.05, -1) AS DOUBLE) AS pred_pin_final_fmv_round FROM w_card GROUP BY meta_pin, run_id""",
    }
)


def _with(df: DataFrame, **columns) -> DataFrame:
    return df.withColumns(columns)


def layer(t: Tables, **attributes) -> DataFrame:
    """Rectangles of nations in two years with the given attributes."""
    shape = geo.rectangle(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    return t.w_layer.select("year", shape.alias("rings"), *[(F.expr(c)).alias(n) for n, c in attributes.items()])


def lines(t: Tables, **attributes) -> DataFrame:
    """Short lines of parts in two years."""
    ring = F.array(F.array(geo.xy(F.col("x1"), F.col("y1")), geo.xy(F.col("x2"), F.col("y2"))))
    year = F.explode(F.array(F.lit("2019"), F.lit("2022"))).alias("year")
    return t.road.select(year, ring.alias("rings"), *[F.expr(c).alias(n) for n, c in attributes.items()])


def dots(t: Tables, **attributes) -> DataFrame:
    """Points of suppliers in two years."""
    year = F.explode(F.array(F.lit("2019"), F.lit("2022"))).alias("year")
    return t.stop_point.select(year, "x", "y", *[F.expr(c).alias(n) for n, c in attributes.items()])


def filler(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns that a view prints but the derived tables have no counterpart for."""
    return df.withColumns({c: F.lit(None).cast("string") for c in columns if c not in df.columns})


def declarations(t: Tables) -> DataFrame:
    from plotwise.plans.sales import DECLARATION_LINES, SUSPECT_LINES

    rows = t.w_mydec
    flags = {c: (F.col("b") if c in SUSPECT_LINES else F.lit(False)) for c in DECLARATION_LINES}
    return rows.withColumns(flags).drop("b")


def pivot_places(t: Tables, kinds: tuple[str, ...], kind: str, **attributes) -> DataFrame:
    """A layer that repeats for every kind of area."""
    return layer(t, **attributes).withColumn(kind, F.explode(F.array(*[F.lit(k) for k in kinds])))


def survey(t: Tables) -> DataFrame:
    """Survey lines: every table line is a small function of the area."""
    from plotwise.plans.census import COUNTS, SHARES

    keys = [*COUNTS.values(), *[k for pair in SHARES.values() for k in pair if not isinstance(k, str)]]
    columns = sorted({f"{table}_{n:03d}e" for table, *numbers in keys for n in numbers})
    values = {c: (F.col("n") * 7 + i % 13 + 1).cast("double") for i, c in enumerate(columns)}
    rows = t.w_layer.select("year", F.col("n").cast("string").alias("geoid"), F.lit("tract").alias("geography"), "n")
    return rows.withColumns(values).drop("n")


def sources(t: Tables) -> dict:
    from plotwise.plans.locations import GEOGRAPHIES
    from plotwise.plans.quality import COMMERCIAL_NAMES, COMMERCIAL_PLAIN

    schools = ("elementary", "secondary", "unified")
    table = {
        **{n: (lambda n=n: getattr(t, f"w_{n}")) for n in (
            "pardat", "legdat", "sales", "land", "dweldat", "oby", "exdet", "exadmn", "excode", "htpar", "owndat", "maildat", "permit", "aprval", "asmt_all",
        )},
        "comdat": lambda: filler(t.w_comdat, [*COMMERCIAL_NAMES, *COMMERCIAL_PLAIN]),
        "asmt_hist": lambda: t.w_asmt_all.where("parid LIKE '%1'"),
        "class_dict": lambda: t.w_class,
        "spatial.township": lambda: t.w_township,
        "sale.mydec": lambda: declarations(t),
        "sale.flag": lambda: t.w_flag.withColumnRenamed("grp", "group"),
        "sale.flag_review": lambda: t.w_review,
        "sale.group_mean": lambda: t.w_flag.groupBy("run_id", F.col("grp").alias("group")).agg(F.count(F.lit(1)).alias("group_size")),
        "sale.parameter": lambda: t.w_flag.select("run_id").distinct().withColumn("min_group_thresh", F.lit(30)),
        "sale.deed_type": lambda: t.w_sales.select(F.col("instrtyp").alias("deed_num")).distinct().where("deed_num IS NOT NULL").withColumn("deed_name", F.concat(F.lit("deed "), "deed_num")),
        "sale.foreclosure": lambda: t.w_order.select(
            F.to_date("day").alias("foreclosure_recording_date"), ((F.col("ok") * 4001) % 10007).cast("double").alias("x"), ((F.col("ok") * 3001) % 10009).cast("double").alias("y")
        ),
        "hidename": lambda: t.w_parcel.where("k % 37 = 0").select(F.col("parid").alias("pin")),
        "cdu": lambda: t.w_dweldat.select(F.upper("user16").alias("cdu_code")).where("cdu_code IS NOT NULL").distinct().withColumn("cdu_description", F.concat(F.lit("about "), "cdu_code")),
        "htagnt": lambda: t.w_htpar.select(F.col("cpatty").alias("agent")).distinct().select("agent", F.concat(F.lit("agent "), "agent").alias("name1"), F.lit("Y").alias("cur"), F.lit(None).cast("string").alias("deactivat")),
        "htpar_reascd": lambda: t.region.select(F.col("r_regionkey").cast("string").alias("reascd"), F.concat(F.lit("reason "), "r_name").alias("description")),
        "aprval_reascd": lambda: t.nation.select(F.col("n_nationkey").cast("string").alias("reascd"), F.concat(F.lit("change "), "n_name").alias("description")),
        "infl_reascd": lambda: t.w_land.select(F.col("infl1").alias("reascd")).where("reascd IS NOT NULL").distinct().withColumn("description", F.lit("influence")),
        **{f"commercial_{n}": (lambda: t.region.select(F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("description"))) for n in ("major_subclass", "minor_subclass", "model_group")},
        "permit_job_code": lambda: t.nation.select((F.col("n_nationkey") + 100).cast("string").alias("code"), F.col("n_name").alias("description")),
        "permit_improvement_code": lambda: t.nation.select((F.col("n_nationkey") + 380).cast("string").alias("code"), F.col("n_name").alias("description")),
        "pin_condo_char": lambda: t.w_parcel.where("k % 10 >= 8").select(
            F.col("parid").alias("pin"), (F.col("k") % 600 * 10).cast("double").alias("building_sf"), (F.col("k") % 300 * 10).cast("double").alias("unit_sf"), (F.col("k") % 7).alias("bedrooms"), (F.col("k") % 4).alias("half_baths"),
            (F.col("k") % 6).alias("full_baths"), (F.col("k") % 21 == 0).alias("parking_pin"),
        ),
        "pin_nonlivable": lambda: t.w_parcel.where("k % 30 IN (8, 19, 28)").select(
            F.col("parid").alias("pin"), F.when(F.col("k") % 30 == 8, "questionable").when(F.col("k") % 30 == 28, "negative pred").otherwise("399 GR").alias("flag")
        ),
        "pin_test": lambda: t.w_py.where("k % 61 = 0").select(F.col("parid").alias("pin"), F.col("taxyr").alias("year"), F.lit("odd").alias("test_type")),
        "spatial.parcel": lambda: _with(
            t.w_spot, rings=geo.rectangle(F.col("x_3435") - 20, F.col("y_3435") - 20, F.col("x_3435") + 20, F.col("y_3435") + 20),
            shp_parcel_num_vertices=F.lit(4), shp_parcel_mrr_area_ratio=F.lit(1.0),
        ),
        "spatial.corner": lambda: t.w_spot.where("year >= '2020' AND year < '2024'").select("pin10", "year", (F.col("x_3435") % 3 == 0).alias("is_corner_lot")),
        "spatial.police_district": lambda: layer(t, pd_num="n * 1.0"),
        "spatial.community_area": lambda: layer(t, area_number="n * 1.0", community="name"),
        "spatial.industrial_corridor": lambda: layer(t, num="n * 1.0", name="name").where("num % 2 = 0"),
        **{f"spatial.{s}": (lambda c=c: layer(t, **{c: "concat('Z', n)"})) for s, c in (
            ("coordinated_care", "cc_num"), ("enterprise_zone", "ez_num"), ("industrial_growth_zone", "igz_num"), ("qualified_opportunity_zone", "geoid"), ("central_business_district", "cbd_num"),
        )},
        **{f"spatial.{d}": (lambda d=d: layer(t, **{f"{d}_num": "n * 1.0", f"{d}_name": "name"})) for d in (
            "board_of_review_district", "commissioner_district", "judicial_district", "state_representative_district", "state_senate_district",
        )},
        "spatial.municipality": lambda: layer(t, municipality_num="concat('M', n)", municipality_name="CASE WHEN n % 6 = 0 THEN 'Unincorporated' ELSE lower(name) END"),
        "spatial.ward": lambda: layer(t, ward_num="n", ward_name="CASE WHEN n % 3 = 0 THEN concat('evanston_', n) ELSE concat('chicago_', n) END"),
        "spatial.walkability": lambda: layer(t, walk_num="n * 1.0", nta_score="n * 0.5", total_score="n * 2.0"),
        "spatial.subdivision": lambda: layer(t, pagesubref="concat('P', n)"),
        "spatial.flood_fema": lambda: layer(t, fema_special_flood_hazard_area="n % 2 = 0", n="n").where("n % 4 = 0"),
        "spatial.ohare_noise_contour": lambda: layer(t, airport="'ohare'", n="n").where("n = 12").drop("n"),
        "spatial.census": lambda: pivot_places(t, GEOGRAPHIES, "geography", geoid="CAST(n AS STRING)"),
        "spatial.school_district": lambda: pivot_places(t, schools, "district_type", geoid="CAST(n AS STRING)", name="concat('SD ', name)"),
        "census.acs5": lambda: survey(t),
        "other.great_schools_rating": lambda: dots(t, rating="CAST(stop_id % 10 AS DOUBLE)", type="CASE WHEN stop_id % 3 = 0 THEN 'private' ELSE 'public' END", district_geoid="CAST(stop_id % 25 AS STRING)", district_type="CASE WHEN stop_id % 2 = 0 THEN 'elementary' ELSE 'secondary' END"),
        "other.airport_noise": lambda: t.w_spot.where("year < '2021'").select("pin10", "year", F.lit(50.5).alias("airport_noise_dnl")).unionByName(
            t.w_spot.select("pin10").distinct().select("pin10", F.lit("omp").alias("year"), F.lit(51.5).alias("airport_noise_dnl"))
        ),
        "other.flood_first_street": lambda: t.w_spot.where("year = '2019'").select("pin10", "year", (F.col("x_3435") % 10).cast("int").alias("fs_flood_factor"), F.lit(1).alias("fs_flood_risk_direction")),
        "other.ihs_index": lambda: t.w_layer.select(F.col("n").cast("string").alias("geoid"), "year", (F.col("n") * 1.5).alias("ihs_index")),
        "other.dci": lambda: t.w_layer.select(F.col("n").cast("string").alias("geoid"), "year", (F.col("n") * 2.5).alias("dci")),
        "other.ari": lambda: t.w_layer.select(F.col("n").cast("string").alias("geoid"), "year", (F.col("n") * 3.5).alias("ari_score")),
        "tax.pin": lambda: t.w_taxpin,
        "tax.tax_code": lambda: t.w_taxcode,
        "tax.agency_info": lambda: t.w_agency.drop("town"),
        "tax.eq_factor": lambda: t.w_taxpin.select("year").distinct().withColumn("eq_factor_final", F.lit(3.0)),
        "location.municipality_crosswalk": lambda: t.nation.select(F.upper("n_name").alias("county_municipality_name"), F.concat(F.lit("VILLAGE "), "n_name").alias("tax_municipality_name")),
        "spatial.bike_trail": lambda: lines(t, street="road_id", name="road_name"),
        "spatial.cemetery": lambda: layer(t, gniscode="n * 1.0", name="name", n="n").where("n % 7 = 3"),
        "spatial.transit_route": lambda: lines(t, route_id="CAST(road_id AS STRING)", route_long_name="road_name", agency="CASE WHEN road_id % 40 = 0 THEN 'cta' ELSE 'metra' END", route_type="CASE WHEN road_id % 40 = 0 THEN 1 ELSE 2 END"),
        "spatial.transit_stop": lambda: dots(t, stop_id="CAST(stop_id AS STRING)", stop_name="concat('stop ', stop_id)", agency="CASE stop_id % 3 WHEN 0 THEN 'cta' WHEN 1 THEN 'metra' ELSE 'pace' END", route_type="CASE stop_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END"),
        "spatial.golf_course": lambda: layer(t, id="CAST(n AS STRING)", n="n").where("n % 9 = 4"),
        "spatial.grocery_store": lambda: dots(t, name="concat('store ', stop_id)"),
        "spatial.hospital": lambda: layer(t, gniscode="n * 1.0", name="name", n="n").where("n % 8 = 5"),
        "spatial.coastline": lambda: lines(t, n="road_id"),
        "spatial.major_road": lambda: lines(t, osm_id="CAST(road_id AS STRING)", name="road_name"),
        "spatial.secondary_road": lambda: lines(t, osm_id="CAST(road_id AS STRING)", name="road_name"),
        "spatial.park": lambda: layer(t, osm_id="CAST(n AS STRING)", name="name", n="n").where("n % 6 = 2"),
        "spatial.railroad": lambda: lines(t, name_id="CAST(road_id AS STRING)", name_anno="road_name"),
        "spatial.road": lambda: lines(t, road_name="road_name", daily_traffic="speed * 10", speed_limit="speed", surface_type="'asphalt'", lanes="2", road_type="CASE WHEN road_id % 60 = 0 THEN 'Interstate' WHEN road_id % 60 = 20 THEN 'Minor Arterial' ELSE 'Major Collector' END"),
        "spatial.stadium_raw": lambda: t.stop_point.where("stop_id % 25 = 0").select(F.concat(F.lit("stadium "), "stop_id").alias("name"), F.lit(-87.6).alias("lon"), F.lit(41.9).alias("lat"), F.col("x").alias("x_3435"), F.col("y").alias("y_3435"), (2018 + F.col("stop_id") % 4).cast("string").alias("year")),
        "spatial.school_location": lambda: dots(t, name="CASE WHEN stop_id % 10 = 0 THEN 'Columbia College' ELSE 'School' END", type="'HigherEd'", gniscode="CAST(stop_id AS INT)"),
        "spatial.hydrology": lambda: layer(t, id="CAST(n AS STRING)", name="name", n="n").where("n % 5 = 1"),
        "model.final_model_raw": lambda: t.w_final_raw,
        "model.metadata": lambda: t.w_run,
        "model.assessment_card": lambda: t.w_card.drop("v"),
        "model.assessment_pin": lambda: t.w_apin,
        "model.training_set": lambda: training_rows(t),
        "model.training_data_stored": lambda: t.w_run.where("run_id LIKE '%asia'").select("run_id"),
        "model.shap": lambda: t.w_card.select("meta_pin", "meta_card_num", "run_id", "township_code", F.lit("2024").alias("assessment_year"), (F.col("v") * 0.1).alias("char_yrblt"), (F.col("v") * 0.2).alias("char_bldg_sf")),
        "model.comp": lambda: comparables(t),
        "pinval.model_run": lambda: t.w_run.select("run_id", "assessment_year", F.explode(F.array(F.lit("card"), F.lit("shap"), F.lit("comp"))).alias("type")),
    }
    return table


def training_rows(t: Tables) -> DataFrame:
    """Sales as training rows of every run."""
    rows = t.w_order.select(
        F.col("parid").alias("meta_pin"), F.lpad(F.col("ok").cast("string"), 10, "0").alias("meta_sale_document_num"), F.col("price").cast("double").alias("meta_sale_price"), F.to_date("day").alias("meta_sale_date"), F.col("yr").alias("meta_year"),
        (F.col("k") % 2 == 0).alias("ind_pin_is_multicard"), F.lit("addr").alias("loc_property_address"), (F.col("price") % 3000).alias("char_bldg_sf"), F.lit(1950).alias("char_yrblt"), F.lit(1.0).alias("assr_is_active_exe_homeowner"),
        (F.col("k") % 25).cast("string").alias("loc_school_elementary_district_geoid"), F.lit(None).cast("string").alias("loc_school_secondary_district_geoid"),
    )
    return rows.withColumn("run_id", F.explode(F.array(*[F.lit(f"2024-02-0{i}-{n}") for i, n in enumerate(("africa", "america", "asia", "europe", "middle east"))])))


def comparables(t: Tables) -> DataFrame:
    """Five comparable sales for each parcel with a card."""
    cols = []
    for i in range(1, 6):
        cols += [
            F.lpad(((F.col("k") + i) % 1500).cast("string"), 14, "0").alias(f"comp_pin_{i}"), (1.0 / i + F.col("k") * 0).alias(f"comp_score_{i}"),
            F.lpad((F.col("first_order") - F.col("first_order") % 5 + 5 * i).cast("string"), 10, "0").alias(f"comp_document_num_{i}"),
        ]
    rows = t.w_py.where("taxyr = '2023' AND k % 10 IN (0, 1, 2, 3, 7)")
    return rows.select(F.col("parid").alias("pin"), F.lit(1).alias("card"), F.lit("2024").alias("year"), F.lit("2024-02-00-africa").alias("run_id"), *cols)


def warehouse(t: Tables, **stand_ins) -> Warehouse:
    """The models' inputs derived from the given tables; ``stand_ins`` replace models by tables."""
    return Warehouse(t.spark, {**sources(t), **stand_ins}, today=TODAY)
