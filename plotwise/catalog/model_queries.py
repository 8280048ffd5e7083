"""Domain models over derived inputs."""

from __future__ import annotations

from plotwise.catalog.model_sql import MODEL_SQL as PLACED_SQL
from plotwise.catalog.registry import QUERIES, query
from plotwise.catalog.standins import TODAY, sources, warehouse
from plotwise.plans.build import Build
from plotwise.plans.warehouse import load_models
from plotwise.session import shared_path

# Views with long chains that several wide models read: stored like tables.
CHAINS = (
    "default.vw_pin_history", "default.vw_pin_address", "default.vw_pin_land", "default.vw_card_res_char", "default.vw_pin_condo_char", "census.vw_acs5_stat",
    "location.vw_pin10_location", "location.vw_pin10_location_fill", "proximity.vw_pin10_proximity", "proximity.vw_pin10_proximity_fill", "model.vw_pin_shared_input",
)
_BUILDS: dict[tuple[str, str], Build] = {}


def build_of(t) -> Build:
    """One build for each session and folder of tables: a table that several models read is made once, by its own joins."""
    key = (t.spark.sparkContext.applicationId, t.root)
    if key not in _BUILDS:
        _BUILDS[key] = Build(t.spark, sources(t), today=TODAY, folder=shared_path(t.spark, "models"), stored_views=CHAINS)
    return _BUILDS[key]


def name_of(model: str) -> str:
    return "model_" + model.replace(".", "_").replace("default_", "").replace("vw_pin_sale", "sale" if model == "default.vw_pin_sale" else "vw_pin_sale")


def register() -> None:
    # Tables come before the views that read many of them.
    for model in sorted(load_models(), key=lambda m: m.split(".", 1)[1].startswith("vw_")):
        name = name_of(model)
        if name not in QUERIES:
            query(name, MODEL_SQL.get(model, PLACED_SQL.get(model)))(lambda t, model=model: build_of(t).ref(model))


MODEL_SQL: dict[str, str] = {
    "sale.vw_flag": """
SELECT meta_sale_document_num AS doc_no, sv_is_outlier, sv_is_ptax_outlier, sv_is_heuristic_outlier, sv_outlier_reason1, sv_outlier_reason2, sv_outlier_reason3, run_id, version
FROM (SELECT *, MAX(version) OVER (PARTITION BY meta_sale_document_num) AS top FROM w_flag) WHERE version = top""",
    "sale.vw_ias_salesval_upload": """
SELECT s.salekey, f.sv_is_outlier, f.sv_outlier_reason1, f.sv_outlier_reason2, f.sv_outlier_reason3, f.run_id FROM w_sales s
JOIN (SELECT *, MAX(version) OVER (PARTITION BY meta_sale_document_num) AS top FROM w_flag) f ON replace(s.instruno, 'D', '') = f.meta_sale_document_num AND f.version = f.top WHERE s.deactivat IS NULL""",
    "qc.vw_iasworld_sales_null_values": """
SELECT substr(saledt, 1, 4) AS taxyr, COUNT(CASE WHEN price IS NULL THEN 1 END) / CAST(COUNT(*) AS DOUBLE) AS price, COUNT(CASE WHEN instrtyp IS NULL THEN 1 END) / CAST(COUNT(*) AS DOUBLE) AS deed_type,
 COUNT(CASE WHEN length(own1) < 2 OR own1 IS NULL THEN 1 END) / CAST(COUNT(*) AS DOUBLE) AS buyer, COUNT(CASE WHEN length(oldown) < 2 OR oldown IS NULL THEN 1 END) / CAST(COUNT(*) AS DOUBLE) AS seller
FROM w_sales WHERE deactivat IS NULL AND instruno IS NOT NULL GROUP BY 1""",
    "qc.vw_iasworld_sales_day_of_month": """
SELECT substr(saledt, 1, 4) AS taxyr, substr(saledt, 9, 2) AS day_of_month, CAST(SUM(COUNT(DISTINCT instruno)) OVER (PARTITION BY substr(saledt, 1, 4)) AS BIGINT) AS total_sales, COUNT(DISTINCT instruno) AS sales_by_day
FROM w_sales WHERE deactivat IS NULL AND price IS NOT NULL AND instruno IS NOT NULL GROUP BY 1, 2""",
    "qc.vw_iasworld_sales_unmatched_joins_sale_mydec": """
SELECT COALESCE(a.y, b.y) AS taxyr, COUNT(a.d) AS iasworld_unmatched, COUNT(b.d) AS mydec_unmatched FROM
(SELECT DISTINCT substr(saledt, 1, 4) AS y, regexp_replace(instruno, '[^0-9]', '', 'g') AS d FROM w_sales WHERE deactivat IS NULL AND instruno IS NOT NULL) a FULL JOIN
(SELECT DISTINCT year_of_sale AS y, document_number AS d FROM w_mydec) b ON a.y = b.y AND a.d = b.d WHERE a.d IS NULL OR b.d IS NULL GROUP BY 1""",
    "qc.vw_iasworld_sales_latest_sale": """
SELECT parid, instruno, price, saledt, strftime(CAST(substr(saledt, 1, 10) AS DATE), '%-m/%-d/%Y') AS saledt_fmt FROM
(SELECT *, ROW_NUMBER() OVER (PARTITION BY parid ORDER BY saledt DESC, salekey) AS r FROM w_sales WHERE price > 1) WHERE r = 1""",
    "qc.vw_report_town_close_289s": """
SELECT o.parid, o.taxyr, o.class, l.user1 AS township_code FROM w_oby o JOIN w_pardat p ON o.parid = p.parid AND o.taxyr = p.taxyr AND p.deactivat IS NULL
LEFT JOIN w_legdat l ON o.parid = l.parid AND o.taxyr = l.taxyr WHERE o.class = '289'""",
}
EXE_SQL = """
WITH t AS (SELECT d.parid AS pin, d.taxyr AS year, CASE WHEN d.excode IN ('HO', 'C-HO') THEN 'exe_homeowner' WHEN d.excode = 'SR' THEN 'exe_senior' WHEN d.excode = 'DV1' THEN 'exe_vet_dis_lt50' WHEN d.excode = 'SF' THEN 'exe_freeze' ELSE 'exe_wwii' END AS kind,
 d.excode, CAST(d.apother AS INT) AS amount, CASE upper(substr(a.user126, 1, 1)) WHEN 'Y' THEN TRUE WHEN 'N' THEN FALSE END AS cofe, CAST(substr(a.udate9, 1, 10) AS DATE) AS cofe_day
 FROM w_exdet d JOIN w_exadmn a ON d.parid = a.parid AND d.taxyr = a.taxyr AND d.caseno = a.caseno AND d.excode = a.excode AND a.exstat = 'A' JOIN w_excode c ON d.excode = c.excode AND d.taxyr = c.taxyr
 JOIN w_pardat p ON d.parid = p.parid AND d.taxyr = p.taxyr AND p.deactivat IS NULL WHERE substr(d.excode, 1, 2) != 'I-'),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY pin, year, kind ORDER BY cofe DESC NULLS LAST, cofe_day DESC NULLS LAST, amount DESC NULLS LAST, excode) AS n FROM t)
"""
MODEL_SQL["default.vw_pin_exe_long"] = EXE_SQL + """SELECT pin, year, excode AS exemption_code, kind AS exemption_type, amount AS exemption_amount, cofe AS is_cofe, CAST(cofe_day AS TIMESTAMP) AS cofe_date FROM r WHERE n = 1"""
_KINDS = ("disabled", "freeze", "homeowner", "longtime_homeowner", "senior", "muni_built", "vet_dis_lt50", "vet_dis_50_69", "vet_dis_ge70", "vet_dis_100", "vet_returning", "wwii")
MODEL_SQL["default.vw_pin_exe"] = EXE_SQL + "SELECT pin, year, " + ", ".join(
    f"CAST(SUM(CASE WHEN kind = 'exe_{k}' THEN amount ELSE 0 END) AS INT) AS exe_{k}" for k in _KINDS
) + " FROM r WHERE n = 1 GROUP BY pin, year"


@query("model_unique_sales", """
WITH tc AS (SELECT p.parid, p.taxyr, l.user1 AS township_code, regexp_replace(p.class, '[^a-zA-Z0-9]', '', 'g') AS class, l.user1 || substr(p.nbhd, 3, 3) AS nbhd
 FROM w_pardat p LEFT JOIN w_legdat l ON p.parid = l.parid AND p.taxyr = l.taxyr WHERE p.deactivat IS NULL),
live AS (SELECT *, replace(instruno, 'D', '') AS doc, instrtyp NOT IN ('03', '04', '06') AS market, CAST(substr(saledt, 1, 10) AS DATE) AS d FROM w_sales WHERE deactivat IS NULL),
cnt AS (SELECT doc, COUNT(*) AS c FROM (SELECT DISTINCT parid, doc FROM live) GROUP BY doc),
j AS (SELECT s.*, tc.township_code, tc.nbhd, tc.class, c, COALESCE(nopar > 1 OR c > 1, FALSE) AS multi,
 ROW_NUMBER() OVER (PARTITION BY s.parid, saledt, market ORDER BY price DESC, salekey) AS top_price, ROW_NUMBER() OVER (PARTITION BY s.doc, market, price > 10000 ORDER BY saledt, salekey) AS first_doc,
 LAG(d) OVER (PARTITION BY s.parid, price, market ORDER BY saledt, salekey) AS before
 FROM live s LEFT JOIN cnt ON s.doc = cnt.doc JOIN tc ON s.parid = tc.parid AND substr(saledt, 1, 4) = tc.taxyr WHERE instruno IS NOT NULL AND price IS NOT NULL AND tc.township_code IS NOT NULL)
SELECT parid AS pin, substr(saledt, 1, 4) AS year, township_code, nbhd, class, d AS sale_date, price AS sale_price, salekey AS sale_key, doc AS doc_no, instrtyp AS deed_type, multi AS is_multisale,
 CAST(CASE WHEN nopar > 1 THEN nopar ELSE c END AS BIGINT) AS num_parcels_sale, CASE WHEN trim(oldown) NOT IN ('', 'MISSING SELLER NAME') THEN oldown END AS seller_name, CASE WHEN trim(own1) NOT IN ('', 'MISSING BUYER NAME') THEN own1 END AS buyer_name,
 CASE saletype WHEN '0' THEN 'LAND' ELSE 'LAND AND BUILDING' END AS sale_type, COALESCE(date_diff('day', before, d) <= 365, FALSE) AS sale_filter_same_sale_within_365, price <= 10000 AS sale_filter_less_than_10k,
 COALESCE(instrtyp IN ('03', '04', '06') OR instrtyp IS NULL, FALSE) AS sale_filter_deed_type FROM j WHERE top_price = 1 AND (first_doc = 1 OR multi)""")
def unique_sales_query(t):
    from plotwise.plans.sales import unique_sales

    return unique_sales(warehouse(t))


@query("model_outlier_verdicts", """
WITH f AS (SELECT *, MAX(version) OVER (PARTITION BY meta_sale_document_num) AS top FROM w_flag),
j AS (SELECT COALESCE(f.meta_sale_document_num, r.doc_no) AS doc_no, f.sv_is_outlier IS NOT NULL AS flagged, COALESCE(f.sv_is_outlier, FALSE) AS o, sv_outlier_reason1 AS r1, sv_outlier_reason2 AS r2,
 NOT (is_arms_length IS NULL AND is_flip IS NULL AND has_class_change IS NULL AND has_characteristic_change IS NULL) AS reviewed, COALESCE(is_arms_length, TRUE) AS arms, COALESCE(is_flip, FALSE) AS flip,
 COALESCE(has_class_change OR has_characteristic_change = 'yes_major', FALSE) AS major FROM (SELECT * FROM f WHERE version = top) f FULL JOIN w_review r ON f.meta_sale_document_num = r.doc_no),
p AS (SELECT *, CASE WHEN r1 = 'High price' OR r2 = 'High price' THEN ', Algorithm: High price' WHEN r1 = 'Low price' OR r2 = 'Low price' THEN ', Algorithm: Low price'
 WHEN r1 = 'Low price per square foot' THEN ', Algorithm: Low price per square foot' ELSE '' END AS why FROM j),
v AS (SELECT doc_no, flagged AS has_flag, reviewed AS has_review, CASE WHEN reviewed AND major THEN 'Review: Major Characteristic Change' WHEN reviewed AND o AND flip THEN 'Review: Flip' || why
 WHEN reviewed AND o AND NOT arms THEN 'Review: Non-Arms-Length' || why WHEN reviewed THEN 'Review: Valid Sale' WHEN flagged AND o THEN concat_ws(', ', 'Algorithm: Outlier Sale', r1, r2) WHEN flagged THEN 'Algorithm: Valid Sale' END AS outlier_reason FROM p)
SELECT *, COALESCE(outlier_reason NOT IN ('Review: Valid Sale', 'Algorithm: Valid Sale'), FALSE) AS is_outlier FROM v""")
def outlier_verdicts(t):
    return warehouse(t).ref("sale.vw_outlier").select("doc_no", "has_flag", "has_review", "outlier_reason", "is_outlier")


register()
