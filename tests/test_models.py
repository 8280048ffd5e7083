"""Models on small hand-made rows."""

from plotwise.plans.warehouse import Warehouse, load_models
from plotwise.operators.yearfill import year_fill_crosswalk

FLAG = "meta_sale_document_num string, sv_is_outlier boolean, sv_is_ptax_outlier boolean, sv_is_heuristic_outlier boolean, sv_outlier_reason1 string, sv_outlier_reason2 string, sv_outlier_reason3 string, run_id string, version int"
REVIEW = "doc_no string, is_arms_length boolean, is_flip boolean, has_class_change boolean, has_characteristic_change string"


def verdicts(spark, flags, reviews):
    w = Warehouse(spark, {"sale.flag": spark.createDataFrame(flags, FLAG), "sale.flag_review": spark.createDataFrame(reviews, REVIEW)})
    return {r.doc_no: (r.outlier_reason, r.is_outlier) for r in w.ref("sale.vw_outlier").collect()}


def test_all_models_are_registered(spark):
    assert len(load_models()) == 146


def test_outlier_truth_table(spark):
    def flag(doc, outlier, *reasons, version=1):
        padded = [*reasons, None, None, None][:3]
        return (doc, outlier, False, outlier, *padded, "r", version)

    got = verdicts(
        spark,
        [
            flag("old", True, "High price", version=1), flag("old", False, version=2), flag("alg", True, "High price", "PTAX"), flag("bare", True),
            flag("flip", True, "PTAX", "Low price"), flag("nal", True, "Raw"), flag("major", True, "High price"), flag("ok", True, "High price"),
            flag("clean", False), flag("empty", True, "High price"),
        ],
        [
            ("flip", True, True, False, "no"), ("nal", False, False, False, "no"), ("major", True, True, False, "yes_major"),
            ("ok", True, False, False, "yes_minor"), ("clean", False, True, False, "no"), ("only", True, False, True, "no"),
            ("empty", None, None, None, None), ("nothing", None, None, None, None),
        ],
    )
    assert got == {
        "old": ("Algorithm: Valid Sale", False), "alg": ("Algorithm: Outlier Sale, High price, PTAX", True), "bare": ("Algorithm: Outlier Sale", True),
        "flip": ("Review: Flip, Algorithm: Low price", True), "nal": ("Review: Non-Arms-Length", True),
        "major": ("Review: Major Characteristic Change", True), "ok": ("Review: Valid Sale", False), "clean": ("Review: Valid Sale", False),
        "only": ("Review: Major Characteristic Change", True), "empty": ("Algorithm: Outlier Sale, High price", True), "nothing": (None, False),
    }


def test_year_fill_crosswalk(spark):
    years = spark.createDataFrame([(str(y),) for y in range(2018, 2023)], "year string")
    layer = spark.createDataFrame([("2020", "2020"), ("2021", "2020"), ("2022", "2020")], "year string, census_data_year string")
    rows = year_fill_crosswalk(years, {"census": (layer, ["census"])}).orderBy("year").collect()
    assert [(r.year, r.census_fill_year, r.census_data_year) for r in rows] == [
        ("2018", "2020", "2020"), ("2019", "2020", "2020"), ("2020", "2020", "2020"), ("2021", "2021", "2020"), ("2022", "2022", "2020"),
    ]


def test_stage_values(spark):
    columns = "parid string, taxyr string, class string, rolltype string, valclass string, procname string, cur string, deactivat string, " + ", ".join(
        f"{c} bigint" for c in ("valasm1", "valasm2", "valasm3", "ovrvalasm1", "ovrvalasm2", "ovrvalasm3", "valapr1", "valapr2", "valapr3", "tot30")
    )

    def row(year, proc, cur, value):
        return ("p", year, "2-03", "RP", None, proc, cur, None, value, value, value, 7, 7, 7, 10 * value, 10 * value, 10 * value, None)

    asmt = spark.createDataFrame(
        [row("2019", "ASSRVALUE", "N", 1), row("2024", "ASSRVALUE", "N", 2), row("2024", None, "Y", 3), row("2025", None, "Y", 4), row("2023", None, "Y", 5)], columns
    )
    par = spark.createDataFrame([("p", y, "Y", None) for y in ("2019", "2023", "2024", "2025")], "parid string, taxyr string, cur string, deactivat string")
    reasons = spark.createDataFrame([("p", "2024", "5", None, "Y")], "parid string, taxyr string, reascd string, procname string, cur string")
    names = spark.createDataFrame([("5", "new house")], "reascd string, description string")
    w = Warehouse(spark, {"asmt_all": asmt, "pardat": par, "aprval": reasons, "aprval_reascd": names}, today="2025-01-01")
    got = {r.year: r for r in w.ref("default.vw_pin_value").collect()}
    assert set(got) == {"2019", "2024", "2025"}  # an open row of a past year without stages is no value
    assert (got["2019"].mailed_tot, got["2019"].mailed_hie, got["2019"].stage_name) == (7, None, "MAILED")
    assert (got["2024"].mailed_tot, got["2024"].pre_certified_tot, got["2024"].stage_num, got["2024"].change_reason) == (2, 3, 1.5, "new house")
    assert (got["2025"].pre_mailed_class, got["2025"].pre_mailed_tot, got["2025"].stage_name) == ("203", 4, "PRE-MAILED")


def test_exemptions_keep_the_best_row(spark):
    det = spark.createDataFrame(
        [("p", "2024", "c1", "HO", "100", "Y", None), ("p", "2024", "c2", "C-HO", "900", "Y", None), ("p", "2024", "c3", "I-Z", "5", "Y", None)],
        "parid string, taxyr string, caseno string, excode string, apother string, cur string, deactivat string",
    )
    adm = spark.createDataFrame(
        [("p", "2024", "c1", "HO", "yes", "2024-05-01 00:00", "A", "Y", None), ("p", "2024", "c2", "C-HO", None, None, "A", "Y", None), ("p", "2024", "c3", "I-Z", None, None, "A", "Y", None)],
        "parid string, taxyr string, caseno string, excode string, user126 string, udate9 string, exstat string, cur string, deactivat string",
    )
    code = spark.createDataFrame([(c, "2024", "Y", None) for c in ("HO", "C-HO", "I-Z")], "excode string, taxyr string, cur string, deactivat string")
    par = spark.createDataFrame([("p", "2024", "Y", None)], "parid string, taxyr string, cur string, deactivat string")
    w = Warehouse(spark, {"exdet": det, "exadmn": adm, "excode": code, "pardat": par})
    rows = w.ref("default.vw_pin_exe_long").collect()
    assert [(r.exemption_code, r.exemption_type, r.exemption_amount, r.is_cofe) for r in rows] == [("HO", "exe_homeowner", 100, True)]
    assert w.ref("default.vw_pin_exe").first().exe_homeowner == 100
