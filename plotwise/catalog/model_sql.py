"""SQL of location and distance models over the derived layers: all pairs, closed rectangles, as-of years written out."""

from __future__ import annotations

from plotwise.plans.proximity import ROAD_ATTRIBUTES, STEPS, TARGETS

MODEL_SQL: dict[str, str] = {}

# Layers exist in two years; the later of them that is not after a parcel's year holds.
_ASOF = "CASE WHEN year >= '2022' THEN '2022' WHEN year >= '2019' THEN '2019' END"
# The nation's rectangle that holds a place, null beyond the grid.
_AREA = """
WITH p AS (SELECT pin10, year, {asof} AS since, CASE WHEN x_3435 < 9999.5 AND y_3435 < 9999.5 THEN CAST(FLOOR((x_3435 + 0.5) / 2000) + 5 * FLOOR((y_3435 + 0.5) / 2000) AS INT) END AS n FROM w_spot WHERE year >= '{first}')
SELECT pin10, year, {columns} FROM p LEFT JOIN nation ON n_nationkey = n"""


def _areas(columns: dict[str, str], first: str = "2019") -> str:
    return _AREA.format(asof=_ASOF, first=first, columns=", ".join(f"{e} AS {c}" for c, e in columns.items()))


def _when(condition: str, value: str) -> str:
    return f"CASE WHEN n IS NOT NULL AND {condition} THEN {value} END"


_TEXT, _SINCE = "CAST(n AS VARCHAR)", _when("TRUE", "since")
MODEL_SQL["location.chicago"] = _areas({
    "chicago_police_district_num": _TEXT, "chicago_police_district_data_year": _SINCE, "chicago_community_area_num": _TEXT, "chicago_community_area_name": "n_name",
    "chicago_community_area_data_year": _SINCE, "chicago_industrial_corridor_num": _when("n % 2 = 0", _TEXT), "chicago_industrial_corridor_name": _when("n % 2 = 0", "n_name"),
    "chicago_industrial_corridor_data_year": _when("n % 2 = 0", "since"),
})
MODEL_SQL["location.economy"] = _areas({
    f"econ_{z}_{part}": value for z in ("coordinated_care_area", "enterprise_zone", "industrial_growth_zone", "qualified_opportunity_zone", "central_business_district")
    for part, value in (("num", "'Z' || n"), ("data_year", _SINCE))
})
MODEL_SQL["location.access"] = _areas({
    "access_cmap_walk_id": _TEXT, "access_cmap_walk_nta_score": "n * 0.5", "access_cmap_walk_total_score": "n * 2.0", "access_cmap_walk_data_year": _SINCE,
})
MODEL_SQL["location.other"] = _areas({"misc_subdivision_id": _when("since IS NOT NULL", "'P' || n"), "misc_subdivision_data_year": _SINCE}, "2014")
MODEL_SQL["location.political"] = _areas({
    **{f"county_{d}_{part}": value for d in ("board_of_review_district", "commissioner_district", "judicial_district") for part, value in (("num", _TEXT), ("data_year", _SINCE))},
    "county_municipality_num": "'M' || n", "county_municipality_name": "CASE WHEN n % 6 = 0 THEN 'UNINCORPORATED' ELSE upper(n_name) END", "county_municipality_data_year": _SINCE,
    "ward_num": _TEXT, "ward_name": "CASE WHEN n % 3 = 0 THEN 'evanston_' || n ELSE 'chicago_' || n END",
    "ward_chicago_data_year": _when("n % 3 != 0", "since"), "ward_evanston_data_year": _when("n % 3 = 0", "since"),
})

# ---- distances ---------------------------------------------------------------------------------------------------

_RECTANGLE = "SELECT {take}, n, {ends} FROM (SELECT n, name, x0, x1, y0, y1 FROM w_layer WHERE year = '2019' AND {where})"
_SIDES = ("x0 AS x1, y0 AS y1, x1 AS x2, y0 AS y2", "x1 AS x1, y0 AS y1, x1 AS x2, y1 AS y2", "x1 AS x1, y1 AS y1, x0 AS x2, y1 AS y2", "x0 AS x1, y1 AS y1, x0 AS x2, y0 AS y2")
_NEAREST = """
WITH s AS (SELECT DISTINCT x_3435 AS px, y_3435 AS py FROM w_spot),
seg AS ({segments}),
way AS (SELECT px, py, {names} x1, y1, x2 - x1 AS dx, y2 - y1 AS dy FROM s CROSS JOIN seg),
placed AS (SELECT *, CASE WHEN dx * dx + dy * dy = 0 THEN 0.0 ELSE LEAST(GREATEST(((px - x1) * dx + (py - y1) * dy) / (dx * dx + dy * dy), 0.0), 1.0) END AS t FROM way),
away AS (SELECT px, py, {names} (px - (x1 + t * dx)) * (px - (x1 + t * dx)) + (py - (y1 + t * dy)) * (py - (y1 + t * dy)) AS d2 FROM placed{inside}),
best AS (SELECT * FROM away QUALIFY ROW_NUMBER() OVER (PARTITION BY px, py ORDER BY d2{order}) = 1)
SELECT pin10, year, {columns} SQRT(d2) AS {stem}_dist_ft, {asof} AS {stem}_data_year FROM w_spot JOIN best ON x_3435 = px AND y_3435 = py WHERE year >= '2019'"""


def _nearest(name: str, kind: str, take: dict[str, str], where: str = "TRUE") -> str:
    """``take``: expressions of the attributes over road, stop_point or w_layer, in the order that settles ties."""
    listed = ", ".join(f"{e} AS {c}" for c, e in take.items()) or "1 AS _any"
    if kind == "line":
        segments = f"SELECT {listed}, x1, y1, x2, y2 FROM road WHERE {where}"
    elif kind == "point":
        segments = f"SELECT {listed}, x AS x1, y AS y1, x AS x2, y AS y2 FROM stop_point WHERE {where}"
    else:
        segments = " UNION ALL ".join(_RECTANGLE.format(take=listed, ends=e, where=where) for e in _SIDES)
    names = "".join(f"{c}, " for c in take)
    # a place inside an area is at distance 0
    held = f" UNION ALL SELECT px, py, {names}0.0 FROM (SELECT {listed}, x0, x1, y0, y1 FROM w_layer WHERE year = '2019' AND {where}) JOIN s ON px > x0 AND px < x1 AND py > y0 AND py < y1"
    stem = f"{TARGETS[name].prefix}{name}"
    return _NEAREST.format(
        segments=segments, names=names, inside=held if kind == "area" else "", order="".join(f", {c} NULLS FIRST" for c in take), stem=stem, asof=_ASOF,
        columns="".join(f"{c} AS {stem}_{c}, " for c in take),
    )


_ROAD = {"name": "road_name", **dict(zip(ROAD_ATTRIBUTES, ("speed * 10", "speed", "'asphalt'", "2")))}
_OSM = {"osm_id": "CAST(road_id AS VARCHAR)", "name": "road_name"}
_GNIS = {"gnis_code": "CAST(n AS VARCHAR)", "name": "name"}
_STOP = {"id": "CAST(stop_id AS VARCHAR)", "name": "'stop ' || stop_id"}
_ROUTE = {"id": "CAST(road_id AS VARCHAR)", "name": "road_name"}
for _name, _kind, _take, _where in (
    ("bike_trail", "line", {"id": "road_id", "name": "road_name"}, "TRUE"), ("lake_michigan", "line", {}, "TRUE"), ("major_road", "line", _OSM, "TRUE"), ("secondary_road", "line", _OSM, "TRUE"),
    ("railroad", "line", _ROUTE, "TRUE"), ("cta_route", "line", _ROUTE, "road_id % 40 = 0"), ("metra_route", "line", _ROUTE, "road_id % 40 != 0"),
    ("road_arterial", "line", _ROAD, "road_id % 60 = 20"), ("road_collector", "line", _ROAD, "road_id % 60 NOT IN (0, 20)"), ("road_highway", "line", _ROAD, "road_id % 60 = 0"),
    ("cta_stop", "point", _STOP, "stop_id % 3 = 0"), ("metra_stop", "point", _STOP, "stop_id % 3 = 1"), ("grocery_store", "point", {"name": "'store ' || stop_id"}, "TRUE"),
    ("university", "point", {"name": "'Columbia College'"}, "stop_id % 10 = 0"),
    ("cemetery", "area", _GNIS, "n % 7 = 3"), ("hospital", "area", _GNIS, "n % 8 = 5"), ("golf_course", "area", {"id": "CAST(n AS VARCHAR)"}, "n % 9 = 4"),
    ("park", "area", {"osm_id": "CAST(n AS VARCHAR)", "name": "name"}, "n % 6 = 2"), ("water", "area", {"id": "CAST(n AS VARCHAR)", "name": "name"}, "n % 5 = 1"),
):
    MODEL_SQL[f"proximity.dist_pin_to_{_name}"] = _nearest(_name, _kind, _take, _where)

MODEL_SQL["proximity.cnt_pin_num_bus_stop"] = """
WITH c AS (SELECT pin10, p.year, COUNT(*) AS n FROM w_spot p JOIN stop_point s ON s.stop_id % 3 = 2 AND p.year IN ('2019', '2022')
 AND (x_3435 - s.x) * (x_3435 - s.x) + (y_3435 - s.y) * (y_3435 - s.y) <= 6969600 GROUP BY pin10, p.year)
SELECT pin10, COALESCE(n, 0) AS num_bus_stop_in_half_mile, CASE WHEN n > 0 THEN year END AS num_bus_stop_data_year, year FROM w_spot LEFT JOIN c USING (pin10, year) WHERE year >= '2019'"""

# Three nearest parcels that share neither x nor y; the smallest radius that holds all three decides the table.
_THREE = """
WITH d AS (SELECT a.pin10, a.year, b.pin10 AS other, (a.x_3435 - b.x_3435) * (a.x_3435 - b.x_3435) + (a.y_3435 - b.y_3435) * (a.y_3435 - b.y_3435) AS d2
 FROM w_spot a JOIN w_spot b ON a.year = b.year AND a.x_3435 != b.x_3435 AND a.y_3435 != b.y_3435),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY pin10, year ORDER BY SQRT(d2), other) AS k FROM d QUALIFY k <= 3),
w AS (SELECT pin10, year, {wide}, MAX(d2) AS far, COUNT(*) AS held FROM r GROUP BY pin10, year)
SELECT * EXCLUDE (far, held) FROM w WHERE held = 3 AND far <= {most} AND far > {least}"""
_WIDE = ", ".join(f"MAX(CASE WHEN k = {k} THEN other END) AS nearest_neighbor_{k}_pin10, MAX(CASE WHEN k = {k} THEN SQRT(d2) END) AS nearest_neighbor_{k}_dist_ft" for k in (1, 2, 3))
_radii = [0.0, *STEPS.values()]
for _step, _low, _high in zip(STEPS, _radii, _radii[1:]):
    MODEL_SQL[f"proximity.dist_pin_to_pin_{_step}"] = _THREE.format(wide=_WIDE, most=_high**2, least=_low**2 or -1)
MODEL_SQL["proximity.dist_pin_to_pin"] = _THREE.format(wide=_WIDE, most=_radii[-1] ** 2, least=-1)

# ---- addresses ---------------------------------------------------------------------------------------------------

_SQUEEZED = "NULLIF(trim(regexp_replace(concat_ws(' ', {}), '\\s+', ' ', 'g')), '')"
_PRIVATE = {
    "owner_address_name": "NULLIF(concat_ws(' ', o.own1, o.own2), '')",
    "owner_address_full": "COALESCE(NULLIF(o.addr1, ''), NULLIF(o.addr2, ''), NULLIF(concat_ws(' ', CAST(o.adrno AS VARCHAR), o.adrdir, o.adrstr, o.adrsuf, o.unitdesc, o.unitno), ''))",
    "owner_address_city_name": "o.cityname", "owner_address_state": "o.statecode", "owner_address_zipcode_1": "NULLIF(o.zip1, '00000')", "owner_address_zipcode_2": "NULLIF(o.zip2, '0000')",
    "mail_address_name": _SQUEEZED.format("m.mail1, m.mail2"), "mail_address_full": _SQUEEZED.format("m.maddr1, m.maddr2"), "mail_address_city_name": "m.mcityname",
    "mail_address_state": "m.mstatecode", "mail_address_zipcode_1": "NULLIF(m.mzip1, '00000')", "mail_address_zipcode_2": "NULLIF(m.mzip2, '0000')",
}
_SITE = {
    "prefix": "adrpre", "street_dir": "adrdir", "street_name": "adrstr", "suffix_1": "adrsuf", "suffix_2": "adrsuf2", "unit_prefix": "unitdesc", "unit_number": "unitno", "city_name": "cityname", "state": "statecode",
}
_NUMBER = "CASE WHEN l.adrno != 0 THEN l.adrno END"
MODEL_SQL["default.vw_pin_address"] = f"""
SELECT p.parid AS pin, substr(p.parid, 1, 10) AS pin10, p.taxyr AS year, {", ".join(f"l.{c} AS prop_address_{n}" for n, c in _SITE.items())}, {_NUMBER} AS prop_address_street_number,
 NULLIF(concat_ws(' ', l.adrpre, CAST({_NUMBER} AS VARCHAR), l.adrdir, l.adrstr, l.adrsuf, l.unitdesc, l.unitno), '') AS prop_address_full, NULLIF(l.zip1, '00000') AS prop_address_zipcode_1, NULLIF(l.zip2, '0000') AS prop_address_zipcode_2,
 {", ".join(f"CASE WHEN h.parid IS NULL THEN {e} END AS {c}" for c, e in _PRIVATE.items())}
FROM w_pardat p LEFT JOIN w_legdat l ON p.parid = l.parid AND p.taxyr = l.taxyr LEFT JOIN w_owndat o ON p.parid = o.parid AND p.taxyr = o.taxyr
LEFT JOIN (SELECT * FROM w_maildat QUALIFY mailseq = MAX(mailseq) OVER (PARTITION BY parid, taxyr)) m ON p.parid = m.parid AND p.taxyr = m.taxyr
LEFT JOIN (SELECT DISTINCT parid FROM w_parcel WHERE k % 37 = 0) h ON p.parid = h.parid WHERE p.deactivat IS NULL AND p.class != '999' AND length(p.parid) = 14"""
