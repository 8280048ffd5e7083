"""Jobs that shape roads, census tables, indices, schools and other layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotwise.operators.dissolve import dissolve
from plotwise.operators.network import drop_small_components
from plotwise.operators.ordered import dedup_by_priority
from plotwise.operators.reshape import union_missing
from plotwise.operators.spatial import points_in_polygons
from plotwise.operators.grouped import with_group_values

# Road words and their short forms.
ROAD_WORDS = {
    "avenue": "ave", "av": "ave", "street": "st", "court": "ct", "road": "rd", "drive": "dr", "place": "pl",
    "lane": "ln", "trail": "trl", "parkway": "pkwy", "highway": "hwy", "expressway": "expy",
}


def road_name(c: Column) -> Column:
    """Lower case, one space between words, words shortened."""
    name = F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))
    for word, short in ROAD_WORDS.items():
        name = F.regexp_replace(name, rf"\b{word}\b", short)
    return F.trim(name)


def zero_to_null(c: Column) -> Column:
    return F.when(~c.cast("string").isin("0", "0000", "0.0"), c)


def road_segments(raw: DataFrame, name: str, attributes: list[str], surface_year: str | None = None) -> DataFrame:
    """Cleaned names and attributes; segments that agree on all of them share one row of lines.

    ``raw`` has x1, y1, x2, y2.
    """
    tidy = raw.withColumn(name, road_name(F.col(name))).withColumns({a: zero_to_null(F.col(a)) for a in attributes})
    keys = [name, *attributes]
    if surface_year:
        tidy = tidy.withColumn(surface_year, F.when(F.col(surface_year).cast("int") != 9999, F.col(surface_year)))
    line = F.struct("x1", "y1", "x2", "y2")
    return tidy.groupBy(*keys).agg(F.array_sort(F.collect_set(line)).alias("lines"))


def road_stack(years: dict[str, DataFrame], way: str = "osm_id") -> DataFrame:
    """One row per way over several years; the earliest year's row stays."""
    stacked = union_missing([df.withColumn("year", F.lit(year)) for year, df in years.items()])
    return dedup_by_priority(stacked, [way], [F.col("year"), F.xxhash64(*stacked.columns)])


def road_network(edges: DataFrame, src: str, dst: str, least: int = 5) -> DataFrame:
    """Ways of connected parts with more than ``least`` edges."""
    return drop_small_components(edges, least, src, dst)


def census_table(df: DataFrame, renames: dict[str, str], geoid: str = "GEOID") -> DataFrame:
    """Older column names to the newest ones, without water-only areas."""
    named = df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})
    return named.where(~F.col(geoid).contains("Z"))


def census_dictionary(variables: DataFrame, tables: list[str], survey: str, long_tables: tuple[str, ...] = ("B22005",)) -> DataFrame:
    """Each variable once, with the table code it starts with. ``variables`` has name, label and an order."""
    first = dedup_by_priority(variables, ["name"], [F.col("order")])
    wanted = first.where(F.col("name").rlike("^(" + "|".join(tables) + ")"))
    longer = F.col("name").rlike("^(" + "|".join(long_tables) + ")")
    return wanted.select(
        F.lit(survey).alias("survey"), F.col("name").alias("variable_name"), F.trim("label").alias("variable_label"),
        F.when(longer, F.substring("name", 1, 7)).otherwise(F.substring("name", 1, 6)).alias("variable_table_code"),
    )


def quarterly_index(wide: DataFrame, ids: list[str], quarters: list[str], value: str) -> DataFrame:
    """Columns such as "2019Q3" to rows with year and quarter; "p" in an area id stands for "170"."""
    long = wide.unpivot(ids, quarters, "_q", value)
    parts = F.split("_q", "Q")
    tidy = long.withColumn("geoid", F.replace(F.col("geoid").cast("string"), F.lit("p"), F.lit("170")))
    return tidy.select(*ids, F.get(parts, 0).alias("year"), F.get(parts, 1).alias("quarter"), value)


def monitor_readings(wide: DataFrame, sites: DataFrame, site: str, years: list[str], value: str = "noise") -> DataFrame:
    """Yearly reading columns to rows, joined to the monitors' places."""
    long = wide.unpivot([site], years, "year", value)
    return long.where(F.col(value).isNotNull()).join(sites, site, "left")


def district_ids(
    districts: DataFrame, areas: DataFrame, cell: float, overrides: list[tuple[Column, str]] = ()
) -> DataFrame:
    """Area id of each district by its centre, for the same year and type, with manual overrides.

    ``districts`` has district_id, district_type, year, x, y; ``areas`` geoid, year, district_type and rings. A
    district without a fitting area keeps one row with a null id.
    """
    located = points_in_polygons(
        districts, areas.select("geoid", F.col("year").alias("area_year"), F.col("district_type").alias("area_type"), "rings"),
        ["geoid", "area_year", "area_type"], cell, "left",
    )
    fits = (F.col("year") == F.col("area_year")) & (F.col("district_type") == F.col("area_type"))
    keys = ["district_id", "district_type", "year"]
    counted = with_group_values(
        located.withColumn("_fits", F.coalesce(fits, F.lit(False))), keys, [F.count_if("_fits").alias("_matches")]
    )
    geoid = F.when(F.col("_matches") > 0, F.col("geoid"))
    kept = counted.withColumn("geoid", geoid).where(F.col("_fits") | F.col("geoid").isNull())
    chosen = F.col("geoid")
    for cond, value in reversed(list(overrides)):
        chosen = F.when(cond, F.lit(value)).otherwise(chosen)
    return kept.withColumn("geoid", chosen).select(*districts.columns, "geoid").distinct()


def dissolve_layer(df: DataFrame, keys: list[str], attributes: list[str], order: str) -> DataFrame:
    """A layer dissolved by attributes: districts, zones, police, tax, schools, water."""
    return dissolve(df, keys, attributes, order)


def transit_stops(stops: DataFrame, stop_times: DataFrame, trips: DataFrame, routes: DataFrame, agency: str, year: str) -> DataFrame:
    """Stops of a transit feed with the route type that serves them."""
    served = stop_times.select("stop_id", "trip_id").distinct().join(trips.select("trip_id", "route_id"), "trip_id")
    kinds = served.join(routes.select("route_id", "route_type"), "route_id").select("stop_id", "route_type").distinct()
    return stops.join(kinds, "stop_id").withColumns({"agency": F.lit(agency), "year": F.lit(year)})


def latest_layer(df: DataFrame, year: str = "year") -> DataFrame:
    """Rows of a layer's newest year."""
    return df.where(F.col(year) == df.agg(F.max(year)).scalar())


def layer_rows(df: DataFrame, names: dict[str, str], shape: str, year: str) -> DataFrame:
    """A landed layer: renamed attributes, its shape as bytes, and the year it is partitioned by."""
    return df.select(*[F.col(c).alias(n) for c, n in names.items()], F.col(shape).cast("binary").alias("geometry_3435"), F.lit(year).alias("year"))
