"""Scans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotwise.operators.reshape import tagged_union


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A Parquet table of a folder of tables."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def seed(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A typed CSV with a header; a row that does not fit the types stops the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").csv(path, header=True)


def landed_json(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def partitioned(spark: SparkSession, root: str, *folders: str, schema: str | T.StructType | None = None) -> DataFrame:
    """A Hive-partitioned dataset, or some of its partition folders; partition keys stay text."""
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*[f"{root}/{f}" for f in folders] or [root])


def tagged_files(spark: SparkSession, paths: dict[str, str], tag: str = "run_id") -> DataFrame:
    """One file set per tag, united by name; columns that a set lacks are null."""
    return tagged_union({name: spark.read.parquet(path) for name, path in paths.items()}, tag)


def fixed_width(spark: SparkSession, path: str, fields: dict[str, tuple[int, int]]) -> DataFrame:
    """Text lines cut at (first position, width), trimmed, empty to null."""
    lines = spark.read.text(path)
    return lines.select(
        *[F.nullif(F.trim(F.substring("value", a, w)), F.lit("")).alias(n) for n, (a, w) in fields.items()]
    )


def typed(df: DataFrame, crosswalk: dict[str, tuple[str, str]]) -> DataFrame:
    """Rename and convert: ``source → (name, type)``. Text that does not convert becomes null."""
    return df.select(*[_convert(F.col(c), t).alias(n) for c, (n, t) in crosswalk.items()])


def _convert(c: Column, kind: str) -> Column:
    if kind == "flag":
        text = F.lower(F.trim(c.cast("string")))
        return F.when(text.isin("1", "true", "t", "y", "yes"), True).when(text.isin("0", "false", "f", "n", "no"), False)
    if kind.startswith("date:"):
        return F.try_to_timestamp(c, F.lit(kind[5:])).cast("date")
    return c.try_cast(kind)


def wide_rates(df: DataFrame, ids: list[str], columns: dict[str, str], value: str, year: str = "year") -> DataFrame:
    """Rate columns per year to rows: ``columns`` maps a column to its year."""
    long = df.unpivot(ids, list(columns), "_column", value)
    years = F.create_map(*[F.lit(x) for pair in columns.items() for x in pair])
    return long.select(*ids, F.try_element_at(years, F.col("_column")).alias(year), value)


def stack_years(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
