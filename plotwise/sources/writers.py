"""Sinks. Every writer hands whole partitions to Spark's committer; nothing passes through the driver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Folder name that Hive layouts give to a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def balanced(df: DataFrame, partitions: list[str]) -> DataFrame:
    """Rows dealt by partition columns into tasks of the size that ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` sets.

    A partition larger than that is split over several tasks, small ones share a task, so the number of files follows
    the bytes and not tasks times partitions. Needs adaptive execution, which is on by default.
    """
    return df.hint("rebalance", *[F.col(p) for p in partitions]) if partitions else df


def write_partitioned(df: DataFrame, path: str, partitions: list[str], mode: str = "overwrite", per_file: int = 0) -> None:
    """Write by partition columns, rows of a partition spread over tasks by size and not by key alone."""
    writer = balanced(df, partitions).write.mode(mode).partitionBy(*partitions).option("compression", "zstd")
    if per_file:
        writer = writer.option("maxRecordsPerFile", per_file)
    writer.parquet(path)


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None) -> None:
    """A table bucketed and sorted by ``keys``, one file for each bucket: rows are dealt by the bucket's own hash beforehand."""
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def bucketed_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join two tables that are bucketed by exactly ``keys`` into as many buckets: neither side is shuffled, buckets are merged where they lie."""
    return left.hint("merge").join(right, keys, how)


def dropped(spark: SparkSession, *names: str) -> None:
    """Take tables with a path of their own out of the catalogue; frames that read them go on, as the files stay."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_dynamic(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Replace just the partitions that ``df`` holds."""
    (
        balanced(df, partitions).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*partitions)
        .parquet(path)
    )


def incremental_new(df: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    """Rows whose key the target does not hold yet; none when all are there."""
    if existing is None:
        return df
    return df.join(existing.select(key).distinct(), key, "left_anti")


def existing_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path`` when it has been written before."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if fs.exists(jvm_path) else None


def write_partitions(df: DataFrame, path: str, partitions: list[str], overwrite: bool = False, now=None) -> None:
    """Add ``loaded_at`` and write the partitions that are not there yet, or replace them on request.

    Existing partitions are read from their folder values, so a null key matches the default partition.
    """
    stamped = df.withColumn("loaded_at", (F.current_timestamp() if now is None else F.lit(now)).cast("string"))
    if overwrite:
        write_dynamic(stamped, path, partitions)
        return
    present = existing_or_none(df.sparkSession, path)
    if present is not None:
        have = present.select(*[F.col(p).cast("string").alias(f"_p_{p}") for p in partitions]).distinct()
        same = reduce(
            lambda a, b: a & b, [F.col(p).cast("string").eqNullSafe(F.col(f"_p_{p}")) for p in partitions]
        )
        stamped = stamped.join(have, same, "left_anti")
    balanced(stamped, partitions).write.mode("append").partitionBy(*partitions).option("compression", "snappy").parquet(path)


def export_by_year(df: DataFrame, path: str, year: str = "year", per_file: int = 10_000) -> None:
    """CSV parts of a fixed number of rows in one folder per year; rows without a year have their own."""
    (
        balanced(df, [year]).write.mode("overwrite")
        .partitionBy(year)
        .option("maxRecordsPerFile", per_file)
        .option("header", "true")
        .csv(path)
    )


def extract_report(df: DataFrame, path: str, year_col: str, years: list[str], town_col: str | None = None, towns=()) -> None:
    """Rows of a report for some years and townships as CSV."""
    report_rows(df, year_col, years, town_col, towns).write.mode("overwrite").csv(path, header=True)


def report_rows(df: DataFrame, year_col: str, years: list[str], town_col: str | None = None, towns=()) -> DataFrame:
    kept = df.where(F.col(year_col).isin(*years))
    return kept.where(F.col(town_col).isin(*towns)) if town_col and towns else kept
