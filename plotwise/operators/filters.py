"""Row filters, lookups and suppression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def active(
    df: DataFrame,
    cur: str = "cur",
    deactivated: str = "deactivat",
    class_col: str | None = None,
    drop_class: tuple[str, ...] = ("999",),
) -> DataFrame:
    """Rows that are current and not deactivated; optionally without test classes."""
    kept = df.where((F.col(cur) == "Y") & F.col(deactivated).isNull())
    if class_col:
        kept = kept.where(~F.col(class_col).isin(*drop_class))
    return kept


def lookup(df: DataFrame, key: str, table: DataFrame, table_key: str, columns: dict[str, str]) -> DataFrame:
    """Left-join a code table. ``columns`` maps table columns to output names.

    Spark broadcasts the table when its size is under the session's threshold.
    """
    right = table.select(F.col(table_key).alias("_code"), *[F.col(c).alias(n) for c, n in columns.items()])
    return df.join(right, df[key] == right["_code"], "left").drop("_code")


def suppress(df: DataFrame, hidden: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Null ``cols`` on every row whose key is listed in ``hidden``."""
    listed = hidden.select(F.col(key).alias("_hidden")).distinct()
    joined = df.join(listed, df[key] == listed["_hidden"], "left")
    visible = F.col("_hidden").isNull()
    return joined.select(*[F.when(visible, F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def equals_extreme(df: DataFrame, column: str, source: DataFrame, source_column: str, how: str = "max") -> DataFrame:
    """Rows whose column equals the max (or min) of another table's column."""
    bound = source.agg(F.call_function(how, F.col(source_column)).alias("_bound"))
    return df.join(bound, df[column] == bound["_bound"], "left_semi")


def where_any(df: DataFrame, conds: list[Column]) -> DataFrame:
    """Rows for which at least one condition holds."""
    test = conds[0]
    for cond in conds[1:]:
        test = test | cond
    return df.where(test)
