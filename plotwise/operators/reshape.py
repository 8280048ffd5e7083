"""Wide ↔ long."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wide_to_long(
    df: DataFrame, keys: list[str], stages: dict, measures: dict[str, list[str]], label: str = "stage"
) -> DataFrame:
    """One row per key and stage. ``stages`` maps a stage label to extra constant columns; each measure
    lists its column for every stage, in order."""
    structs = []
    for i, (name, constants) in enumerate(stages.items()):
        fields = [F.lit(name).alias(label)]
        fields += [F.lit(v).alias(k) for k, v in constants.items()]
        fields += [F.col(cols[i]).alias(measure) for measure, cols in measures.items()]
        structs.append(F.struct(*fields))
    return df.select(*keys, F.explode(F.array(*structs)).alias("_row")).select(*keys, "_row.*")


def numbered_to_long(
    df: DataFrame, keys: list[str], prefixes: list[str], n: int, index: str = "number", keep_null: bool = True
) -> DataFrame:
    """``comp_pin_1 .. comp_pin_n`` and its siblings to rows with an index."""
    rows = F.array(
        *[
            F.struct(F.lit(i).alias(index), *[F.col(f"{p}_{i}").alias(p) for p in prefixes])
            for i in range(1, n + 1)
        ]
    )
    long = df.select(*keys, F.explode(rows).alias("_row")).select(*keys, "_row.*")
    return long if keep_null else long.where(F.col(prefixes[0]).isNotNull())


def union_missing(frames: list[DataFrame]) -> DataFrame:
    """Union by name; columns that one side lacks become null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def tagged_union(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    return union_missing([frame.withColumn(tag, F.lit(name)) for name, frame in frames.items()])


def current_minus_history(current: DataFrame, history: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows of the current table that the history does not hold."""
    return current.select(*columns).subtract(history.select(*columns))


def decode_numbered(df: DataFrame, prefix: str, n: int, table: dict, out: str) -> DataFrame:
    """Decode ``prefix1 .. prefixN`` through one literal map."""
    mapping = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    decoded: dict[str, Column] = {f"{out}{i}": F.try_element_at(mapping, F.col(f"{prefix}{i}")) for i in range(1, n + 1)}
    return df.withColumns(decoded)
