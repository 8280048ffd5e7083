"""Many checks of a table in few passes.

Row checks, and checks against a parent's keys, are fused: each row gets the list of checks it fails, and only rows with
a failure are exploded, so any number of them reads the table once. Group checks are fused by their keys: one aggregate
for each set of keys gives all counts that its checks ask for. Failing rows come out as in ``rollup.failing_rows``.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RowCheck:
    """Rows for which ``bad`` (SQL) is true fail and report ``columns`` (SQL by name)."""

    name: str
    bad: str
    columns: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class ParentCheck:
    """Rows fail whose value of ``column`` is no value of ``parent.of``; null fails too if ``nulls`` is set."""

    name: str
    column: str
    parent: DataFrame
    of: str
    columns: dict[str, str] = field(default_factory=dict)
    nulls: bool = False


@dataclass(frozen=True)
class GroupCheck:
    """Groups by ``keys`` (none: the whole table, an empty one included) for which ``bad`` (SQL over ``measures``) is true fail and report keys and measures."""

    name: str
    keys: tuple[str, ...]
    measures: dict[str, str]
    bad: str


Check = RowCheck | ParentCheck | GroupCheck


def _own(columns: Iterable[str], extra: Iterable[str]) -> dict[str, str]:
    return {c: f"`{c}`" for c in dict.fromkeys([*columns, *extra])}


def _text(value) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else str(value)


def in_range(name: str, c: str, low=None, high=None, inclusive: bool = True, extra: Iterable[str] = ()) -> RowCheck:
    sign = "=" if inclusive else ""
    bad = [f"NOT (`{c}` >{sign} {low})"] * (low is not None) + [f"NOT (`{c}` <{sign} {high})"] * (high is not None)
    return RowCheck(name, " OR ".join(bad) or "false", _own([c], extra))


def one_of(name: str, c: str, values: list, extra: Iterable[str] = ()) -> RowCheck:
    return RowCheck(name, f"`{c}` NOT IN ({', '.join(map(_text, values))})", _own([c], extra))


def none_of(name: str, c: str, values: list, extra: Iterable[str] = ()) -> RowCheck:
    return RowCheck(name, f"`{c}` IN ({', '.join(map(_text, values))})", _own([c], extra))


def known(name: str, c: str, extra: Iterable[str] = ()) -> RowCheck:
    return RowCheck(name, f"`{c}` IS NULL", _own([], extra) or _own([c], []))


def unknown(name: str, c: str, extra: Iterable[str] = ()) -> RowCheck:
    return RowCheck(name, f"`{c}` IS NOT NULL", _own([c], extra))


def at_most(name: str, cols: list[str], length: int, extra: Iterable[str] = ()) -> RowCheck:
    """No text longer than ``length``."""
    measured = {f"len_{c}": f"length(`{c}`)" for c in cols}
    return RowCheck(name, " OR ".join(f"{e} > {length}" for e in measured.values()), measured | _own([], extra))


def matches_one(name: str, c: str, others: list[str], extra: Iterable[str] = ()) -> RowCheck:
    return RowCheck(name, " AND ".join(f"`{c}` != `{o}`" for o in others), _own([c, *others], extra))


def tidy(name: str, cols: list[str], allow_interior: bool = False) -> RowCheck:
    """No leading or trailing space, and no doubled one unless ``allow_interior`` is set."""
    shapes = ["% ", " %"] + ([] if allow_interior else ["%  %"])
    return RowCheck(name, " OR ".join(f"`{c}` LIKE '{s}'" for c in cols for s in shapes), _own(cols, []))


def holds(name: str, expression: str, columns: Iterable[str] = ()) -> RowCheck:
    return RowCheck(name, f"NOT ({expression})", _own(columns, []) or {"fail": "1"})


def unique_by(name: str, keys: list[str], allowed_duplicates: int = 0, measures: dict[str, str] | None = None) -> GroupCheck:
    return GroupCheck(name, tuple(keys), {"num_duplicates": "count(1)"} | (measures or {}), f"num_duplicates > {allowed_duplicates + 1}")


def counted_between(name: str, c: str, group: str, low: int, high: int) -> GroupCheck:
    return GroupCheck(name, (group,), {"count": f"count(DISTINCT `{c}`)"}, f"NOT (count BETWEEN {low} AND {high})")


def rows_above(name: str, least: int) -> GroupCheck:
    return GroupCheck(name, (), {"row_count": "count(1)"}, f"row_count < {least}")


def present(name: str, expression: str) -> GroupCheck:
    """Some row satisfies the expression."""
    return GroupCheck(name, (), {"row_count": f"count_if({expression})"}, "row_count = 0")


def _problem(name: str, values: dict[str, Column], bad: Column, town: Column) -> Column:
    body = F.to_json(F.struct(*[v.alias(n) for n, v in values.items()]), {"ignoreNullFields": "false"})
    return F.when(bad, F.struct(F.lit(name).alias("test_name"), town.alias("township_code"), body.alias("problem")))


def _exploded(df: DataFrame, problems: list[Column]) -> DataFrame:
    found = df.select(F.array_compact(F.array(*problems)).alias("_found")).where(F.size("_found") > 0)
    return found.select(F.inline("_found"))


def _fused_rows(df: DataFrame, checks: list[RowCheck | ParentCheck], town: Column) -> DataFrame:
    problems = []
    for number, c in enumerate(checks):
        if isinstance(c, ParentCheck):
            keys = c.parent.where(F.col(c.of).isNotNull()).select(F.col(c.of).alias(f"_parent_{number}")).distinct()
            df = df.join(keys, df[c.column] == keys[f"_parent_{number}"], "left")
            bad = F.col(f"_parent_{number}").isNull() & (F.lit(c.nulls) | F.col(c.column).isNotNull())
        else:
            bad = F.expr(c.bad)
        problems.append(_problem(c.name, {n: F.expr(e) for n, e in c.columns.items()}, bad, town))
    return _exploded(df, problems)


def _fused_groups(df: DataFrame, keys: tuple[str, ...], checks: list[GroupCheck], township: str | None) -> DataFrame:
    # measures that several checks share are taken once
    names = {e: f"_m{i}" for i, e in enumerate(dict.fromkeys(e for c in checks for e in c.measures.values()))}
    grouped = df.groupBy(*keys).agg(*[F.expr(e).alias(n) for e, n in names.items()])
    town = F.col(township).cast("string") if township in keys else F.lit(None).cast("string")
    problems = []
    for c in checks:
        own = {n: F.col(names[e]) for n, e in c.measures.items()}
        values = F.struct(*[F.col(k) for k in keys], *[v.alias(n) for n, v in own.items()])
        grouped = grouped.withColumn(f"_of_{c.name}", values).withColumn(f"_bad_{c.name}", _over(c.bad, f"_of_{c.name}", [*own]))
        problems.append(_problem(c.name, {k: F.col(k) for k in keys} | own, F.col(f"_bad_{c.name}"), town))
    return _exploded(grouped, problems)


def _over(expression: str, struct: str, names: list[str]) -> Column:
    """An expression over fields of a struct, by the fields' own names."""
    body = f"transform(array({struct}), _r -> {_qualified(expression, names)})[0]"
    return F.expr(body)


def _qualified(expression: str, names: list[str]) -> str:
    return re.sub(r"\b(" + "|".join(map(re.escape, names)) + r")\b", r"_r.\1", expression)


def run(df: DataFrame, checks: list[Check], township: str | None = None) -> DataFrame:
    """test_name, township_code, problem (the reported values as JSON): a row per check and failing row or group.

    The table is read once for all row and parent checks together and once for each set of keys of the group checks.
    ``township`` names the column that is reported besides; groups report it where it is one of their keys.
    """
    town = F.col(township).cast("string") if township else F.lit(None).cast("string")
    groups: dict[tuple[str, ...], list[GroupCheck]] = defaultdict(list)
    for c in checks:
        if isinstance(c, GroupCheck):
            groups[c.keys].append(c)
    by_row = [c for c in checks if not isinstance(c, GroupCheck)]
    parts = [_fused_rows(df, by_row, town)] if by_row else []
    parts += [_fused_groups(df, keys, some, township) for keys, some in groups.items()]
    return reduce(DataFrame.unionByName, parts)
