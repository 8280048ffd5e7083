"""Predicates, decodes and arithmetic with the null handling that assessment queries expect."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def yes_no(c: Column | str) -> Column:
    """Y → true, N → false, anything else → null."""
    source = _col(c)
    return F.when(source == "Y", True).when(source == "N", False)


def known_true(cond: Column) -> Column:
    """A condition whose unknown outcome counts as false."""
    return F.coalesce(cond, F.lit(False))


def decode(c: Column | str, mapping: Mapping, default: Column | str | None = None) -> Column:
    """Replace codes by literals; unmatched codes take ``default`` (a Column) or null."""
    source = _col(c)
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    hit = F.try_element_at(table, source)
    return hit if default is None else F.coalesce(hit, _col(default))


def any_of(conds: list[Column]) -> Column:
    return reduce(or_, conds)


def all_of(conds: list[Column]) -> Column:
    return reduce(and_, conds)


def greatest_strict(*cols: Column | str) -> Column:
    """Largest value, null as soon as one input is null (Spark's own skips nulls)."""
    sources = [_col(c) for c in cols]
    return F.when(all_of([c.isNotNull() for c in sources]), F.greatest(*sources))


def int_div(a: Column | str, b: Column | str) -> Column:
    """Whole-number quotient that truncates toward zero."""
    return F.call_function("div", _col(a), _col(b))


def ratio_or_null(top: Column, bottom: Column) -> Column:
    """Division that gives null for an empty denominator."""
    return F.when(bottom != 0, top / bottom)


def at(array: Column | str, position: int) -> Column:
    """1-based array access, null when out of range."""
    return F.get(_col(array), F.lit(position - 1))


def json_object(**fields: Column) -> Column:
    """JSON text that keeps null members."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})


def json_list(c: Column | str, element: str = "string") -> Column:
    return F.from_json(_col(c), f"array<{element}>")


def flag_comments(pairs: list[tuple[Column, str]], sep: str = ", ") -> Column:
    """Text of every condition that holds, joined; null when none does."""
    return F.nullif(F.concat_ws(sep, *[F.when(cond, F.lit(text)) for cond, text in pairs]), F.lit(""))


def extra_columns(spec: list) -> list[Column]:
    """Columns from plain names or ``{"column", "alias", "agg_func"}`` mappings."""
    out = []
    for item in spec:
        if isinstance(item, str):
            out.append(F.col(item))
            continue
        if "column" not in item:
            raise ValueError(f'missing "column" key: {item}')
        column, function = item["column"], item.get("agg_func")
        source = F.col(column)
        if function:
            alias = item.get("alias") or f"{function}_{column}"
            out.append(F.call_function(function, source).alias(alias))
        else:
            out.append(source.alias(item["alias"]) if item.get("alias") else source)
    return out


def is_aggregate(spec_item) -> bool:
    return isinstance(spec_item, Mapping) and bool(spec_item.get("agg_func"))


def today_column(today: dt.date | str | None = None) -> Column:
    """The current date, or a fixed one for repeatable runs."""
    return F.current_date() if today is None else F.to_date(F.lit(str(today)))


def trailing_lag_year(c: Column | str, offset: int) -> Column:
    """Shift a text year."""
    return (_col(c).cast("int") + offset).cast("string")


def pre_mailed(procname: Column, cur: Column, stages: Column) -> Column:
    """Open row of a parcel-year that has no named stage yet."""
    return procname.isNull() & (cur == "Y") & (F.size(stages) == 0)


def pre_certified(procname: Column, cur: Column, stages: Column, final_stage: str) -> Column:
    """Open row of a parcel-year that has a named stage, but not the given one."""
    return (
        procname.isNull()
        & (cur == "Y")
        & (F.size(stages) > 0)
        & ~F.array_contains(stages, final_stage)
    )
