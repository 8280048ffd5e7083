"""String helpers with Java regular-expression classes (POSIX brackets do not work in Spark)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def alnum_only(c: Column | str) -> Column:
    """Drop every character that is not a letter or digit."""
    return F.regexp_replace(_col(c), r"[^\p{Alnum}]", "")


def digits_only(c: Column | str) -> Column:
    """Keep the digits; a string without any becomes null."""
    return empty_to_null(F.regexp_replace(_col(c), r"[^0-9]", ""))


def squeeze(c: Column | str) -> Column:
    """Drop control characters, then turn each run of white space into one space and trim."""
    cleaned = F.regexp_replace(_col(c), r"\p{Cntrl}", "")
    return F.trim(F.regexp_replace(cleaned, r"\s+", " "))


def concat_address(*parts: Column | str) -> Column:
    """Join address parts with spaces; null when nothing is left."""
    return empty_to_null(squeeze(F.concat_ws(" ", *[_col(p) for p in parts])))


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def insert_hyphens(c: Column | str, *positions: int) -> Column:
    """Cut a string after each position and join the pieces with hyphens."""
    if not positions:
        raise ValueError("give at least one position")
    if list(positions) != sorted(set(positions)) or positions[0] <= 0:
        raise ValueError("positions must be positive and increasing")
    source = _col(c)
    starts = (0, *positions)
    pieces = [F.substring(source, a + 1, b - a) for a, b in zip(starts, positions)]
    rest = source.substr(F.lit(positions[-1] + 1), F.length(source))
    joined = pieces[0]
    for piece in [*pieces[1:], rest]:
        joined = F.concat(joined, F.lit("-"), piece)
    return joined


def hyphenated_pin(c: Column | str) -> Column:
    """The printed form of a 14-character parcel id."""
    return insert_hyphens(c, 2, 4, 7, 10)


def slugify(name: str) -> str:
    """Snake-case a label for use as a column name."""
    spaced = re.sub(r"[ /-]+", "_", name.strip())
    split_words = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", spaced)
    return re.sub(r"[^0-9a-z_]", "", re.sub(r"_+", "_", split_words.lower()))


def row_id(*parts: Column | str) -> Column:
    """A surrogate id built by concatenation."""
    return F.concat(*[_col(p).cast("string") for p in parts])
