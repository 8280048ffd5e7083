"""Registration of queries and their SQL counterparts."""

from __future__ import annotations

import re
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plotwise.session import ensure_checkpoint_dir, sized
from plotwise.sources.readers import table
from plotwise.sources.writers import existing_or_none

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Shared derivations in SQL that both Spark and DuckDB read the same way.
DERIVED: dict[str, str] = {}


# Folders of derived tables that were written before, by application, input folder and name.
_WRITTEN: dict[tuple[str, str, str], str] = {}
_LOCKS: dict[tuple[str, str, str], threading.RLock] = defaultdict(threading.RLock)
# Places meet the cells of areas, which are the side to broadcast; their numbers take about as much on disk as in memory.
PLACES = ("w_spot",)


class Tables:
    """Lazy access to the given tables and to tables derived from them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self.spark, self.root, name)
        if name.startswith("w_") and name in DERIVED:
            return self._stored(name)
        if name in DERIVED:
            return self.sql(DERIVED[name])
        raise AttributeError(name)

    def _stored(self, name: str) -> DataFrame:
        """A derived assessment table, written once per session to the folder that all executors share.

        Models read these tables many times; stored, they are scans with known sizes and pruned columns.
        """
        key = (self.spark.sparkContext.applicationId, self.root, name)
        with _LOCKS[key]:
            return self._once(name, key)

    def _once(self, name: str, key: tuple[str, str, str]) -> DataFrame:
        if key in _WRITTEN:
            found = existing_or_none(self.spark, _WRITTEN[key])
            if found is not None:
                return self._sized(name, found)
        ensure_checkpoint_dir(self.spark)
        path = f"{self.spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
        self.sql(DERIVED[name]).write.parquet(path)
        _WRITTEN[key] = path
        return self._sized(name, self.spark.read.parquet(path))

    def _sized(self, name: str, frame: DataFrame) -> DataFrame:
        return frame if name in PLACES else sized(frame)

    def sql(self, text: str) -> DataFrame:
        """Run SQL over the given and derived tables, passed as arguments rather than as global views."""
        frames = {n: getattr(self, n) for n in [*TABLES, *DERIVED] if _mentions(text, n)}
        for name in frames:
            text = _replace(text, name)
        return self.spark.sql(text, **frames)


def _mentions(text: str, name: str) -> bool:
    return _pattern(name).search(text) is not None


def _replace(text: str, name: str) -> str:
    return _pattern(name).sub(lambda m: m.group(1) + "{" + name + "}", text)


def _pattern(name: str):
    return re.compile(rf"((?:FROM|JOIN)\s+){name}\b")


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables``; ``sql`` may name derived tables, which are put in front of it."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, root: fn(Tables(spark, root))
        if sql is not None:
            SQL[name] = with_derived(sql)
        return fn

    return wrap


def with_derived(sql: str) -> str:
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in DERIVED.items():
            if name not in needed and _mentions(text, name):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    head = ",\n".join(f"{n} AS ({DERIVED[n].strip()})" for n in needed)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
