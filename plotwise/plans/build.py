"""Incremental builds of the model graph.

Every table (a model whose name has no ``vw_``, and views named as worth it) is stored once under a key of the code, the
settings, the state of the source files it read and the keys of the tables it read. What a table reads is recorded while
it is built. A later build works out the key from the recorded inputs: where a table with that key is stored it is read,
else it is built anew. So a changed source rebuilds what depends on it, in the order of the graph, and nothing else.
"""

from __future__ import annotations

import hashlib
import json
import threading
from collections import defaultdict
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cache
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotwise.plans.warehouse import MODELS, Warehouse, load_models
from plotwise.session import sized

#: Tables that are built at the same time: one table's many short jobs leave most cores idle.
AT_ONCE = 4


@cache
def code_version() -> str:
    """A hash of the library's modules."""
    digest = hashlib.sha256()
    for file in sorted(Path(__file__).resolve().parent.parent.rglob("*.py")):
        if "llm" not in file.parts:
            digest.update(file.read_bytes())
    return digest.hexdigest()


@dataclass
class Inputs:
    """Names of the sources and stored tables that a model read."""

    sources: set[str] = field(default_factory=set)
    tables: set[str] = field(default_factory=set)

    def add(self, other: Inputs) -> None:
        self.sources |= other.sources
        self.tables |= other.tables


class Opened(threading.local):
    """What a thread is building, the innermost last, and whether it is one of those of ``prepare``."""

    def __init__(self):
        self.inputs: list[Inputs] = []
        self.helps = False


@dataclass
class Build(Warehouse):
    """A warehouse that stores its tables below ``folder`` (one that all executors share) and reuses what is up to date.

    ``stored_views`` are views that are stored like tables. ``version`` stands for the code; the default is a hash of the
    library. A source's state is that of the files its frame reads (names, lengths, times); one that reads no file is
    taken as changed only with ``version``. ``rebuilt`` and ``reused`` list tables by what was done.
    """

    folder: str = ""
    stored_views: tuple[str, ...] = ()
    version: str = ""
    rebuilt: list[str] = field(default_factory=list)
    reused: list[str] = field(default_factory=list)
    _opened: Opened = field(default_factory=Opened)
    _locks: dict[str, threading.RLock] = field(default_factory=lambda: defaultdict(threading.RLock))
    _read: dict[str, Inputs] = field(default_factory=dict)
    _keys: dict[str, str] = field(default_factory=dict)
    _states: dict[str, str] = field(default_factory=dict)

    @property
    def _open(self) -> list[Inputs]:
        return self._opened.inputs

    def src(self, name: str) -> DataFrame:
        if self._open:
            self._open[-1].sources.add(name)
        return super().src(name)

    def ref(self, name: str) -> DataFrame:
        if name in self.sources:
            return self.src(name)
        load_models()
        if self._is_table(name):
            frame = self._table(name)
            if self._open:
                self._open[-1].tables.add(name)
            return frame
        with self._locks[name]:
            if name not in self.built:
                self.built[name], self._read[name] = self._recorded(name)
        if self._open:
            self._open[-1].add(self._read[name])
        return self.built[name]

    def prepare(self, names: Iterable[str]) -> None:
        """Build these models, ``AT_ONCE`` at a time; what several of them need is built once, by the first, and the others wait."""
        names = [n for n in names if n not in self.built and n not in self.sources]
        if self._opened.helps or len(names) < 2:
            return super().prepare(names)

        def help_with(name: str) -> None:
            self._opened.helps = True
            self.ref(name)

        load_models()
        with ThreadPoolExecutor(AT_ONCE) as pool:
            done = [pool.submit(inheritable_thread_target(self.spark)(help_with), n) for n in names]
            try:
                for d in done:
                    d.result()
            finally:
                pool.shutdown(cancel_futures=True)

    def _is_table(self, name: str) -> bool:
        return name in self.stored_views or not name.split(".", 1)[1].startswith("vw_")

    def _recorded(self, name: str) -> tuple[DataFrame, Inputs]:
        self._open.append(Inputs())
        try:
            return MODELS[name](self), self._open[-1]
        finally:
            self._open.pop()

    def _table(self, name: str) -> DataFrame:
        with self._locks[name]:
            return self.built[name] if name in self.built else self._made(name)

    def _made(self, name: str) -> DataFrame:
        key = self.key(name)
        if key is None or not self._exists(f"{self._path(name, key)}/_SUCCESS"):
            frame, inputs = self._recorded(name)
            self._write_text(f"{self.folder}/_inputs/{name}.json", json.dumps({"sources": sorted(inputs.sources), "tables": sorted(inputs.tables)}))
            key = self._key_of(name, inputs)
            storable = frame.withColumns({f.name: F.col(f"`{f.name}`").cast("string") for f in frame.schema if isinstance(f.dataType, T.NullType)})
            storable.write.mode("overwrite").option("compression", "zstd").parquet(self._path(name, key))
            self.rebuilt.append(name)
        else:
            self.reused.append(name)
        self._keys[name] = key
        self.built[name] = sized(self.spark.read.parquet(self._path(name, key)))
        return self.built[name]

    def key(self, name: str) -> str | None:
        """The key that a table has now, by the inputs recorded when it was last built; None if it never was."""
        if name not in self._keys:
            text = self._read_text(f"{self.folder}/_inputs/{name}.json")
            if text is None:
                return None
            known = json.loads(text)
            if not set(known["tables"]) <= set(MODELS) or not set(known["sources"]) <= set(self.sources):
                return None
            found = self._key_of(name, Inputs(set(known["sources"]), set(known["tables"])))
            if found is None:
                return None
            self._keys[name] = found
        return self._keys[name]

    def _key_of(self, name: str, inputs: Inputs) -> str | None:
        tables = {t: self.key(t) for t in sorted(inputs.tables)}
        if None in tables.values():
            return None
        parts = [name, self.version or code_version(), repr(self.settings), str(self.today), {s: self._state(s) for s in sorted(inputs.sources)}, tables]
        return hashlib.sha256(json.dumps(parts).encode()).hexdigest()[:24]

    def _state(self, source: str) -> str:
        if source not in self._states:
            digest = hashlib.sha256()
            for file in sorted(super().src(source).inputFiles()):
                path = self.spark._jvm.org.apache.hadoop.fs.Path(file)
                status = self._fs(path).getFileStatus(path)
                digest.update(f"{file} {status.getLen()} {status.getModificationTime()}\n".encode())
            self._states[source] = digest.hexdigest()[:24]
        return self._states[source]

    def _path(self, name: str, key: str) -> str:
        return f"{self.folder}/{name}/{key}"

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return self._fs(found).exists(found)

    def _write_text(self, path: str, text: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        out = self._fs(target).create(target, True)
        out.write(bytearray(text.encode()))
        out.close()

    def _read_text(self, path: str) -> str | None:
        if not self._exists(path):
            return None
        return "\n".join(r.value for r in self.spark.read.text(path).collect())
