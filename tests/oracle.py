"""Compare registered queries with their SQL in DuckDB: ``python tests/oracle.py [sf_dir] [name prefix ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

import __spark_entry__ as entry
from plotwise.catalog.registry import TABLES


def connect(root: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, root: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = entry.queries()[name](spark, root)
    ours = rows_of(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if ours else "no rows"
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    theirs = rows_of(names, rel.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if ours != theirs:
        only = [r for r in ours if r not in set(theirs)][:2], [r for r in theirs if r not in set(ours)][:2]
        return f"{len(ours)} vs {len(theirs)} rows, {sorted(names)} e.g. {only[0]} vs {only[1]}"
    return None if ours else "both empty"


def main() -> int:
    from plotwise.session import local_session

    args = sys.argv[1:]
    root = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = local_session(partitions=8)
    con = connect(root)
    bad = 0
    for name in entry.queries():
        if args and not any(name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, root, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        took = time.time() - start
        note = "" if name in entry.oracle_sql() else " (rows only)"
        if problem:
            bad += 1
            print(f"BAD  {name}{note} {took:.1f}s: {problem}", flush=True)
        else:
            print(f"ok   {name}{note} {took:.1f}s", flush=True)
    print(f"{bad} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
