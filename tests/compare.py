"""Runs a query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb

KINDS = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 5) + 0.0
    return value


def _sorted(rows):
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


def differences(frame, connection, sql: str) -> list[str]:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = dict(zip(names, (KINDS.get(str(d[1]), str(d[1])) for d in result.description)))
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} against {sorted(names)}"]
    found = [
        f"type of {name}: {kind} against {kinds[name]}" for name, kind in frame.dtypes if kinds[name] != kind
    ]
    order = sorted(names)
    theirs = _sorted([tuple(row[names.index(n)] for n in order) for row in result.fetchall()])
    ours = _sorted([tuple(row[n] for n in order) for row in frame.collect()])
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows against {len(theirs)}")
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        a, b = wrong[0]
        found.append(f"{len(wrong)} rows differ, first {str(a)[:300]} against {str(b)[:300]}")
    if not ours:
        found.append("no rows")
    return found
