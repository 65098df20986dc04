"""Spark results against DuckDB's on the same files: rows, columns by name, values in any order."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def views(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{source}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, (int, float)):
        return "nan" if math.isnan(value) else float(f"{float(value):.9g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def differences(frame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both give the same columns and rows."""
    names = sorted(frame.columns)
    mine = sorted(repr([_plain(r[n]) for n in names]) for r in (x.asDict(recursive=True) for x in frame.collect()))
    result = con.execute(sql)
    theirs_names = [d[0] for d in result.description]
    if sorted(theirs_names) != names:
        return f"columns {names} and {sorted(theirs_names)}"
    at = [theirs_names.index(n) for n in names]
    theirs = sorted(repr([_plain(r[i]) for i in at]) for r in result.fetchall())
    if mine == theirs:
        return ""
    a, b = [x for x in mine if x not in set(theirs)], [x for x in theirs if x not in set(mine)]
    return f"rows {len(mine)} and {len(theirs)}, only here {a[:1]}, only there {b[:1]}"
