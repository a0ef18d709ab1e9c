"""Run a query and its SQL twin side by side and compare rows."""

from __future__ import annotations

import math
import time

import duckdb

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v).__name__ in ("int", "float")), round(v, 4) + 0.0 if isinstance(v, float) else v)
                 if not isinstance(v, (list, dict, tuple, bool)) else (True, "x", str(v)) for v in row)


def _plain(value):
    if hasattr(value, "asDict"):
        return {k: _plain(v) for k, v in value.asDict().items()}
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return value


def compare(spark, con, query, twin: str, sf_dir: str) -> dict:
    start = time.time()
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    mine = [tuple(_plain(r[n]) for n in names) for r in df.collect()]
    spent = time.time() - start
    start = time.time()
    cursor = con.execute(twin)
    order = [d[0] for d in cursor.description]
    if sorted(order) != names:
        return {"ok": False, "why": f"columns {names} against {sorted(order)}"}
    place = [order.index(n) for n in names]
    theirs = [tuple(_plain(r[i]) for i in place) for r in cursor.fetchall()]
    out = {"rows": len(mine), "spark_s": round(spent, 2), "sql_s": round(time.time() - start, 2)}
    if len(mine) != len(theirs):
        return {**out, "ok": False, "why": f"{len(mine)} rows against {len(theirs)}"}
    mine.sort(key=_key)
    theirs.sort(key=_key)
    exact = True
    for a, b in zip(mine, theirs):
        for n, x, y in zip(names, a, b):
            if type(x) is not type(y) and not (x is None or y is None):
                return {**out, "ok": False, "why": f"{n}: {type(x).__name__} against {type(y).__name__} ({x}, {y})"}
            if x == y:
                continue
            if isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9):
                exact = False
                continue
            return {**out, "ok": False, "why": f"{n}: {x} against {y}", "rows_at": (a, b)}
    return {**out, "ok": True, "exact": exact}
