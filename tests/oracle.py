"""Run registered queries against their oracle SQL: python tests/oracle.py [folder] [name …]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from tidemark.registry import ORACLES, QUERIES
from tidemark.registry.base import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, float):
        return repr(float(f"{v:.10g}"))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def rowset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def numeric_kinds(rows, i):
    return {type(r[i]).__name__ for r in rows if r[i] is not None}


def compare(spark, con, folder: str, name: str):
    """None when equal, else a message."""
    df = QUERIES[name](spark, folder)
    got_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    want_cols = [d[0] for d in cur.description]
    want_rows = cur.fetchall()
    gc, got = rowset(df.columns, got_rows)
    wc, want = rowset(want_cols, want_rows)
    if gc != wc:
        return f"columns {gc} != {wc}"
    for i, c in enumerate(df.columns):
        a, b = numeric_kinds(got_rows, i), numeric_kinds(want_rows, want_cols.index(c))
        if a and b and a != b:
            return f"{c}: types {a} != {b}"
    if got != want:
        have, expected = set(got), set(want)
        only_got = [r for r in got if r not in expected][:3]
        only_want = [r for r in want if r not in have][:3]
        return f"rows {len(got)} != {len(want)}; ours {only_got} theirs {only_want}"
    return None if got else "EMPTY"


if __name__ == "__main__":
    from tidemark.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    bad = 0
    for n in names:
        start = time.time()
        try:
            msg = compare(spark, con, folder, n) if n in ORACLES else f"no oracle, rows={QUERIES[n](spark, folder).count()}"
        except Exception as e:  # noqa: BLE001
            msg = f"{type(e).__name__}: {str(e)[:400]}"
        if msg and not msg.startswith("no oracle"):
            bad += 1
        print(f"{'ok ' if not msg else 'BAD' if not msg.startswith('no oracle') else '-- '} {n} {time.time() - start:.1f}s {msg or ''}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
