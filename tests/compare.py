"""Compare a Spark result with the same query run by DuckDB."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

TESTDATA = os.environ.get("WEIGHLINE_TESTDATA", "/root/testdata")


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(int(v)) if v == int(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(con, sql: str, df) -> str | None:
    """None when equal, else a short description of the difference."""
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want = rows_of(want_cols, cur.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(want_cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} <> {sorted(want_cols)}"
    if len(want) != len(got):
        return f"rows spark {len(got)} <> sql {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first spark {bad[0][0]} sql {bad[0][1]}" if bad else None
