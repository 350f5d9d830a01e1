"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb


def connect(root: str):
    con = duckdb.connect()
    for path in sorted(Path(root).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, decimal.Decimal):
        return "decimal " + str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return "ts " + v.isoformat()
    return f"{type(v).__name__} {v}"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark, con, root, fn, sql, show=3) -> list[str]:
    df = fn(spark, root)
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_names, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    out = []
    if got_names != want_names:
        out.append(f"columns {got_names} != {want_names}")
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        a, b = sorted(set(got) - set(want)), sorted(set(want) - set(got))
        out += [f"spark {x}" for x in a[:show]] + [f"sql   {x}" for x in b[:show]]
        if not a and not b:
            out.append("same distinct rows, different multiplicities")
    return out
