"""Compare a query's rows with its SQL's rows, both as multisets of plain values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, decimal.Decimal):
        return float(f"{float(value):.9g}")
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    if isinstance(value, int):
        return value
    return str(value)


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    cur = con.execute(sql)
    wanted = [d[0] for d in cur.description]
    rows = cur.fetchall()
    found = df.collect()
    if sorted(df.columns) != sorted(wanted):
        return [f"columns {sorted(df.columns)} but SQL has {sorted(wanted)}"]
    ours, theirs = bag(df.columns, found), bag(wanted, rows)
    notes = []
    if ours != theirs:
        notes.append(f"{len(found)} rows but SQL has {len(rows)}")
        notes += [f"only here {r}" for r in list((ours - theirs).elements())[:3]]
        notes += [f"only SQL {r}" for r in list((theirs - ours).elements())[:3]]
    return notes
