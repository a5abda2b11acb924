"""Compare a Spark result with the same query in DuckDB: columns by name, rows in any order, exact values."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        if Path(f"{sf}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, float) and v == 0:
        return 0.0
    return v


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz", "HUGEINT": "hugeint",
}


def differences(df, con, sql: str) -> list[str]:
    got = df.collect()
    names = sorted(df.columns)
    cur = con.execute(sql)
    theirs = [d[0] for d in cur.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in cur.description}
    rows = cur.fetchall()
    if sorted(theirs) != names:
        return [f"columns {names} != {sorted(theirs)}"]
    out = []
    mine = dict(df.dtypes)
    for n in names:
        if mine[n] != kinds[n]:
            out.append(f"type of {n}: spark {mine[n]}, duckdb {kinds[n]}")
    at = [theirs.index(n) for n in names]
    a = Counter(tuple(plain(r[n]) for n in names) for r in got)
    b = Counter(tuple(plain(r[i]) for i in at) for r in rows)
    if a != b:
        x, y = a - b, b - a
        out.append(f"rows {len(got)} vs {len(rows)}; only spark {sum(x.values())}, only duckdb {sum(y.values())}")
        out += [f"  spark  {dict(zip(names, r))}" for r in sorted(x, key=str)[:3]]
        out += [f"  duckdb {dict(zip(names, r))}" for r in sorted(y, key=str)[:3]]
    return out
