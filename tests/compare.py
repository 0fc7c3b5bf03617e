"""Compare a Spark query with its DuckDB statement, row by row."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _key(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, float):
        v = v + 0.0
        return f"{v:.10g}" if v else "0"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_key(x) for x in v) + "]"
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat().replace("T00:00:00", "")
    return str(v)


def kind(name: str) -> str:
    n = name.lower()
    for a, b in (("bigint", "long"), ("varchar", "string"), ("integer", "int"), ("timestamp", "timestamp")):
        if n.startswith(a):
            return b
    return n.split("(")[0]


def compare(df, con, sql: str) -> str | None:
    """None when equal, otherwise a short description of the difference."""
    cols = sorted(df.columns)
    rel = con.sql(sql)
    if cols != sorted(rel.columns):
        return f"columns {cols} != {sorted(rel.columns)}"
    types = {f.name: kind(f.dataType.simpleString()) for f in df.schema}
    other = {c: kind(str(t)) for c, t in zip(rel.columns, rel.types)}
    odd = {c: (types[c], other[c]) for c in cols if types[c] != other[c] and not types[c].startswith("array")}
    mine = sorted(tuple(_key(r[c]) for c in cols) for r in df.collect())
    at = [rel.columns.index(c) for c in cols]
    theirs = sorted(tuple(_key(r[i]) for i in at) for r in rel.fetchall())
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    if mine != theirs:
        bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
        return f"{len(bad)} of {len(mine)} rows differ, e.g. {cols} {bad[0]}"
    if odd:
        return f"types {odd}"
    return None
