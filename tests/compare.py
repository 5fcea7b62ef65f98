"""Order-insensitive comparison of a Spark result with a DuckDB oracle.

Used by the tests and scripts/check_oracles.py (a local stand-in for the
driver's correctness gate).  Only small results are compared this way.
"""

from __future__ import annotations

import decimal
import hashlib
import math
import os

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_views(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return repr(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(str(norm(r[i])) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def compare(df, con, sql: str) -> tuple[bool, str]:
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    ocols, orows = rel.columns, rel.fetchall()
    ds, ls = digest(df.columns, srows)
    do, lo = digest(ocols, orows)
    if sorted(df.columns) != sorted(ocols):
        return False, f"columns {sorted(df.columns)} != {sorted(ocols)}"
    if len(srows) != len(orows):
        return False, f"rows {len(srows)} != {len(orows)}"
    if ds != do:
        return False, f"values differ: {sorted(set(ls) - set(lo))[:2]} vs {sorted(set(lo) - set(ls))[:2]}"
    return True, f"{len(srows)} rows"
