"""Compare a Spark result with an SQL oracle result (order-insensitive, exact values)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

#: The driver's smaller tables.
SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def norm(v):
    """Engine-neutral form of one value."""
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, repr(type(x)), x if x is not None else 0) for x in row)


def diff_results(s_cols, s_rows, o_cols, o_rows) -> list[str]:
    """Problems found comparing two results (columns by name, rows as multisets)."""
    problems = []
    if sorted(s_cols) != sorted(o_cols):
        problems.append(f"columns differ: spark={sorted(s_cols)} oracle={sorted(o_cols)}")
        return problems
    if len(s_rows) != len(o_rows):
        problems.append(f"row count spark={len(s_rows)} oracle={len(o_rows)}")
        return problems
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    oorder = [list(o_cols).index(s_cols[i]) for i in order]
    a = sorted((tuple(norm(r[i]) for i in order) for r in s_rows), key=_key)
    b = sorted((tuple(norm(r[i]) for i in oorder) for r in o_rows), key=_key)
    diffs = [(x, y) for x, y in zip(a, b) if x != y]
    if diffs:
        problems.append(f"{len(diffs)} differing rows, e.g. spark={diffs[0][0]} oracle={diffs[0][1]}")
    return problems


def duckdb_connection(sf_dir: str):
    """DuckDB with the driver tables registered as views."""
    import duckdb

    from ratebridge.sources.fixtures import DRIVER_TABLES

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con
