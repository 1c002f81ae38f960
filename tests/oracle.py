"""Side-by-side check of a Spark query against its DuckDB oracle SQL.

Mirrors the driver's gate: same row count, same column names, and the same
multiset of rows (columns sorted by name).  Floats must be equal bit for bit
(queries present sum-derived doubles rounded in both engines).
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from lendscore.sources.applications import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v + 0.0  # -0.0 == 0.0
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in r))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s = spark_df.toPandas()
    d = con.execute(sql).df()
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: spark={sorted(s.columns)} duck={sorted(d.columns)}"
    if len(s) != len(d):
        return False, f"row count differs: spark={len(s)} duck={len(d)}"
    rs, rd = rows_of(s), rows_of(d)
    for a, b in zip(rs, rd):
        if a != b:
            return False, f"first differing row: spark={a} duck={b}"
    return True, f"{len(s)} rows equal"
