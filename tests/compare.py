"""Order-insensitive comparison of a Spark result with the DuckDB result."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

TABLAS = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def conectar(carpeta: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLAS:
        con.execute(f"create view {t} as select * from read_parquet('{carpeta}/{t}.parquet')")
    return con


def _valor(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (float, Decimal)):
        v = float(v)
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v.isoformat() if isinstance(v, dt.date) else v


def filas_spark(df):
    orden = sorted(df.columns)
    return orden, Counter(tuple(_valor(r[c]) for c in orden) for r in df.collect())


def filas_duckdb(con, sql: str):
    cur = con.execute(sql)
    nombres = [d[0] for d in cur.description]
    orden = sorted(nombres)
    idx = [nombres.index(c) for c in orden]
    return orden, Counter(tuple(_valor(r[i]) for i in idx) for r in cur.fetchall())


def diferencia(df, con, sql: str) -> str:
    """Empty when both agree."""
    cols_a, a = filas_spark(df)
    cols_b, b = filas_duckdb(con, sql)
    if cols_a != cols_b:
        return f"columns: {cols_a} / {cols_b}"
    if a != b:
        return (
            f"rows {sum(a.values())} / {sum(b.values())}; only spark {list((a - b).items())[:3]}; "
            f"only duckdb {list((b - a).items())[:3]}"
        )
    return ""
