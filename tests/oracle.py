"""Compare a Spark result with a DuckDB oracle: columns, row count, values.

Values are normalised (floats rounded to 9 significant digits, decimals to
float, timestamps to ISO text) and compared as sorted row lists, so row
order does not matter.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark_df, con, sql: str):
    s_cols = list(spark_df.columns)
    d = con.execute(sql)
    d_cols = [c[0] for c in d.description]
    d_rows = d.fetchall()
    s_rows = [tuple(r) for r in spark_df.collect()]
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={s_cols} duck={d_cols}")
        return problems
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    s_norm = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=_key)
    d_norm = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=_key)
    if len(s_norm) != len(d_norm):
        problems.append(f"row count spark={len(s_norm)} duck={len(d_norm)}")
    if s_norm != d_norm:
        diff = [(a, b) for a, b in zip(s_norm, d_norm) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems
