"""Rows of a Spark query and of its SQL twin in a form that can be compared."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, (list, tuple)) and not hasattr(v, "asDict"):
        return "[" + ",".join(map(canon, v)) + "]"
    return str(v)


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, sorted(tuple(canon(r[c]) for c in columns) for r in df.collect())


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def duck_rows(con, sql: str):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = [names.index(c) for c in sorted(names)]
    return sorted(names), sorted(tuple(canon(r[i]) for i in order) for r in result.fetchall())
