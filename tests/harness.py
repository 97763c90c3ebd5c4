"""Spark-vs-DuckDB comparison used by the oracle tests and scripts/oracle_check.py.

Mirrors the driver's check: same column names, same row count, and the same
multiset of rows after normalising values (floats to 6 places, timestamps
to ISO text, NaN to null).
"""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_connection(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "toArray"):
        return tuple(_norm(float(x)) for x in v.toArray())
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, repr(x)) for x in row)


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, sorted(rows, key=_key)


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    return [names[i] for i in order], sorted(rows, key=_key)


# Spark type -> DuckDB type name, for the column-type check.
SPARK_TO_DUCK = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "array<int>": "INTEGER[]",
    "float": "FLOAT", "array<double>": "DOUBLE[]", "date": "DATE",
}


def type_diff(df, con, sql):
    """Columns whose Spark and DuckDB types differ."""
    st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    rel = con.sql(sql)
    dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}


def compare(df, con, sql):
    """Return None when equal, else a short description of the difference."""
    s_cols, s_rows = spark_rows(df)
    d_cols, d_rows = duck_rows(con, sql)
    if s_cols != d_cols:
        return f"columns differ: spark={s_cols} duckdb={d_cols}"
    types = type_diff(df, con, sql)
    if types:
        return f"column types differ: {types}"
    if len(s_rows) != len(d_rows):
        return f"row count differs: spark={len(s_rows)} duckdb={len(d_rows)}"
    for a, b in zip(s_rows, d_rows):
        if a != b:
            return f"first differing row: spark={a} duckdb={b}"
    return None
