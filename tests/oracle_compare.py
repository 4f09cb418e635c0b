"""Compare a Spark DataFrame with a DuckDB query on the same parquet tables.

Mirrors the driver's check: same column names, same row count, same multiset of rows
(order-insensitive).  Values are canonicalised to text so that Spark and DuckDB types with
equal values compare equal (timestamps to ISO text, floats by repr of the double).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _canon(v) -> str:
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def rows_spark(df) -> tuple[list[str], list[tuple]]:
    cols = df.columns
    return cols, [tuple(r) for r in df.collect()]


SPARK_TO_DUCK = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "smallint": "SMALLINT",
}


def rows_duck(con, sql: str) -> tuple[list[str], list[tuple], list[str]]:
    rel = con.sql(sql)
    return list(rel.columns), rel.fetchall(), [str(t) for t in rel.types]


def type_diff(df, d_cols: list[str], d_types: list[str]) -> dict:
    duck_types = {c.lower(): t for c, t in zip(d_cols, d_types)}
    out = {}
    for f in df.schema.fields:
        s = f.dataType.simpleString()
        if SPARK_TO_DUCK.get(s, s) != duck_types.get(f.name.lower()):
            out[f.name] = (s, duck_types.get(f.name.lower()))
    return out


def compare(df, con, sql: str) -> dict:
    s_cols, s_rows = rows_spark(df)
    d_cols, d_rows, d_types = rows_duck(con, sql)
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows)}
    diff = type_diff(df, d_cols, d_types)
    out["types_match"] = not diff
    if diff:
        out["type_diff"] = diff
    out["columns_match"] = sorted(c.lower() for c in s_cols) == sorted(c.lower() for c in d_cols)
    if not out["columns_match"]:
        out["spark_cols"] = s_cols
        out["oracle_cols"] = d_cols
        out["match"] = False
        return out
    order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i].lower())
    order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i].lower())
    cs = Counter(tuple(_canon(r[i]) for i in order_s) for r in s_rows)
    cd = Counter(tuple(_canon(r[i]) for i in order_d) for r in d_rows)
    out["match"] = cs == cd and out["types_match"]
    if not out["match"]:
        names = [s_cols[i] for i in order_s]
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        out["only_spark"] = [dict(zip(names, r)) for r in only_s]
        out["only_oracle"] = [dict(zip(names, r)) for r in only_d]
    return out
