"""Side-by-side check of a Spark binding against its DuckDB oracle SQL.

Rows are normalised (dates/timestamps to ISO text, floats rounded) and
compared as multisets together with column names and type families.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


_SPARK_FAMILY = {
    "StringType": "str", "LongType": "int64", "IntegerType": "int32", "DoubleType": "float",
    "DateType": "date", "TimestampType": "ts", "BooleanType": "bool", "FloatType": "float",
    "ShortType": "int16", "TimestampNTZType": "ts",
}
_DUCK_FAMILY = {
    "VARCHAR": "str", "BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "float", "DATE": "date",
    "TIMESTAMP": "ts", "BOOLEAN": "bool", "FLOAT": "float", "SMALLINT": "int16",
    "TIMESTAMP WITH TIME ZONE": "ts",
}


def compare(spark, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: _SPARK_FAMILY.get(type(f.dataType).__name__, type(f.dataType).__name__) for f in sdf.schema}
    s_rows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    con = duck(sf_dir)
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: _DUCK_FAMILY.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    d_rows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if s_types != d_types:
        diffs = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
        return False, f"types differ: {diffs}"
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sc = Counter(tuple(r[i] for i in si) for r in s_rows)
    dc = Counter(tuple(r[i] for i in di) for r in d_rows)
    if sc != dc:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        return False, f"rows differ: spark={len(s_rows)} duck={len(d_rows)} only_spark={only_s} only_duck={only_d}"
    return True, f"{len(s_rows)} rows"
