"""Comparing a query with its SQL twin in DuckDB, value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


# Types that count as the same on both sides.
SPARK_TYPES = {
    "bigint": "int64", "int": "int32", "double": "double", "string": "text", "boolean": "bool", "date": "date",
    "timestamp_ntz": "time", "timestamp": "time",
}
DUCK_TYPES = {
    "BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "double", "VARCHAR": "text", "BOOLEAN": "bool", "DATE": "date",
    "TIMESTAMP": "time",
}


def _value(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def spark_result(df):
    names = sorted(df.columns)
    types = {n: SPARK_TYPES.get(t, t) for n, t in df.dtypes}
    rows = sorted(tuple(_value(row[n]) for n in names) for row in df.collect())
    return names, [types[n] for n in names], rows


def duck_result(con, sql: str):
    rel = con.sql(sql)
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    types = [DUCK_TYPES.get(str(rel.types[i]), str(rel.types[i])) for i in order]
    rows = sorted(tuple(_value(row[i]) for i in order) for row in rel.fetchall())
    return [rel.columns[i] for i in order], types, rows


def differences(spark_side, duck_side) -> list[str]:
    """What differs, in words; empty when the two agree."""
    found = []
    if spark_side[0] != duck_side[0]:
        return [f"columns {spark_side[0]} / {duck_side[0]}"]
    for name, s, d in zip(spark_side[0], spark_side[1], duck_side[1]):
        if s != d:
            found.append(f"type of {name}: {s} / {d}")
    if len(spark_side[2]) != len(duck_side[2]):
        found.append(f"rows {len(spark_side[2])} / {len(duck_side[2])}")
    if spark_side[2] != duck_side[2]:
        only_spark = [r for r, o in zip(spark_side[2], duck_side[2]) if r != o][:3]
        only_duck = [o for r, o in zip(spark_side[2], duck_side[2]) if r != o][:3]
        found.append(f"values {str(only_spark)[:600]} / {str(only_duck)[:600]}")
    return found
