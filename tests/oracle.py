"""Compares a query with its SQL in DuckDB, without regard to the order of rows."""

import glob
import math
import os

import duckdb


def connect(folder):
    c = duckdb.connect()
    for p in glob.glob(f"{folder}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return c


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, str):
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return str(list(v))
    return f"{float(v):.9g}"


def same(spark, connection, query, sql, folder):
    df = query(spark, folder)
    names = sorted(df.columns)
    r = connection.execute(sql)
    theirs = [x[0] for x in r.description]
    assert sorted(theirs) == names
    at = [theirs.index(n) for n in names]
    expected = sorted(tuple(_value(row[k]) for k in at) for row in r.fetchall())
    got = sorted(tuple(_value(row[n]) for n in names) for row in df.collect())
    assert len(got) == len(expected)
    assert got == expected
