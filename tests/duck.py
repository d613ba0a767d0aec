"""Runs a query and its SQL over one data folder and compares the rows."""

import glob
import math
import os

import duckdb

DATA = "/root/testdata/sf0.001"


def connect(data=DATA):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


def compare(con, spark, query, sql, data=DATA):
    df = query(spark, data)
    columns = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in columns) for r in df.collect())
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(norm(r[i]) for i in at) for r in cursor.fetchall())
