"""Compare a Spark result with DuckDB's on the same Parquet tables."""

import datetime
import glob
import math
import os

import duckdb

ROOT = "/root/testdata"


def connection(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{ROOT}/{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return tuple(map(plain, value)) if isinstance(value, (list, tuple)) else value


def rows_of(cursor, columns):
    at = [[d[0] for d in cursor.description].index(c) for c in columns]
    return sorted((tuple(plain(r[i]) for i in at) for r in cursor.fetchall()), key=repr)


def check(df, con, sql):
    columns = sorted(df.columns)
    cursor = con.execute(sql)
    assert sorted(d[0] for d in cursor.description) == columns
    want = rows_of(cursor, columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert got == want
