"""Runs a query's DuckDB SQL and compares rows, whatever their order."""

import glob
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder=None):
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for t in TABLES if folder else ():
        path = f"{folder}/{t}.parquet"
        if glob.glob(path):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return c


def plain(v):
    if isinstance(v, float):
        return repr(v) if v != int(v) else str(int(v))
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return v.isoformat(timespec="microseconds") if hasattr(v, "isoformat") else str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def assert_same(df, connection, sql):
    r = connection.sql(sql)
    assert sorted(df.columns) == sorted(r.columns)
    assert rows(df.columns, [tuple(x) for x in df.collect()]) == rows(r.columns, r.fetchall())
