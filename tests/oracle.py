"""Spark results against SQL in DuckDB."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def same(df, con, sql):
    names = sorted(df.columns)
    got = sorted(repr(tuple(plain(r[n]) for n in names)) for r in df.collect())
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == names
    order = sorted(range(len(cols)), key=cols.__getitem__)
    want = sorted(repr(tuple(plain(r[i]) for i in order)) for r in cur.fetchall())
    assert got == want
