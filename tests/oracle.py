"""Runs a query and its SQL on the same tables and compares rows."""

import glob
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        path = f"{path}/*.parquet" if os.path.isdir(path) else path
        if glob.glob(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, (list, tuple)) or type(value).__name__ == "ndarray":
        return tuple(normal(x) for x in value)
    if isinstance(value, dict):
        return tuple(sorted((k, normal(v)) for k, v in value.items()))
    if type(value).__name__ == "Decimal":
        return normal(float(value))
    return value


def compare(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    got = sorted((repr(tuple(normal(r[c]) for c in names)) for r in df.collect()))
    cur = connect(sf_dir).execute(sql)
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == names, (sorted(cols), names)
    at = [cols.index(c) for c in names]
    want = sorted(repr(tuple(normal(r[i]) for i in at)) for r in cur.fetchall())
    assert len(got) == len(want), (len(got), len(want))
    diff = [(g, w) for g, w in zip(got, want) if g != w]
    assert not diff, diff[:3]
    return len(got)
