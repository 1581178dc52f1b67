"""Runs a registered query and its SQL over the same tables."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.sql(f"create view {t} as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def tidy(value):
    return round(value, 6) if isinstance(value, float) else value


def compare(df, sql, sf_dir):
    found = connection(sf_dir).sql(sql)
    assert sorted(df.columns) == sorted(found.columns)
    columns = sorted(df.columns)
    ours = sorted((tuple(tidy(r[c]) for c in columns) for r in df.collect()), key=repr)
    place = [found.columns.index(c) for c in columns]
    theirs = sorted((tuple(tidy(r[i]) for i in place) for r in found.fetchall()), key=repr)
    assert ours == theirs
