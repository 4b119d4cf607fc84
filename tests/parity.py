"""Compares a query's rows with its SQL run by DuckDB over the same tables."""

import math
import os

import duckdb


def connect(folder):
    c = duckdb.connect()
    for f in os.listdir(folder):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{folder}/{f}'")
    return c


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def same(spark, folder, con, query, sql):
    df = query(spark, folder)
    names = sorted(df.columns)
    mine = sorted((tuple(_plain(v) for v in r) for r in df.select(*names).collect()), key=repr)
    rel = con.sql(sql)
    assert sorted(rel.columns) == names
    other = sorted((tuple(_plain(v) for v in r) for r in rel.project(", ".join(f'"{n}"' for n in names)).fetchall()), key=repr)
    assert mine == other
