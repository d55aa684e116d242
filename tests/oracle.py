"""Runs a query and its SQL on the same tables and compares them."""

import math
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, Decimal)):
        return "~" if isinstance(v, float) and math.isnan(v) else f"{float(v) + 0.0:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(_plain, v)) + "]"
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(_plain(r[i]) for i in order) for r in rows)


def duck(sql, sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    found = con.execute(sql)
    return [d[0] for d in found.description], found.fetchall()


def check(spark, f, sql, sf_dir):
    df = f(spark, sf_dir)
    columns, rows = duck(sql, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    mine, theirs = rows_of(df.columns, [tuple(r) for r in df.collect()]), rows_of(columns, rows)
    assert len(mine) == len(theirs)
    assert mine == theirs
