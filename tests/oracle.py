"""Runs a query and its DuckDB SQL over the same tables and compares the rows."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return str([plain(x) for x in value])
    return str(value)


def compare(spark, query, sql, sf=SF):
    rows = query(spark, sf)
    names = sorted(rows.columns)
    got = sorted(tuple(map(plain, r)) for r in rows.select(*names).collect())
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == names
    assert got == sorted(tuple(plain(r[columns.index(n)]) for n in names) for r in result.fetchall())
