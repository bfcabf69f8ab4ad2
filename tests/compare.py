"""Rows of a Spark query against rows of its SQL in DuckDB."""

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if hasattr(value, "item"):
        return plain(value.item())
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(tuple(plain(r[k]) for k in order) for r in rows)


def connection(sf):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def compare(spark, sf, query, sql):
    df = query(spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    answer = connection(sf).execute(sql)
    want = rows_of([d[0] for d in answer.description], answer.fetchall())
    return got, want
