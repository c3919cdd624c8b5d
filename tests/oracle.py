"""Runs a query on Spark and its twin on DuckDB and compares the rows."""

import os

import duckdb

DATA = os.environ.get("TESSERA_TEST_DATA", "/root/testdata/sf0.001")


def views(sf_dir=DATA):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def compare(spark, run, sql, sf_dir=DATA):
    df = run(spark, sf_dir)
    cols = sorted(df.columns)
    mine = sorted(repr(tuple(r)) for r in df.select(*cols).collect())
    rel = views(sf_dir).sql(sql)
    assert cols == sorted(rel.columns)
    theirs = sorted(repr(tuple(r)) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall())
    assert mine == theirs
