"""Comparing Spark results with DuckDB over the same tables."""

import glob
import os

import duckdb


def connect(sf_dir):
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def rows_of(names, rows):
    """Rows as text in a fixed order, columns sorted by name."""
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(row) for row in df.collect()])


def oracle_rows(db, sql):
    result = db.execute(sql)
    names = [column[0] for column in result.description]
    return sorted(names), rows_of(names, result.fetchall())
