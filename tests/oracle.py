"""Run a query on Spark and its SQL twin on DuckDB, and compare the rows."""

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_dir, t)}.parquet'")
    return con


def rows_of(cursor):
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=repr)
