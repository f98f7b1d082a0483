"""Running a registered query and its SQL side by side."""

from __future__ import annotations

import datetime as dt
import decimal
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else float(f"{value:.12g}")
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, dt.datetime):
        return value.date() if value.time() == dt.time() else value
    return value


def _sorted(rows):
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, _sorted(df.select(*columns).collect())


def sql_rows(con, sql):
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [[row[i] for i in order] for row in found.fetchall()]
    return [names[i] for i in order], _sorted(rows)
