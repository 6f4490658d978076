"""Compare a Spark result with the SQL engine's, independent of row order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return float(f"{value:.12g}")
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(plain, key=repr)


def spark_rows(frame):
    return _sorted(frame.columns, [tuple(r) for r in frame.collect()])


def sql_rows(connection, sql):
    result = connection.execute(sql)
    return _sorted([d[0] for d in result.description], result.fetchall())
