"""Compare a Spark result with a DuckDB result, without regard to row order."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value.is_integer() else round(value, 9)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def normalised(columns: list[str], rows) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [repr(tuple(_plain(row[i]) for i in order)) for row in rows]
    return [columns[i] for i in order], sorted(out)


def spark_rows(df):
    return normalised(df.columns, df.collect())


def duck_rows(connection, sql):
    result = connection.execute(sql)
    return normalised([c[0] for c in result.description], result.fetchall())
