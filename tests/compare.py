"""Comparison of a Spark result with the same query in DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    """Values of both engines in one form; floats to 12 significant digits."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, int):
        return float(value)
    return str(value)


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both agree, else what differs."""
    result = connection.execute(sql)
    oracle_columns = [c[0] for c in result.description]
    if sorted(df.columns) != sorted(oracle_columns):
        return f"columns {sorted(df.columns)} != {sorted(oracle_columns)}"
    ours, theirs = bag(df.columns, df.collect()), bag(oracle_columns, result.fetchall())
    if ours == theirs:
        return None
    extra, missing = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
    return f"{ours.total()} rows against {theirs.total()}; extra {extra}; missing {missing}"
