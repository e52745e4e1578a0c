"""Compare a Spark result with DuckDB's, row for row, in any order."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def _plain(value):
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day).isoformat()
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (sorted(columns),
            Counter(tuple((type(_plain(r[i])).__name__, _plain(r[i])) for i in order)
                    for r in rows))


def oracle(folder: str, sql: str):
    with duckdb.connect() as db:
        for file in Path(folder).glob("*.parquet"):
            db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        result = db.execute(sql)
        return _rows([d[0] for d in result.description], result.fetchall())


def spark_rows(df: DataFrame):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def difference(df: DataFrame, folder: str, sql: str) -> str:
    """Empty if both agree in columns, types and values."""
    (left_columns, left), (right_columns, right) = spark_rows(df), oracle(folder, sql)
    if left_columns != right_columns:
        return f"columns {left_columns} vs {right_columns}"
    if left != right:
        only_spark, only_sql = left - right, right - left
        return (f"{sum(left.values())} vs {sum(right.values())} rows; "
                f"only Spark ({sum(only_spark.values())}): {sorted(map(str, only_spark))[:3]}; "
                f"only SQL ({sum(only_sql.values())}): {sorted(map(str, only_sql))[:3]}")
    return ""
