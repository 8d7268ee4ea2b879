"""Compare registered queries with their SQL on the same Parquet tables."""

from __future__ import annotations

import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return f"D{value}"
    if isinstance(value, (list, tuple)):
        return [normal(v) for v in value]
    return f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(str([normal(r[i]) for i in order]) for r in rows)


def compare(con, df, sql: str) -> str | None:
    """None when both sides agree, else a short description of the difference."""
    spark_cols, spark_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    duck_cols, duck_rows = rows_of([d[0] for d in result.description], result.fetchall())
    if spark_cols != duck_cols:
        return f"columns {spark_cols} != {duck_cols}"
    if spark_rows == duck_rows:
        return None if spark_rows else "both sides are empty"
    spark_set, duck_set = set(spark_rows), set(duck_rows)
    only_spark = [r for r in spark_rows if r not in duck_set][:3]
    only_duck = [r for r in duck_rows if r not in spark_set][:3]
    return f"rows {len(spark_rows)} != {len(duck_rows)}; spark only {only_spark}; sql only {only_duck}"[:1500]
