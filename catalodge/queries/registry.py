"""Registered queries: a name, a Spark callable and, where SQL can say it, the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Rows of a few bytes from which a task makes whole pages or labels.
ROWS_PER_TASK = 4096


def dealt(rows: DataFrame) -> DataFrame:
    """The same rows, at most about ROWS_PER_TASK in a partition.

    Scans are split by bytes, which for narrow rows with much work each leaves a few tasks
    with millions of rows.
    """
    return rows.repartition(max(1, -(-rows.count() // ROWS_PER_TASK)))
