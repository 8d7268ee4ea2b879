"""Session helpers. A cluster brings its own session; tests and the bench build one here."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the jobs expect a cluster to have as well."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("catalodge")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        # One small file of pages still gives work to every core.
        .config("spark.sql.files.minPartitionNum", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.files.openCostInBytes", "262144")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


@functools.cache
def _test_dir() -> str:
    return tempfile.mkdtemp(prefix="catalodge-")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the one the cluster shares between executors.

    The session names it in ``spark.checkpoint.dir``. Where that is unset, a session on
    one machine, as in tests, gets a temporary folder; on a cluster that is an error, for
    executors would not see each other's files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.conf.get("spark.master", "").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = root or _test_dir()
    return os.path.join(root, name) if "://" not in root else f"{root.rstrip('/')}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    For results that several later steps use: they read the table instead of
    repeating its joins, and a lost executor costs a file read, not the lineage.
    """
    path = f"{shared_dir(df.sparkSession, 'stages')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows of a few numbers that one task sorts or gathers, and that one task writes behind a shuffle.
SPREAD_ROWS, WRITTEN_ROWS = 1 << 20, 1 << 17


def written(df: DataFrame, name: str, rows: int) -> DataFrame:
    """Materialized by as many tasks as there are cores, or more, of WRITTEN_ROWS rows: for no more than about `rows` narrow rows behind a shuffle.

    A small table then costs no task and no file for each shuffle partition. What comes before the shuffle is done by as many tasks as ever.
    """
    return materialize(df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // WRITTEN_ROWS))), name)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The same rows by hash of their keys, about SPREAD_ROWS in a partition: what a task holds does not grow with the table.

    Adaptive execution measures partitions compressed, so narrow rows that compress well would fill one with millions.
    """
    return df.repartition(max(1, -(-df.count() // SPREAD_ROWS)), *keys)


# Pages whose rows one task sorts and groups.
PAGES_PER_TASK = 1 << 13


def by_page(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """The same rows, those of about PAGES_PER_TASK pages in a partition, where the session's number of shuffle partitions would hold more.

    That number is fixed while pages grow, and adaptive execution only makes fewer of it. What groups by page_id and more needs no further shuffle.
    """
    parts = -(-pages.count() // PAGES_PER_TASK)
    return rows.repartition(parts, "page_id") if parts > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows
