"""Tables of one row per key of which a merge reads and rewrites only the part that a batch touches."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalodge.operators import merge
from catalodge.session import materialize

SHARD = "shard"


class ShardedTable:
    """A stored table, dealt by a hash of its keys into shards and clustered by key inside them.

    Shards are partitions: a batch prunes those that hold none of its keys, and replaces the
    others as a whole. Clustering lets the join with a batch take the stored rows as they
    lie, without an exchange, when there are as many buckets as the session has shuffle
    partitions. Both numbers are written beside the folder when it is made and hold from
    then on. A merge that fails before shards are replaced changes nothing; one that is run
    again after that finds its values stored and logs nothing new.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: str, shards: int = 64, buckets: int | None = None):
        self.spark, self.path, self.keys = spark, path, list(keys)
        self.name = "sharded_" + hashlib.sha1(path.encode()).hexdigest()[:16]
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        layout = spark.range(1).select(F.lit(shards).alias("shards"), F.lit(buckets).alias("buckets"))
        layout.write.mode("ignore").parquet(f"{path}.layout")
        self.shards, self.buckets = spark.read.schema("shards int, buckets int").parquet(f"{path}.layout").first()
        by = ", ".join(f"`{key}`" for key in self.keys)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({schema}, {SHARD} INT) USING parquet PARTITIONED BY ({SHARD}) "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )

    def shard(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.shards)).cast("int")

    def read(self, shards: Sequence[int] | None = None) -> DataFrame:
        """The whole table, or the rows of some shards."""
        rows = self.spark.table(self.name)
        return (rows if shards is None else rows.where(F.col(SHARD).isin(*shards))).drop(SHARD)

    def touched(self, batch: DataFrame) -> list[int]:
        """Numbers of the shards that a batch has keys in: no more than there are shards."""
        return sorted(row[0] for row in batch.select(self.shard().alias(SHARD)).distinct().collect())

    def replace(self, rows: DataFrame) -> None:
        """Write ``rows`` in place of the shards that they belong to; all other files stay."""
        rows = rows.withColumn(SHARD, self.shard())
        # A bucket of a shard is written by one task, and by one only.
        placed = rows.repartition(self.buckets, *self.keys).select(*self.spark.table(self.name).columns)
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            placed.write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(mode, before)

    def merge(self, batch: DataFrame, spec: merge.MergeSpec, order: Sequence[str], bucket: Column | None = None) -> DataFrame:
        """Apply a batch as ``merge.merge_records`` does; returns the change log."""
        shards = self.touched(batch)
        if not shards:
            return merge.merge_records(self.read([-1]), batch, spec, order, bucket).log
        found = merge.merge_records(self.read(shards), batch, spec, order, bucket)
        # Both are written before the shards that they are made from are replaced.
        log = materialize(found.log, "merge-log")
        self.replace(materialize(found.table, "merged-shards"))
        return log

    def replace_sets(self, incoming: DataFrame, member: Sequence[str], order: Sequence[str]) -> None:
        """Replace the member lists of the owners, the keys of this table, that a batch brings."""
        shards = self.touched(incoming)
        if shards:
            found = merge.replace_sets(self.read(shards), incoming, self.keys, member, order)
            self.replace(materialize(found, "replaced-sets"))

    def close(self) -> None:
        """Take the table out of the session's catalog; the folder stays."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
