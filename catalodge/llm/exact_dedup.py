"""Exact deduplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest, one row for each text ever
kept. A batch is reduced to one row for each digest, the digests that the index has are
taken out by a sort-merge anti-join on the bucket column, and the rest is appended.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalodge.llm.common import text_of
from catalodge.operators.graph import hot_lookup
from catalodge.session import materialize


def digest_of(text: str = "text") -> Column:
    """SHA-256 of the whole text in UTF-8, 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.encode(text_of(text), "UTF-8"), 256))


class DigestIndex:
    """A digest index in a folder that all executors share.

    The folder outlives the session: opening it again registers the same files. The number
    of buckets is written beside it when it is made; later ones given are not used.
    Appending a batch twice adds nothing, so a failed run is simply repeated.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path = spark, path
        self.name = "digest_index_" + hashlib.sha1(path.encode()).hexdigest()[:16]
        spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("ignore").parquet(f"{path}.buckets")
        self.buckets = buckets = spark.read.schema("buckets int").parquet(f"{path}.buckets").first()[0]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, rows: DataFrame) -> None:
        """Add the digests of (digest, doc_id) rows that the index lacks; of equal ones the largest id stays."""
        groups = rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        fresh = groups.join(self.table().select("digest").hint("merge"), "digest", "left_anti")
        fresh.repartition(self.buckets, "digest").select("digest", "keep_id").write.insertInto(self.name)

    def compacted(self, path: str, buckets: int | None = None) -> DigestIndex:
        """The same index in a new folder: one sorted file for each bucket, and another number of buckets if wanted."""
        new = DigestIndex(self.spark, path, buckets or self.buckets)
        self.table().repartition(new.buckets, "digest").write.insertInto(new.name)
        return new

    def close(self) -> None:
        """Take the table out of the session's catalog; the folder stays."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def exact_dedup(docs: DataFrame, index: DigestIndex, batches: int = 2, text: str = "text") -> DataFrame:
    """One row for each row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Ids are dealt into `batches` ranges that are appended from the highest range down, so
    that with an index of other documents these keep their place, and within `docs` the
    largest id of equal texts stays. `group_size` counts rows of `docs`. Null and empty
    texts are equal; rows that repeat both id and text are all marked as kept, a null id
    ranks below all others. An empty table gives an empty result. Other columns are not read.
    """
    digests = materialize(docs.select("doc_id", digest_of(text).alias("digest")), "digests")
    low, high = digests.agg(F.min("doc_id"), F.max("doc_id")).first()
    # Ids may span all 64 bits: as doubles they keep their order, and the largest has the last place.
    low, span = float(low or 0), max(1.0, float(high or 0) - float(low or 0))
    share = (F.col("doc_id").cast("double") - low) / span
    place = F.least(F.coalesce((share * batches).cast("int"), F.lit(0)), F.lit(batches - 1))
    for batch in reversed(range(batches)):
        index.append(digests.where(place == batch))
    sizes = digests.groupBy("digest").agg(F.count("*").alias("group_size"))
    groups = materialize(sizes.join(index.table().hint("merge"), "digest"), "digest-groups")
    return hot_lookup(digests, groups, "digest", "group_size").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
