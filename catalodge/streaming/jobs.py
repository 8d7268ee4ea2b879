"""The daily run as streams: change detection, page states and upserts, batch by batch.

Each job hands its micro-batches to the same functions the batch jobs use, so a
replay over stored data gives the same result. State lives in a DeltaTable: one
Parquet folder per batch that holds only the keys the batch touched, and a full
copy every ``full_every`` batches. A batch that is run again after a failure
overwrites its own folder and reads only earlier ones, so it has the same effect.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from catalodge.operators import merge, ordered, registry
from catalodge.operators.merge import MergeSpec


@dataclass(frozen=True)
class DeltaTable:
    """Latest row per key, kept as one folder per batch."""

    path: str
    keys: tuple[str, ...]
    schema: str
    full_every: int = 20

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/batch={batch_id}"

    def read(self, spark: SparkSession, before: int) -> DataFrame:
        """State left by all batches before ``before``."""
        if before <= 0:
            return spark.createDataFrame([], self.schema)
        since = ((before - 1) // self.full_every) * self.full_every
        parts = [
            spark.read.schema(self.schema).parquet(self._folder(b)).withColumn("__batch", F.lit(b))
            for b in range(since, before)
        ]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return ordered.last_per_key(rows, list(self.keys), ["__batch"]).drop("__batch")

    def latest(self, spark: SparkSession) -> DataFrame:
        """State left by all batches so far; the folders name them."""
        newest = spark.read.schema(f"{self.schema}, batch INT").parquet(self.path).agg(F.max("batch")).first()[0]
        return self.read(spark, 0 if newest is None else newest + 1)

    def write(self, batch_id: int, touched: DataFrame) -> None:
        """Store the touched rows; every ``full_every`` batches also carry over all untouched ones."""
        rows = touched
        if batch_id and batch_id % self.full_every == 0:
            old = self.read(touched.sparkSession, batch_id).join(touched.select(*self.keys), list(self.keys), "left_anti")
            rows = old.unionByName(touched)
        rows.write.mode("overwrite").parquet(self._folder(batch_id))


def start(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches of an output that was written batch by batch."""
    return spark.read.schema(f"{schema}, batch INT").parquet(path).drop("batch")


# ---- change detection --------------------------------------------------------------------


def change_stream(
    stream: DataFrame,
    page: str,
    order: Sequence[str],
    content_hash: str,
    state: DeltaTable,
    output: str,
    checkpoint: str,
    bucket: Column | None = None,
) -> StreamingQuery:
    """Emit a version only when its hash differs from the last one of its page.

    ``state`` keeps (page, last_hash). Versions of a page must not arrive in an
    earlier batch than older versions of it; inside a batch any order will do.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = state.read(spark, batch_id).join(batch.select(page).distinct(), page, "left_semi")
        marked = registry.changed_versions(batch, page, order, content_hash, known, bucket)
        marked.filter("changed").drop("changed", "previous_hash").write.mode("overwrite").parquet(f"{output}/batch={batch_id}")
        last = ordered.last_per_key(batch.select(page, *order, F.col(content_hash).alias("last_hash")), [page], order)
        state.write(batch_id, last.select(page, "last_hash"))

    return start(stream, handle, checkpoint)


# ---- page states ---------------------------------------------------------------------------


def outcome_stream(
    stream: DataFrame, initial: DataFrame, order: Sequence[str], state: DeltaTable, checkpoint: str
) -> StreamingQuery:
    """Keep the registry up to date with fetch outcomes; untouched pages stay as in ``initial``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        touched = batch.select(F.col("page_id").alias("id")).distinct()
        seen = state.read(spark, batch_id).join(touched, "id", "left_semi")
        first_time = initial.join(touched, "id", "left_semi").join(seen.select("id"), "id", "left_anti")
        pages = seen.unionByName(first_time.select(*seen.columns))
        state.write(batch_id, registry.apply_outcomes(pages, batch, order))

    return start(stream, handle, checkpoint)


# ---- upserts --------------------------------------------------------------------------------


def upsert_stream(
    stream: DataFrame,
    spec: MergeSpec,
    order: Sequence[str],
    state: DeltaTable,
    log_path: str,
    checkpoint: str,
    bucket: Column | None = None,
) -> StreamingQuery:
    """Merge extracted records into an entity table and append to its change log."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        stored = state.read(batch.sparkSession, batch_id).join(
            batch.select(*spec.keys).distinct(), list(spec.keys), "left_semi"
        )
        result = merge.merge_records(stored, batch, spec, order, bucket)
        result.log.write.mode("overwrite").parquet(f"{log_path}/batch={batch_id}")
        state.write(batch_id, result.table)

    return start(stream, handle, checkpoint)
