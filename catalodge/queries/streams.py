"""Streaming jobs over the event and order files; their SQL is the one of the batch job they equal."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalodge.queries import merges, registry
from catalodge.queries.merges import CUSTOMER, RECORDS_SQL, fetch_log, full_registry
from catalodge.queries.registry import query, table
from catalodge.session import shared_dir
from catalodge.streaming import jobs
from catalodge.streaming.jobs import DeltaTable

EVENTS = ["ts", "event_id"]


SLICES = 3


def in_slices(spark, sf, name, at, base, run):
    """Feed a table to a stream in time slices: each slice is appended to its folder, then the job runs on what is new."""
    rows = table(spark, sf, name)
    low, high = rows.agg(F.min(at), F.max(at)).first()
    for k in range(SLICES):
        begin, end = (low + (high - low) * (k + d) / SLICES for d in (0, 1))
        kept = (F.col(at) >= F.lit(begin)) & (F.lit(k == SLICES - 1) | (F.col(at) < F.lit(end)))
        # Rows without a time come first, as they do in the order of the batch job.
        kept = kept | F.col(at).isNull() if k == 0 else kept
        rows.filter(kept).write.mode("append").parquet(f"{base}/input")
        run(spark.readStream.schema(rows.schema).parquet(f"{base}/input"))


def run_dir(spark, name):
    return f"{shared_dir(spark, 'streams')}/{name}-{uuid.uuid4().hex}"


def run_changes(spark, sf):
    base = run_dir(spark, "changes")
    state = DeltaTable(f"{base}/state", ("user_id",), "user_id BIGINT, last_hash STRING")

    def run(stream):
        versions = stream.select("user_id", *EVENTS, F.sha2("props", 256).alias("content_hash"))
        jobs.change_stream(
            versions, "user_id", EVENTS, "content_hash", state, f"{base}/out", f"{base}/checkpoint", F.to_date("ts")
        ).awaitTermination()

    in_slices(spark, sf, "events", "ts", base, run)
    out = jobs.read_batches(spark, f"{base}/out", "user_id BIGINT, ts TIMESTAMP_NTZ, event_id BIGINT, content_hash STRING")
    return out.select("event_id", "user_id", "content_hash")


# ``sequences`` registers the batch query whose SQL is used here.
from catalodge.queries import sequences  # noqa: E402, F401


@query("stream_change", registry.ORACLE["hash_change_detection"])
def stream_change(spark, sf):
    return run_changes(spark, sf)


@query("stream_state", registry.ORACLE["state_machine"])
def stream_state(spark, sf):
    base = run_dir(spark, "state")
    initial = full_registry(spark, sf)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in initial.schema)
    state = DeltaTable(f"{base}/state", ("id",), schema)

    def run(stream):
        jobs.outcome_stream(fetch_log(spark, sf, stream), initial, EVENTS, state, f"{base}/checkpoint").awaitTermination()

    in_slices(spark, sf, "events", "ts", base, run)
    latest = state.latest(spark)
    pages = latest.unionByName(initial.join(latest.select("id"), "id", "left_anti"))
    return pages.select(
        "id", "status", F.date_format("last_fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched"),
        F.date_format("last_changed_at", "yyyy-MM-dd HH:mm:ss").alias("changed"), "last_content_hash", "redirect_to",
        "failure_note", "discovery_note",
    ).fillna("-")


@query(
    "stream_upsert",
    f"""WITH {RECORDS_SQL}, t AS (SELECT program_id, seq, o_orderkey, 'tuition' AS field_name, CAST(tuition AS VARCHAR) AS v FROM r WHERE tuition IS NOT NULL
  UNION ALL SELECT program_id, seq, o_orderkey, 'priority', priority FROM r WHERE priority IS NOT NULL),
l AS (SELECT *, lag(v) OVER (PARTITION BY program_id, field_name ORDER BY seq, o_orderkey) AS o FROM t)
SELECT program_id, field_name, o AS old_value, v AS new_value, o_orderkey FROM l WHERE o IS NOT NULL AND o <> v""",
)
def stream_upsert(spark, sf):
    base = run_dir(spark, "upsert")
    state = DeltaTable(f"{base}/state", ("program_id",), "program_id BIGINT, tuition INT, priority STRING, status STRING")

    def run(stream):
        records = merges.records(spark, sf, stream)
        jobs.upsert_stream(
            records, CUSTOMER, merges.ORDER, state, f"{base}/log", f"{base}/checkpoint", merges.month()
        ).awaitTermination()

    in_slices(spark, sf, "orders", "o_orderdate", base, run)
    log = jobs.read_batches(
        spark, f"{base}/log",
        "program_id BIGINT, entity_type STRING, change_type STRING, field_name STRING, old_value STRING, new_value STRING,"
        " seq TIMESTAMP_NTZ, o_orderkey BIGINT",
    )
    return log.select("program_id", "field_name", "old_value", "new_value", "o_orderkey")


@query("replay_equals_stream", f"SELECT count(*) AS n_changes, 0 AS n_different FROM ({registry.ORACLE['hash_change_detection']})")
def replay_equals_stream(spark, sf):
    """Changes found by the stream against those of the batch job on the same data."""
    streamed = run_changes(spark, sf)
    replayed = registry.QUERIES["hash_change_detection"](spark, sf)
    both = streamed.withColumn("side", F.lit(1)).unionByName(replayed.withColumn("side", F.lit(-1)))
    sums = both.groupBy("event_id", "content_hash").agg(F.sum("side").alias("balance"), F.max("side").alias("top"))
    return sums.agg(
        F.count_if(F.col("top") == 1).alias("n_changes"), F.count_if(F.col("balance") != 0).cast("int").alias("n_different")
    )
