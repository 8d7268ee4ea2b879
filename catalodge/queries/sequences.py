"""Ordered-sequence operators bound to events (page = user, ordered by time) and document lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalodge.functions.text import split_lines
from catalodge.operators import ordered, registry
from catalodge.queries.registry import query, table

ORDER = ["ts", "event_id"]
SQL_ORDER = "PARTITION BY user_id ORDER BY ts, event_id"


def day():
    """Bucket of an event: days never decrease along the order of a user."""
    return F.to_date("ts")


def stamp(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def sql_stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


@query(
    "latest_snapshot",
    f"""SELECT user_id AS page_id, event_id AS snapshot_id, sha256(props) AS content_hash FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_snapshot(spark, sf):
    events = table(spark, sf, "events").select("user_id", *ORDER, "props")
    latest = registry.latest_snapshots(events, "user_id", ORDER)
    return latest.select(
        F.col("user_id").alias("page_id"), F.col("event_id").alias("snapshot_id"), F.sha2("props", 256).alias("content_hash")
    )


@query(
    "latest_detail",
    """SELECT o_custkey AS program_id, o_orderkey AS detail_id, o_totalprice AS tuition FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def latest_detail(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return ordered.last_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        F.col("o_custkey").alias("program_id"), F.col("o_orderkey").alias("detail_id"), F.col("o_totalprice").alias("tuition")
    )


@query(
    "newest_valid",
    """SELECT p_name || '/' || p_brand AS code, p_partkey AS row_id, p_size AS valid_from FROM part
QUALIFY row_number() OVER (PARTITION BY p_name || '/' || p_brand ORDER BY p_size DESC, p_partkey) = 1""",
)
def newest_valid(spark, sf):
    rows = table(spark, sf, "part").select(
        F.concat_ws("/", "p_name", "p_brand").alias("code"), F.col("p_partkey").alias("row_id"),
        F.col("p_size").alias("valid_from"), (-F.col("p_size")).alias("newest"),
    )
    return ordered.first_per_key(rows, ["code"], ["newest", "row_id"]).select("code", "row_id", "valid_from")


@query(
    "forward_fill",
    f"""SELECT event_id, user_id, coalesce(last_value(CASE WHEN event_type = 'purchase' THEN props END IGNORE NULLS)
  OVER ({SQL_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '-') AS year_label FROM events""",
)
def forward_fill(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("props")).alias("label")
    )
    filled = ordered.last_known(events, ["user_id"], ORDER, {"label": "year_label"}, day())
    return filled.select("event_id", "user_id", F.coalesce("year_label", F.lit("-")).alias("year_label"))


@query(
    "line_pairs",
    """WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
x AS (SELECT doc_id, i, ls[i] AS label, ls[i + 1] AS value FROM d, unnest(generate_series(1, len(ls) - 1)) AS g(i))
SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, label, value FROM x WHERE length(label) BETWEEN 1 AND 60""",
)
def line_pairs(spark, sf):
    from catalodge.operators.lines import label_value_pairs

    pairs = label_value_pairs(split_lines(F.col("text")), lambda label: F.char_length(label).between(1, 60))
    return table(spark, sf, "documents").select("doc_id", F.inline(pairs)).select("doc_id", "line_no", "label", "value")


@query(
    "gap_intervals",
    f"""SELECT user_id, {sql_stamp('ts')} AS gap_start, {sql_stamp('nxt')} AS gap_end FROM (
  SELECT user_id, ts, lead(ts) OVER ({SQL_ORDER}) AS nxt FROM events WHERE event_type = 'view') WHERE nxt IS NOT NULL""",
)
def gap_intervals(spark, sf):
    blocks = table(spark, sf, "events").filter("event_type = 'view'").select("user_id", *ORDER)
    out = ordered.gaps(blocks, ["user_id"], "ts", "ts", ORDER, day())
    return out.select("user_id", stamp("gap_start").alias("gap_start"), stamp("gap_end").alias("gap_end"))


@query(
    "round_numbers",
    f"SELECT event_id, user_id, row_number() OVER ({SQL_ORDER}) AS round_no FROM events WHERE event_type = 'purchase'",
)
def round_numbers(spark, sf):
    rounds = table(spark, sf, "events").filter("event_type = 'purchase'").select("user_id", *ORDER)
    return ordered.number_rows(rounds, ["user_id"], ORDER, "round_no", day()).select("event_id", "user_id", "round_no")


@query(
    "pair_start_end",
    f"""WITH f AS (SELECT user_id, ts, event_id, CAST(event_type = 'view' AS INTEGER) AS s, CAST(event_type = 'purchase' AS INTEGER) AS e
  FROM events WHERE event_type IN ('view', 'purchase')),
g AS (SELECT *, sum(s) OVER w AS ns, sum(e) OVER w AS ne, sum(e - s) OVER w AS depth FROM f WINDOW w AS ({SQL_ORDER})),
h AS (SELECT *, greatest(coalesce(max(depth) OVER ({SQL_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS lost_before FROM g),
k AS (SELECT *, e = 1 AND depth > lost_before AS is_lost FROM h),
st AS (SELECT user_id, ns AS r, ts FROM k WHERE s = 1), en AS (SELECT user_id, ne - lost_before AS r, ts FROM k WHERE e = 1 AND NOT is_lost)
SELECT st.user_id, CASE WHEN en.ts IS NULL THEN 'open' ELSE 'pair' END AS kind, {sql_stamp('st.ts')} AS start_at, coalesce({sql_stamp('en.ts')}, '-') AS end_at
FROM st LEFT JOIN en ON st.user_id = en.user_id AND st.r = en.r
UNION ALL SELECT user_id, 'point', {sql_stamp('ts')}, '-' FROM k WHERE is_lost""",
)
def pair_start_end(spark, sf):
    events = table(spark, sf, "events").select("user_id", *ORDER, "event_type")
    out = ordered.pair_points(
        events, ["user_id"], ORDER, F.col("event_type") == "view", F.col("event_type") == "purchase", "ts", day()
    )
    return out.select(
        "user_id", "kind", stamp("start").alias("start_at"), F.coalesce(stamp("end"), F.lit("-")).alias("end_at")
    )


@query(
    "merge_begin_end",
    """WITH x AS (SELECT user_id, CAST(ts AS DATE) AS y, event_id AS pos, ts, event_type = 'error' AS is_end FROM events WHERE event_type IN ('signup', 'error')),
b AS (SELECT user_id, y, max(pos) FILTER (NOT is_end) AS bp, max(pos) FILTER (is_end) AS ep, max_by(ts, pos) FILTER (NOT is_end) AS bt,
  max_by(ts, pos) FILTER (is_end) AS et FROM x GROUP BY 1, 2)
SELECT user_id, strftime(y, '%Y-%m-%d') AS track, strftime(bt, '%H:%M:%S') AS starts,
 strftime(CASE WHEN ep > bp THEN greatest(bt, et) ELSE bt END, '%H:%M:%S') AS ends FROM b WHERE bp IS NOT NULL""",
)
def merge_begin_end(spark, sf):
    rows = table(spark, sf, "events").filter(F.col("event_type").isin("signup", "error")).select(
        "user_id", stamp("ts").substr(1, 10).alias("track"), "event_id", "ts", "event_type"
    )
    merged = ordered.merge_begin_end(rows, ["user_id", "track"], "event_id", "ts", F.col("event_type") == "error")
    return merged.select(
        "user_id", "track", F.date_format("start_date", "HH:mm:ss").alias("starts"), F.date_format("end_date", "HH:mm:ss").alias("ends")
    )


@query(
    "disambiguate",
    """SELECT event_id, user_id, CASE WHEN row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) > 1
  THEN event_type || ' (' || strftime(ts, '%b') || ')' ELSE event_type END AS name FROM events""",
)
def disambiguate(spark, sf):
    events = table(spark, sf, "events").select("user_id", *ORDER, F.col("event_type").alias("name"))
    out = ordered.disambiguate(events, ["user_id"], "name", ORDER, F.date_format("ts", "MMM"), day())
    return out.select("event_id", "user_id", "name")


@query(
    "first_seen_dedupe",
    """SELECT doc_id, lang, source, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1""",
)
def first_seen_dedupe(spark, sf):
    # Only the digest and a few small columns are shuffled, never the texts.
    docs = table(spark, sf, "documents").select(F.sha2("text", 256).alias("digest"), "doc_id", "lang", "source", "n_chars")
    return ordered.first_per_key(docs, ["digest"], ["doc_id"]).drop("digest")


@query(
    "hash_change_detection",
    f"""WITH v AS (SELECT event_id, user_id, sha256(props) AS h, lag(sha256(props)) OVER ({SQL_ORDER}) AS p FROM events)
SELECT event_id, user_id, h AS content_hash FROM v WHERE p IS NULL OR p <> h""",
)
def hash_change_detection(spark, sf):
    versions = table(spark, sf, "events").select("user_id", *ORDER, F.sha2("props", 256).alias("content_hash"))
    marked = registry.changed_versions(versions, "user_id", ORDER, "content_hash", bucket=day())
    return marked.filter("changed").select("event_id", "user_id", "content_hash")
