"""Upserts, change logs and state machines bound to orders, lineitem and events."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalodge.functions import translate, urls
from catalodge.operators import merge, ordered, registry
from catalodge.operators.merge import MergeSpec, Unit
from catalodge.operators.sharded import ShardedTable
from catalodge.plans import entities, views
from catalodge.queries.registry import ORACLE, query, table
from catalodge.queries.relational import PAGES_SQL, mapped, registry_pages, sql_map
from catalodge.session import materialize, shared_dir

CUT = "TIMESTAMP '1998-01-01'"
ORDER = ["seq", "o_orderkey"]
TYPES = {"view": "ok", "click": "ok", "signup": "moved", "purchase": "dead", "error": "error"}

CUSTOMER = MergeSpec.simple("program_detail", ("program_id",), ("tuition", "priority", "status"), tracked=("tuition", "priority"))


def records(spark, sf, source=None):
    """Orders as records about their customer; a low priority brings no value, a pending one no price."""
    orders = table(spark, sf, "orders") if source is None else source
    return orders.select(
        F.col("o_custkey").alias("program_id"),
        F.col("o_orderdate").alias("seq"),
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 100000).cast("int")).alias("tuition"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderstatus").alias("status"),
    )


def stored_and_batch(spark, sf):
    """Stored state: the latest record before 1998 of each customer; batch: everything from 1998 on."""
    rows = records(spark, sf)
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    stored = ordered.last_per_key(rows.filter(F.col("seq") < cut), ["program_id"], ORDER).drop(*ORDER)
    return stored, rows.filter(F.col("seq") >= cut)


def month():
    return F.trunc("seq", "month")


RECORDS_SQL = """r AS (SELECT o_custkey AS program_id, o_orderdate AS seq, o_orderkey,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 100000) AS INTEGER) END AS tuition,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority, o_orderstatus AS status FROM orders),
s AS (SELECT * FROM r WHERE seq < TIMESTAMP '1998-01-01' QUALIFY row_number() OVER (PARTITION BY program_id ORDER BY seq DESC, o_orderkey DESC) = 1),
b AS (SELECT * FROM r WHERE seq >= TIMESTAMP '1998-01-01')"""


@query(
    "diff_upsert",
    f"""WITH {RECORDS_SQL}, n AS (SELECT program_id, max_by(tuition, (seq, o_orderkey)) FILTER (tuition IS NOT NULL) AS tuition,
  max_by(priority, (seq, o_orderkey)) FILTER (priority IS NOT NULL) AS priority, max_by(status, (seq, o_orderkey)) AS status FROM b GROUP BY 1)
SELECT coalesce(s.program_id, n.program_id) AS program_id, coalesce(n.tuition, s.tuition, -1) AS tuition,
  coalesce(n.priority, s.priority, '-') AS priority, coalesce(n.status, s.status) AS status
FROM s FULL JOIN n ON s.program_id = n.program_id""",
)
def diff_upsert(spark, sf):
    stored, batch = stored_and_batch(spark, sf)
    out = merge.merge_records(stored, batch, CUSTOMER, ORDER, month()).table
    return out.fillna(-1, subset=["tuition"]).fillna("-", subset=["priority"])


def sharded(spark, name, keys, schema):
    """A new sharded table in the shared folder."""
    return ShardedTable(spark, f"{shared_dir(spark, 'sharded')}/{name}-{uuid.uuid4().hex}", keys, schema, shards=16)


@query("sharded_upsert", ORACLE["diff_upsert"])
def sharded_upsert(spark, sf):
    stored, batch = stored_and_batch(spark, sf)
    target = sharded(spark, "customers", CUSTOMER.keys, "program_id bigint, tuition int, priority string, status string")
    target.replace(stored)
    target.merge(batch, CUSTOMER, ORDER, month())
    out = materialize(target.read(), "sharded-upsert")
    target.close()
    return out.fillna(-1, subset=["tuition"]).fillna("-", subset=["priority"])


@query(
    "change_log",
    f"""WITH {RECORDS_SQL}, a AS (SELECT * FROM s UNION ALL SELECT * FROM b),
t AS (SELECT program_id, seq, o_orderkey, 'tuition' AS field_name, CAST(tuition AS VARCHAR) AS v FROM a WHERE tuition IS NOT NULL
  UNION ALL SELECT program_id, seq, o_orderkey, 'priority', priority FROM a WHERE priority IS NOT NULL),
l AS (SELECT *, lag(v) OVER (PARTITION BY program_id, field_name ORDER BY seq, o_orderkey) AS o FROM t)
SELECT program_id, 'program_detail' AS entity_type, 'update' AS change_type, field_name, o AS old_value, v AS new_value,
  strftime(seq, '%Y-%m-%d') AS seq, o_orderkey FROM l WHERE o IS NOT NULL AND o <> v""",
)
def change_log(spark, sf):
    stored, batch = stored_and_batch(spark, sf)
    log = merge.merge_records(stored, batch, CUSTOMER, ORDER, month()).log
    return log.withColumn("seq", F.date_format("seq", "yyyy-MM-dd"))


@query(
    "batch_fold",
    """WITH r AS (SELECT o_custkey AS program_id, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS v, o_orderdate, o_orderkey FROM orders),
l AS (SELECT program_id, v, lag(v) OVER (PARTITION BY program_id ORDER BY o_orderdate, o_orderkey) AS p FROM r WHERE v IS NOT NULL),
f AS (SELECT program_id, max_by(v, (o_orderdate, o_orderkey)) FILTER (v IS NOT NULL) AS priority FROM r GROUP BY 1),
c AS (SELECT program_id, count(*) FILTER (p <> v) AS n_changes FROM l GROUP BY 1)
SELECT f.program_id, coalesce(priority, '-') AS priority, coalesce(n_changes, 0) AS n_changes FROM f LEFT JOIN c USING (program_id)""",
)
def batch_fold(spark, sf):
    spec = MergeSpec.simple("program", ("program_id",), ("priority",))
    _, summary = merge.fold_batch(records(spark, sf), spec, ORDER, month())
    return summary.select(
        "program_id", F.coalesce(F.col("__l_priority.priority"), F.lit("-")).alias("priority"),
        F.col("__n_priority").alias("n_changes"),
    )


@query(
    "deadline_upsert",
    """WITH x AS (SELECT c_nationkey AS nk, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS rnd, o_orderstatus AS typ,
   o_orderdate AS seq, o_orderkey AS k FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT nk AS university_id, typ AS deadline_type, coalesce(rnd, 'none') AS round_no, strftime(max_by(seq, (seq, k)), '%Y-%m-%d') AS deadline_at,
 max_by(n, (seq, k)) AS note FROM (
  SELECT *, min(k) OVER (PARTITION BY nk, typ, rnd, seq) AS first_k, 'order ' || min(k) OVER (PARTITION BY nk, typ, rnd, seq) AS n FROM x) GROUP BY 1, 2, 3""",
)
def deadline_upsert(spark, sf):
    # A deadline changes when its date does; the note comes along only then. Missing round numbers match each other.
    spec = MergeSpec(
        "deadline", ("university_id", "deadline_type", "round_no"),
        (Unit("deadline_at", ("deadline_at", "note"), tracked=True),), log_insert=True, null_safe=True,
    )
    rows = table(spark, sf, "orders").join(
        table(spark, sf, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    ).select(
        F.col("c_nationkey").alias("university_id"), F.col("o_orderstatus").alias("deadline_type"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("round_no"),
        F.col("o_orderdate").alias("deadline_at"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("note"),
        F.col("o_orderdate").alias("seq"), "o_orderkey",
    )
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    keys = ["university_id", "deadline_type", "round_no"]
    empty = rows.filter(F.lit(False)).select(*keys, "deadline_at", "note")
    stored = merge.merge_records(empty, rows.filter(F.col("seq") < cut), spec, ORDER, month()).table
    out = merge.merge_records(stored, rows.filter(F.col("seq") >= cut), spec, ORDER, month()).table
    return out.withColumn("deadline_at", F.date_format("deadline_at", "yyyy-MM-dd")).fillna("none", subset=["round_no"])


@query(
    "calendar_upsert",
    """WITH x AS (SELECT o_custkey AS u, o_orderpriority AS name, o_orderdate AS d, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 10 DAY END AS e, o_orderkey AS k FROM orders),
t AS (SELECT *, strftime(d, '%Y-%m-%d') || '~' || coalesce(strftime(e, '%Y-%m-%d'), 'None') AS v FROM x),
l AS (SELECT *, lag(v) OVER (PARTITION BY u, name ORDER BY d, k) AS o FROM t)
SELECT u AS university_id, name, o AS old_value, v AS new_value, k AS o_orderkey FROM l WHERE o IS NOT NULL AND o <> v""",
)
def calendar_upsert(spark, sf):
    spec = MergeSpec(
        "calendar_event", ("university_id", "name"),
        (Unit("dates", ("start_date", "end_date"), tracked=True,
              compare="concat(cast(start_date as string), '~', coalesce(cast(end_date as string), 'None'))"),),
    )
    start = F.col("o_orderdate").cast("date")
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("university_id"), F.col("o_orderpriority").alias("name"), start.alias("start_date"),
        F.when(F.col("o_orderstatus") != "O", F.date_add(start, 10)).alias("end_date"), F.col("o_orderdate").alias("seq"), "o_orderkey",
    )
    empty = rows.filter(F.lit(False)).select("university_id", "name", "start_date", "end_date")
    log = merge.merge_records(empty, rows, spec, ORDER, month()).log
    return log.select("university_id", "name", "old_value", "new_value", "o_orderkey")


@query(
    "program_upsert",
    """WITH r AS (SELECT c_nationkey AS university_id, o_orderstatus AS level, 'P ' || o_orderpriority || ' ' || c_mktsegment AS name_en, o_orderdate AS seq, o_orderkey AS k,
   CASE WHEN o_totalprice > 250000 THEN o_totalprice END AS v FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT university_id, level, name_en, min(k) FILTER (first) AS first_record, count(*) AS n_records FROM (
  SELECT *, row_number() OVER (PARTITION BY university_id, level, name_en ORDER BY seq, k) = 1 AS first FROM r) GROUP BY 1, 2, 3""",
)
def program_upsert(spark, sf):
    rows = table(spark, sf, "orders").join(
        table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")
    )
    name = F.concat_ws(" ", F.lit("P"), "o_orderpriority", "c_mktsegment")
    shaped = rows.select(
        F.col("c_nationkey").alias("university_id"), F.col("o_orderstatus").alias("level"), name.alias("name_en"),
        F.concat_ws("/", F.lit("https://x"), F.col("c_nationkey").cast("string"), "o_orderstatus", F.replace(name, F.lit(" "), F.lit("-"))).alias("url"),
        F.lit(None).cast("string").alias("faculty"), F.lit(None).cast("string").alias("ucas_code"),
        F.lit(None).cast("string").alias("duration"), F.lit(False).alias("backfill_only"), F.col("o_orderdate").alias("seq"), "o_orderkey",
    )
    stored = shaped.filter(F.lit(False)).select(
        F.lit("").alias("entity_key"), "university_id", "level", "name_en", "faculty", "url",
        F.lit("").alias("slug"), "ucas_code", "duration",
    )
    result, identified = entities.upsert_programs(stored, shaped, ORDER, month())
    first = result.log.filter("change_type = 'insert'").select("entity_key", F.col("o_orderkey").alias("first_record"))
    counts = identified.groupBy("entity_key").agg(F.count(F.lit(1)).alias("n_records"))
    return result.table.select("entity_key", "university_id", "level", "name_en").join(first, "entity_key").join(
        counts, "entity_key"
    ).drop("entity_key")


@query(
    "module_upsert",
    """WITH r AS (SELECT s_nationkey AS university_id, CAST(year(l_shipdate) AS VARCHAR) AS entry_year, p_name AS name_en,
  CASE WHEN p_type <> 'PROMO' THEN p_brand || p_name END AS code, CAST(l_quantity AS INTEGER) AS credits,
  (l_shipdate, l_orderkey, l_partkey, l_linenumber, l_extendedprice) AS o
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
f AS (SELECT university_id, entry_year, code, min(o) AS since, min_by(name_en, o) AS nm FROM r WHERE code IS NOT NULL GROUP BY 1, 2, 3),
g AS (SELECT university_id, entry_year, nm, min(since) AS since, min_by(code, since) AS first_code FROM f GROUP BY 1, 2, 3),
k AS (SELECT r.*, coalesce(r.code, CASE WHEN g.since < r.o THEN g.first_code END) AS found
  FROM r LEFT JOIN g ON g.university_id = r.university_id AND g.entry_year = r.entry_year AND g.nm = r.name_en)
SELECT university_id, entry_year, coalesce(found, '-') AS code, CASE WHEN found IS NULL THEN name_en ELSE '-' END AS name_en,
  count(*) AS n_records, max_by(credits, o) AS credits
FROM k GROUP BY 1, 2, 3, 4""",
)
def module_upsert(spark, sf):
    rows = table(spark, sf, "lineitem").join(
        table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey")
    ).join(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    none = F.lit(None).cast("string")
    shaped = rows.select(
        F.col("s_nationkey").alias("university_id"), F.year("l_shipdate").cast("string").alias("entry_year"),
        F.when(F.col("p_type") != "PROMO", F.concat("p_brand", "p_name")).alias("code"), F.col("p_name").alias("name_en"),
        F.col("l_quantity").cast("int").alias("credits"),
        *[none.alias(c) for c in ("faculty", "level", "semester", "leader", "prerequisites", "assessment", "description", "url", "fetched_at")],
        F.lit(None).cast("long").alias("source_page_id"),
        F.col("l_shipdate").alias("seq"), "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice",
    )
    order = ["seq", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice"]
    columns = ["university_id", "entry_year", "code", "name_en", "credits", "faculty", "level", "semester", "leader",
               "prerequisites", "assessment", "description", "url", "fetched_at", "source_page_id"]
    stored = shaped.filter(F.lit(False)).select(F.lit("").alias("entity_key"), *columns)
    result, resolved = entities.upsert_modules(stored, shaped, order, month())
    counts = resolved.groupBy("entity_key").agg(F.count(F.lit(1)).alias("n_records"))
    return result.table.join(counts, "entity_key").select(
        "university_id", "entry_year", F.coalesce("code", F.lit("-")).alias("code"),
        F.when(F.col("code").isNull(), F.col("name_en")).otherwise("-").alias("name_en"), "n_records", "credits",
    )


@query(
    "faculty_get_or_create",
    """WITH m AS (SELECT s_nationkey AS university_id, p_brand AS name_en, min(l_orderkey) AS first_seen FROM lineitem JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
SELECT * FROM m WHERE (university_id, name_en) NOT IN (SELECT DISTINCT c_nationkey, 'Brand#' || length(c_mktsegment) FROM customer)""",
)
def faculty_get_or_create(spark, sf):
    mentions = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey").join(
        table(spark, sf, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")
    ).join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_nationkey").alias("university_id"), F.col("p_brand").alias("name_en"), F.col("l_orderkey").alias("first_seen")
    )
    stored = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("university_id"), F.concat(F.lit("Brand#"), F.char_length("c_mktsegment").cast("string")).alias("name_en")
    ).distinct()
    return entities.new_faculties(stored, mentions, ["first_seen"])


@query(
    "replace_set",
    """WITH o AS (SELECT l_orderkey AS program_id, l_partkey AS module_id, l_linenumber AS year_of_study, l_returnflag AS module_type, l_shipdate AS d FROM lineitem),
inc AS (SELECT * FROM o WHERE d >= TIMESTAMP '1998-01-01'), old AS (SELECT * FROM o WHERE d < TIMESTAMP '1998-01-01')
SELECT program_id, module_id, year_of_study, module_type FROM old WHERE program_id NOT IN (SELECT program_id FROM inc)
UNION ALL SELECT program_id, module_id, year_of_study, module_type FROM inc
 QUALIFY row_number() OVER (PARTITION BY program_id, module_id ORDER BY year_of_study, module_type) = 1""",
)
def replace_set(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("program_id"), F.col("l_partkey").alias("module_id"),
        F.col("l_linenumber").alias("year_of_study"), F.col("l_returnflag").alias("module_type"), "l_shipdate",
    )
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    stored = rows.filter(F.col("l_shipdate") < cut).drop("l_shipdate")
    incoming = rows.filter(F.col("l_shipdate") >= cut).drop("l_shipdate")
    return merge.replace_sets(stored, incoming, ["program_id"], ["module_id"], ["year_of_study", "module_type"])


@query("sharded_replace_set", ORACLE["replace_set"])
def sharded_replace_set(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("program_id"), F.col("l_partkey").alias("module_id"),
        F.col("l_linenumber").alias("year_of_study"), F.col("l_returnflag").alias("module_type"), "l_shipdate",
    )
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    target = sharded(spark, "members", ["program_id"], "program_id bigint, module_id bigint, year_of_study int, module_type string")
    target.replace(rows.filter(F.col("l_shipdate") < cut).drop("l_shipdate"))
    target.replace_sets(rows.filter(F.col("l_shipdate") >= cut).drop("l_shipdate"), ["module_id"], ["year_of_study", "module_type"])
    out = materialize(target.read(), "sharded-members")
    target.close()
    return out


def fetch_log(spark, sf, source=None):
    kind = mapped(F.col("event_type"), TYPES)
    events = table(spark, sf, "events") if source is None else source
    log = events.select(
        F.col("user_id").alias("page_id"), "ts", "event_id", kind.alias("kind"),
        F.sha2("props", 256).alias("content_hash"), F.concat(F.lit("https://moved/"), F.col("event_id").cast("string")).alias("final_url"),
        F.when(kind == "error", F.concat(F.lit("timeout "), F.col("event_id").cast("string"))).alias("note"),
    )
    return log.withColumn("changed", F.col("kind") == "ok")


def full_registry(spark, sf):
    return registry_pages(spark, sf).select(
        "id", "university_id", "category", F.lit("active").alias("status"), F.lit("monthly").alias("crawl_freq"),
        F.concat(F.lit("Page "), F.col("id").cast("string")).alias("title"),
        F.lit(None).cast("timestamp_ntz").alias("last_fetched_at"), F.lit(None).cast("timestamp_ntz").alias("last_changed_at"),
        F.lit(None).cast("string").alias("last_content_hash"), F.lit(None).cast("string").alias("redirect_to"),
        F.lit("timeout old").alias("failure_note"), F.when(F.col("category") == "news", "timeout 1").otherwise("Faculty of X").alias("discovery_note"),
    )


@query(
    "state_machine",
    f"""WITH e AS (SELECT user_id, ts, event_id, {sql_map('event_type', TYPES)} AS kind, sha256(props) AS h FROM events),
f AS (SELECT user_id, max(ts) FILTER (kind <> 'error') AS fetched, max(ts) FILTER (kind = 'ok') AS changed,
  max_by(h, (ts, event_id)) FILTER (kind = 'ok') AS h, max_by(kind, (ts, event_id)) FILTER (kind IN ('dead', 'moved')) AS st,
  max_by(event_id, (ts, event_id)) FILTER (kind = 'moved') AS mv, max_by(kind, (ts, event_id)) FILTER (kind <> 'moved') AS lk,
  max_by(event_id, (ts, event_id)) FILTER (kind <> 'moved') AS le, bool_or(kind = 'ok') AS any_ok FROM e GROUP BY 1)
SELECT c_custkey AS id, coalesce(st, 'active') AS status, coalesce(strftime(fetched, '%Y-%m-%d %H:%M:%S'), '-') AS fetched,
 coalesce(strftime(changed, '%Y-%m-%d %H:%M:%S'), '-') AS changed, coalesce(h, '-') AS last_content_hash,
 coalesce('https://moved/' || mv, '-') AS redirect_to,
 coalesce(CASE WHEN lk IS NULL THEN 'timeout old' WHEN lk = 'dead' THEN '404' WHEN lk = 'ok' THEN NULL ELSE 'timeout ' || le END, '-') AS failure_note,
 coalesce(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN CASE WHEN any_ok THEN NULL ELSE 'timeout 1' END ELSE 'Faculty of X' END, '-') AS discovery_note
FROM customer LEFT JOIN f ON f.user_id = c_custkey""",
)
def state_machine(spark, sf):
    out = registry.apply_outcomes(full_registry(spark, sf), fetch_log(spark, sf), ["ts", "event_id"])
    return out.select(
        "id", "status", F.date_format("last_fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched"),
        F.date_format("last_changed_at", "yyyy-MM-dd HH:mm:ss").alias("changed"), "last_content_hash", "redirect_to",
        "failure_note", "discovery_note",
    ).fillna("-")


@query(
    "moved_pages",
    f"""SELECT university_id, category, 'https://moved/' || event_id AS url, 'Page ' || id AS title, 'monthly' AS crawl_freq
FROM events JOIN ({PAGES_SQL}) p ON user_id = id WHERE event_type = 'signup'""",
)
def moved_pages(spark, sf):
    registered = full_registry(spark, sf).withColumn("url", F.concat(F.lit("https://page/"), F.col("id").cast("string")))
    moved = registry.moved_pages(fetch_log(spark, sf), registered, ["ts", "event_id"])
    return moved.select("university_id", "category", "url", "title", "crawl_freq")


@query(
    "replay_join",
    f"""SELECT p.id, category, event_id AS snapshot_id, props AS content_path FROM ({PAGES_SQL}) p
JOIN (SELECT user_id, event_id, CASE WHEN event_type <> 'error' THEN props END AS props FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) e ON user_id = p.id WHERE props IS NOT NULL""",
)
def replay_join(spark, sf):
    snapshots = table(spark, sf, "events").select(
        F.col("user_id").alias("id"), "ts", "event_id", F.when(F.col("event_type") != "error", F.col("props")).alias("content_path")
    )
    tasks = registry_pages(spark, sf).select("id", "category")
    return registry.replay_tasks(tasks, snapshots, "id", ["ts", "event_id"]).select(
        "id", "category", F.col("event_id").alias("snapshot_id"), "content_path"
    )


@query(
    "parsed_flag",
    """SELECT e.event_id AS snapshot_id, CASE WHEN p.page_id IS NOT NULL THEN TRUE WHEN event_type = 'error' THEN FALSE ELSE FALSE END AS parsed_ok
FROM events e LEFT JOIN pages p ON p.page_id = e.event_id""",
)
def parsed_flag(spark, sf):
    snapshots = table(spark, sf, "events").select(F.col("event_id").alias("snapshot_id"), F.lit(False).alias("parsed_ok"))
    return views.mark_parsed(snapshots, table(spark, sf, "pages").select(F.col("page_id").alias("snapshot_id")))


@query(
    "plan_upsert",
    """WITH r AS (SELECT l_orderkey AS program_id, l_linestatus AS variant_label, l_shipdate AS seq, l_partkey, l_linenumber, l_extendedprice, l_suppkey FROM lineitem)
SELECT program_id, variant_label, max_by(CAST(l_partkey AS VARCHAR), (seq, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS plan FROM r GROUP BY 1, 2""",
)
def plan_upsert(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("program_id"), F.col("l_linestatus").alias("variant_label"), F.lit("2026").alias("entry_year"),
        F.col("l_partkey").cast("string").alias("plan"), F.lit("u").alias("source_url"), F.lit(None).cast("string").alias("variant_label_zh"),
        F.col("l_shipdate").alias("seq"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
    )
    stored = rows.filter(F.lit(False)).select("program_id", "variant_label", "entry_year", "plan", "source_url", "variant_label_zh")
    order = ["seq", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return entities.upsert_plans(stored, rows, order, month()).table.select("program_id", "variant_label", "plan")


@query(
    "known_translation",
    """WITH r AS (SELECT p_partkey AS id, p_name AS en, CASE WHEN p_type = 'PROMO' AND p_size > 25 THEN '译 ' || p_name END AS zh FROM part),
k AS (SELECT en, min(zh) AS k FROM r WHERE zh IS NOT NULL GROUP BY 1)
SELECT id, coalesce(zh, k, CASE WHEN en LIKE '%ring' THEN regexp_replace(en, 'ring', '环') END, '-') AS name_zh FROM r LEFT JOIN k USING (en)""",
)
def known_translation(spark, sf):
    rows = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("en"),
        F.when((F.col("p_type") == "PROMO") & (F.col("p_size") > 25), F.concat(F.lit("译 "), "p_name")).alias("zh"),
    )
    dictionary = F.when(F.col("en").endswith("ring"), translate.replace_phrases(F.col("en"), [("ring", "环")]))
    out = entities.translation_backfill(rows, "en", "zh", dictionary)
    return out.select("id", F.coalesce("zh", F.lit("-")).alias("name_zh"))


@query(
    "module_page_registry",
    """SELECT DISTINCT s_nationkey AS university_id, 'https://mods/' || l_partkey AS url, p_brand || ' ' || p_name AS title
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey WHERE p_retailprice <= 950 OR p_size > 10""",
)
def module_page_registry(spark, sf):
    references = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct().join(
        table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")
    ).join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("s_nationkey").alias("university_id"), F.col("p_brand").alias("code"), F.col("p_name").alias("name"),
        F.concat(F.lit("https://mods/"), F.col("l_partkey").cast("string")).alias("url"), "p_retailprice", "p_size",
    )
    registered = references.filter("p_retailprice > 950 and p_size <= 10").select("university_id", "url").distinct()
    found = entities.module_pages(references, F.lit(False))
    return registry.new_pages(registered, found, ["title"]).select("university_id", "url", "title")


@query(
    "new_pages_except",
    """WITH l AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS root, unnest(regexp_extract_all(html, '<a href="(/[^"#]*)">', 1)) AS h FROM pages),
d AS (SELECT root || h AS url, min(page_id) AS first_page FROM l GROUP BY 1)
SELECT url, first_page FROM d WHERE url NOT IN (SELECT regexp_replace(url, '#.*$', '') FROM pages)""",
)
def new_pages_except(spark, sf):
    from catalodge.sources.html import page_links

    pages = table(spark, sf, "pages")
    registered = pages.select(F.lit(1).alias("university_id"), urls.without_fragment(F.col("url")).alias("url")).distinct()
    found = page_links(pages, "page_id").filter(F.col("href").startswith("/")).select(
        F.lit(1).alias("university_id"), F.col("link_url").alias("url"), F.col("link_text").alias("title"), "page_id", "pos"
    )
    return registry.new_pages(registered, found, ["page_id", "pos"]).select("url", F.col("page_id").alias("first_page"))
