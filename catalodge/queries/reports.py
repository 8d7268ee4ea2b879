"""Aggregates, scorecards, ordered reports and exports bound to the bench tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalodge.functions import labels, urls
from catalodge.functions.rules import assessment_class
from catalodge.operators import ordered, quality, registry, rollup
from catalodge.plans import views
from catalodge.queries.registry import query, table
from catalodge.queries.relational import PAGES_SQL, mapped, registry_pages, school_programs, sql_map
from catalodge.sinks import export
from catalodge.sources import config

OUTCOME = {"view": "ok", "click": "ok", "signup": "moved", "purchase": "dead", "error": "error"}

def n_rows():
    return F.count(F.lit(1))



def schools(spark, sf):
    """Nations as schools, regions as countries."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("university_id"), F.col("n_name").alias("code"), F.col("r_name").alias("country")
    )


# ---- coverage and scorecard ------------------------------------------------------------


@query(
    "coverage_pct",
    """SELECT c_nationkey AS university_id, count(*) AS n_rows,
  CAST(round(100.0 * count(CASE WHEN o_orderpriority <> '5-LOW' THEN 1 END) / count(*)) AS INTEGER) AS url_pct,
  CAST(round(100.0 * count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) / count(*)) AS INTEGER) AS faculty_id_pct
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def coverage_pct(spark, sf):
    rows = school_programs(spark, sf).select(
        F.col("c_nationkey").alias("university_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", 1).alias("url"),
        F.when(F.col("o_orderstatus") != "P", 1).alias("faculty_id"),
    )
    return quality.coverage(rows, ["university_id"], ["url", "faculty_id"])


@query(
    "duplicate_keys",
    """SELECT p_brand AS school, p_type AS entry_year, p_name AS code, count(*) AS n FROM part
GROUP BY 1, 2, 3 HAVING count(*) > 1""",
)
def duplicate_keys(spark, sf):
    rows = table(spark, sf, "part").select(
        F.col("p_brand").alias("school"), F.col("p_type").alias("entry_year"), F.col("p_name").alias("code")
    )
    return quality.duplicate_keys(rows, ["school", "entry_year", "code"])


@query(
    "threshold_layers",
    """SELECT s_suppkey AS school, k AS rule_key,
  CASE WHEN k = 'programs_min' AND s_acctbal > 5000 THEN CAST(floor(s_acctbal) AS INTEGER) ELSE v END AS threshold
FROM supplier, (VALUES ('modules_min', 1), ('module_url_pct', 90), ('module_zh_pct', 90), ('module_faculty_pct', 60),
  ('programs_min', 100), ('program_faculty_pct', 90), ('calendar_future', 1), ('exam_periods', 1), ('dead_src_pct', 25)) t(k, v)""",
)
def threshold_layers(spark, sf):
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("school"), "s_acctbal")
    overrides = supplier.filter("s_acctbal > 5000").select(
        "school", F.lit("programs_min").alias("rule_key"), F.floor("s_acctbal").cast("int").alias("value")
    )
    return quality.thresholds(supplier.select("school"), overrides, "school")


def audit_tables(spark, sf):
    customer = table(spark, sf, "customer")
    modules = customer.select(
        F.col("c_nationkey").alias("university_id"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "[x").otherwise(F.col("c_name")).alias("name_en"),
        F.when(F.col("c_acctbal") > 7000, F.repeat("c_mktsegment", F.lit(8))).when(F.col("c_acctbal") > 0, "好").alias("name_zh"),
        F.when(F.col("c_acctbal") > -500, F.lit("u")).alias("url"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey")).alias("faculty_id"),
        F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment")).alias("code"),
        F.floor(F.col("c_acctbal") / 100).cast("string").alias("entry_year"),
        (F.col("c_acctbal") < 9500).alias("is_active"),
    )
    orders = school_programs(spark, sf)
    programs = orders.select(
        F.col("c_nationkey").alias("university_id"),
        F.when(F.col("o_orderstatus") != "P", 1).alias("faculty_id"),
        (F.col("o_orderpriority") != "5-LOW").alias("is_active"),
    )
    events = orders.select(
        F.col("c_nationkey").alias("university_id"), F.col("o_orderdate").alias("start_date"),
        F.when(F.col("o_orderstatus") == "P", "exam_period").otherwise("holiday").alias("event_type"),
    )
    return modules, programs, events, registry_pages(spark, sf)


AUDIT_SQL = f"""
WITH mo AS (SELECT c_nationkey AS u, CASE WHEN c_mktsegment = 'FURNITURE' THEN '[x' ELSE c_name END AS name_en,
   CASE WHEN c_acctbal > 7000 THEN repeat(c_mktsegment, 8) WHEN c_acctbal > 0 THEN '好' END AS name_zh,
   CASE WHEN c_acctbal > -500 THEN 'u' END AS url, CASE WHEN c_mktsegment <> 'BUILDING' THEN 1 END AS fac,
   CASE WHEN c_acctbal > 5000 THEN c_mktsegment END AS code, floor(c_acctbal / 100) AS y FROM customer WHERE c_acctbal < 9500),
m AS (SELECT u, count(*) AS n_modules, round(100.0 * count(url) / count(*)) AS url_pct, round(100.0 * count(name_zh) / count(*)) AS zh_pct,
   round(100.0 * count(fac) / count(*)) AS fac_pct, count(*) FILTER (name_en LIKE '[%') AS junk,
   count(*) FILTER (length(name_zh) > greatest(60, 3 * length(name_en))) AS fat FROM mo GROUP BY u),
dup AS (SELECT u, count(*) AS dups FROM (SELECT u, code, y FROM mo WHERE code IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) > 1) GROUP BY u),
pr AS (SELECT c_nationkey AS u, count(*) FILTER (o_orderpriority <> '5-LOW') AS n_programs,
   round(100.0 * count(*) FILTER (o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P') / nullif(count(*) FILTER (o_orderpriority <> '5-LOW'), 0)) AS pf_pct,
   count(*) FILTER (o_orderdate >= TIMESTAMP '2001-07-20') AS fut,
   count(*) FILTER (o_orderdate >= TIMESTAMP '2001-07-20' AND o_orderstatus = 'P') AS ex FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
sp AS (SELECT university_id AS u, count(*) FILTER (status = 'active' AND crawl_freq <> 'manual' AND last_fetched_at IS NULL) AS miss,
   round(100.0 * count(*) FILTER (status = 'dead') / count(*)) AS dead FROM ({PAGES_SQL}) GROUP BY 1),
w AS (SELECT n_nationkey AS u, n_regionkey = 3 AS skip, n_regionkey = 2 AS exam_skip, coalesce(n_modules, 0) AS n_modules, url_pct, zh_pct, fac_pct, junk, fat,
   coalesce(dups, 0) AS dups, coalesce(n_programs, 0) AS n_programs, pf_pct, coalesce(fut, 0) AS fut, coalesce(ex, 0) AS ex,
   coalesce(miss, 0) AS miss, coalesce(dead, 0) AS dead, CASE WHEN n_regionkey = 1 THEN 50 ELSE 100 END AS pmin
 FROM nation LEFT JOIN m ON m.u = n_nationkey LEFT JOIN dup ON dup.u = n_nationkey LEFT JOIN pr ON pr.u = n_nationkey LEFT JOIN sp ON sp.u = n_nationkey),
r AS (
 SELECT u, 1 AS no, 'modules' AS rule, n_modules AS a, n_modules >= 1 AS ok, exam_skip FROM w WHERE NOT skip
 UNION ALL SELECT u, 2, 'module url %', url_pct, url_pct >= 90, exam_skip FROM w WHERE NOT skip AND n_modules > 0
 UNION ALL SELECT u, 3, 'module zh %', zh_pct, zh_pct >= 90, exam_skip FROM w WHERE NOT skip AND n_modules > 0
 UNION ALL SELECT u, 4, 'module faculty %', fac_pct, fac_pct >= 60, exam_skip FROM w WHERE NOT skip AND n_modules > 0
 UNION ALL SELECT u, 5, 'junk names', junk, junk = 0, exam_skip FROM w WHERE NOT skip AND n_modules > 0
 UNION ALL SELECT u, 6, 'duplicate codes', dups, dups = 0, exam_skip FROM w WHERE NOT skip AND n_modules > 0
 UNION ALL SELECT u, 7, 'runaway translations', fat, fat = 0, exam_skip FROM w WHERE NOT skip AND n_modules > 0
 UNION ALL SELECT u, 8, 'programs', n_programs, n_programs >= pmin, exam_skip FROM w
 UNION ALL SELECT u, 9, 'program faculty %', pf_pct, pf_pct >= 90, exam_skip FROM w WHERE n_programs > 0
 UNION ALL SELECT u, 10, 'future events', fut, fut >= 1, exam_skip FROM w
 UNION ALL SELECT u, 11, 'future exams', ex, ex >= 1, exam_skip FROM w
 UNION ALL SELECT u, 12, 'never fetched', miss, miss = 0, exam_skip FROM w
 UNION ALL SELECT u, 13, 'dead pages %', dead, dead <= 25, exam_skip FROM w)
SELECT u AS university_id, CAST(no AS INTEGER) AS rule_no, rule, CAST(CAST(a AS BIGINT) AS VARCHAR) AS actual,
  CASE WHEN ok THEN '✓' WHEN no = 11 AND exam_skip THEN '△' ELSE '✗' END AS light FROM r
UNION ALL SELECT u, 1, 'modules (skipped)', 'blocked', '△' FROM w WHERE skip"""


def card(spark, sf):
    nation = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("university_id"),
        F.when(F.col("n_regionkey") == 3, "blocked").alias("modules_skip"),
        (F.col("n_regionkey") == 2).alias("exam_skip"), "n_regionkey",
    )
    overrides = nation.filter("n_regionkey = 1").select(
        "university_id", F.lit("programs_min").alias("rule_key"), F.lit(50).alias("value")
    )
    limits = quality.thresholds(nation.select("university_id"), overrides, "university_id")
    wide = quality.measures(
        nation.drop("n_regionkey"), *audit_tables(spark, sf), F.lit("2001-07-20").cast("timestamp_ntz")
    )
    return quality.scorecard(wide, limits)


@query("audit_scorecard", AUDIT_SQL)
def audit_scorecard(spark, sf):
    return card(spark, sf)


@query("audit_red_total", f"SELECT count(*) FILTER (light = '✗') AS reds FROM ({AUDIT_SQL})")
def audit_red_total(spark, sf):
    return quality.red_total(card(spark, sf))


@query(
    "index_summary",
    f"""SELECT n_nationkey AS university_id, n_name AS code, r_name AS country, coalesce(np, 0) AS n_programs,
 coalesce(nm, 0) AS n_modules, coalesce(dead, 0) AS dead_sources, coalesce(ne, 0) > 0 AS has_calendar
FROM nation JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT c_nationkey, count(*) FILTER (o_orderpriority <> '5-LOW') AS np, count(*) AS ne FROM orders
  JOIN customer ON o_custkey = c_custkey GROUP BY 1) p ON p.c_nationkey = n_nationkey
LEFT JOIN (SELECT c_nationkey, count(*) AS nm FROM customer WHERE c_acctbal < 9500 GROUP BY 1) m ON m.c_nationkey = n_nationkey
LEFT JOIN (SELECT university_id, count(*) FILTER (status = 'dead') AS dead FROM ({PAGES_SQL}) GROUP BY 1) s ON s.university_id = n_nationkey""",
)
def index_summary(spark, sf):
    active = schools(spark, sf).withColumn("is_active", F.lit(True))
    return export.index_summary(active, *audit_tables(spark, sf))


@query(
    "status_table",
    f"""SELECT n_name AS code, coalesce(np, 0) AS n_programs, coalesce(pf || '%', '—') AS faculty_pct,
 coalesce(nm, 0) AS n_modules, coalesce(mu || '%', '—') AS url_pct, coalesce(ne, 0) AS n_events, coalesce(nx, 0) AS n_exams,
 coalesce(fetched, 0) AS n_fetched, coalesce(miss, 0) AS n_never
FROM nation
LEFT JOIN (SELECT c_nationkey k, count(*) FILTER (o_orderpriority <> '5-LOW') AS np, count(*) AS ne, count(*) FILTER (o_orderstatus = 'P') AS nx,
  CAST(CAST(round(100.0 * count(*) FILTER (o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P') / nullif(count(*) FILTER (o_orderpriority <> '5-LOW'), 0)) AS INTEGER) AS VARCHAR) AS pf
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) p ON p.k = n_nationkey
LEFT JOIN (SELECT c_nationkey k, count(*) AS nm, CAST(CAST(round(100.0 * count(*) FILTER (c_acctbal > -500) / count(*)) AS INTEGER) AS VARCHAR) AS mu
  FROM customer WHERE c_acctbal < 9500 GROUP BY 1) m ON m.k = n_nationkey
LEFT JOIN (SELECT university_id k, count(last_fetched_at) AS fetched,
  count(*) FILTER (status = 'active' AND crawl_freq <> 'manual' AND last_fetched_at IS NULL) AS miss FROM ({PAGES_SQL}) GROUP BY 1) s ON s.k = n_nationkey""",
)
def status_table(spark, sf):
    from catalodge.plans.reports import status_table as report

    return report(schools(spark, sf), *audit_tables(spark, sf)).drop("university_id", "country")


MATRIX_GROUPS = {
    "detail": ("program_detail",), "module": ("module_catalog",), "catalog": ("program_catalog",),
    "calendar": ("term_dates", "faculty_list"),
}


def _matrix_sql() -> str:
    def cell(name, test):
        return (
            f"CAST(count(*) FILTER ({test} AND ok AND last_fetched_at IS NOT NULL) AS VARCHAR) || '/' || "
            f"CAST(count(*) FILTER ({test} AND ok) AS VARCHAR) AS {name}"
        )

    cells, listed = [], []
    for name, cats in MATRIX_GROUPS.items():
        names = ", ".join(f"'{c}'" for c in cats)
        listed.append(names)
        cells.append(cell(name, f"category IN ({names})"))
    cells.append(cell("other", f"category NOT IN ({', '.join(listed)})"))
    return (
        f"SELECT university_id, {', '.join(cells)}, count(*) FILTER (crawl_freq = 'manual' AND status = 'active') AS frozen, "
        f"count(*) FILTER (status <> 'active') AS lost FROM (SELECT *, status = 'active' AND crawl_freq <> 'manual' AS ok "
        f"FROM ({PAGES_SQL})) GROUP BY university_id"
    )


@query("status_matrix", _matrix_sql())
def status_matrix(spark, sf):
    from catalodge.plans.reports import status_matrix as report

    return report(registry_pages(spark, sf), MATRIX_GROUPS)


@query(
    "acceptance_ratio",
    """SELECT c_nationkey AS university_id, count(*) AS n_programs,
  count(*) FILTER (o_totalprice > 100000) || '/' || count(*) AS tuition_intl,
  count(*) FILTER (o_orderpriority <> '5-LOW' OR o_orderstatus = 'F') || '/' || count(*) AS language_req,
  count(*) FILTER (o_orderstatus <> 'P') || '/' || count(*) AS faculty_id
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def acceptance_ratio(spark, sf):
    from catalodge.plans.reports import acceptance

    rows = school_programs(spark, sf).select(
        F.col("c_nationkey").alias("university_id"),
        F.when(F.col("o_totalprice") > 100000, 1).alias("tuition_intl"),
        F.coalesce(
            F.when(F.col("o_orderpriority") != "5-LOW", 1), F.when(F.col("o_orderstatus") == "F", 1)
        ).alias("language_req"),
        F.when(F.col("o_orderstatus") != "P", 1).alias("faculty_id"),
    )
    return acceptance(rows, "university_id", ["tuition_intl", "language_req", "faculty_id"])


# ---- counters ----------------------------------------------------------------------------


@query(
    "skipped_by_method",
    f"SELECT fetch_method, count(*) AS n FROM ({PAGES_SQL}) WHERE status = 'active' AND fetch_method IN ('js_render', 'pdf') GROUP BY 1",
)
def skipped_by_method(spark, sf):
    skipped = registry_pages(spark, sf).filter(
        (F.col("status") == "active") & F.col("fetch_method").isin(*registry.SKIPPED)
    )
    return registry.count_by(skipped, "fetch_method")


@query("outcome_counts", f"SELECT {sql_map('event_type', OUTCOME)} AS kind, count(*) AS n FROM events GROUP BY 1")
def outcome_counts(spark, sf):
    kinds = table(spark, sf, "events").select(mapped(F.col("event_type"), OUTCOME).alias("kind"))
    return registry.count_by(kinds, "kind")


@query(
    "tasks_per_host",
    "SELECT lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host, count(*) AS n FROM pages GROUP BY 1",
)
def tasks_per_host(spark, sf):
    return registry.count_by(table(spark, sf, "pages").select(urls.host(F.col("url")).alias("host")), "host")


@query(
    "school_task_order",
    """SELECT source AS school, count(*) AS n, min(doc_id) AS first_seen,
 row_number() OVER (ORDER BY min(doc_id)) AS place FROM documents GROUP BY source""",
)
def school_task_order(spark, sf):
    counted = table(spark, sf, "documents").groupBy(F.col("source").alias("school")).agg(
        n_rows().alias("n"), F.min("doc_id").alias("first_seen")
    )
    return ordered.number_all(counted, ["first_seen"], "place")


@query(
    "exam_weight",
    """SELECT p_partkey AS module_id, CAST(100 - p_size AS BIGINT) + CASE WHEN p_type = 'PROMO' THEN p_size ELSE 0 END AS exam,
 CASE WHEN p_type = 'PROMO' THEN 0 ELSE p_size END AS other,
 (100 - p_size) || '% Written Exam + ' || p_size || '% ' || kind AS label,
 CASE WHEN contains(lower(kind), 'exam') THEN 'exam' WHEN regexp_matches(kind, 'course|assignment|essay|report|project|lab', 'i') THEN 'coursework'
  WHEN regexp_matches(kind, 'group|class|present|participation|quiz|test', 'i') THEN 'group' ELSE 'other' END AS second_class
FROM (SELECT *, CASE p_type WHEN 'PROMO' THEN 'Exam 2' WHEN 'SMALL' THEN 'Lab report' WHEN 'LARGE' THEN 'Quiz' ELSE p_name END AS kind FROM part)""",
)
def exam_weight(spark, sf):
    kind = (
        F.when(F.col("p_type") == "PROMO", "Exam 2").when(F.col("p_type") == "SMALL", "Lab report")
        .when(F.col("p_type") == "LARGE", "Quiz").otherwise(F.col("p_name"))
    )
    items = F.array(
        F.struct(F.lit("Written Exam").alias("type"), (100 - F.col("p_size")).alias("weight")),
        F.struct(kind.alias("type"), F.col("p_size").alias("weight")),
    )
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("module_id"), items.alias("items"))
    exam = rollup.exam_share(F.col("items"))
    return rows.select(
        "module_id", exam.alias("exam"), (rollup.total_weight(F.col("items")) - exam).cast("int").alias("other"),
        labels.assessment_text(F.col("items")).alias("label"),
        assessment_class(F.col("items")[1]["type"]).alias("second_class"),
    )


@query(
    "plan_credits",
    """SELECT l_orderkey AS plan_id, l_linenumber AS term, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS credits, count(*) AS n_items
FROM lineitem GROUP BY 1, 2""",
)
def plan_credits(spark, sf):
    items = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("plan_id"), F.col("l_linenumber").alias("term"), F.col("l_quantity").alias("credits")
    )
    return views.plan_credits(items)


@query(
    "plan_nonempty",
    """SELECT o_orderkey AS plan_id, coalesce(n, 0) AS n_items, n IS NOT NULL AS loaded FROM orders
LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
)
def plan_nonempty(spark, sf):
    items = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("plan_id"))
    return views.plan_sizes(table(spark, sf, "orders").select(F.col("o_orderkey").alias("plan_id")), items)


@query(
    "contents_by_type",
    """SELECT l_orderkey AS module_id, l_returnflag AS content_type, 0 AS chunk, 1 AS n_chunks,
 string_agg(l_linenumber || ':' || l_partkey, ';' ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) AS items
FROM lineitem GROUP BY 1, 2""",
)
def contents_by_type(spark, sf):
    element = F.concat_ws(":", F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"))
    grouped = rollup.chunked_lists(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_returnflag"],
        ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"], element,
    )
    return grouped.select(
        F.col("l_orderkey").alias("module_id"), F.col("l_returnflag").alias("content_type"), "chunk", "n_chunks",
        F.array_join("items", ";").alias("items"),
    )


# ---- ordered reports -----------------------------------------------------------------------


@query(
    "recent_changes_top8",
    """SELECT event_id, user_id, left(props, 21) || ' → ' || left(event_type, 21) AS change, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS place
FROM events ORDER BY ts DESC, event_id DESC LIMIT 8""",
)
def recent_changes_top8(spark, sf):
    log = table(spark, sf, "events").select("event_id", "user_id", "ts", F.col("props").alias("old_value"), F.col("event_type").alias("new_value"))
    return views.recent_changes(log, ["ts", "event_id"]).select("event_id", "user_id", "change", "place")


@query(
    "next_deadlines_top15",
    """WITH d AS (SELECT o_orderdate AS t, 'school' AS kind, o_orderkey AS a, CAST(0 AS BIGINT) AS b, 0 AS c FROM orders
 UNION ALL SELECT l_shipdate, 'program', l_orderkey, l_partkey, l_linenumber FROM lineitem)
SELECT kind, strftime(t, '%Y-%m-%d') AS deadline, a AS owner, b AS part_id, row_number() OVER (ORDER BY t, kind, a, b, c) AS place
FROM d WHERE t >= TIMESTAMP '1998-01-01' ORDER BY t, kind, a, b, c LIMIT 15""",
)
def next_deadlines_top15(spark, sf):
    school = table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("t"), F.col("o_orderkey").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).alias("c"),
    )
    program = table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("t"), F.col("l_orderkey").alias("a"), F.col("l_partkey").alias("b"), F.col("l_linenumber").alias("c"),
    )
    both = views.all_deadlines(school, program)
    top = views.next_deadlines(both, F.lit("1998-01-01").cast("timestamp_ntz"), ["t", "kind", "a", "b", "c"])
    return top.select(
        "kind", F.date_format("t", "yyyy-MM-dd").alias("deadline"), F.col("a").alias("owner"), F.col("b").alias("part_id"), "place"
    )


@query(
    "nearest_deadline",
    """SELECT user_id AS program_id, strftime(coalesce(min(ts) FILTER (ts >= TIMESTAMP '2024-01-15'), max(ts)), '%Y-%m-%d %H:%M:%S') AS deadline,
 min(ts) FILTER (ts >= TIMESTAMP '2024-01-15') IS NOT NULL AS is_open FROM events GROUP BY 1""",
)
def nearest_deadline(spark, sf):
    deadlines = table(spark, sf, "events").select(F.col("user_id").alias("program_id"), "ts")
    found = views.nearest_deadlines(deadlines, "program_id", "ts", F.lit("2024-01-15").cast("timestamp_ntz"))
    return found.withColumn("deadline", F.date_format("deadline", "yyyy-MM-dd HH:mm:ss"))


@query(
    "export_order",
    f"""SELECT university_id, id, row_number() OVER (PARTITION BY university_id ORDER BY (status = 'dead') DESC, (last_fetched_at IS NOT NULL) DESC, category, id) AS place
FROM ({PAGES_SQL})""",
)
def export_order(spark, sf):
    pages = registry_pages(spark, sf).select(
        "university_id", "id", "category", "status", F.when(F.col("last_fetched_at").isNotNull(), "noted").alias("note")
    )
    return views.export_order(pages, "source_pages").select("university_id", "id", "place")


@query(
    "region_rank",
    """WITH r AS (SELECT CASE WHEN contains(url, '.com') THEN 'UK' WHEN contains(url, '.net') THEN 'AU' ELSE 'ZZ' END AS region, page_id FROM pages)
SELECT region, CASE region WHEN 'UK' THEN 1 WHEN 'AU' THEN 2 WHEN 'HK' THEN 3 ELSE 99 END AS rnk, count(*) AS n, min(page_id) AS first_seen FROM r GROUP BY 1""",
)
def region_rank(spark, sf):
    region = F.when(F.col("url").contains(".com"), "UK").when(F.col("url").contains(".net"), "AU").otherwise("ZZ")
    grouped = table(spark, sf, "pages").groupBy(region.alias("region")).agg(
        n_rows().alias("n"), F.min("page_id").alias("first_seen")
    )
    return grouped.withColumn("rnk", labels.region_rank(F.col("region")))


@query(
    "code_order_nulls_last",
    """SELECT id, row_number() OVER (ORDER BY coalesce(code, 'zz'), id) AS place
FROM (SELECT p_partkey AS id, CASE WHEN p_type <> 'PROMO' THEN p_name END AS code FROM part)""",
)
def code_order_nulls_last(spark, sf):
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_type") != "PROMO", F.col("p_name")).alias("code")
    )
    return views.code_order(parts).select("id", "place")


@query(
    "export_order_units",
    """SELECT s_nationkey AS university_id, s_suppkey AS id,
  row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal > 5000, s_suppkey) AS place FROM supplier""",
)
def export_order_units(spark, sf):
    units = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("university_id"), F.col("s_suppkey").alias("id"),
        F.when(F.col("s_acctbal") > 5000, 1).alias("parent_id"),
    )
    return views.export_order(units, "faculties").select("university_id", "id", "place")


@query(
    "export_order_calendar",
    """SELECT o_custkey AS university_id, o_orderkey AS id, row_number() OVER (PARTITION BY o_custkey ORDER BY
  CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END NULLS FIRST, o_orderkey) AS place FROM orders""",
)
def export_order_calendar(spark, sf):
    events = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("university_id"), F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date")).alias("start_date"),
    )
    return views.export_order(events, "calendar_events").select("university_id", "id", "place")


@query(
    "card_order",
    """WITH c AS (SELECT l_suppkey AS top_id, count(DISTINCT l_orderkey) AS n, count(DISTINCT l_partkey) AS n_modules FROM lineitem GROUP BY 1)
SELECT *, row_number() OVER (ORDER BY n DESC, n_modules DESC, top_id) AS place FROM c""",
)
def card_order(spark, sf):
    cards = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("top_id")).agg(
        F.countDistinct("l_orderkey").alias("n"), F.countDistinct("l_partkey").alias("n_modules")
    )
    return views.placed_cards(cards)


# ---- exports ---------------------------------------------------------------------------------


@query(
    "nested_export",
    """WITH dl AS (SELECT l_orderkey k, string_agg('{"at":"' || strftime(l_shipdate, '%Y-%m-%d') || '","line":' || l_linenumber || ',"flag":"' || l_linestatus || '"}', ','
    ORDER BY l_shipdate, l_linenumber, l_linestatus) AS js FROM lineitem GROUP BY 1),
md AS (SELECT l_orderkey k, string_agg('{"module_id":' || l_partkey || ',"module_type":"' || l_returnflag || '"}', ',' ORDER BY l_partkey, l_returnflag) AS js FROM lineitem GROUP BY 1),
de AS (SELECT l_orderkey k, max(year(l_shipdate)) AS y, max(l_linenumber) FILTER (year(l_shipdate) = my) AS n
   FROM (SELECT *, max(year(l_shipdate)) OVER (PARTITION BY l_orderkey) AS my FROM lineitem) GROUP BY 1)
SELECT c_nationkey AS university_id, o_orderkey AS program_id, 0 AS part,
 '{"id":' || o_orderkey || ',"level":"' || o_orderstatus || '"' ||
 CASE WHEN de.y IS NULL THEN '' ELSE ',"detail":{"entry_year":' || de.y || ',"lines":' || de.n || '}' END ||
 ',"deadlines":[' || coalesce(dl.js, '') || '],"modules":[' || coalesce(md.js, '') || ']}' AS body
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN dl ON dl.k = o_orderkey LEFT JOIN md ON md.k = o_orderkey LEFT JOIN de ON de.k = o_orderkey""",
)
def nested_export(spark, sf):
    programs = school_programs(spark, sf).select(
        F.col("c_nationkey").alias("university_id"), F.col("o_orderkey").alias("program_id"),
        F.col("o_orderstatus").alias("level"),
    )
    lines = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi"
    ).withColumnRenamed("l_orderkey", "program_id")
    details = lines.groupBy("program_id", F.year("l_shipdate").alias("entry_year")).agg(F.max("l_linenumber").alias("lines"))
    deadlines = lines.select(
        "program_id", export.iso_date(F.col("l_shipdate")).alias("at"), F.col("l_linenumber").alias("line"),
        F.col("l_linestatus").alias("flag"),
    )
    members = lines.select("program_id", F.col("l_partkey").alias("module_id"), F.col("l_returnflag").alias("module_type"))
    return export.program_documents(programs, details, deadlines, members)


@query(
    "section_export",
    """SELECT c_nationkey AS university_id, 'sources' AS section,
 '{"id":' || c_custkey || ',"name":"' || c_name || '","segment":"' || c_mktsegment || '"}' AS body FROM customer""",
)
def section_export(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("university_id"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    return export.section_documents(rows, "sources")


@query(
    "run_report",
    f"""WITH o AS (SELECT *, {sql_map('event_type', OUTCOME)} AS kind FROM events)
SELECT 'count' AS section, kind, n AS value FROM (SELECT kind, count(*) AS n FROM o GROUP BY 1)
UNION ALL SELECT 'failure', kind, event_id FROM (SELECT kind, event_id FROM o WHERE kind = 'error' ORDER BY ts, event_id LIMIT 10)""",
)
def run_report(spark, sf):
    outcomes = table(spark, sf, "events").withColumn("kind", mapped(F.col("event_type"), OUTCOME))
    counts, failures = export.run_report(outcomes)
    return counts.select(F.lit("count").alias("section"), "kind", F.col("n").alias("value")).unionByName(
        failures.select(F.lit("failure").alias("section"), "kind", F.col("event_id").alias("value"))
    )


@query(
    "first_changes",
    """SELECT ts, event_id, '[' || event_type || '] props ' || props || ' -> ' || CAST(user_id AS VARCHAR) AS change
FROM events ORDER BY ts, event_id LIMIT 20""",
)
def first_changes(spark, sf):
    log = table(spark, sf, "events").select(
        "ts", "event_id", F.col("event_type").alias("entity_type"), F.lit("props").alias("field_name"),
        F.col("props").alias("old_value"), F.col("user_id").cast("string").alias("new_value"),
    )
    return export.first_changes(log, ["ts", "event_id"])


@query(
    "band_policy_report",
    """SELECT o_custkey AS school, o_orderkey AS policy_id, year(o_orderdate) AS entry_year,
 trim(substring(o_orderpriority, 3)) AS label, CAST(k AS INTEGER) AS minimum_each
FROM (SELECT *, json_extract_string('{"minimum_each": ' || CAST(floor(o_totalprice / 1000) AS INTEGER) || '}', '$.minimum_each') AS k
  FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)""",
)
def band_policy_report(spark, sf):
    policies = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("university_id"), F.col("o_orderkey").alias("policy_id"), "o_orderdate",
        F.regexp_replace("o_orderpriority", r"^\d-", "").alias("label"),
        F.concat(F.lit('{"minimum_each": '), F.floor(F.col("o_totalprice") / 1000).cast("string"), F.lit("}")).alias("detail"),
    )
    newest = views.newest_policies(policies, ["o_orderdate", "policy_id"])
    return newest.select(
        F.col("university_id").alias("school"), "policy_id", F.year("o_orderdate").cast("long").alias("entry_year"), "label", "minimum_each"
    )


# ---- configuration ---------------------------------------------------------------------------


@query(
    "config_layers",
    """WITH c AS (SELECT c_nationkey AS nk, CAST(count(*) AS VARCHAR) AS v FROM customer GROUP BY 1)
SELECT s_suppkey AS school, 'interval' AS key, CASE WHEN s_acctbal > 5000 THEN CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR)
   WHEN v IS NOT NULL THEN v ELSE '3' END AS value FROM supplier LEFT JOIN c ON nk = s_nationkey
UNION ALL SELECT s_suppkey, 'entry_year', '2026' FROM supplier
UNION ALL SELECT s_suppkey, 'scope.details', 'yes' FROM supplier WHERE s_acctbal < 1000""",
)
def config_layers(spark, sf):
    supplier = table(spark, sf, "supplier")
    base = supplier.select(F.col("s_suppkey").alias("school"), F.col("s_nationkey").alias("country"))
    defaults = {"interval": "3", "entry_year": "2026"}
    country = table(spark, sf, "customer").groupBy("c_nationkey").agg(n_rows().cast("string").alias("value")).select(
        F.lit(1).alias("layer"), F.col("c_nationkey").cast("long").alias("scope"), F.lit("interval").alias("key"), "value"
    )
    own = supplier.select(
        F.lit(2).alias("layer"), F.col("s_suppkey").alias("scope"),
        F.inline(
            F.array(
                F.struct(
                    F.lit("interval").alias("key"),
                    F.when(F.col("s_acctbal") > 5000, F.floor("s_acctbal").cast("string")).alias("value"),
                ),
                F.struct(
                    F.lit("scope.details").alias("key"), F.when(F.col("s_acctbal") < 1000, "yes").alias("value")
                ),
            )
        ),
    ).filter("value is not null")
    return config.resolve_layers(base, country.unionByName(own), defaults)


@query(
    "host_policy",
    """WITH h AS (SELECT DISTINCT lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host FROM pages),
l AS (SELECT lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host, 's' || page_id AS school, page_id / 10.0 AS iv FROM pages WHERE url LIKE '%/en/%')
SELECT host, coalesce(school, '-') AS school, coalesce(CAST(iv AS DOUBLE), 3.0) AS interval, CASE WHEN school IS NULL THEN 1 ELSE 4 END AS concurrency
FROM h LEFT JOIN (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY host ORDER BY school) = 1) USING (host)""",
)
def host_policy(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", urls.host(F.col("url")).alias("host"))
    listed = pages.filter(F.col("url").contains("/en/")).select(
        "host", F.concat(F.lit("s"), F.col("page_id").cast("string")).alias("school"),
        (F.col("page_id") / 10.0).alias("interval"), F.lit(4).alias("concurrency"),
    )
    return config.host_policies(pages.select("host").distinct(), listed)


@query(
    "seed_pages",
    """SELECT s_nationkey AS university_id, url, category, crawl_freq FROM (
 SELECT s_suppkey, s_nationkey, 'https://' || lower(s_name) || '/terms' AS url, 'term_dates' AS category, 'monthly' AS crawl_freq FROM supplier
 UNION ALL SELECT s_suppkey, s_nationkey, 'https://' || lower(s_name) || '/degrees', 'program_catalog', 'weekly' FROM supplier)
WHERE NOT (category = 'term_dates' AND s_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000))""",
)
def seed_pages(spark, sf):
    base = F.concat(F.lit("https://"), F.lower("s_name"))

    def seed(path, category, freq):
        return F.struct(
            F.lit(category).alias("category"), F.concat(base, F.lit(path)).alias("url"),
            F.lit(None).cast("string").alias("title"), F.lit(freq).alias("crawl_freq"), F.lit("html").alias("fetch_method"),
        )

    suppliers = table(spark, sf, "supplier")
    listed = suppliers.select(
        F.col("s_nationkey").alias("university_id"),
        F.array(seed("/terms", "term_dates", "monthly"), seed("/degrees", "program_catalog", "weekly")).alias("seed_pages"),
    )
    registered = suppliers.filter("s_acctbal > 5000").select(
        F.col("s_nationkey").alias("university_id"), F.concat(base, F.lit("/terms")).alias("url")
    )
    fresh = registry.new_pages(registered, config.seed_rows(listed), ["pos"])
    return fresh.select("university_id", "url", "category", "crawl_freq")
