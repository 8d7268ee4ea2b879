"""Filters, joins, lookups and set operations bound to the bench tables.

Binding: school = nation, country = region, programme = order (its school is the
customer's nation), module = part, module list = lineitem, registry page =
customer, fetch log = events (page = user).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalodge.functions import dates, rules, text
from catalodge.operators import lookup, merge, ordered, registry, rollup
from catalodge.plans import views
from catalodge.queries.registry import query, table

AS_OF = "1998-01-01"
EVENTS_AS_OF = "2024-02-01"

# Event type -> crawl frequency, market segment -> page category.
FREQ = {"view": "daily", "click": "weekly", "signup": "quarterly", "purchase": "monthly", "error": "manual"}
CATEGORY = {
    "AUTOMOBILE": "program_detail", "BUILDING": "deadlines", "FURNITURE": "module_catalog",
    "HOUSEHOLD": "news", "MACHINERY": "term_dates",
}


def mapped(column, labels, default=None):
    chain = None
    for key, value in labels.items():
        chain = F.when(column == key, value) if chain is None else chain.when(column == key, value)
    return chain.otherwise(F.lit(default).cast("string"))


def sql_map(column: str, labels: dict[str, str], default: str = "NULL") -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    return f"CASE {column} {cases} ELSE {default} END"


def school_programs(spark, sf):
    """Orders as programmes with the nation of their customer as school."""
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))


# ---- votes ------------------------------------------------------------------------

VOTE_SQL = """
  SELECT l_orderkey AS program_id, n_regionkey AS faculty_id, v AS votes, CAST(tot AS BIGINT) AS total_votes
  FROM (SELECT *, sum(v) OVER (PARTITION BY l_orderkey) AS tot,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY v DESC, n_regionkey) AS rn
        FROM (SELECT l_orderkey, n_regionkey, count(*) AS v
              FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
              GROUP BY l_orderkey, n_regionkey))
  WHERE rn = 1 AND v >= 3 AND v * 2 > tot"""


def votes(spark, sf):
    units = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select("s_suppkey", F.col("n_regionkey").alias("faculty_id"))
    members = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("program_id"), "l_suppkey").join(
        units, F.col("l_suppkey") == F.col("s_suppkey")
    )
    return rollup.majority_vote(members, "program_id", "faculty_id")


@query("majority_vote", VOTE_SQL)
def majority_vote(spark, sf):
    return votes(spark, sf)


@query(
    "derived_backfill",
    f"""
WITH p AS (SELECT o_orderkey AS program_id, o_orderstatus <> 'P' AS is_active,
                  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN n_regionkey END AS faculty_id
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
t AS ({VOTE_SQL})
SELECT p.program_id, p.is_active,
       coalesce(p.faculty_id, CASE WHEN p.is_active THEN t.faculty_id END, -1) AS faculty_id
FROM p LEFT JOIN t ON t.program_id = p.program_id""",
)
def derived_backfill(spark, sf):
    nation = table(spark, sf, "nation")
    programs = school_programs(spark, sf).join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("o_orderkey").alias("program_id"),
        (F.col("o_orderstatus") != "P").alias("is_active"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("n_regionkey")).alias("faculty_id"),
    )
    filled = merge.fill_missing(programs, votes(spark, sf), ["program_id"], "faculty_id", active="is_active")
    return filled.fillna(-1, subset=["faculty_id"])


# ---- registry ----------------------------------------------------------------------


def registry_pages(spark, sf):
    """Customers as registered pages, with the latest event of the same number as last fetch."""
    last = ordered.last_per_key(
        table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"]
    )
    return table(spark, sf, "customer").join(last, F.col("c_custkey") == F.col("user_id"), "left").select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").alias("university_id"),
        mapped(F.col("c_mktsegment"), CATEGORY, "other").alias("category"),
        F.coalesce(mapped(F.col("event_type"), FREQ), F.lit("monthly")).alias("crawl_freq"),
        F.when(F.col("c_acctbal") < 0, "pdf").otherwise("html").alias("fetch_method"),
        F.when(F.col("c_acctbal") > 9000, "dead").otherwise("active").alias("status"),
        F.col("ts").alias("last_fetched_at"),
    )


PAGES_SQL = f"""
  SELECT c_custkey AS id, c_nationkey AS university_id, {sql_map('c_mktsegment', CATEGORY, "'other'")} AS category,
         coalesce({sql_map('event_type', FREQ)}, 'monthly') AS crawl_freq,
         CASE WHEN c_acctbal < 0 THEN 'pdf' ELSE 'html' END AS fetch_method,
         CASE WHEN c_acctbal > 9000 THEN 'dead' ELSE 'active' END AS status, ts AS last_fetched_at
  FROM customer LEFT JOIN (SELECT * FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) e ON user_id = c_custkey"""

DUE_SQL = """crawl_freq <> 'manual' AND (last_fetched_at IS NULL OR last_fetched_at < TIMESTAMP '2024-02-01' -
  to_days(CAST(CASE crawl_freq WHEN 'daily' THEN 1 WHEN 'weekly' THEN 7 WHEN 'quarterly' THEN 90 ELSE 30 END AS INTEGER)))"""

ORDER_SQL = """list_position(['deadlines','term_dates','ug_admissions','pg_admissions','language_req','china_page',
  'fees','program_detail','program_catalog','faculty_list','module_catalog','staff_list','research','news','other'],
  category), last_fetched_at IS NOT NULL, last_fetched_at, id"""


@query(
    "due_tasks",
    f"""SELECT id, category, crawl_freq, coalesce(strftime(last_fetched_at, '%Y-%m-%d %H:%M:%S'), 'never') AS last_fetched
FROM ({PAGES_SQL}) WHERE status = 'active' AND fetch_method IN ('html', 'portlet_post', 'cdp') AND {DUE_SQL}""",
)
def due_tasks(spark, sf):
    as_of = F.lit(EVENTS_AS_OF).cast("timestamp_ntz")
    tasks = registry.active_tasks(registry_pages(spark, sf)).filter(registry.is_due(as_of))
    stamp = F.date_format("last_fetched_at", "yyyy-MM-dd HH:mm:ss")
    return tasks.select("id", "category", "crawl_freq", F.coalesce(stamp, F.lit("never")).alias("last_fetched"))


@query(
    "school_tasks",
    f"""SELECT id, n_name AS uni_code, n_name || '!' AS uni_name_zh FROM ({PAGES_SQL}) JOIN nation ON n_nationkey = university_id
WHERE n_regionkey <> 4 AND status = 'active' AND fetch_method IN ('html', 'portlet_post', 'cdp') AND category = 'news'""",
)
def school_tasks(spark, sf):
    schools = table(spark, sf, "nation").filter("n_regionkey <> 4").select(
        F.col("n_nationkey").alias("university_id"), F.col("n_name").alias("code"), F.concat("n_name", F.lit("!")).alias("name_zh")
    )
    return registry.school_tasks(registry_pages(spark, sf), schools, category="news").select("id", "uni_code", "uni_name_zh")


@query(
    "task_priority_topn",
    f"""SELECT id, category, row_number() OVER (ORDER BY {ORDER_SQL}) AS place FROM ({PAGES_SQL})
WHERE status = 'active' AND fetch_method IN ('html', 'portlet_post', 'cdp') ORDER BY {ORDER_SQL} LIMIT 100""",
)
def task_priority_topn(spark, sf):
    top = registry.by_priority(registry.active_tasks(registry_pages(spark, sf)), limit=100)
    # At most 100 rows are left here, so numbering them in one task is fine.
    place = F.row_number().over(
        ordered.Window.orderBy(
            rules.category_rank(F.col("category")), F.col("last_fetched_at").isNotNull(), "last_fetched_at", "id"
        )
    )
    return top.select("id", "category", place.cast("long").alias("place"))


PAGE_CATEGORY_SQL = """CASE WHEN url LIKE '%/en/%' THEN 'program_catalog' WHEN url LIKE '%/fr/%' THEN 'module_catalog'
  WHEN url LIKE '%/de/%' THEN 'faculty_list' ELSE 'program_detail' END"""


@query(
    "discover_filter",
    f"""SELECT page_id, category FROM (SELECT page_id, regexp_replace(url, '[.]html$', '/modules/1') AS url,
 {PAGE_CATEGORY_SQL} AS category FROM pages)
WHERE category IN ('program_catalog', 'faculty_list', 'module_catalog')
  AND NOT (category = 'module_catalog' AND url LIKE '%/modules/%')""",
)
def discover_filter(spark, sf):
    url = F.col("url")
    category = (
        F.when(url.contains("/en/"), "program_catalog").when(url.contains("/fr/"), "module_catalog")
        .when(url.contains("/de/"), "faculty_list").otherwise("program_detail")
    )
    pages = table(spark, sf, "pages").select(
        "page_id", F.regexp_replace("url", "[.]html$", "/modules/1").alias("url"), category.alias("category")
    )
    return pages.filter(registry.is_discovery()).select("page_id", "category")


@query(
    "focus_scope",
    """WITH k(lang, words) AS (VALUES ('en', ['theth', 'ingth']), ('fr', ['QUEQUE']), ('es', CAST([] AS VARCHAR[])))
SELECT doc_id, in_focus, CASE WHEN d.source IN ('src1', 'src2', 'src3') OR in_focus THEN 'monthly' ELSE 'manual' END AS crawl_freq
FROM (SELECT doc_id, source, CASE WHEN words IS NULL OR len(words) = 0 THEN TRUE
        ELSE len(list_filter(words, lambda w: contains(lower(source || ' ' || text), lower(w)))) > 0 END AS in_focus
      FROM documents LEFT JOIN k USING (lang)) d""",
)
def focus_scope(spark, sf):
    words = spark.createDataFrame(
        [("en", ["theth", "ingth"]), ("fr", ["QUEQUE"]), ("es", [])], "lang string, words array<string>"
    )
    focus = registry.in_focus(F.col("words"), F.col("source"), F.col("text"))
    # Focus words are configuration, a row for each language; texts are not shuffled.
    docs = table(spark, sf, "documents").join(F.broadcast(words), "lang", "left")
    category = F.when(F.col("source").isin("src1", "src2", "src3"), "news").otherwise("program_detail")
    out = docs.select("doc_id", focus.alias("in_focus"), category.alias("category"))
    freq = registry.scoped_frequency(F.lit("monthly"), F.col("category"), F.col("in_focus"))
    return out.select("doc_id", "in_focus", freq.alias("crawl_freq"))


NAME_SQL = """CASE p_type WHEN 'PROMO' THEN '[' || p_name WHEN 'SMALL' THEN 'year ' || p_size
  WHEN 'LARGE' THEN 'MODULES' WHEN 'MEDIUM' THEN '<' || p_name ELSE p_name END"""


@query(
    "junk_names",
    f"""SELECT p_brand AS brand, count(*) FILTER (regexp_matches({NAME_SQL},
  '^\\[|^["{{<]|^(Modules?|Year [0-9]|Semester [0-9]|Optional|Core)$', 'i')) AS n_junk, count(*) AS n_modules
FROM part GROUP BY p_brand""",
)
def junk_names(spark, sf):
    name = F.col("p_name")
    kind = F.col("p_type")
    composed = (
        F.when(kind == "PROMO", F.concat(F.lit("["), name))
        .when(kind == "SMALL", F.concat(F.lit("year "), F.col("p_size").cast("string")))
        .when(kind == "LARGE", F.lit("MODULES")).when(kind == "MEDIUM", F.concat(F.lit("<"), name)).otherwise(name)
    )
    parts = table(spark, sf, "part").select(F.col("p_brand").alias("brand"), composed.alias("name"))
    return parts.groupBy("brand").agg(
        F.count_if(rules.is_junk_name(F.col("name"))).alias("n_junk"), F.count(F.lit(1)).alias("n_modules")
    )


@query(
    "runaway_text",
    """SELECT doc_id, length(text) AS n FROM documents
WHERE length(text) > greatest(60, 3 * length(split_part(text, chr(10), 1)))""",
)
def runaway_text(spark, sf):
    docs = table(spark, sf, "documents")
    runaway = rules.is_runaway(F.col("text"), F.split_part("text", F.lit("\n"), F.lit(1)))
    return docs.filter(runaway).select("doc_id", F.char_length("text").cast("long").alias("n"))


@query(
    "upcoming_window",
    """SELECT o_orderkey AS program_id, n_name AS school, strftime(o_orderdate, '%Y-%m-%d') AS deadline
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-01-01' + INTERVAL 90 DAY""",
)
def upcoming_window(spark, sf):
    rows = views.upcoming(school_programs(spark, sf), "o_orderdate", F.lit(AS_OF).cast("timestamp_ntz"))
    return rows.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("o_orderkey").alias("program_id"), F.col("n_name").alias("school"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("deadline"),
    )


@query(
    "future_events",
    """SELECT user_id, count(*) AS n_future, count(*) FILTER (event_type IN ('error', 'signup')) AS n_exams
FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY user_id""",
)
def future_events(spark, sf):
    future = table(spark, sf, "events").filter(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    return future.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_future"), F.count_if(F.col("event_type").isin("error", "signup")).alias("n_exams")
    )


@query(
    "never_fetched",
    f"""SELECT university_id, count(*) AS n_missing FROM ({PAGES_SQL})
WHERE status = 'active' AND crawl_freq <> 'manual' AND last_fetched_at IS NULL GROUP BY university_id""",
)
def never_fetched(spark, sf):
    missing = registry_pages(spark, sf).filter(
        (F.col("status") == "active") & (F.col("crawl_freq") != "manual") & F.col("last_fetched_at").isNull()
    )
    return registry.count_by(missing, "university_id", name="n_missing")


@query(
    "academic_year_calendar",
    """WITH ev AS (
  SELECT c_nationkey AS university_id, n_regionkey = 1 AS is_au, o_orderdate AS s,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 30 DAY END AS e
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
lab AS (
  SELECT university_id, is_au, CASE WHEN is_au THEN CAST(year(s) AS VARCHAR) ELSE
     CAST(year(s) - CASE WHEN month(s) >= 9 THEN 0 ELSE 1 END AS VARCHAR) || '/' ||
     lpad(CAST((year(s) - CASE WHEN month(s) >= 9 THEN 0 ELSE 1 END + 1) % 100 AS VARCHAR), 2, '0') END AS academic_year
  FROM ev WHERE coalesce(e, s) >= TIMESTAMP '1998-01-01'),
cnt AS (SELECT university_id, academic_year, count(*) AS n_events,
     bool_or(CASE WHEN is_au THEN academic_year IN ('1998', '1999') ELSE academic_year IN ('1997/98', '1998/99') END) AS wanted
  FROM lab GROUP BY university_id, academic_year),
flag AS (SELECT *, bool_or(wanted) OVER (PARTITION BY university_id) AS any_wanted FROM cnt)
SELECT university_id, academic_year, n_events FROM flag WHERE wanted OR NOT any_wanted""",
)
def academic_year_calendar(spark, sf):
    start = F.col("o_orderdate").cast("date")
    country = F.when(F.col("n_regionkey") == 1, "AU").otherwise("UK")
    events = school_programs(spark, sf).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_nationkey").alias("university_id"), country.alias("country"), start.alias("start_date"),
        F.when(country == "AU", F.year(start).cast("string")).otherwise(dates.academic_year(start)).alias("academic_year"),
        F.when(F.col("o_orderstatus") != "O", F.date_add(start, 30)).alias("end_date"),
    )
    return views.current_years(events, F.lit(AS_OF).cast("date"))


@query(
    "program_search",
    """SELECT p_partkey AS id, p_name AS name_en FROM part
WHERE p_type = 'ECONOMY' AND p_brand = 'Brand#2' AND contains(lower(p_name), lower('Ring'))
UNION ALL SELECT p_partkey, p_name FROM part
WHERE p_type <> 'ECONOMY' AND contains(lower(p_name), lower('RED'))""",
)
def program_search(spark, sf):
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name_en"), F.lit(None).cast("string").alias("name_zh"),
        F.col("p_brand").alias("faculty"), F.when(F.col("p_type") == "ECONOMY", "UG").otherwise("PGT").alias("level"),
    )
    one = views.search_programs(parts, "Ring", level="UG", faculty="Brand#2")
    return one.unionByName(views.search_programs(parts, "RED", level="PGT")).select("id", "name_en")


@query(
    "filter_options",
    """SELECT brand, row_number() OVER (ORDER BY brand) AS place FROM (SELECT DISTINCT p_brand AS brand FROM part)""",
)
def filter_options(spark, sf):
    return views.filter_options(table(spark, sf, "part").select(F.col("p_brand").alias("brand")), "brand")


# ---- views -------------------------------------------------------------------------


@query(
    "calendar_view",
    """SELECT n_name AS code, r_name AS name_zh, year(o_orderdate) AS academic_year, o_orderkey AS event_id,
  strftime(o_orderdate, '%Y-%m-%d') AS start_date
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
)
def calendar_view(spark, sf):
    schools = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("university_id"), F.col("n_name").alias("code"), F.col("r_name").alias("name_zh")
    )
    events = school_programs(spark, sf).select(
        F.col("c_nationkey").alias("university_id"), F.year("o_orderdate").cast("long").alias("academic_year"),
        F.col("o_orderkey").alias("event_id"), F.col("o_orderdate").alias("start_date"),
    )
    return views.calendar_view(events, schools)


@query(
    "program_full",
    """WITH d AS (SELECT l_orderkey, max(l_quantity) AS tuition, max(l_returnflag) AS band FROM lineitem GROUP BY l_orderkey),
lb AS (SELECT s_nationkey, CASE WHEN s_acctbal < 3000 THEN 'A' WHEN s_acctbal < 6000 THEN 'N' ELSE 'R' END AS band_code,
       max(s_acctbal) AS ielts FROM supplier GROUP BY 1, 2)
SELECT o_orderkey AS program_id, n_name AS univ, o_orderstatus AS level, r_name AS faculty,
  coalesce(d.tuition, -1) AS tuition_intl, coalesce(CASE WHEN o_totalprice > 300000 THEN 7.0 END, lb.ielts, -1) AS ielts
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN d ON d.l_orderkey = o_orderkey
LEFT JOIN lb ON lb.s_nationkey = c_nationkey AND lb.band_code = d.band""",
)
def program_full(spark, sf):
    details = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("program_id")).agg(
        F.max("l_quantity").alias("tuition_intl"), F.max("l_returnflag").alias("language_band")
    )
    own = school_programs(spark, sf).select(
        F.col("o_orderkey").alias("program_id"), F.when(F.col("o_totalprice") > 300000, 7.0).alias("ielts_overall")
    )
    code = F.when(F.col("s_acctbal") < 3000, "A").when(F.col("s_acctbal") < 6000, "N").otherwise("R")
    bands = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("university_id"), code.alias("band_code")).agg(
        F.max("s_acctbal").alias("band_ielts")
    )
    nation = table(spark, sf, "nation")
    programs = school_programs(spark, sf).join(nation, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.col("o_orderkey").alias("program_id"), F.col("c_nationkey").alias("university_id"),
        F.col("n_regionkey").alias("faculty_id"), F.col("o_orderstatus").alias("level"),
    )
    schools = nation.select(F.col("n_nationkey").alias("university_id"), F.col("n_name").alias("univ"))
    faculties = table(spark, sf, "region").select(F.col("r_regionkey").alias("faculty_id"), F.col("r_name").alias("faculty"))
    out = views.program_full(programs, schools, faculties, own.join(details, "program_id", "left"), bands)
    return out.select(
        "program_id", "univ", "level", "faculty", F.coalesce("tuition_intl", F.lit(-1.0)).alias("tuition_intl"),
        F.coalesce("ielts", F.lit(-1.0)).alias("ielts"),
    )


@query(
    "bridge_view",
    """SELECT n_name AS univ, o_orderkey AS program_id, l_linenumber AS year_of_study, l_returnflag AS module_type,
  p_name AS module_name, l_quantity AS credits
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def bridge_view(spark, sf):
    members = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("program_id"), F.col("l_partkey").alias("module_id"), F.col("l_linenumber").alias("year_of_study"),
        F.col("l_returnflag").alias("module_type"), F.col("l_quantity").alias("credits"),
    )
    programs = school_programs(spark, sf).select(F.col("o_orderkey").alias("program_id"), F.col("c_nationkey").alias("university_id"))
    modules = table(spark, sf, "part").select(F.col("p_partkey").alias("module_id"), F.col("p_name").alias("module_name"))
    schools = table(spark, sf, "nation").select(F.col("n_nationkey").alias("university_id"), F.col("n_name").alias("univ"))
    return views.bridge_view(members, programs, modules, schools).drop("module_id", "university_id")


@query(
    "deadline_view",
    """SELECT e.event_id, coalesce(c_name, '(school)') AS program, event_type AS audience,
  strftime(ts, '%Y-%m-%d %H:%M') AS deadline_at
FROM events e LEFT JOIN customer ON c_custkey = user_id AND c_acctbal > 0
WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-10' + INTERVAL 90 DAY""",
)
def deadline_view(spark, sf):
    programs = table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("program_id"), F.col("c_name").alias("program"))
    deadlines = table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("program_id"), F.col("event_type").alias("audience"), F.col("ts").alias("deadline_at")
    )
    return views.deadline_view(deadlines, programs, F.lit("2024-01-10").cast("timestamp_ntz")).drop("program_id")


# ---- lookups -----------------------------------------------------------------------


@query(
    "null_safe_join",
    """WITH k AS (SELECT c_custkey, c_nationkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS seg FROM customer),
d AS (SELECT c_nationkey AS nk, seg AS dseg, count(*) AS n, max(c_custkey) AS top_id FROM k GROUP BY 1, 2)
SELECT c_custkey AS record_id, top_id AS deadline_id, n FROM k JOIN d
  ON c_nationkey = nk AND seg IS NOT DISTINCT FROM dseg""",
)
def null_safe_join(spark, sf):
    records = table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("seg")
    )
    stored = records.groupBy(F.col("c_nationkey").alias("nk"), F.col("seg").alias("dseg")).agg(
        F.count(F.lit(1)).alias("n"), F.max("c_custkey").alias("top_id")
    )
    match = (F.col("c_nationkey") == F.col("nk")) & F.col("seg").eqNullSafe(F.col("dseg"))
    return records.join(stored, match).select(
        F.col("c_custkey").alias("record_id"), F.col("top_id").alias("deadline_id"), "n"
    )


@query(
    "two_step_lookup",
    """WITH t AS (SELECT p_partkey AS id, p_type AS lvl, p_name AS nm, p_brand AS url FROM part),
r AS (SELECT DISTINCT l_orderkey AS rec, l_partkey, p_type AS lvl,
        CASE WHEN p_size > 25 THEN p_name || ' x' ELSE p_name END AS nm, p_brand AS url
      FROM lineitem JOIN part ON l_partkey = p_partkey),
a AS (SELECT lvl, nm, min(id) AS id1 FROM t GROUP BY 1, 2), b AS (SELECT lvl, url, min(id) AS id2 FROM t GROUP BY 1, 2)
SELECT rec AS record_id, l_partkey AS part_id, coalesce(id1, id2) AS id
FROM r LEFT JOIN a USING (lvl, nm) LEFT JOIN b USING (lvl, url)""",
)
def two_step_lookup(spark, sf):
    part = table(spark, sf, "part")
    target = part.select(
        F.col("p_partkey").alias("id"), F.col("p_type").alias("lvl"), F.col("p_name").alias("nm"), F.col("p_brand").alias("url")
    )
    name = F.when(F.col("p_size") > 25, F.concat("p_name", F.lit(" x"))).otherwise(F.col("p_name"))
    records = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").join(
        part, F.col("l_partkey") == F.col("p_partkey")
    ).select(
        F.col("l_orderkey").alias("record_id"), F.col("l_partkey").alias("part_id"), F.col("p_type").alias("lvl"),
        name.alias("nm"), F.col("p_brand").alias("url"),
    ).distinct()
    found = lookup.lookup_two_step(records, target, "id", ["lvl", "nm"], ["lvl", "url"])
    return found.select("record_id", "part_id", "id")


@query(
    "code_then_name_lookup",
    """WITH t AS (SELECT p_partkey AS id, p_brand AS sch, CASE WHEN p_size > 10 THEN p_type END AS code, p_name AS nm FROM part),
r AS (SELECT DISTINCT l_orderkey AS rec, p_brand AS sch, CASE WHEN p_retailprice > 950 THEN p_type END AS code, p_name AS nm
      FROM lineitem JOIN part ON l_partkey = p_partkey),
a AS (SELECT sch, code, min(id) AS id1 FROM t WHERE code IS NOT NULL GROUP BY 1, 2),
b AS (SELECT sch, nm, id AS id2 FROM t QUALIFY row_number() OVER (PARTITION BY sch, nm ORDER BY code IS NULL, id) = 1)
SELECT rec AS record_id, r.sch, coalesce(r.code, '-') AS code, r.nm,
  coalesce(CASE WHEN r.code IS NOT NULL THEN id1 ELSE id2 END, -1) AS id
FROM r LEFT JOIN a ON a.sch = r.sch AND a.code = r.code LEFT JOIN b ON b.sch = r.sch AND b.nm = r.nm""",
)
def code_then_name_lookup(spark, sf):
    part = table(spark, sf, "part")
    target = part.select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("sch"),
        F.when(F.col("p_size") > 10, F.col("p_type")).alias("code"), F.col("p_name").alias("nm"),
    )
    records = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").join(
        part, F.col("l_partkey") == F.col("p_partkey")
    ).select(
        F.col("l_orderkey").alias("record_id"), F.col("p_brand").alias("sch"),
        F.when(F.col("p_retailprice") > 950, F.col("p_type")).alias("code"), F.col("p_name").alias("nm"),
    ).distinct()
    found = lookup.lookup_code_or_name(records, target, "id", ["sch"], "code", "nm")
    return found.select("record_id", "sch", F.coalesce("code", F.lit("-")).alias("code"), "nm", F.coalesce("id", F.lit(-1)).alias("id"))


# ---- insert if absent ----------------------------------------------------------------


@query(
    "insert_if_absent",
    """SELECT p_brand AS school, p_type AS level, p_name AS name_en, min(p_partkey) AS id FROM part WHERE p_size > 25
AND NOT EXISTS (SELECT 1 FROM part q WHERE q.p_size <= 25 AND q.p_brand = part.p_brand AND q.p_type = part.p_type
  AND q.p_name = part.p_name) GROUP BY 1, 2, 3""",
)
def insert_if_absent(spark, sf):
    part = table(spark, sf, "part").select(
        F.col("p_brand").alias("school"), F.col("p_type").alias("level"), F.col("p_name").alias("name_en"),
        F.col("p_partkey").alias("id"), "p_size",
    )
    keys = ["school", "level", "name_en"]
    stored = part.filter("p_size <= 25").select(*keys)
    return merge.insert_if_absent(stored, part.filter("p_size > 25").drop("p_size"), keys, ["id"])


@query(
    "insert_ignore",
    """SELECT l_orderkey AS program_id, l_partkey AS module_id, l_linenumber AS year_of_study, l_returnflag AS module_type
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey
  ORDER BY l_linenumber, l_shipdate, l_suppkey, l_quantity, l_extendedprice, l_returnflag) = 1""",
)
def insert_ignore(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("program_id"), F.col("l_partkey").alias("module_id"),
        F.col("l_linenumber").alias("year_of_study"), F.col("l_returnflag").alias("module_type"),
        "l_shipdate", "l_suppkey", "l_quantity", "l_extendedprice",
    )
    order = ["year_of_study", "l_shipdate", "l_suppkey", "l_quantity", "l_extendedprice", "module_type"]
    return ordered.first_per_key(lines, ["program_id", "module_id"], order).select(
        "program_id", "module_id", "year_of_study", "module_type"
    )


# ---- hierarchy -----------------------------------------------------------------------


def unit_tree(spark, sf):
    """Region -> nation -> supplier as a parent tree with disjoint numbers."""
    region = table(spark, sf, "region").select((F.col("r_regionkey") + 1).cast("long").alias("id"), F.lit(None).cast("long").alias("parent_id"))
    nation = table(spark, sf, "nation").select(
        (F.col("n_nationkey") + 100).cast("long").alias("id"), (F.col("n_regionkey") + 1).cast("long").alias("parent_id")
    )
    supplier = table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 1000).alias("id"), (F.col("s_nationkey") + 100).cast("long").alias("parent_id")
    )
    return region.unionByName(nation).unionByName(supplier)


TREE_SQL = """tree AS (SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, CAST(NULL AS BIGINT) AS parent_id FROM region
  UNION ALL SELECT n_nationkey + 100, n_regionkey + 1 FROM nation
  UNION ALL SELECT s_suppkey + 1000, s_nationkey + 100 FROM supplier),
up AS (SELECT id, id AS top_id FROM tree WHERE parent_id IS NULL
  UNION ALL SELECT t.id, u.top_id FROM tree t JOIN up u ON t.parent_id = u.id)"""


@query("top_ancestor", f"WITH RECURSIVE {TREE_SQL} SELECT id, top_id FROM up")
def top_ancestor(spark, sf):
    return lookup.top_ancestors(unit_tree(spark, sf))


@query(
    "faculty_cards",
    f"""WITH RECURSIVE {TREE_SQL},
p AS (SELECT coalesce(top_id, 0) AS top_id, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS n_first FROM orders
  JOIN customer ON o_custkey = c_custkey
  LEFT JOIN up ON up.id = CASE WHEN o_orderpriority <> '5-LOW' THEN c_nationkey + 100 END GROUP BY 1),
m AS (SELECT top_id, count(*) AS n_modules FROM lineitem JOIN up ON up.id = l_suppkey + 1000 GROUP BY 1)
SELECT coalesce(p.top_id, m.top_id) AS top_id, coalesce(n, 0) AS n, coalesce(n_first, 0) AS n_first,
  coalesce(n_modules, 0) AS n_modules, coalesce(n, 0) - coalesce(n_first, 0) AS n_other
FROM p FULL JOIN m ON p.top_id = m.top_id""",
)
def faculty_cards(spark, sf):
    programs = school_programs(spark, sf).select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("c_nationkey") + 100).cast("long").alias("unit"),
        F.col("o_orderstatus").alias("level"),
    )
    modules = table(spark, sf, "lineitem").select((F.col("l_suppkey") + 1000).alias("unit"))
    return rollup.unit_cards(unit_tree(spark, sf), programs, modules, "unit", "level", "F")


@query(
    "department_cards",
    """SELECT coalesce(CASE WHEN o_orderpriority <> '5-LOW' THEN c_nationkey + 100 END, 0) AS unit, count(*) AS n,
  count(*) FILTER (o_orderstatus = 'F') AS n_first, count(*) FILTER (o_orderstatus <> 'F') AS n_other
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def department_cards(spark, sf):
    programs = school_programs(spark, sf).select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("c_nationkey") + 100).alias("unit"),
        F.col("o_orderstatus").alias("level"),
    )
    return rollup.department_cards(programs, "unit", "level", "F")


@query(
    "inverse_lookup",
    """SELECT l_partkey AS module_id, l_orderkey AS program_id, min(l_returnflag) AS module_type,
  any_value(n_programs) AS n_programs
FROM lineitem JOIN (SELECT l_partkey AS pk, count(DISTINCT l_orderkey) AS n_programs FROM lineitem GROUP BY 1) ON pk = l_partkey
GROUP BY l_partkey, l_orderkey""",
)
def inverse_lookup(spark, sf):
    members = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("module_id"), F.col("l_orderkey").alias("program_id"), F.col("l_returnflag").alias("module_type")
    )
    return views.programs_of_modules(members)


@query(
    "unit_module_union",
    """SELECT DISTINCT unit, module_id FROM (
  SELECT c_nationkey AS unit, l_partkey AS module_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
  UNION ALL SELECT s_nationkey, l_partkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)""",
)
def unit_module_union(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    members = lines.select(F.col("l_orderkey").alias("program_id"), F.col("l_partkey").alias("module_id"))
    programs = school_programs(spark, sf).select(F.col("o_orderkey").alias("program_id"), F.col("c_nationkey").alias("unit"))
    modules = lines.select("l_suppkey", "l_partkey").distinct().join(
        table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    ).select(F.col("s_nationkey").alias("unit"), F.col("l_partkey").alias("module_id"))
    return views.unit_modules(members, programs, modules)


# ---- names ---------------------------------------------------------------------------


@query(
    "alias_override",
    """WITH al(brand, official) AS (VALUES ('Brand#1', 'School of Tools'), ('Brand#2', 'School of Rings'), ('Brand#3', 'School of Tools')),
ov(nm, official) AS (VALUES ('red ring', 'Institute of Red Rings')), zh(official, name_zh) AS (VALUES ('School of Tools', '工具学院'))
SELECT p_partkey AS program_id, coalesce(ov.official, al.official, CASE WHEN p_type <> 'PROMO' THEN p_brand END,
   trim(split_part('Note | ' || p_type, '|', 2))) AS faculty,
  coalesce(zh.name_zh, '-') AS faculty_zh
FROM part LEFT JOIN ov ON ov.nm = p_name LEFT JOIN al ON al.brand = p_brand AND p_type <> 'PROMO'
LEFT JOIN zh ON zh.official = coalesce(ov.official, al.official, CASE WHEN p_type <> 'PROMO' THEN p_brand END,
   trim(split_part('Note | ' || p_type, '|', 2)))""",
)
def alias_override(spark, sf):
    alias = spark.createDataFrame(
        [("Brand#1", "School of Tools"), ("Brand#2", "School of Rings"), ("Brand#3", "School of Tools")], "dept string, official string"
    )
    override = spark.createDataFrame([("red ring", "Institute of Red Rings")], "slug string, forced string")
    chinese = spark.createDataFrame([("School of Tools", "工具学院")], "faculty string, faculty_zh string")
    programs = table(spark, sf, "part").select(
        F.col("p_partkey").alias("program_id"), F.col("p_name").alias("slug"),
        F.when(F.col("p_type") != "PROMO", F.col("p_brand")).alias("dept"), F.concat(F.lit("Note | "), "p_type").alias("note"),
    )
    from catalodge.plans.entities import resolve_faculty

    return resolve_faculty(programs, override, alias, chinese).select(
        "program_id", "faculty", F.coalesce("faculty_zh", F.lit("-")).alias("faculty_zh")
    )


OFFICIAL = ("School of Ring", "School of Rings and Plates", "School of Bolt", "School of Bolts", "School of Gear")


def official_names(spark):
    return lookup.name_lists(
        spark.createDataFrame([("x", n, i) for i, n in enumerate(OFFICIAL)], "school string, name string, position int"),
        ["school"], "name",
    )


@query(
    "longest_name_match",
    """WITH n(nm) AS (VALUES ('School of Ring'), ('School of Rings and Plates'), ('School of Bolt'), ('School of Bolts'), ('School of Gear')),
t AS (SELECT p_partkey, lower(replace('Taught by the School of ' || split_part(p_name, ' ', 2) ||
   CASE p_type WHEN 'PROMO' THEN 's' WHEN 'SMALL' THEN 's and plates' ELSE '' END || ' since ' || p_size, ' and ', ' & ')) AS txt FROM part)
SELECT p_partkey AS program_id, nm AS faculty FROM t JOIN n
  ON regexp_matches(txt, lower(replace(nm, ' and ', ' & ')) || '([^a-z]|$)')
QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY length(nm) DESC, nm) = 1""",
)
def longest_name_match(spark, sf):
    suffix = F.when(F.col("p_type") == "PROMO", "s").when(F.col("p_type") == "SMALL", "s and plates").otherwise("")
    body = F.concat(
        F.lit("Taught by the School of "), F.split_part("p_name", F.lit(" "), F.lit(2)), suffix, F.lit(" since "),
        F.col("p_size").cast("string"),
    )
    pages = table(spark, sf, "part").select(F.col("p_partkey").alias("program_id"), F.when(F.col("p_partkey").isNotNull(), "x").alias("school"), body.alias("txt"))
    found = pages.join(official_names(spark), "school").select(
        "program_id", lookup.longest_name_in(F.col("txt"), F.col("names")).alias("faculty")
    )
    return found.filter(F.col("faculty").isNotNull())


@query(
    "canonical_mention",
    """WITH n(nm, pos) AS (VALUES ('School of Ring', 0), ('School of Rings and Plates', 1), ('School of Bolt', 2), ('School of Bolts', 3), ('School of Gear', 4)),
t AS (SELECT p_partkey, regexp_extract_all('School of Xyz 7. School of ' || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] ||
   CASE p_type WHEN 'SMALL' THEN 's and Plates' ELSE '' END || ' 5. School of Gear', 'School of [A-Z][A-Za-z &]{3,70}') AS ms FROM part),
m AS (SELECT p_partkey, i, trim(lower(replace(ms[i], ' and ', ' & '))) AS mm FROM t, unnest(generate_series(1, len(ms))) AS g(i))
SELECT p_partkey AS program_id, nm AS faculty FROM m JOIN n ON starts_with(mm, lower(replace(nm, ' and ', ' & ')))
QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY i, pos) = 1""",
)
def canonical_mention(spark, sf):
    noun = F.initcap(F.split_part("p_name", F.lit(" "), F.lit(2)))
    body = F.concat(
        F.lit("School of Xyz 7. School of "), noun, F.when(F.col("p_type") == "SMALL", "s and Plates").otherwise(""),
        F.lit(" 5. School of Gear"),
    )
    names = lookup.name_lists(
        spark.createDataFrame([("x", n, i) for i, n in enumerate(OFFICIAL)], "school string, name string, position int"),
        ["school"], "name", longest_first=False,
    )
    pages = table(spark, sf, "part").select(F.col("p_partkey").alias("program_id"), F.when(F.col("p_partkey").isNotNull(), "x").alias("school"), body.alias("txt"))
    mention = F.lit("School of [A-Z][A-Za-z &]{3,70}")
    return pages.join(names, "school").select(
        "program_id", lookup.canonical_mention(F.col("txt"), mention, F.col("names")).alias("faculty")
    ).filter(F.col("faculty").isNotNull())


@query(
    "ci_key_groups",
    """SELECT lower(strip_accents(rtrim(w))) AS word_key, count(*) AS n FROM (
  SELECT unnest(string_split(text, ' ')) AS w FROM documents) WHERE w <> '' GROUP BY 1""",
)
def ci_key_groups(spark, sf):
    words = table(spark, sf, "documents").select(F.explode(F.split("text", " ")).alias("w"))
    return words.filter(F.col("w") != "").groupBy(text.ci_key(F.col("w")).alias("word_key")).agg(F.count(F.lit(1)).alias("n"))
