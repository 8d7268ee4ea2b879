"""Scalar functions bound to columns of the bench tables, partly composed into the texts they read."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalodge.functions import dates, fees, labels, rules, text, translate, urls
from catalodge.operators import registry
from catalodge.queries.registry import dealt, query, table


def nz(column, default="-"):
    return F.coalesce(column, F.lit(default))


def iso(column):
    return nz(F.date_format(column, "yyyy-MM-dd"))


# ---- text ---------------------------------------------------------------------------


@query(
    "text_basics",
    r"""SELECT doc_id, length(trim(regexp_replace(text, '[\s]+', ' ', 'g'))) AS n_norm,
  md5(trim(regexp_replace(text, '[\s]+', ' ', 'g'))) AS digest, CASE WHEN length(text) > 64 THEN left(text, 63) || '…' ELSE text END AS cut
FROM documents""",
)
def text_basics(spark, sf):
    clean = text.norm_ws(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.char_length(clean).cast("long").alias("n_norm"), F.md5(clean.cast("binary")).alias("digest"),
        text.truncate(F.col("text"), 64).alias("cut"),
    )


@query(
    "loose_neq",
    """WITH x AS (SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, CASE l_returnflag WHEN 'A' THEN CAST(l_quantity AS VARCHAR) WHEN 'N' THEN l_linestatus END AS a,
  CASE l_linestatus WHEN 'O' THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.00' ELSE ' F ' END AS b FROM lineitem)
SELECT a IS NULL AS a_missing, count(*) AS n, count(*) FILTER (CASE WHEN a IS NULL OR b IS NULL THEN (a IS NULL) <> (b IS NULL)
   WHEN TRY_CAST(a AS DOUBLE) IS NOT NULL AND TRY_CAST(b AS DOUBLE) IS NOT NULL THEN TRY_CAST(a AS DOUBLE) <> TRY_CAST(b AS DOUBLE)
   ELSE trim(a) <> trim(b) END) AS n_different FROM x GROUP BY 1""",
)
def loose_neq(spark, sf):
    a = F.when(F.col("l_returnflag") == "A", F.col("l_quantity").cast("string")).when(
        F.col("l_returnflag") == "N", F.col("l_linestatus")
    )
    b = F.when(F.col("l_linestatus") == "O", F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".00"))).otherwise(" F ")
    rows = table(spark, sf, "lineitem").select(a.alias("a"), b.alias("b"))
    return rows.groupBy(F.col("a").isNull().alias("a_missing")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(text.differs(F.col("a"), F.col("b"))).alias("n_different")
    )


@query(
    "note_cleanup",
    """WITH n AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'HTTP 500 timeout' WHEN 'signup' THEN '处理异常，待下轮重试' WHEN 'click' THEN 'Faculty of X' END AS note FROM events)
SELECT event_id, coalesce(CASE WHEN note LIKE '%失败%' OR note LIKE '%Cloudflare%' OR note LIKE '%待重试%' OR note LIKE '%待下轮%' OR note LIKE '%timeout%' OR note LIKE '%异常%'
  THEN NULL ELSE note END, '-') AS note FROM n""",
)
def note_cleanup(spark, sf):
    kind = F.col("event_type")
    note = F.when(kind == "error", "HTTP 500 timeout").when(kind == "signup", "处理异常，待下轮重试").when(kind == "click", "Faculty of X")
    return table(spark, sf, "events").select("event_id", nz(text.clean_failure_note(note)).alias("note"))


@query(
    "first_pick",
    r"""SELECT p_partkey AS id, trim(coalesce(nullif(regexp_extract(t, 'duration:? *(\w+ years?)', 1, 'i'), ''), nullif(regexp_extract(t, '(\d+) (?:months|weeks)', 1), ''), '-')) AS duration,
  CASE WHEN p_type = 'PROMO' THEN p_brand ELSE p_name END AS picked
FROM (SELECT *, CASE WHEN p_size > 25 THEN 'x Duration: ' || p_size || ' years' WHEN p_size > 10 THEN 'takes ' || p_size || ' months' ELSE p_name END AS t FROM part)""",
)
def first_pick(spark, sf):
    size = F.col("p_size").cast("string")
    body = F.when(F.col("p_size") > 25, F.concat(F.lit("x Duration: "), size, F.lit(" years"))).when(
        F.col("p_size") > 10, F.concat(F.lit("takes "), size, F.lit(" months"))
    ).otherwise(F.col("p_name"))
    pairs = F.when(
        F.col("p_type") == "PROMO", F.create_map(F.lit("ucas code"), F.col("p_brand"), F.lit("x"), F.col("p_name"))
    ).otherwise(F.create_map(F.lit("other"), F.lit("no"), F.lit("the ucas code (short)"), F.col("p_name")))
    found = text.first_match(body, r"duration:? *(\w+ years?)", r"(\d+) (?:months|weeks)")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), nz(found).alias("duration"), text.pick(pairs, ["UCAS code"]).alias("picked")
    )


@query(
    "text_window",
    r"""SELECT doc_id, trim(regexp_replace(CASE WHEN p > 0 THEN substr(text, CAST(greatest(p - 1 - 50, 0) + 1 AS BIGINT), CAST(p - 1 + 50 - greatest(p - 1 - 50, 0) AS BIGINT)) ELSE '' END, '[\s]+', ' ', 'g')) AS around
FROM (SELECT *, strpos(text, ' of ') AS p FROM documents)""",
)
def text_window(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.window_around(F.col("text"), F.lit(" of "), 50).alias("around")
    )


@query(
    "band_code",
    r"""SELECT doc_id, coalesce('band-' || upper(nullif(regexp_extract(text || ' needs Band ' || lang[1], '\bBand\s+([A-E])\b', 1, 'i'), '')), '-') AS band FROM documents""",
)
def band_code(spark, sf):
    body = F.concat("text", F.lit(" needs Band "), F.substring("lang", 1, 1))
    return table(spark, sf, "documents").select("doc_id", nz(rules.band(body)).alias("band"))


@query(
    "entry_year",
    r"""SELECT page_id, coalesce(nullif(regexp_extract(url || '/courses-20' || lpad(CAST(page_id % 100 AS VARCHAR), 2, '0') || '/x', '/courses-(20\d{2})/', 1), ''), '2026') AS from_path,
  coalesce(nullif(regexp_extract(url, '/(20\d{2})/', 1), ''), '2026') AS plain FROM pages""",
)
def entry_year(spark, sf):
    from catalodge.plans.extraction import year_from

    composed = F.concat(F.col("url"), F.lit("/courses-20"), F.lpad((F.col("page_id") % 100).cast("string"), 2, "0"), F.lit("/x"))
    return table(spark, sf, "pages").select(
        "page_id", year_from(composed, F.lit(r"/courses-(20\d{2})/"), F.lit("2026")).alias("from_path"),
        year_from(F.col("url"), F.lit(r"/(20\d{2})/"), F.lit("2026")).alias("plain"),
    )


@query(
    "dept_trim",
    r"""WITH t AS (SELECT p_partkey, regexp_extract('In the Department of ' || upper(p_name[1]) || p_name[2:] || CASE p_type WHEN 'PROMO' THEN ' was ranked' WHEN 'SMALL' THEN ' and' WHEN 'LARGE' THEN ' and develop' ELSE '' END || '. 5',
  '\b(Birmingham Business School|School of [A-Z][A-Za-z &,-]{3,80}|Department of [A-Z][A-Za-z &,-]{3,80})\b', 1) AS m FROM part)
SELECT p_partkey AS id, regexp_replace(trim(regexp_replace(m, '(,| (was|is|are|has|have|means|covers|enjoys|examines|stretches|offers|provides|at the|and (develop|work|clinical)|student-run|ranked|based)\b).*$', '')), '\s+(and|in|to|of|the)$', '') AS dept FROM t""",
)
def dept_trim(spark, sf):
    from catalodge.plans.extraction import trimmed_department

    tail = F.when(F.col("p_type") == "PROMO", " was ranked").when(F.col("p_type") == "SMALL", " and").when(
        F.col("p_type") == "LARGE", " and develop"
    ).otherwise("")
    name = F.concat(F.upper(F.substring("p_name", 1, 1)), F.substring("p_name", 2, 100))
    body = F.concat(F.lit("In the Department of "), name, tail, F.lit(". 5"))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), trimmed_department(body).alias("dept"))


@query(
    "code_level",
    r"""SELECT p_partkey AS id, upper(replace(p_name, ' ', '')) || p_size AS code, 'L' || left(CAST(p_size AS VARCHAR), 1) AS level FROM part""",
)
def code_level(spark, sf):
    from catalodge.plans.extraction import clean_code, level_digit

    code = F.concat("p_name", F.col("p_size").cast("string"))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), clean_code(code).alias("code"), level_digit(clean_code(code)).alias("level")
    )


# ---- dates and amounts -----------------------------------------------------------------


@query(
    "money_extract",
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN -1.0 ELSE round(o_totalprice, 2) END AS fee FROM orders""",
)
def money_extract(spark, sf):
    amount = F.format_number(F.round("o_totalprice", 2), 2)
    body = F.when(F.col("o_orderstatus") == "P", "no fee here").otherwise(F.concat(F.lit("Full-time fee: £ "), amount, F.lit(" per year")))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.coalesce(dates.money(body), F.lit(-1.0)).alias("fee")
    )


@query(
    "date_parse",
    """SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '5-LOW' THEN '-' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
)
def date_parse(spark, sf):
    priority = F.col("o_orderpriority")
    day = F.col("o_orderdate")
    body = (
        F.when(priority == "1-URGENT", F.date_format(day, "d MMMM yyyy"))
        .when(priority == "2-HIGH", F.date_format(day, "dd MMM yyyy"))
        .when(priority == "3-MEDIUM", F.date_format(day, "MMMM d, yyyy"))
        .when(priority == "5-LOW", F.concat(F.date_format(day, "d MMMM"), F.lit(" soon")))
        .otherwise(F.date_format(day, "dd/MM/yyyy"))
    )
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), iso(dates.parse_date(body)).alias("day"))


@query(
    "date_range",
    """SELECT id, strftime(d, '%Y-%m-%d') AS start_date, strftime(CASE WHEN o_orderstatus = 'P' THEN d ELSE d + INTERVAL 11 DAY END, '%Y-%m-%d') AS end_date
FROM (SELECT o_orderkey AS id, o_orderstatus, o_orderdate + INTERVAL 10 YEAR AS d FROM orders)""",
)
def date_range(spark, sf):
    # Only years from 2000 on count as dates in a range, so the order dates move by ten years.
    start = F.add_months(F.col("o_orderdate").cast("date"), 120)
    end = F.date_add(start, 11)
    same_year = F.year(start) == F.year(end)
    opening = F.when(same_year, F.date_format(start, "EEEE d MMMM")).otherwise(F.date_format(start, "EEEE d MMMM yyyy"))
    body = F.when(F.col("o_orderstatus") == "P", F.date_format(start, "d'th' MMMM yyyy")).when(
        F.col("o_orderstatus") == "O", F.concat(opening, F.lit(" – "), F.date_format(end, "EEEE d MMMM yyyy"))
    ).otherwise(F.concat_ws(" and then (maybe) ", F.date_format(start, "d MMMM yyyy"), F.date_format(end, "d MMMM yyyy")))
    found = dates.date_range(body)
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), iso(found["start"]).alias("start_date"), iso(found["end"]).alias("end_date")
    )


@query(
    "academic_year",
    """SELECT o_orderkey AS id, CAST(y AS VARCHAR) || '/' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') AS academic_year
FROM (SELECT o_orderkey, year(o_orderdate) - CASE WHEN month(o_orderdate) >= 9 THEN 0 ELSE 1 END AS y FROM orders)""",
)
def academic_year(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), dates.academic_year(F.col("o_orderdate")).alias("academic_year")
    )


@query(
    "fee_near",
    """SELECT o_orderkey AS id, CASE WHEN v BETWEEN 3500 AND 70000 THEN v ELSE -1.0 END AS fee
FROM (SELECT *, CAST(floor(o_totalprice / 5) AS DOUBLE) AS v FROM orders)""",
)
def fee_near(spark, sf):
    amount = F.concat(F.lit("£"), F.format_number(F.floor(F.col("o_totalprice") / 5), 0))
    status = F.col("o_orderstatus")
    body = (
        F.when(status == "P", F.concat(F.lit("International students\n"), amount, F.lit(" scholarships for international students")))
        .when(status == "O", F.concat(F.lit("Fees\nInternational & EU\nFull-time fee:\n"), amount))
        .otherwise(F.concat(F.lit("The fee is\n"), amount, F.lit("\nfor all\nOverseas students")))
    )
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.coalesce(
            F.when(status == "F", fees.fee_near(F.concat(F.lit("Overseas students\n"), body), F.array(*[F.lit(x) for x in rules.FEE_INTL_LABELS]))).otherwise(
                fees.fee_near(body, F.array(*[F.lit(x) for x in rules.FEE_INTL_LABELS]))
            ),
            F.lit(-1.0),
        ).alias("fee"),
    )


@query(
    "score_minmax",
    """SELECT p_partkey AS id, CASE p_type WHEN 'PROMO' THEN -1.0 WHEN 'SMALL' THEN CAST(4 + p_size % 6 AS DOUBLE) ELSE greatest(a, b) END AS overall,
  CASE WHEN p_type IN ('PROMO', 'SMALL') OR a = b THEN -1.0 ELSE least(a, b) END AS minimum
FROM (SELECT *, 4 + p_size % 5 + 0.5 AS a, CAST(4 + p_size % 3 AS DOUBLE) + CASE WHEN p_size > 25 THEN 0.5 ELSE 0 END AS b FROM part)""",
)
def score_minmax(spark, sf):
    size = F.col("p_size")
    a = F.concat((4 + size % 5).cast("string"), F.lit(".5"))
    b = F.concat((4 + size % 3).cast("string"), F.when(size > 25, ".5").otherwise(".0"))
    body = (
        F.when(F.col("p_type") == "PROMO", "Course lasts 4 years")
        .when(F.col("p_type") == "SMALL", F.concat(F.lit("IELTS "), (4 + size % 6).cast("string"), F.lit(" please, lasts 3 years")))
        .otherwise(F.concat(F.lit("IELTS "), a, F.lit(" overall with "), b, F.lit(" in each. Course lasts 4 years.")))
    )
    found = rules.ielts(body)
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.coalesce(found["overall"], F.lit(-1.0)).alias("overall"),
        F.coalesce(found["minimum"], F.lit(-1.0)).alias("minimum"),
    )


# ---- rules -------------------------------------------------------------------------------

@query(
    "event_type_rules",
    """WITH n AS (SELECT o_orderkey, o_orderdate, CASE o_orderpriority WHEN '1-URGENT' THEN 'Orientation / academic year' WHEN '2-HIGH' THEN 'Revision and exam weeks'
  WHEN '3-MEDIUM' THEN 'University closed' WHEN '4-NOT SPECIFIED' THEN 'Resit exam' ELSE 'Semester ' || o_orderstatus END AS name FROM orders)
SELECT o_orderkey AS id, CASE WHEN name LIKE 'Orient%' THEN 'welcome_week' WHEN name LIKE 'Revision%' THEN CASE WHEN month(o_orderdate) IN (7, 8) THEN 'resit_period' ELSE 'exam_period' END
  WHEN name LIKE '%closed' THEN 'closure' WHEN name LIKE 'Resit%' THEN 'resit_period' ELSE 'teaching_period' END AS event_type FROM n""",
)
def event_type_rules(spark, sf):
    priority = F.col("o_orderpriority")
    name = (
        F.when(priority == "1-URGENT", "Orientation / academic year").when(priority == "2-HIGH", "Revision and exam weeks")
        .when(priority == "3-MEDIUM", "University closed").when(priority == "4-NOT SPECIFIED", "Resit exam")
        .otherwise(F.concat(F.lit("Semester "), F.col("o_orderstatus")))
    )
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), rules.event_type(name, F.col("o_orderdate")).alias("event_type")
    )


@query(
    "level_rules",
    """SELECT p_partkey AS id, CASE p_type WHEN 'PROMO' THEN 'PGR' WHEN 'SMALL' THEN 'PGT' WHEN 'LARGE' THEN 'UG' ELSE 'UG' END AS by_name,
  CASE WHEN p_size >= 10 THEN 'PGR' WHEN p_size = 9 THEN 'PGT' WHEN p_type = 'PROMO' THEN 'PGT' ELSE 'UG' END AS by_aqf FROM part""",
)
def level_rules(spark, sf):
    from catalodge.plans.extraction import level_from_aqf, level_from_name

    kind = F.col("p_type")
    name = (
        F.when(kind == "PROMO", F.concat(F.lit("Doctor of "), "p_name")).when(kind == "SMALL", F.concat(F.lit("Master of "), "p_name"))
        .when(kind == "LARGE", F.concat(F.lit("Bachelor ("), F.lit("Honours) of "), "p_name")).otherwise(F.col("p_name"))
    )
    aqf = F.concat(F.lit("Level "), F.col("p_size").cast("string"), F.when(kind == "PROMO", " Graduate Diploma").otherwise(" Award"))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), level_from_name(name).alias("by_name"), level_from_aqf(aqf).alias("by_aqf")
    )


@query(
    "response_class",
    """SELECT page_id, CASE WHEN contains(left(html, 4096), 'Thheouble') THEN 'cloudflare' WHEN page_id % 10 = 1 THEN 'cloudflare' WHEN page_id % 10 = 2 THEN 'dead' WHEN url LIKE '%#top' THEN 'moved' WHEN page_id % 10 = 3 THEN 'transient' WHEN page_id % 10 = 4 THEN 'error' ELSE 'ok' END AS kind FROM pages""",
)
def response_class(spark, sf):
    last = F.col("page_id") % 10
    status = F.when(last == 1, 429).when(last == 2, 404).when(last == 3, 503).when(last == 4, 403).otherwise(200)
    head = F.substring("html", 1, 4096)
    # The stored pages hold no bot check; one of their words stands for its marker.
    head = F.replace(head, F.lit("Thheouble"), F.lit("Just a moment"))
    kind = rules.response_kind(status, head, F.col("url").contains("#top"), F.lit("html"))
    return table(spark, sf, "pages").select("page_id", kind.alias("kind"))


# ---- urls ----------------------------------------------------------------------------------


@query(
    "url_normalise",
    """SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host,
  regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || rtrim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') || '/' AS clean,
  regexp_replace(url, '#.*$', '') AS no_fragment, coalesce(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), ''), '-') AS page_no FROM pages""",
)
def url_normalise(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", urls.host(url).alias("host"), urls.clean_url(url).alias("clean"),
        urls.without_fragment(url).alias("no_fragment"), nz(urls.query_value(url, "page")).alias("page_no"),
    )


@query(
    "same_page",
    """SELECT regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www\\.', '') || rtrim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/')
  || coalesce('?' || nullif(regexp_extract(url, '\\?([^#]*)', 1), ''), '') AS page_key, count(*) AS n FROM pages GROUP BY 1""",
)
def same_page(spark, sf):
    return registry.count_by(table(spark, sf, "pages").select(urls.same_page_key(F.col("url")).alias("page_key")), "page_key")


@query(
    "unwrap_redirect",
    """SELECT page_id, CASE WHEN url LIKE '%/en/%' THEN regexp_replace(url, '#.*$', '') ELSE 'https://other.example/x' END AS target FROM pages""",
)
def unwrap_redirect(spark, sf):
    wrapped = F.concat(F.lit("https://find.funnelback.example/s/redirect?a=1&url="), F.url_encode("url"), F.lit("&rank=2"))
    link = F.when(F.col("url").contains("/en/"), wrapped).otherwise("https://other.example/x#frag")
    return table(spark, sf, "pages").select("page_id", urls.unwrap_redirect(link).alias("target"))


@query(
    "slug",
    """WITH p AS (SELECT page_id, trim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') AS path, regexp_extract(url, '\\?([^#]*)', 1) AS q FROM pages)
SELECT page_id, right(regexp_replace(replace(CASE WHEN path = '' THEN 'index' ELSE path END, '/', '__'), '[^A-Za-z0-9._-]+', '-', 'g') ||
  CASE WHEN q = '' THEN '' ELSE '_' || left(regexp_replace(q, '[^A-Za-z0-9]+', '-', 'g'), 60) END, 160) AS slug, regexp_extract(path, '([^/]*)$', 1) AS last_segment FROM p""",
)
def slug(spark, sf):
    url = F.col("url")
    path_only = F.regexp_replace(urls.without_fragment(url), r"\?.*$", "")
    return table(spark, sf, "pages").select(
        "page_id", urls.snapshot_slug(url).alias("slug"), urls.last_segment(path_only).alias("last_segment")
    )


@query(
    "next_page_urls",
    """SELECT c_custkey AS seed_id, 'https://s.example/rest?firstResult=' || o || '&numberOfResults=200' AS url
FROM customer, unnest(range(200, CAST(greatest(c_acctbal, 0) AS BIGINT), 200)) AS t(o)""",
)
def next_page_urls(spark, sf):
    from catalodge.sources.feeds import next_offset_urls

    total = F.greatest(F.col("c_acctbal"), F.lit(0.0))
    total = F.round(total, 0).cast("int")
    found = next_offset_urls(F.lit("https://s.example/rest?firstResult=0&numberOfResults=200"), total)
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("seed_id"), F.explode(found).alias("url"))


# ---- labels and translations -----------------------------------------------------------------


@query(
    "money_format",
    """SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN '£' WHEN 'O' THEN 'A$' ELSE 'NZD ' END || format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS amount FROM orders""",
)
def money_format(spark, sf):
    currency = F.when(F.col("o_orderstatus") == "F", "GBP").when(F.col("o_orderstatus") == "O", "AUD").otherwise("NZD")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), labels.money_text(F.floor("o_totalprice"), currency).alias("amount")
    )


@query(
    "days_left",
    """SELECT event_id, d AS days, CASE WHEN d < 0 THEN 'past' WHEN d <= 10 THEN 'soon' ELSE 'open' END AS state FROM (
 SELECT event_id, CAST(ceil((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15 12:00:00')) / 86400000000.0) AS INTEGER) AS d FROM events)""",
)
def days_left(spark, sf):
    as_of = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    days = labels.days_left(F.col("ts"), as_of)
    state = labels.deadline_state(F.when(days > 10, days + 30).otherwise(days))
    return table(spark, sf, "events").select("event_id", days.alias("days"), state.alias("state"))


@query(
    "label_maps",
    """SELECT CASE o_orderstatus WHEN 'F' THEN '本科' WHEN 'O' THEN '授课硕士' ELSE 'P' END AS level, count(*) AS n,
 CASE WHEN o_orderstatus = 'F' THEN '✓ 已核实' ELSE '未核实' END AS badge FROM orders GROUP BY 1, 3""",
)
def label_maps(spark, sf):
    code = F.when(F.col("o_orderstatus") == "F", "UG").when(F.col("o_orderstatus") == "O", "PGT").otherwise(F.col("o_orderstatus"))
    return table(spark, sf, "orders").groupBy(
        labels.label(code, labels.LEVEL).alias("level"), labels.verified_badge(F.col("o_orderstatus") == "F").alias("badge")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "phrase_translate",
    """SELECT p_partkey AS id, CASE p_type WHEN 'PROMO' THEN '第' || p_size % 10 || '学期 开始' WHEN 'SMALL' THEN '春假 T' || p_size % 10 WHEN 'LARGE' THEN '-' ELSE '公共假期 ' || upper(p_name) END AS zh FROM part""",
)
def phrase_translate(spark, sf):
    kind, size = F.col("p_type"), (F.col("p_size") % 10).cast("string")
    name = (
        F.when(kind == "PROMO", F.concat(F.lit("Semester "), size, F.lit("  begins")))
        .when(kind == "SMALL", F.concat(F.lit("Spring teaching vacation t"), size))
        .when(kind == "LARGE", F.concat(F.lit("Grand opening of the "), "p_name"))
        .otherwise(F.concat(F.lit("Bank Holiday "), F.upper("p_name")))
    )
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), nz(translate.calendar_zh(name)).alias("zh"))


@query(
    "degree_split",
    """SELECT p_partkey AS id, CASE p_type WHEN 'PROMO' THEN 'MSc' WHEN 'SMALL' THEN 'BA / BSc' ELSE '-' END AS suffix,
  upper(split_part(p_name, ' ', 1)[1]) || split_part(p_name, ' ', 1)[2:] || ' ' || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] AS body,
  CASE p_type WHEN 'PROMO' THEN '深度学习 MSc' WHEN 'SMALL' THEN '深度学习 BA / BSc' ELSE '深度学习' END AS zh FROM part""",
)
def degree_split(spark, sf):
    kind = F.col("p_type")
    name = F.concat(F.upper("p_name"), F.when(kind == "PROMO", " MSc").when(kind == "SMALL", " BA / BSc").otherwise(""))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), nz(text.blank_to_null(translate.degree_suffix(name))).alias("suffix"),
        translate.translatable_body(name).alias("body"),
        translate.finish_translation(name, F.lit("，深层学习硕士学位。")).alias("zh"),
    )


@query(
    "label_translate",
    """SELECT p_partkey AS id, CASE p_type WHEN 'PROMO' THEN 'COMP' || lpad(CAST(p_size AS VARCHAR), 4, '0') || ' 或 MATH1081' WHEN 'SMALL' THEN p_size % 10 || '级 通识教育' WHEN 'LARGE' THEN '自由选修 和 毕业论文' ELSE '-' END AS zh,
  CASE p_type WHEN 'PROMO' THEN 'Aerospace Engineering · T1 2026 入学' ELSE 'Corporate Finance · T' || (1 + p_size % 3) || ' 2027 入学' END AS variant,
  CASE p_type WHEN 'PROMO' THEN '航空航天工程 · T1 2026 入学' ELSE '金融 · T' || (1 + p_size % 3) || ' 2027 入学' END AS variant_zh FROM part""",
)
def label_translate(spark, sf):
    kind = F.col("p_type")
    item = (
        F.when(kind == "PROMO", F.concat(F.lit("COMP"), F.lpad(F.col("p_size").cast("string"), 4, "0"), F.lit(" or MATH1081")))
        .when(kind == "SMALL", F.concat(F.lit("Level "), (F.col("p_size") % 10).cast("string"), F.lit(" General Education")))
        .when(kind == "LARGE", "Free Electives and Thesis").otherwise(F.col("p_name"))
    )
    url = F.when(
        kind == "PROMO",
        "https://x/dam/pdfs/3707%20-%20Bachelor%20Engineering%20(Honours)%20-%20Aerospace%20Engineering%20-%20AEROAH%20-%20T1%202026%20Start.pdf",
    ).otherwise(F.concat(F.lit("https://x/dam/pdfs/3502__corporate%20finance__FINSA1__T"), (1 + F.col("p_size") % 3).cast("string"), F.lit("%202027.pdf")))
    label = translate.plan_variant_label(url)
    return dealt(table(spark, sf, "part")).select(
        F.col("p_partkey").alias("id"), nz(translate.plan_label_zh(item)).alias("zh"), label.alias("variant"),
        translate.plan_variant_zh(label).alias("variant_zh"),
    )
