"""Extraction jobs: pages joined with rule tables give typed records.

Rules are data. A job joins the rule rows of a page's (school, category) to the
page, evaluates one expression per rule and folds the small results back into
one record per page. The page text is made once per page and never shuffled;
only extracted values are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from catalodge.functions import dates, fees, rules, urls
from catalodge.functions.text import blank_to_null, let, norm_ws, window_around
from catalodge.operators import closure, lookup, ordered
from catalodge.plans import site_rules
from catalodge.sources import elements, feeds, html
from catalodge.session import by_page, materialize
from catalodge.sources.config import DEFAULT_ENTRY_YEAR

# ---- small expressions shared by the jobs --------------------------------------------


def extract(text: Column, pattern: Column, group: int = 1) -> Column:
    """Capture group of a pattern that comes from a column; NULL when nothing or '' is found."""
    return blank_to_null(F.call_function("regexp_extract", text, pattern, F.lit(group)))


def year_from(source: Column, pattern: Column, default: Column) -> Column:
    return F.coalesce(extract(source, pattern), default)


def clean_code(code: Column) -> Column:
    return F.upper(F.regexp_replace(code, r"[\s-]+", ""))


def level_digit(code: Column) -> Column:
    """'L1' from the first digit behind the letters of a module code."""
    digit = blank_to_null(F.regexp_extract(code, r"[A-Za-z]+([0-9])", 1))
    return F.concat(F.lit("L"), digit)


def level_from_name(name: Column) -> Column:
    """UG, PGT or PGR from the wording of a programme name."""
    n = F.lower(name)
    research = rules.contains_any(n, ("doctor", "phd", "mphil"))
    taught = rules.contains_any(n, ("master", "graduate certificate", "graduate diploma", "postgraduate"))
    return F.when(research, "PGR").when(n.contains("(honours)"), "UG").when(taught, "PGT").otherwise("UG")


def level_from_aqf(label: Column) -> Column:
    """Level from a qualification-framework label such as 'Level 9 - Masters Degree'."""
    n = F.regexp_extract(label, r"Level\s+([0-9]+)", 1).try_cast("int")
    taught = (n == 9) | F.lower(label).contains("graduate")
    return F.when(n.isNull(), None).when(n >= 10, "PGR").when(taught, "PGT").otherwise("UG")


# Fixed value: department mentions.
DEPARTMENT_RE = (
    r"\b(Birmingham Business School|School of [A-Z][A-Za-z &,\-]{3,80}|Department of [A-Z][A-Za-z &,\-]{3,80})\b"
)
# Fixed value: where a department mention turns into a sentence.
SENTENCE_RE = (
    r"(,| (was|is|are|has|have|means|covers|enjoys|examines|stretches|offers|provides|at the"
    r"|and (develop|work|clinical)|student-run|ranked|based)\b).*$"
)


def trimmed_department(text: Column) -> Column:
    """First department mention, cut where a sentence goes on; NULL unless 8 to 60 characters are left."""
    name = norm_ws(F.regexp_extract(text, DEPARTMENT_RE, 1))
    name = F.trim(F.regexp_replace(name, SENTENCE_RE, ""))
    name = F.regexp_replace(name, r"\s+(and|in|to|of|the)$", "")
    return F.when(F.char_length(name).between(8, 60), name)


# ---- rule tables ------------------------------------------------------------------------


def discovery_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(site_rules.discovery_rows()), site_rules.DISCOVERY_SCHEMA)


def field_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(site_rules.field_rows()), site_rules.FIELD_SCHEMA)


def deadline_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(site_rules.DEADLINES, site_rules.DEADLINE_SCHEMA)


def module_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(site_rules.MODULE_RULES, site_rules.MODULE_SCHEMA)


def check_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(site_rules.CHECKS, site_rules.CHECK_SCHEMA)


def with_rules(pages: DataFrame, rules_table: DataFrame, *keep: str, shape: bool = False) -> DataFrame:
    """Pages (page_id, school, category, url, kept columns) with each rule of their school and category.

    A rule table is configuration of a few hundred short rows. It is named as the side to
    broadcast: by estimated sizes Spark may take the pages, all of which one task then sends.
    With ``shape``, rules may restrict themselves to URLs by page_re / page_not_re.
    """
    columns = ["page_id", "school", "category", "url", *keep]
    out = pages.select(*columns).join(F.broadcast(rules_table), ["school", "category"])
    if shape:
        fits = F.col("page_re").isNull() | F.regexp_like(F.col("url"), F.col("page_re"))
        if "page_not_re" in rules_table.columns:
            fits = fits & (F.col("page_not_re").isNull() | ~F.regexp_like(F.col("url"), F.col("page_not_re")))
        out = out.filter(fits)
    return out


def prepared(pages: DataFrame) -> DataFrame:
    """Pages with valid ``html``, their ``text`` and the parts many rules read, each made once per page.

    What a job does not use is pruned from its plan.
    """
    page = F.col("html")
    return pages.withColumn("html", html.page_string(page)).withColumns(
        {
            "text": html.page_text(page),
            "h1": html.first_heading(page),
            "og_title": html.meta_content(page, "og:title", by="property"),
            "title": html.document_title(page),
            "pairs": html.pairs(page),
        }
    )


# ---- X1, X5: discovered pages ---------------------------------------------------------------

OPTION_RE = r"(?is)<option[^>]*\bvalue\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)(?=</option|<option|</select|\z)"
CANDIDATE = "array<struct<value:string,url:string,label:string,note:string>>"


# Kinds of rules that look at the same parts of a page. Pages are read for the kinds that their rules have.
KINDS = (("link", "next", "numbered", "full", "option"), ("loc", "index"), ("match", "self"), ("json", "indexed", "offset"))
# Kinds whose candidates need not match the rule's pattern once more.
SURE = ("match", "next", "self", "json", "numbered", "full", "indexed", "offset")


def _entry(value: Column, url: Column | None = None, label: Column | None = None, note: Column | None = None) -> Column:
    nothing = F.lit(None).cast("string")
    parts = {"value": value, "url": url, "label": label, "note": note}
    return F.struct(*[(nothing if part is None else part).alias(name) for name, part in parts.items()])


def _from_links(base: Column) -> dict[str, Column]:
    """Candidates of rules that look at the links in the elements of a rule, or at those of a whole page."""
    anchors = F.flatten("scope_links")

    def of_scope(scope: Column, found: Column) -> Column:
        found = F.when(F.col("first_only"), F.slice(found, 1, 1)).otherwise(found)
        note = F.when(
            F.col("note_re").isNotNull(), html.inner_text(F.coalesce(extract(scope, F.col("note_re")), F.lit("")))
        )
        return F.transform(found, lambda a: _entry(a["url"], a["url"], a["text"], blank_to_null(note)))

    marked = F.filter(anchors, lambda a: F.regexp_like(a["tag"], F.col("target_re")))
    targets = F.transform("scope_urls", lambda u: F.call_function("regexp_extract", u, F.col("target_re"), F.lit(1)))
    n_targets = F.size(F.array_distinct(F.filter(targets, lambda t: t != "")))
    number = lambda u: F.regexp_extract(u, r"[?&]page=(\d+)", 1)
    return {
        "link": F.flatten(F.zip_with("scopes", "scope_links", of_scope)),
        "next": F.transform(marked, lambda a: _entry(a["url"], a["url"], a["text"])),
        "numbered": F.transform(
            feeds.numbered_page_urls(F.col("scope_urls")), lambda u: _entry(u, u, number(u))
        ),
        "full": _single(feeds.next_full_page_url(base, n_targets, F.col("page_size")), number),
    }


def _single(url: Column, number: Callable[[Column], Column]) -> Column:
    return F.filter(F.array(let(url, lambda u: _entry(u, u, number(u)))), lambda e: e["url"].isNotNull())


def _from_sitemaps(page: Column) -> dict[str, Column]:
    locs = F.transform(F.array_distinct(feeds.sitemap_locs(page)), lambda u: _entry(u, u))
    is_index = feeds.is_sitemap_index(page)
    return {"loc": F.when(~is_index, locs), "index": F.when(is_index, locs)}


def _from_options() -> dict[str, Column]:
    part = lambda o, group: F.regexp_extract(o, OPTION_RE, group)
    of_scope = lambda scope: F.transform(
        html.all_matches(scope, OPTION_RE), lambda o: _entry(html.unescape(part(o, 1)), label=html.inner_text(part(o, 2)))
    )
    return {"option": F.flatten(F.transform("scopes", of_scope))}


def _from_text(base: Column) -> dict[str, Column]:
    of_scope = lambda scope: F.transform(
        F.array_distinct(F.regexp_extract_all(scope, F.col("target_re"), F.lit(1))), lambda m: _entry(m, label=m)
    )
    own = F.array(_entry(F.call_function("regexp_extract", base, F.col("target_re"), F.lit(1))))
    return {"match": F.flatten(F.transform("scopes", of_scope)), "self": F.filter(own, lambda e: e["value"] != "")}


def _from_json(page: Column, base: Column) -> dict[str, Column]:
    def of_item(item: Column) -> Column:
        value = F.call_function("regexp_extract", feeds.item_text(item, F.col("value_field")), F.col("target_re"), F.lit(1))
        label = norm_ws(F.try_element_at(item, F.col("label_field")).try_cast("string"))
        return let(value, lambda v: F.when(v != "", _entry(v, label=let(label, lambda t: F.when(t != "", t).otherwise(v)))))

    # Items without the field and without the part that stands in for it give no entry.
    named = lambda item: F.map_contains_key(item, F.col("value_field")) | F.map_contains_key(item, F.lit("raw"))
    n_items = F.coalesce(feeds.json_count(page), F.lit(0))
    total = F.coalesce(F.get_json_object(page, "$.totalCount").try_cast("int"), F.lit(0))
    return {
        "json": F.filter(F.transform(F.filter(feeds.json_items(page), named), of_item), lambda e: e.isNotNull()),
        "indexed": _single(feeds.next_index_url(base, n_items, F.col("page_size")), lambda u: F.regexp_extract(u, r"PageIndex=(\d+)", 1)),
        "offset": F.transform(feeds.next_offset_urls(base, total), lambda u: _entry(u, u)),
    }


def _candidates(ruled: DataFrame, kinds: set[str]) -> DataFrame:
    """Pages with rules of one group of kinds, one row for each link-like thing: pos, c (value, url, label, note)."""
    page, base, source = F.col("html"), F.col("url"), F.col("source")
    # Rules that look for text cut it by a pattern, the others take the elements with such an opening tag.
    if kinds & {"match"}:
        by_text = F.regexp_extract_all(page, F.col("scope_re"), F.lit(0))
        ruled = ruled.withColumn("scopes", F.when(F.col("scope_re").isNull(), F.array(page)).otherwise(by_text))
    elif kinds & set(KINDS[0]):
        ruled = ruled.withColumn("scopes", elements.scopes(page, F.col("scope_re")))
    if kinds & set(KINDS[0]):
        # The links of a rule's elements are cut once; several kinds of rules look at them.
        # Rules for numbered and full pages look at URLs alone.
        cut = F.transform("scopes", lambda scope: html.links(scope, base))
        ruled = ruled.withColumn("scope_links", F.when(source.isin("link", "next"), cut))
        own = F.flatten(F.transform("scopes", lambda scope: html.link_urls(scope, base)))
        ruled = ruled.withColumn("scope_urls", F.when(source.isin("numbered", "full"), own))
        made = _from_links(base) | _from_options()
    elif kinds & {"loc", "index"}:
        made = _from_sitemaps(page)
    elif kinds & {"match", "self"}:
        made = _from_text(base)
    else:
        made = _from_json(page, base)
    chosen = None
    for kind in sorted(kinds):
        chosen = F.when(source == kind, made[kind]) if chosen is None else chosen.when(source == kind, made[kind])
    return ruled.select(
        "page_id", "school", "rule_no", "source", "target_re", "exclude_re", "to_category", "template", "careers", "fixed_title",
        "crawl_freq", "fetch_method", "clean", "unwrap", "canon", "suffix", "carry", F.col("url").alias("page_url"),
        F.posexplode(F.coalesce(chosen, F.array().cast(CANDIDATE))).alias("pos", "c"),
    )


def _page_url(career: Column) -> Column:
    """URL of a found page from the columns of its candidate and rule."""

    def by_template() -> Column:
        made = F.col("template")
        for mark, filler in (
            ("{1}", F.col("value")), ("{value}", F.url_encode("value")), ("{raw}", F.col("value")),
            ("{label}", F.url_encode(F.coalesce("c.label", F.lit("")))), ("{career}", career),
        ):
            made = F.replace(made, F.lit(mark), filler)
        return made

    def step(flag: Column, change: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda plain: let(plain, lambda p: F.when(flag, change(p)).otherwise(p))

    def tagged(plain: Column) -> Column:
        page = F.col("page_url")
        carried = F.coalesce(urls.query_value(page, "uaDept"), urls.query_value(page, "pgDdesc"), F.col("c.label"), F.lit(""))
        return F.concat(plain, F.when(plain.contains("?"), "&").otherwise("?"), F.col("carry"), F.lit("="), F.url_encode(carried))

    own = F.when(F.col("clean"), urls.clean_url(F.col("value"))).otherwise(F.col("value"))
    plain = F.when(F.col("template").isNull(), own).otherwise(F.coalesce(by_template(), own))
    plain = step(F.col("canon").isNotNull(), lambda p: urls.canonical_course(p, "courses.leeds.ac.uk"))(plain)
    plain = step(F.col("suffix").isNotNull(), lambda p: F.concat(F.rtrim(p, F.lit("/")), F.lit("/"), F.col("suffix")))(plain)
    return step(F.col("carry").isNotNull(), tagged)(plain)


def _concerned(pages: DataFrame, shapes: list[Row]) -> DataFrame:
    """The pages of the school and category of any of the rules: what else there is need not be read for them.

    As a filter rather than a join it is done before pages are put together, and where they are read.
    """
    any_of = F.lit(False)
    for school, category in sorted({(row["school"], row["category"]) for row in shapes if None not in (row["school"], row["category"])}):
        any_of = any_of | ((F.col("school") == school) & (F.col("category") == category))
    return pages.filter(any_of)


def discover(pages: DataFrame, rules_table: DataFrame) -> DataFrame:
    """Pages found on catalogue pages: school, url, category, title, note, crawl_freq, fetch_method, page_id.

    Within a page each URL counts once, at its first position. Links to the page itself are dropped.
    """
    pages = pages.withColumn("html", html.page_string(F.col("html")))
    shapes = rules_table.select("source", "school", "category").distinct().collect()
    present = {row["source"] for row in shapes}
    found = None
    for group in KINDS:
        kinds = present & set(group)
        if kinds:
            own = _concerned(pages, [row for row in shapes if row["source"] in kinds])
            ruled = with_rules(own, rules_table.filter(F.col("source").isin(*kinds)), "html", shape=True)
            part = _candidates(ruled, kinds)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = _candidates(with_rules(pages, rules_table, "html", shape=True), {"self"})
    value = F.col("c.value")
    value = F.when(F.col("unwrap"), urls.unwrap_redirect(value)).otherwise(value)
    found = found.withColumn("value", value)
    matched = F.col("source").isin(*SURE) | F.regexp_like(F.col("value"), F.col("target_re"))
    excluded = F.coalesce(F.regexp_like(F.col("value"), F.col("exclude_re")), F.lit(False))
    found = found.filter(matched & ~excluded)
    # Each row's URLs are made once: what a generator gives is not copied into the filters above it.
    made = F.transform(F.coalesce("careers", F.array(F.lit(""))), lambda career: F.struct(career.alias("career"), _page_url(career).alias("url")))
    found = found.withColumn("made", F.explode(made)).withColumns({"career": F.col("made.career"), "url": F.col("made.url")})
    found = found.filter(F.rtrim("url", F.lit("/")) != F.rtrim("page_url", F.lit("/")))
    title = F.coalesce(F.replace("fixed_title", F.lit("{label}"), F.coalesce("c.label", F.lit(""))), blank_to_null(F.col("c.label")))
    rows = found.select(
        "page_id", "school", "url", F.col("to_category").alias("category"), title.alias("title"), F.col("c.note").alias("note"),
        "crawl_freq", "fetch_method", F.struct("rule_no", "pos", "career").alias("place"),
    )
    return ordered.first_per_key(by_page(rows, pages), ["page_id", "url"], ["place"]).drop("place")


def page_closure(pages: DataFrame, rules_table: DataFrame, seeds: DataFrame) -> DataFrame:
    """All pages that seeds lead to over stored pages: url, round, page_id (NULL where no page is stored).

    Index, list, next page, detail: every stored page is cut once into its links, then only
    links are followed. ``seeds`` has a column url.
    """
    links = discover(pages, rules_table).select("page_id", F.col("url").alias("to"))
    stored = pages.select(F.col("url").alias("from"), "page_id")
    edges = materialize(links.join(stored, "page_id").select("from", "to"), "page-links")
    found = closure.reachable(seeds.select(F.col("url").alias("node")), edges, "from", "to")
    known = stored.groupBy("from").agg(F.min("page_id").alias("page_id"))
    return found.join(known, found["node"] == known["from"], "left").select(F.col("node").alias("url"), "round", "page_id")


# ---- X3, X7: fields of detail pages -------------------------------------------------------------


def _field_value(has_names: bool) -> Column:
    page, text, url = F.col("html"), F.col("text"), F.col("url")
    pattern, args, source = F.col("pattern"), F.col("args"), F.col("source")
    first, second = F.get(args, F.lit(0)), F.get(args, F.lit(1))
    nothing = F.lit(None).cast("string")

    def shaped(value: Column) -> Column:
        cased = F.when(second == "upper", F.upper(value)).when(second == "lower", F.lower(value)).otherwise(value)
        return F.concat(F.coalesce(first, F.lit("")), cased)

    def flag(subject: Column) -> Column:
        return F.when(F.regexp_like(subject, pattern), first).otherwise(second)

    content = F.concat(F.lit("$.props.pageProps.pageContent."), pattern)
    block = F.regexp_extract(page, feeds.NEXT_DATA_RE, 1)
    meta_tag = F.call_function(
        "regexp_extract", page, F.concat(F.lit("(?is)<meta\\b[^>]*\\bname\\s*=\\s*[\"']"), pattern, F.lit("[\"'][^>]*>")), F.lit(0)
    )
    pair_value = F.try_element_at(F.col("pairs"), pattern)

    def picked(pairs: Column) -> Column:
        exact = F.get(F.filter(F.transform(args, lambda a: F.try_element_at(pairs, a)), lambda v: v.isNotNull()), F.lit(0))
        near = F.map_filter(pairs, lambda k, _v: F.exists(args, lambda a: F.contains(k, a)))
        return F.coalesce(exact, F.get(F.map_values(near), F.lit(0)))

    limit = F.coalesce(F.get(args, F.lit(1)).try_cast("int"), F.lit(800))
    cases = [
        ("text", shaped(norm_ws(extract(text, pattern)))),
        ("text_raw", extract(text, pattern)),
        ("raw", norm_ws(html.unescape(extract(page, pattern)))),
        ("raw_text", let(html.page_text(extract(page, pattern)), lambda t: F.coalesce(F.left(t, first.try_cast("int")), t))),
        ("url", extract(url, pattern)),
        ("h1", F.col("h1")),
        ("h1_part", extract(F.col("h1"), pattern)),
        ("tail", html.tail_of(F.col("title"))),
        ("document", F.regexp_replace(F.col("title"), F.coalesce(pattern, F.lit("(?!)")), F.lit(""))),
        ("title", html.pick_title(F.col("h1"), F.col("og_title"), F.col("title"), F.coalesce(args, F.array().cast("array<string>")), pattern)),
        ("meta", F.trim(html.attribute(meta_tag, "content"))),
        ("pair", pair_value),
        ("pick", picked(F.col("pairs"))),
        ("next", F.call_function("get_json_object", block, content)),
        ("next_flag", F.when(F.contains(F.call_function("get_json_object", block, content), first), second).otherwise(F.get(args, F.lit(2)))),
        ("ld", F.regexp_replace(feeds.ld_json_names(page, ("Study", "The University of Queensland")), pattern, F.lit(""))),
        ("url_flag", flag(url)),
        ("pair_flag", F.when(F.regexp_like(F.coalesce(pair_value, F.lit("")), first), second).otherwise(F.get(args, F.lit(2)))),
        ("text_flag", let(extract(text, pattern), lambda v: F.when(v == first, second).when(v.isNotNull(), F.get(args, F.lit(2))))),
        ("fee", fees.fee_near(text, args).cast("string")),
        ("section", F.left(html.section_text(page, pattern, first), limit)),
        ("department", trimmed_department(text)),
        ("const", pattern),
    ]
    if has_names:
        cases += [
            ("name", lookup.longest_name_in(text, F.col("names"))),
            ("mention", lookup.canonical_mention(text, pattern, F.array_sort(F.col("names"), lambda a, b: a["position"] - b["position"]))),
        ]
    chain = None
    for name, value in cases:
        chain = F.when(source == name, value) if chain is None else chain.when(source == name, value)
    return blank_to_null(chain.otherwise(nothing))


def extract_fields(pages: DataFrame, rules_table: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """(page_id, school, category, url, fields): field -> value of the first rule that found one.

    ``pages`` come from ``prepared``. Only the found values are shuffled, never a page.
    """
    source = pages
    keep = ["html", "text", "h1", "og_title", "title", "pairs"]
    if names is not None:
        # Official names are configuration: a few dozen for each school.
        source = pages.join(F.broadcast(names), "school", "left")
        keep.append("names")
    ruled = with_rules(source, rules_table, *keep)
    late = F.when(F.col("source").isin("name_flag", "name_level"), F.struct("source", "pattern", "args"))
    values = ruled.select(
        "page_id", "school", "category", "url", "field", "rank", late.alias("late"), _field_value(names is not None).alias("value")
    )
    found = by_page(values, pages).groupBy("page_id", "school", "category", "url", "field").agg(
        F.min_by("value", F.when(F.col("value").isNotNull(), F.col("rank"))).alias("value"),
        F.min_by("late", F.when(F.col("late").isNotNull(), F.col("rank"))).alias("late"),
    )
    # A page has a few dozen fields at most: the number of rules of its school.
    return found.groupBy("page_id", "school", "category", "url").agg(
        F.map_from_entries(F.collect_list(F.struct("field", F.coalesce("value", F.lit("")).alias("value")))).alias("fields"),
        F.max("late").alias("late"),
    )


def _field(name: str) -> Column:
    return blank_to_null(F.try_element_at(F.col("fields"), F.lit(name)))


def _number(name: str) -> Column:
    return F.replace(_field(name), F.lit(","), F.lit("")).try_cast("double")


def program_records(pages: DataFrame, rules_table: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """One programme per detail page that has a name; the rest shows up in ``field_notes``."""
    fields = extract_fields(pages.filter(F.col("category") == site_rules.DETAIL), rules_table, names)
    scores = pages.select("page_id", rules.ielts(F.col("text")).alias("scores"))
    # Both sides have a row for each page: neither is broadcast, however small its estimate.
    base = fields.join(scores.hint("merge"), "page_id")
    title = _field("name_en")
    code = _field("code")
    named = F.coalesce(
        F.concat(_field("code_prefix"), F.lit(" - "), title), F.concat(title, F.lit(" ("), code, F.lit(")")), title
    )
    late = F.col("late")
    by_name = F.when(
        late["source"] == "name_flag",
        F.when(F.regexp_like(title, late["pattern"]), F.get(late["args"], F.lit(0))).otherwise(F.get(late["args"], F.lit(1))),
    ).when(late["source"] == "name_level", level_from_name(title))
    level = F.coalesce(_field("level"), by_name, level_from_aqf(_field("aqf")))
    duration = F.coalesce(
        _field("duration"), F.concat(_field("years"), F.lit(" years full-time")), F.concat_ws(" ", _field("duration_n"), _field("duration_unit"))
    )
    wants_scores = F.col("school").isin(*sorted({s for (s, c), e in site_rules.FIELDS.items() if any(f[0] == "ielts" for f in e)}))
    year = F.substring(F.coalesce(_field("entry_year"), _field("fee_year_label"), F.lit(DEFAULT_ENTRY_YEAR)), 1, 4)
    return base.filter(title.isNotNull()).select(
        "page_id", "school", "url", named.alias("name_en"), level.alias("level"), year.alias("entry_year"),
        _field("ucas_code").alias("ucas_code"), blank_to_null(duration).alias("duration"), _field("campus").alias("campus"),
        _field("faculty").alias("faculty"), _field("dept").alias("dept"), _number("tuition_home").alias("tuition_home"),
        _number("tuition_intl").alias("tuition_intl"), F.coalesce(_field("currency"), F.lit("GBP")).alias("currency"),
        _field("fee_year_label").alias("fee_year_label"), _field("entry_req_text").alias("entry_req_text"),
        _field("language_band").alias("language_band"),
        F.coalesce(_number("ielts_overall"), F.when(wants_scores, F.col("scores.overall"))).alias("ielts_overall"),
        F.coalesce(_number("ielts_min_each"), F.when(wants_scores, F.col("scores.minimum"))).alias("ielts_min_each"),
        dates.parse_date(_field("app_open_date")).alias("app_open_date"), F.lit(False).alias("backfill_only"),
        F.filter(
            F.array(F.when(_field("tuition_intl").isNull() & (level == "PGT"), F.lit("no international fee"))), lambda n: n.isNotNull()
        ).alias("notes"),
    )


def assessments(text: Column) -> Column:
    """array<struct<weight, type>> from 'NN% ... type' lines, repeated entries once."""
    pattern = r"\n([0-9]{1,3})%\s*\n?([A-Z][^\n%]{2,60})"
    found = F.transform(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda m: F.struct(
            F.regexp_extract(m, pattern, 1).cast("int").alias("weight"), F.trim(F.regexp_extract(m, pattern, 2)).alias("type")
        ),
    )

    def key(a: Column) -> Column:
        return F.struct(a["weight"].alias("w"), F.lower(a["type"]).alias("t"))

    def first_of_key(items: Column) -> Column:
        return let(
            F.transform(items, key), lambda keys: F.filter(items, lambda a, i: F.array_position(keys, key(a)) == i + 1)
        )

    return let(found, first_of_key)


COURSE_ASSESSMENTS = "array<struct<assessments: array<struct<assessment_name: string, weighting: string, assessment_type: struct<label: string>>>>>"


def embedded_assessments(page: Column) -> Column:
    """array<struct<weight, type>> from the assessment groups of an embedded page object."""
    block = F.regexp_extract(page, feeds.NEXT_DATA_RE, 1)
    groups = F.from_json(F.get_json_object(block, "$.props.pageProps.pageContent.hb_assessments"), COURSE_ASSESSMENTS)
    items = F.filter(F.flatten(F.transform(groups, lambda g: g["assessments"])), lambda a: norm_ws(a["assessment_name"]) != "")
    return F.array_distinct(
        F.transform(
            items, lambda a: F.struct(F.trim(a["weighting"]).try_cast("int").alias("weight"), a["assessment_type"]["label"].alias("type"))
        )
    )


def module_records(pages: DataFrame, rules_table: DataFrame) -> DataFrame:
    """One module per module page that has a name."""
    fields = extract_fields(pages.filter(F.col("category") == site_rules.MODULES), rules_table)
    embedded = let(embedded_assessments(F.col("html")), lambda a: F.when(F.size(a) > 0, a))
    listed = F.coalesce(embedded, assessments(F.col("text")))
    extra = pages.select("page_id", listed.alias("assessment"))
    code = clean_code(_field("code"))
    level = F.coalesce(_field("level"), F.concat(F.lit("L"), _field("level_no")), F.when(F.col("school").isin("monash", "unsw", "anu"), level_digit(code)))
    # Both sides have a row for each page: neither is broadcast, however small its estimate.
    return fields.join(extra.hint("merge"), "page_id").filter(_field("name_en").isNotNull()).select(
        "page_id", "school", "url", _field("name_en").alias("name_en"), code.alias("code"),
        _field("credits").try_cast("int").alias("credits"), level.alias("level"), _field("semester").alias("semester"),
        _field("leader").alias("leader"), _field("prerequisites").alias("prerequisites"), _field("dept").alias("dept"),
        _field("description").alias("description"), "assessment",
    )


# ---- X4, X6: module references and lists ----------------------------------------------------------


def module_links(pages: DataFrame, rules_table: DataFrame) -> DataFrame:
    """Modules a page names: page_id, school, pos, name, code, url, module_type; first per code or name."""
    pages = pages.withColumn("html", html.page_string(F.col("html")))
    parts = [
        _linked_modules(with_rules(pages, rules_table.filter(F.col("source").isin("link", "next_cell")), "html", shape=True)),
        _item_modules(with_rules(pages, rules_table.filter("source = 'items'"), "html", shape=True)),
        _column_modules(with_rules(pages, rules_table.filter("source = 'columns'"), "html", shape=True)),
        *[_section_modules(pages, *rule) for rule in site_rules.SECTION_MODULES],
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    found = found.filter(F.col("name") != "").withColumn("key", F.coalesce("code", F.lower("name")))
    return ordered.first_per_key(by_page(found, pages), ["page_id", "key"], ["pos"]).drop("key")


MODULE_ENTRY = ["page_id", "school", "pos", "name", "code", "url", "module_type"]


def _code_in(value: Column) -> Column:
    return F.when(F.col("code_re").isNotNull(), extract(value, F.col("code_re")))


def _linked_modules(ruled: DataFrame) -> DataFrame:
    """Links whose URL fits, in the elements of a rule; or links in table cells with the name in the next cell."""
    nothing = F.lit(None).cast("string")

    def entry(name: Column, code: Column, url: Column, kind: Column) -> Column:
        return F.struct(
            norm_ws(name).alias("name"), F.upper(F.regexp_replace(blank_to_null(code), "-", "")).alias("code"), url.alias("url"), kind.alias("module_type")
        )

    def linked(scope: Column) -> Column:
        fits = F.filter(
            html.links(scope, F.col("url")),
            lambda a: F.regexp_like(a["url"], F.col("pattern"))
            & ~F.coalesce(F.regexp_like(a["tag"], F.col("exclude_tag_re")), F.lit(False)),
        )
        return F.transform(
            fits,
            lambda a: let(
                _code_in(a["url"]),
                lambda code: entry(F.coalesce(blank_to_null(a["text"]), code), code, a["url"], F.col("module_type")),
            ),
        )

    def behind_link(row: Column) -> Column:
        at = F.array_position(F.transform(row["cell_html"], lambda c: F.regexp_like(c, F.col("pattern"))), F.lit(True)).cast("int")
        link = F.get(html.links(F.get(row["cell_html"], at - 1), F.col("url")), F.lit(0))
        code = F.coalesce(_code_in(link["text"]), _code_in(link["url"]))
        return F.when(at > 0, entry(F.get(row["cells"], at), code, link["url"], F.col("module_type")))

    by_link = ruled.filter("source = 'link'").withColumn("scopes", elements.scopes(F.col("html"), F.col("scope_re")))
    links = by_link.select("page_id", "school", F.posexplode(F.flatten(F.transform("scopes", linked))).alias("pos", "m"))
    rows = F.flatten(F.transform(elements.tables(F.col("html")), lambda t: t["rows"]))
    listed = F.filter(F.transform(rows, behind_link), lambda e: e.isNotNull() & e["code"].isNotNull())
    cells = ruled.filter("source = 'next_cell'").select("page_id", "school", F.posexplode(listed).alias("pos", "m"))
    return links.unionByName(cells).select("page_id", "school", "pos", "m.*").withColumn("url", F.coalesce("url", nothing)).select(*MODULE_ENTRY)


ITEM = r"^(.{3,120}?)\s*\((\d{1,3})\s*[Cc]redits?\)$"


def _item_modules(ruled: DataFrame) -> DataFrame:
    """List items that read exactly 'name (N credits)': optional where the nearest heading above says so, else core."""
    found = elements.under_marks(
        ruled, "page_id", "school", tags=("li",), marks=("h3", "h4", "h5", "strong"),
        values={"name": lambda e: let(html.inner_text(e["body"]), lambda t: blank_to_null(F.trim(F.regexp_extract(t, ITEM, 1))))},
    )
    kind = F.when(F.lower("above").contains("optional"), "optional").otherwise("core")
    nothing = F.lit(None).cast("string")
    return found.filter(F.col("name").isNotNull()).select(
        "page_id", "school", "pos", "name", nothing.alias("code"), nothing.alias("url"), kind.alias("module_type")
    )


def _column_modules(ruled: DataFrame) -> DataFrame:
    """Rows of tables with the headers of a rule: name and code by column, whichever place the columns have."""
    rows = elements.page_cells(ruled, "page_id", "school", "pattern", "code_re")
    headers = F.split("pattern", r"\|")
    at = rows.withColumns(
        {
            "name_at": elements.column_of(F.col("columns"), F.get(headers, F.lit(0))),
            "code_at": elements.column_of(F.col("columns"), F.get(headers, F.lit(1))),
        }
    ).filter(~F.col("is_header") & F.col("name_at").isNotNull() & F.col("code_at").isNotNull() & (F.size("cells") >= 2))
    title, code = F.get("grid", F.col("name_at")), F.get("grid", F.col("code_at"))
    mandatory = F.lower(F.element_at("cells", -1)).contains("mandatory")
    return at.select(
        "page_id", "school", (F.col("table_no") * 1_000_000 + F.col("row_no")).alias("pos"),
        F.trim(F.regexp_replace(title, F.col("code_re"), F.lit(""))).alias("name"),
        F.coalesce(extract(code, F.col("code_re")), extract(title, F.col("code_re"))).alias("code"),
        F.lit(None).cast("string").alias("url"), F.when(mandatory, "core").otherwise("optional").alias("module_type"),
    )


def _section_modules(
    pages: DataFrame, school: str, heading_re: str, limit: int, pieces_re: str | None, item_re: str, skip_re: str | None
) -> DataFrame:
    """Modules named in the running text of a section of a school's programme pages."""
    own = pages.filter((F.col("school") == school) & (F.col("category") == site_rules.DETAIL))
    area = F.coalesce(html.section_text(F.col("html"), F.lit(heading_re), F.lit(None).cast("string"), limit), F.lit(""))
    pieces = F.array(area) if pieces_re is None else F.transform(F.split(area, pieces_re), norm_ws)
    names = F.flatten(F.transform(pieces, lambda p: F.regexp_extract_all(p, F.lit(item_re), F.lit(1))))
    found = own.select("page_id", "school", F.posexplode(names).alias("pos", "name")).withColumn("name", norm_ws(F.col("name")))
    if skip_re is not None:
        found = found.filter(~F.col("name").rlike(skip_re))
    nothing = F.lit(None).cast("string")
    return found.select("page_id", "school", "pos", "name", nothing.alias("code"), nothing.alias("url"), F.lit("core").alias("module_type"))


def article_modules(pages: DataFrame) -> DataFrame:
    """Modules of lists with one article each, named by the nearest heading above: page_id, school, pos, url, name, code, level, credits, dept, semester."""
    out = None
    for school, page_re, headings, tail_re, fields in site_rules.ARTICLE_MODULES:
        own = pages.filter((F.col("school") == school) & (F.col("category") == site_rules.MODULES) & F.col("url").rlike(page_re))

        def first_of(pattern: str) -> Callable[[Column], Column]:
            return lambda e: let(html.page_text(e["body"]), lambda t: blank_to_null(norm_ws(F.regexp_extract(t, pattern, 1))))

        found = elements.under_marks(
            own, "page_id", "school", "url", tags=("article",), marks=headings, values={name: first_of(p) for name, p in fields.items()}
        )
        rows = found.select(
            "page_id", "school", "pos", "url", norm_ws(F.regexp_replace("above", tail_re, "")).alias("name"), "code",
            F.concat(F.lit("Level "), "level").alias("level"), F.col("credits").try_cast("int").alias("credits"), "dept", "semester",
        ).filter(F.col("code").isNotNull() & (F.col("name") != ""))
        out = rows if out is None else out.unionByName(rows)
    return out


UNIT_ROW_CELLS = 7


def unit_table_modules(pages: DataFrame) -> DataFrame:
    """Modules of result tables 'unit code | title | level | semester | credits | .. | valid from'.

    A code with several rows keeps the one valid latest, the first of equal ones.
    """
    rows = elements.page_cells(pages, "page_id", "school")
    cell = lambda i: F.get(F.col("cells"), F.lit(i))
    fits = (F.size("cells") >= UNIT_ROW_CELLS) & cell(0).rlike(r"^[A-Z]{2,6}[0-9]{5}$") & (cell(1) != "")
    href = F.regexp_extract("row_html", r"(?is)href\s*=\s*[\"'](/[^\"']*)[\"']", 1)
    shaped = rows.filter(fits & (href != "")).select(
        "page_id", "school", cell(0).alias("code"), cell(1).alias("name"),
        F.concat(F.lit("https://portal.manchester.ac.uk"), html.unescape(href)).alias("url"),
        cell(4).try_cast("int").alias("credits"), F.concat(F.lit("Level "), blank_to_null(cell(2))).alias("level"),
        blank_to_null(cell(3)).alias("semester"),
        F.coalesce(F.datediff(dates.parse_date(cell(6)), F.lit("1970-01-01").cast("date")), F.lit(-1)).alias("valid"),
        F.struct("table_no", "row_no").alias("place"),
    ).withColumn("oldest", -F.col("valid"))
    return ordered.first_per_key(shaped, ["page_id", "code"], ["oldest", "place"]).drop("oldest", "place", "valid")


# ---- X2: programmes straight from result lists ----------------------------------------------------

# Level wording of result lists.
LIST_LEVELS = {"undergraduate coursework": "UG", "graduate coursework": "PGT", "graduate research": "PGR", "research": "PGR"}
SEARCH_LEVELS = {"uc": "UG", "pc": "PGT", "pr": "PGR"}
ITEM_RE = r"(?is)<a[^>]*\bsearch-result-item__anchor\b[^>]*>.*?</a\s*>"


def _class_texts(block: Column, name: str, tag: str = "[a-z0-9]+") -> Column:
    pattern = rf"(?is)<({tag})[^>]*\b{name}\b[^>]*>(.*?)</\1\s*>"
    return F.transform(html.all_matches(block, pattern), lambda m: html.inner_text(F.regexp_extract(m, pattern, 2)))


def result_items(pages: DataFrame) -> DataFrame:
    """Entries of server-rendered result lists: page_id, pos, url, name, code, flags, metas."""
    blocks = pages.withColumn("html", html.page_string(F.col("html"))).select(
        "page_id", "url", F.posexplode(html.all_matches(F.col("html"), ITEM_RE)).alias("pos", "block")
    )
    block = F.col("block")
    metas_re = r"(?is)<p\b[^>]*>(.*?)</p\s*>"
    return blocks.select(
        "page_id", "pos", urls.resolve(F.col("url"), html.attribute(block, "href")).alias("url"),
        blank_to_null(html.inner_text(F.regexp_extract(block, r"(?is)<h3\b[^>]*>(.*?)</h3", 1))).alias("name"),
        F.get(_class_texts(block, "search-result-item__code"), F.lit(0)).alias("code"),
        _class_texts(block, "search-result-item__flag").alias("flags"),
        F.transform(html.all_matches(block, metas_re), lambda m: html.inner_text(F.regexp_extract(m, metas_re, 1))).alias("metas"),
    )


def listed_programs(pages: DataFrame) -> DataFrame:
    """Programmes of result lists: entries with a degree level; campus and duration from the small print."""
    items = result_items(pages).filter(F.col("name").isNotNull() & F.col("url").contains("/courses/"))
    mapped = F.transform(
        "flags", lambda f: F.coalesce(*[F.when(F.lower(f) == key, value) for key, value in LIST_LEVELS.items()])
    )
    level = F.get(F.filter(mapped, lambda v: v.isNotNull()), F.lit(0))
    campus = F.filter("metas", lambda m: F.lower(m).contains("campus"))
    length = F.filter("metas", lambda m: ~F.lower(m).contains("campus") & F.lower(m).rlike("month|year"))
    return items.select(
        "page_id", "pos", "url", F.col("name").alias("name_en"), level.alias("level"),
        F.try_element_at(campus, F.lit(-1)).alias("campus"), F.try_element_at(length, F.lit(-1)).alias("duration"), "code",
    ).filter(F.col("level").isNotNull())


def listed_modules(pages: DataFrame) -> DataFrame:
    """Modules of result lists: code, level and offered periods from the small print."""
    items = result_items(pages).filter(F.col("name").isNotNull() & F.col("code").isNotNull() & F.col("url").contains("/subjects/"))
    joined = F.array_join("metas", "\n")
    ug = blank_to_null(F.regexp_extract(joined, r"(?i)Undergraduate\s+Level\s+(\d)", 1))
    graduate = joined.rlike(r"(?i)Graduate\s+coursework")
    offered = F.regexp_extract(joined, r"(?im)^Offered(.*)$", 1)
    return items.select(
        "page_id", "pos", "url", "name", "code",
        F.coalesce(F.concat(F.lit("UG L"), ug), F.when(graduate, "PGT")).alias("level"),
        blank_to_null(F.regexp_replace(norm_ws(offered), r"^[ ,]+|[ ,]+$", "")).alias("semester"),
    )


def searched_programs(pages: DataFrame, official: DataFrame) -> DataFrame:
    """Programmes of a JSON search result. ``official`` (school, fields: array) lists the subject slugs with a unit."""
    data = F.from_json(html.page_string(F.col("html")), feeds.SEARCH_SCHEMA)
    rows = pages.select("page_id", "school", F.posexplode(data["results"]).alias("pos", "r")).join(official, "school", "left")
    level = F.coalesce(*[F.when(F.get("r.raw.usyd_courses_studylevel", F.lit(0)) == k, v) for k, v in SEARCH_LEVELS.items()])
    subject = F.filter("r.raw.usyd_courses_fieldofstudy", lambda f: F.array_contains(F.col("fields"), f))
    return rows.select(
        "page_id", "pos", norm_ws(F.col("r.title")).alias("name_en"), level.alias("level"), F.col("r.clickUri").alias("url"),
        F.get(subject, F.lit(0)).alias("faculty"), blank_to_null(norm_ws(F.col("r.raw.usyd_courses_courseduration"))).alias("duration"),
    ).filter((F.col("name_en") != "") & F.col("url").isNotNull() & F.col("level").isNotNull())


# ---- X9: deadlines ------------------------------------------------------------------------------------


def deadline_records(pages: DataFrame, rules_table: DataFrame) -> DataFrame:
    """Deadlines named on pages: every match of a rule whose surroundings hold its words."""
    ruled = with_rules(pages, rules_table, "text")
    hits = ruled.select(
        "page_id", "school", "category", "audience", "deadline_type", "at_time", "note", "nearby", "text",
        F.posexplode(F.regexp_extract_all("text", F.col("pattern"), F.lit(1))).alias("pos", "raw"),
    )
    near = let(
        F.lower(window_around(F.col("text"), F.col("raw"))),
        lambda around: F.forall("nearby", lambda w: F.contains(around, w)),
    )
    near = F.when(F.size("nearby") == 0, True).otherwise(near)
    day = dates.parse_date(F.col("raw"))
    return hits.filter(near).select(
        "page_id", "school", "category", "audience", "deadline_type",
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), "at_time").alias("deadline_at"), "note", "pos",
    ).filter(F.col("deadline_at").isNotNull())


def deadline_rounds(pages: DataFrame) -> DataFrame:
    """Deadlines of tables with one application round per row, numbered within their table.

    The date column is found by its header; a date that spans several rows is one round.
    """
    out = None
    for school, page_re, header, audience, kind, at_time, before, behind in site_rules.DEADLINE_ROUNDS:
        own = pages.filter((F.col("school") == school) & (F.col("category") == site_rules.DETAIL) & F.col("url").rlike(page_re))
        rows = elements.page_cells(own, "page_id", "school", "category").withColumn("at", elements.column_of(F.col("columns"), header))
        dated = rows.filter(~F.col("is_header") & F.get("starts", F.col("at"))).withColumn("day", dates.parse_date(F.get("grid", F.col("at"))))
        dated = dated.filter(F.col("day").isNotNull()).select("page_id", "school", "category", "table_no", "row_no", "day")
        numbered = ordered.number_rows(dated, ["page_id", "table_no"], ["row_no"], "n").withColumn("round_no", F.col("n").cast("int"))
        found = numbered.select(
            "page_id", "school", "category", F.lit(audience).alias("audience"), F.lit(kind).alias("deadline_type"),
            F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit(f" {at_time}")).alias("deadline_at"),
            F.concat(F.lit(before), F.col("round_no").cast("string"), F.lit(behind)).alias("note"),
            (F.col("table_no") * 1_000_000 + F.col("row_no")).alias("pos"), "round_no",
        )
        out = found if out is None else out.unionByName(found)
    return out


def deadline_rows(pages: DataFrame) -> DataFrame:
    """Deadlines from tables 'date | description': the first wording rule that fits decides type and audience."""
    rows = elements.page_cells(pages, "page_id", "school").filter(F.size("cells") >= 2)
    wording = F.lower(F.get("cells", F.lit(1)))
    cases, audiences = [], []
    for school, phrases, kind, audience in site_rules.DEADLINE_ROWS:
        fits = (F.col("school") == school) & rules.contains_any(wording, phrases)
        who = F.when(wording.contains("visa"), "international").otherwise("all") if audience == "visa" else F.lit(audience)
        cases.append((fits, F.lit(kind)))
        audiences.append((fits, who))
    day = dates.loose_date(F.get("cells", F.lit(0)))
    return rows.select(
        "page_id", "school", rules.ordered(audiences).alias("audience"), rules.ordered(cases).alias("deadline_type"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 23:59:00")).alias("deadline_at"), F.get("cells", F.lit(1)).alias("note"),
    ).filter(F.col("deadline_at").isNotNull() & F.col("deadline_type").isNotNull())


# ---- X10: reverse faculty index --------------------------------------------------------------------------


def reverse_index(pages: DataFrame, dept: Column, link_re: str) -> DataFrame:
    """Programmes a unit page links to: they only fill the unit of programmes that exist."""
    found = html.page_links(pages.withColumn("dept", dept).filter(F.col("dept").isNotNull()), "page_id", "school", "dept")
    rows = found.filter(F.col("link_url").rlike(link_re)).select(
        "page_id", "school", "dept", "pos", F.regexp_replace("link_url", r"\?.*$", "").alias("url"),
        F.coalesce(
            blank_to_null(F.trim(F.regexp_replace("link_text", r"\[.*?\]$", ""))), urls.last_segment(F.col("link_url"))
        ).alias("name_en"),
        F.when(F.col("link_url").contains("/postgraduate/"), "PGT").otherwise("UG").alias("level"),
        F.lit(True).alias("backfill_only"),
    )
    return ordered.first_per_key(rows, ["page_id", "url"], ["pos"])


# ---- X11, X12: information rows and notes -------------------------------------------------------------------


def language_info(pages: DataFrame) -> DataFrame:
    """Scores a language page states, as text; pages without any give a note."""
    found = rules.ielts(F.col("text"))
    return pages.filter(F.col("category") == "language_req").select("page_id", "school", found.alias("s")).select(
        "page_id", "school",
        F.when(F.col("s.overall").isNull(), "note").otherwise("info").alias("kind"),
        F.when(F.col("s.overall").isNull(), "no IELTS score found")
        .when(F.col("s.minimum").isNull(), F.concat(F.lit("IELTS overall "), F.col("s.overall").cast("string")))
        .otherwise(
            F.concat(F.lit("IELTS overall "), F.col("s.overall").cast("string"), F.lit(", minimum "), F.col("s.minimum").cast("string"))
        ).alias("message"),
    )


def page_checks(pages: DataFrame, rules_table: DataFrame) -> DataFrame:
    """A note for every page on which a keyword that should be there is gone."""
    ruled = with_rules(pages, rules_table, "text")
    present = F.regexp_like(F.col("text"), F.concat(F.lit("(?i)"), F.col("pattern")))
    return ruled.filter(~present).select(
        "page_id", "school", F.lit("note").alias("kind"), F.concat(F.lit("keyword missing: "), "label").alias("message")
    )


# Pages that answer in JSON, by school and category.
JSON_PAGES = {("anu", site_rules.CATALOG): None, ("sydney", site_rules.CATALOG): None, ("sydney", site_rules.MODULES): r"org\.coveo\.com"}
# Numbers that the stored columns can hold.
NUMBERS = {
    "tuition_home": 10**8, "tuition_intl": 10**8, "ielts_overall": 10, "ielts_min_each": 10, "credits": 2**15,
}


def page_faults(pages: DataFrame, rules_table: DataFrame) -> DataFrame:
    """(page_id, kind, message): what is wrong with the content of pages, one row for each fault.

    Bytes that are no UTF-8, answers that are not JSON, embedded objects that do not parse,
    and found values that are no numbers or too large for their column. All other values of
    such a page, and all other pages, still give their rows.
    """
    raw = pages.select("page_id", "school", "category", "url", (~F.is_valid_utf8(F.col("html").cast("string"))).alias("broken"))
    fault = lambda message: (F.lit("fault").alias("kind"), message.alias("message"))
    out = raw.filter("broken").select("page_id", *fault(F.lit("bytes are not valid UTF-8")))

    ready = pages.withColumn("html", html.page_string(F.col("html")))
    answers = F.lit(False)
    for (school, category), url_re in JSON_PAGES.items():
        own = (F.col("school") == school) & (F.col("category") == category)
        answers = answers | (own if url_re is None else own & F.col("url").rlike(url_re))
    not_json = answers & F.try_parse_json("html").isNull()
    out = out.unionByName(ready.filter(not_json).select("page_id", *fault(F.lit("answer is not JSON"))))
    block = blank_to_null(F.regexp_extract("html", feeds.NEXT_DATA_RE, 1))
    out = out.unionByName(
        ready.filter(block.isNotNull() & F.try_parse_json(block).isNull()).select("page_id", *fault(F.lit("embedded object is not JSON")))
    )
    details = prepared(pages.filter(F.col("category").isin(site_rules.DETAIL, site_rules.MODULES)))
    fields = extract_fields(details, rules_table)
    checked = []
    for name, bound in NUMBERS.items():
        value = _number(name)
        wrong = _field(name).isNotNull() & (value.isNull() | (F.abs(value) >= bound))
        checked.append(F.when(wrong, F.concat(F.lit(f"{name} is no number that fits: "), F.left(_field(name), F.lit(80)))))
    found = fields.select("page_id", F.explode(F.filter(F.array(*checked), lambda m: m.isNotNull())).alias("message"))
    return out.unionByName(found.select("page_id", *fault(F.col("message"))))


def quality_notes(pages: DataFrame, counts: DataFrame, known: DataFrame, reference: DataFrame) -> DataFrame:
    """(page_id, kind, message): pages without rules, reference pages, pages that gave no rows.

    ``counts`` is (page_id, n_records); ``known`` and ``reference`` are (school, category).
    """
    keyed = ["school", "category"]
    flagged = (
        pages.select("page_id", *keyed)
        .join(known.select(*keyed, F.lit(True).alias("ruled")).distinct(), keyed, "left")
        .join(reference.select(*keyed, F.lit(True).alias("reference")).distinct(), keyed, "left")
        .join(counts, "page_id", "left")
    )
    kind = (
        F.when(F.col("reference"), "info")
        .when(F.col("ruled").isNull(), "no rules")
        .when(F.coalesce("n_records", F.lit(0)) == 0, "note")
    )
    message = F.when(kind == "info", "reference page").when(kind == "note", "page gave no rows").otherwise(
        F.concat(F.lit("no rules for "), "category")
    )
    return flagged.select("page_id", kind.alias("kind"), message.alias("message")).filter(F.col("kind").isNotNull())


def scoped_names(names: DataFrame) -> DataFrame:
    """Official names per school for the ``names`` argument of the jobs: longest first, list position kept."""
    key = F.lower(F.replace(norm_ws(F.col("name")), F.lit(" and "), F.lit(" & ")))
    return names.groupBy("school").agg(
        F.array_sort(
            F.collect_set(
                F.struct((-F.char_length("name")).alias("rank"), F.col("name").alias("name"), key.alias("key"), F.col("position").alias("position"))
            )
        ).alias("names")
    )
