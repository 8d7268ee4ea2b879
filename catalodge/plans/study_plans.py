"""Study plans: positioned words of a document to plan items, plan links, Chinese labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalodge.functions import translate
from catalodge.functions.text import blank_to_null
from catalodge.operators import ordered
from catalodge.sources import html

# Column borders where a page has no header words, and the margin before a header.
PREREQ_X, CREDIT_X, MARGIN = 400, 510, 8
# Patterns of plan tables.
CODE_RE = r"^[A-Z]{2,4}\d{4}"
TERM_HEAD_RE = r"^Year (\d+) Term (\d+)"
CREDIT_RE = r"^\d+$"
CROSS_REFERENCE_RE = r"\[\d{4}\]\s*$"


def plan_lines(words: DataFrame) -> DataFrame:
    """(doc, page, top, line, name, prereq, credit): words joined to lines and cut at the header columns.

    ``words`` is (doc, page, text, x0, top). Only the words of one printed line are
    ever gathered together.
    """
    borders = words.groupBy("doc", "page").agg(
        F.min(F.when(F.col("text") == "Prerequisites", F.col("x0"))).alias("pre"),
        F.min(F.when(F.col("text") == "Credits", F.col("x0"))).alias("cr"),
    )
    lines = words.groupBy("doc", "page", F.bround("top").cast("long").alias("top")).agg(
        F.array_sort(F.collect_list(F.struct("x0", "text"))).alias("words")
    )
    out = lines.join(borders, ["doc", "page"])
    x_pre = F.coalesce(F.col("pre") - MARGIN, F.lit(PREREQ_X))
    x_cr = F.coalesce(F.col("cr") - MARGIN, F.lit(CREDIT_X))

    def joined(keep) -> Column:
        return F.trim(F.array_join(F.transform(F.filter("words", keep), lambda w: w["text"]), " "))

    return out.select(
        "doc", "page", "top",
        joined(lambda w: F.lit(True)).alias("line"),
        joined(lambda w: w["x0"] < x_pre).alias("name"),
        joined(lambda w: (w["x0"] >= x_pre) & (w["x0"] < x_cr)).alias("prereq"),
        joined(lambda w: w["x0"] >= x_cr).alias("credit"),
    )


def plan_items(words: DataFrame) -> DataFrame:
    """(doc, page, top, year, term, code, label, prereq, credits) of the items under 'Year n Term m' lines.

    Lines without a name or a whole number of credits and cross references to other
    degrees ('... [3736]') are no items. A single leading code is split off; 'A or B' stays a label.
    """
    lines = plan_lines(words)
    head_re = TERM_HEAD_RE
    is_head = F.col("line").rlike(head_re)
    head = F.struct(
        F.regexp_extract("line", head_re, 1).try_cast("int").alias("year"), F.regexp_extract("line", head_re, 2).try_cast("int").alias("term")
    )
    lines = lines.withColumn("head", F.when(is_head, head))
    # Pages follow each other, so a long document is filled page by page.
    filled = ordered.last_known(lines, ["doc"], ["page", "top"], {"head": "under"}, F.col("page"))
    items = filled.filter(
        F.col("head").isNull()
        & F.col("under").isNotNull()
        & ~F.col("line").startswith("Course or Activity")
        & (F.col("name") != "")
        & F.col("credit").rlike(CREDIT_RE)
        & ~F.col("name").rlike(CROSS_REFERENCE_RE)
    )
    code = F.regexp_extract("name", CODE_RE, 0)
    rest = F.regexp_replace("name", CODE_RE, "")
    single = (code != "") & ~F.lower(F.substring(rest, 1, 4)).contains("or")
    label = F.when(single, F.coalesce(blank_to_null(F.trim(rest)), code)).otherwise(F.col("name"))
    return items.select(
        "doc", "page", "top", F.col("under.year").alias("year"), F.col("under.term").alias("term"),
        F.when(single, code).alias("code"), label.alias("label"), blank_to_null(F.col("prereq")).alias("prereq"),
        F.col("credit").cast("int").alias("credits"),
    )


def with_chinese_labels(items: DataFrame, modules: DataFrame) -> DataFrame:
    """Add label_zh: the module's Chinese name for coded items, the dictionary for the others.

    ``modules`` is (university_id, code, name_zh), ``items`` carries university_id.
    """
    named = modules.filter(F.col("code").isNotNull() & F.col("name_zh").isNotNull()).groupBy("university_id", "code").agg(
        F.min("name_zh").alias("name_zh")
    )
    # Items without a code take no module's name. They are spread, as one null key would be one task.
    spread = F.concat(F.lit("\u0000"), F.xxhash64(*items.columns).cast("string"))
    keyed = items.withColumn("__code", F.coalesce("code", spread))
    out = keyed.join(named.withColumnRenamed("code", "__code"), ["university_id", "__code"], "left")
    zh = F.when(F.col("code").isNotNull(), F.col("name_zh")).otherwise(translate.plan_label_zh(F.col("label")))
    return out.select(*items.columns, zh.alias("label_zh"))


def plan_documents(items: DataFrame) -> DataFrame:
    """(doc, plan): years with their items as nested arrays; documents without items do not appear."""
    terms = items.groupBy("doc", "year", "term").agg(
        F.array_sort(F.collect_list(F.struct("page", "top", "code", "label", "label_zh", "prereq", "credits"))).alias("items")
    )
    term = F.struct(
        "year", "term",
        F.transform(
            "items", lambda i: F.struct(i["code"].alias("code"), i["label"].alias("label"), i["label_zh"].alias("label_zh"),
                                        i["prereq"].alias("prereq"), i["credits"].alias("credits"))
        ).alias("items"),
    )
    return terms.groupBy("doc").agg(F.array_sort(F.collect_list(term)).alias("plan"))


def plan_links(pages: DataFrame, programs: DataFrame) -> DataFrame:
    """Plan files linked from index pages: term 1, not first-year, with the code of a known programme.

    ``programs`` is (code, program_id). Each URL counts once.
    """
    found = html.page_links(pages, "page_id")
    name = F.coalesce(F.try_url_decode(F.element_at(F.split("link_url", "/"), -1)), F.lit(""))
    found = found.withColumn("name", name).filter(
        F.lower("href").endswith(".pdf")
        & F.col("href").contains("/dam/pdfs/")
        & ~F.col("name").contains("1st Yr")
        & ~F.col("name").rlike("(?i)1st.?year")
        & (F.col("name").contains("T1") | F.col("link_url").contains("term-1") | F.lower("name").contains("t1"))
    )
    coded = found.withColumn("code", F.regexp_extract("name", r"\b([0-9]{4})\b", 1))
    first = programs.groupBy("code").agg(F.min("program_id").alias("program_id"))
    rows = coded.join(first, "code").select("program_id", "code", "link_url", "page_id", "pos")
    kept = ordered.first_per_key(rows, ["link_url"], ["page_id", "pos"])
    return kept.select(
        "program_id", "code", "link_url", translate.plan_variant_label(F.col("link_url")).alias("variant_label")
    )
