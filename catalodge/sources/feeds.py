"""Sitemaps, embedded JSON, JSON search results and stored snapshot files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalodge.functions import urls
from catalodge.functions.text import blank_to_null, norm_ws
from catalodge.sources.html import unescape

NEXT_DATA_RE = r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>'
LD_JSON_RE = r'(?s)<script type="application/ld\+json">(.*?)</script>'


def sitemap_locs(body: Column) -> Column:
    """All <loc> targets of a sitemap or sitemap index, in order."""
    found = F.regexp_extract_all(body, F.lit("<loc>([^<]+)</loc>"), F.lit(1))
    return F.transform(found, lambda loc: unescape(F.trim(loc)))


def is_sitemap_index(body: Column) -> Column:
    return body.contains("<sitemapindex")


def next_data(html: Column) -> Column:
    """Page content object of a server-rendered application page as VARIANT.

    NULL when the page has no such block, the block is not JSON or the object is missing.
    """
    block = F.try_parse_json(blank_to_null(F.regexp_extract(html, NEXT_DATA_RE, 1)))
    return F.try_variant_get(block, "$.props.pageProps.pageContent", "variant")


def variant_text(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def reference_value(value: Column, name: str) -> Column:
    """A field that is either {'value': text, ...} or plain text."""
    return F.coalesce(
        variant_text(value, f"$.{name}.value"),
        F.when(
            F.schema_of_variant(F.try_variant_get(value, f"$.{name}", "variant")) == "STRING",
            variant_text(value, f"$.{name}"),
        ),
    )


def ld_json_names(html: Column, ignored: tuple[str, ...]) -> Column:
    """First 'name' of the structured-data blocks that is not a site-wide one."""
    blocks = F.regexp_extract_all(html, F.lit(LD_JSON_RE), F.lit(1))
    names = F.transform(blocks, lambda b: F.try_variant_get(F.try_parse_json(b), "$.name", "string"))
    fit = F.filter(names, lambda n: n.isNotNull() & ~n.isin(*ignored))
    return norm_ws(F.get(fit, F.lit(0)))


def assigned_object(html: Column, variable: str) -> Column:
    """Text of a JSON object assigned to a script variable, up to the statement's end."""
    return blank_to_null(
        F.regexp_extract(html, rf"(?s){variable}\s*=\s*(\{{.*?\}})\s*(?:;|</script>)", 1)
    )


SEARCH_SCHEMA = (
    "totalCount INT, results ARRAY<STRUCT<title: STRING, clickUri: STRING, raw: STRUCT<uri: STRING,"
    " usyd_courses_studylevel: ARRAY<STRING>, usyd_courses_fieldofstudy: ARRAY<STRING>,"
    " usyd_courses_courseduration: STRING>>>"
)

def _answer_list(body: Column, item_type: str) -> Column:
    """The list in a JSON answer; an item that is not of this type is NULL."""
    lists = lambda answer: [F.try_variant_get(answer, f"$.{name}", f"array<{item_type}>") for name in ("Items", "results")]
    # Parsed once; a fold, unlike ``let``, does not copy the list that it gives.
    return F.aggregate(F.array(F.try_parse_json(body)), F.lit(None).cast(f"array<{item_type}>"), lambda _, answer: F.coalesce(*lists(answer)))


def json_items(body: Column) -> Column:
    """array<map<field, variant>> of the list in a JSON answer ('Items' or 'results'); NULL where it is not JSON or has none.

    Items that are no objects are NULL.
    """
    return _answer_list(body, "map<string,variant>")


def json_count(body: Column) -> Column:
    """Number of items of the list in a JSON answer, whatever they are; NULL where it is not JSON or has none."""
    # Nothing is copied of an item that is not of the type asked for, and it keeps its place.
    return F.size(_answer_list(body, "boolean"))


def item_text(item: Column, field: Column) -> Column:
    """Text of a field of an item, else of the same field of its 'raw' part or of that part's uri; NULL for none."""
    raw = F.try_element_at(item, F.lit("raw"))
    return F.coalesce(F.try_element_at(item, field).try_cast("string"), F.try_variant_get(raw, "$.uri", "string"))


def next_offset_urls(url: Column, total: Column, default_size: int = 200) -> Column:
    """Follow-up URLs of an offset-paged search; only the first page names them."""
    first = F.coalesce(urls.query_value(url, "firstResult").try_cast("int"), F.lit(0))
    size = F.coalesce(urls.query_value(url, "numberOfResults").try_cast("int"), F.lit(default_size))
    offsets = F.when(
        (first == 0) & (total > size), F.sequence(size, total - 1, size)
    ).otherwise(F.array().cast("array<int>"))
    has_first = url.rlike(r"[?&]firstResult=\d+")

    def at(offset: Column) -> Column:
        swapped = F.regexp_replace(url, F.lit(r"([?&]firstResult=)\d+"), F.concat(F.lit("$1"), offset.cast("string")))
        appended = F.concat(url, F.when(url.contains("?"), "&").otherwise("?"), F.lit("firstResult="), offset.cast("string"))
        return F.when(has_first, swapped).otherwise(appended)

    return F.transform(offsets, at)


def numbered_page_urls(links: Column) -> Column:
    """URLs of pages 2..last made from the pager link with the highest page number."""
    number = lambda u: F.regexp_extract(u, r"[?&]page=(\d+)", 1).try_cast("int")
    numbered = F.filter(links, lambda u: u.rlike(r"[?&]page=\d+"))
    last = F.array_max(F.transform(numbered, lambda u: F.struct(number(u).alias("n"), u.alias("url"))))
    pages = F.when(last["n"] >= 2, F.sequence(F.lit(2), last["n"])).otherwise(F.array().cast("array<int>"))
    return F.transform(
        pages,
        lambda n: F.regexp_replace(last["url"], F.lit(r"([?&]page=)\d+"), F.concat(F.lit("$1"), n.cast("string"))),
    )


def next_index_url(url: Column, n_items: Column, page_size: Column | int) -> Column:
    """The next page of an index-paged API while pages are full, else NULL."""
    index = F.coalesce(F.regexp_extract(url, r"PageIndex=(\d+)", 1).try_cast("int"), F.lit(0))
    moved = F.regexp_replace(url, F.lit(r"PageIndex=\d+"), F.concat(F.lit("PageIndex="), (index + 1).cast("string")))
    return F.when(n_items == page_size, moved)


def next_full_page_url(url: Column, n_rows: Column, page_size: Column) -> Column:
    """The next page of a list whose pages are numbered from 0 while a page is full, else NULL."""
    number = F.coalesce(F.regexp_extract(url, r"[?&]page=(\d+)", 1).try_cast("int"), F.lit(0)) + 1
    moved = F.regexp_replace(url, F.lit(r"([?&]page=)\d+"), F.concat(F.lit("$1"), number.cast("string")))
    added = F.concat(url, F.when(url.contains("?"), "&").otherwise("?"), F.lit("page="), number.cast("string"))
    return F.when(n_rows >= page_size, F.when(url.rlike(r"[?&]page=\d+"), moved).otherwise(added))


def snapshot_path(root: str, school: Column, category: Column, url: Column) -> Column:
    """Place of a stored page: root/school/category/slug.html.gz."""
    return F.concat_ws("/", F.lit(root), school, category, F.concat(urls.snapshot_slug(url), F.lit(".html.gz")))


def read_snapshot_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Stored pages, gzip or plain, one row per file: path, school, category, html."""
    raw = spark.read.text(pattern, wholetext=True)
    path = F.col("_metadata.file_path")
    return raw.select(
        path.alias("content_path"),
        F.regexp_extract(path, r"([^/]+)/([^/]+)/[^/]+$", 1).alias("school"),
        F.regexp_extract(path, r"([^/]+)/([^/]+)/[^/]+$", 2).alias("category"),
        F.make_valid_utf8("value").alias("html"),
    )
