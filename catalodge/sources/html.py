"""Raw pages as tables of text lines, links, label/value pairs and headings.

Nested elements, tables and their cells are in ``elements``. All here is built from regular-expression columns: a page is cut inside the JVM
in one narrow pass, only the parts a job asks for are computed, and there is no
Python worker and no shuffle. A page is one row, so every array here is bounded
by the size of that page.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalodge.functions import urls
from catalodge.functions.text import blank_to_null, let, norm_ws

BREAK = "\u0001"  # stands for a tag while text nodes are cut
TAG_RE = r"<[A-Za-z/!?](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
NOISE_RE = r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>"
# White space of any kind, stripped from both ends of a text node.
BLANKS = "\t\n\x0b\f\r \x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
HEADING_RE = r"(?is)<h([1-6])\b[^>]*>(.*?)</h\1\s*>"
LINK_RE = r"(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)[^>]*>(.*?)</a\s*>"
PAIR_RE = r"(?is)<dt\b[^>]*>(.*?)</dt\s*>\s*<dd\b[^>]*>(.*?)</dd\s*>"
# Names that count without their semicolon as well, the longest first; and what browsers read 128 to 159 as.
OPEN_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
ENTITY_RE = rf"&(#[0-9]{{1,7}};?|#[xX][0-9a-fA-F]{{1,6}};?|[A-Za-z][A-Za-z0-9]{{1,31}};|{'|'.join(OPEN_NAMES)})"
COMMON = ("nbsp;", "amp;", "lt;", "gt;", "quot;", "apos;", "pound;", "ndash;", "rsquo;")
WINDOWS = {c: bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(128, 160)}


def page_string(raw: Column) -> Column:
    """Bytes or text to valid text; bytes that are not UTF-8 become the replacement character."""
    return F.make_valid_utf8(raw.cast("string"))


def _named_entities() -> Column:
    """The standard named characters, straight from the language's own table, as one map literal."""
    pairs = [f"{name}\u0002{chars}" for name, chars in html5.items()]
    return F.str_to_map(F.lit("\u0003".join(pairs)), F.lit("\u0003"), F.lit("\u0002"))


def _decoded(entity: Column) -> Column:
    """The characters a reference like '&pound;' or '&#163;' stands for, else the reference itself."""

    def of_code(code: Column) -> Column:
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        return F.translate(F.when(valid, char).otherwise("\ufffd"), "".join(map(chr, WINDOWS)), "".join(WINDOWS.values()))

    def of_body(body: Column) -> Column:
        bare = F.rtrim(body, F.lit(";"))
        digits = F.when(F.lower(F.substring(bare, 1, 2)) == "#x", F.conv(F.substring(bare, 3, 8), 16, 10)).otherwise(
            F.substring(bare, 2, 9)
        )
        named = F.when(body == COMMON[0], html5[COMMON[0]])
        for name in COMMON[1:]:
            named = named.when(body == name, html5[name])
        named = named.otherwise(F.try_element_at(_named_entities(), body))
        return F.when(body.startswith("#"), let(digits.try_cast("int"), of_code)).otherwise(named)

    return F.coalesce(let(F.substring(entity, 2, 40), of_body), entity)


def unescape(text: Column) -> Column:
    """Decode character references in one pass from left to right, so that nothing is decoded twice."""

    def decode_all(body: Column) -> Column:
        between = F.split(body, ENTITY_RE, -1)
        found = F.transform(F.regexp_extract_all(body, F.lit(ENTITY_RE), F.lit(0)), _decoded)
        joined = F.zip_with(between, found, lambda part, char: F.concat(part, F.coalesce(char, F.lit(""))))
        return F.when(body.contains("&"), F.array_join(joined, "")).otherwise(body)

    return let(text, decode_all)


def without_noise(html: Column) -> Column:
    """The page without comments, scripts and styles; each still separates text like a tag."""
    return F.regexp_replace(html, NOISE_RE, "<br>")


def page_text(html: Column) -> Column:
    """Text nodes joined by newlines, each stripped at both ends, blank ones dropped.

    Newlines inside a node stay, and so does the padding around them.
    """
    marked = F.regexp_replace(without_noise(html), TAG_RE, BREAK)
    nodes = F.transform(F.split(unescape(marked), BREAK), lambda node: F.btrim(node, F.lit(BLANKS)))
    return F.array_join(F.filter(nodes, lambda node: node != ""), "\n")


def inner_text(fragment: Column) -> Column:
    """Text of a fragment on one line, white space collapsed."""
    marked = let(fragment, lambda f: F.when(f.contains("<"), F.regexp_replace(without_noise(f), TAG_RE, " ")).otherwise(f))
    return norm_ws(unescape(marked))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute in an opening tag, NULL when missing."""
    raw = F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", 1)
    return unescape(blank_to_null(F.regexp_replace(raw, "^[\"']|[\"']$", "")))


def first_heading(html: Column, level: int = 1) -> Column:
    body = F.regexp_extract(without_noise(html), rf"(?is)<h{level}\b[^>]*>(.*?)</h{level}\s*>", 1)
    return blank_to_null(inner_text(body))


def document_title(html: Column) -> Column:
    return blank_to_null(inner_text(F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)))


def meta_content(html: Column, name: str, by: str = "name") -> Column:
    tag = F.regexp_extract(html, rf"(?is)<meta\b[^>]*\b{by}\s*=\s*[\"']{name}[\"'][^>]*>", 0)
    return blank_to_null(F.trim(attribute(tag, "content")))


def tail_of(title: Column, separator: str = " - ") -> Column:
    """Last piece of a document title."""
    return blank_to_null(F.trim(F.element_at(F.split(title, separator), -1)))


def pick_title(
    heading: Column, og_title: Column, title: Column, bad_headings: Column | None = None, suffix_re: Column | None = None
) -> Column:
    """First heading unless it is a known section name, else og:title, else the document title."""
    if bad_headings is not None:
        lowered = F.transform(bad_headings, lambda b: F.lower(b))
        heading = F.when(~F.coalesce(F.array_contains(lowered, F.lower(heading)), F.lit(False)), heading)

    def clean(text: Column) -> Column:
        cut = text
        if suffix_re is not None:
            cut = F.regexp_replace(text, F.concat(F.lit("(?i)"), F.coalesce(suffix_re, F.lit("(?!)"))), F.lit(""))
        return blank_to_null(norm_ws(cut))

    return F.coalesce(clean(heading), clean(og_title), clean(title))


def choose_title(html: Column, bad_headings: Column | None = None, suffix_re: Column | None = None) -> Column:
    """``pick_title`` straight from a page."""
    parts = F.array(first_heading(html), meta_content(html, "og:title", by="property"), document_title(html))
    return let(parts, lambda p: pick_title(F.get(p, F.lit(0)), F.get(p, F.lit(1)), F.get(p, F.lit(2)), bad_headings, suffix_re))


def all_matches(html: Column, pattern: str) -> Column:
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(0))


def _target(value: Column) -> Column:
    """What an href value stands for, without its quotes."""
    return unescape(F.trim(F.regexp_replace(value, "^[\"']|[\"']$", "")))


def link_urls(html: Column, base: Column) -> Column:
    """array<string> of the absolute URLs of the links of a page in order, as ``links`` has them."""
    values = F.regexp_extract_all(without_noise(html), F.lit(LINK_RE), F.lit(1))

    def url_of(value: Column, on: Column) -> Column:
        # A quoted path from the root on, without anything to decode or to resolve, is taken as it is.
        whole = F.concat(on["root"], F.substr(value, F.lit(2), F.char_length(value) - 2))
        return F.when(value.rlike(r'^"/(?!/)[^"&?#. ]*"\z'), whole).otherwise(urls.resolve_on(on, _target(value)))

    return let(urls.base_parts(base), lambda on: F.transform(values, lambda value: url_of(value, on)))


def links(html: Column, base: Column) -> Column:
    """array<struct<pos, href, url, text, tag>> of the links of a page in order."""
    found = all_matches(without_noise(html), LINK_RE)

    def entry(tag: Column, pos: Column, on: Column) -> Column:
        return let(
            _target(F.regexp_extract(tag, LINK_RE, 1)),
            lambda href: F.struct(
                pos.alias("pos"),
                href.alias("href"),
                urls.resolve_on(on, href).alias("url"),
                inner_text(F.regexp_extract(tag, LINK_RE, 2)).alias("text"),
                F.regexp_extract(tag, "(?s)^<[^>]*>", 0).alias("tag"),
            ),
        )

    return let(urls.base_parts(base), lambda on: F.transform(found, lambda tag, pos: entry(tag, pos, on)))


def pairs(html: Column) -> Column:
    """map<label, value> of definition lists; labels lower-case without colon, first one wins."""
    found = F.transform(
        all_matches(without_noise(html), PAIR_RE),
        lambda m: F.struct(
            F.lower(F.rtrim(inner_text(F.regexp_extract(m, PAIR_RE, 1)), F.lit(":"))).alias("key"),
            inner_text(F.regexp_extract(m, PAIR_RE, 2)).alias("value"),
        ),
    )
    kept = F.filter(found, lambda p: (p["key"] != "") & (p["value"] != ""))

    def first_of_key(items: Column) -> Column:
        return let(
            F.transform(items, lambda p: p["key"]),
            lambda keys: F.filter(items, lambda p, i: F.array_position(keys, p["key"]) == i + 1),
        )

    return F.map_from_entries(let(kept, first_of_key))


# ---- the same parts as exploded tables ---------------------------------------


def page_lines(pages: DataFrame, *keep: str, html: str = "html") -> DataFrame:
    """One row per text line: kept columns, line_no, line."""
    text = page_text(page_string(F.col(html)))
    return pages.select(*keep, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def page_links(pages: DataFrame, *keep: str, html: str = "html", url: str = "url") -> DataFrame:
    """One row per link: kept columns, pos, href, url (absolute), text."""
    found = links(page_string(F.col(html)), F.col(url))
    return pages.select(*keep, F.explode(found).alias("link")).select(
        *keep, "link.pos", "link.href", F.col("link.url").alias("link_url"), F.col("link.text").alias("link_text"),
        F.col("link.tag").alias("link_tag"),
    )


def section_text(html: Column, heading_re: Column, stop_re: Column, limit: int = 800) -> Column:
    """Paragraph, list and cell text behind a matching heading up to the next one of level 2 to 4, cut to ``limit``.

    Without such a heading, the text lines behind a line that ends in the pattern
    count, up to the stop pattern or, without one, to a short capitalised line.
    """
    flag = F.lit("(?i)")
    sections = F.split(without_noise(html), r"(?i)(?=<h[1-6]\b)")
    heading_of = lambda s: inner_text(F.regexp_extract(s, HEADING_RE, 2))
    body_re = r"(?is)<(p|li|td)\b[^>]*>(.*?)</\1\s*>"

    def body_of(section: Column) -> Column:
        parts = F.transform(all_matches(section, body_re), lambda b: inner_text(F.regexp_extract(b, body_re, 2)))
        return F.array_join(F.filter(parts, lambda p: p != ""), " ")

    def ends(section: Column, parts: Column) -> Column:
        """Headings of level 2 to 4 end the text; before any text only those in the stop pattern do, if there is one."""
        stops = stop_re.isNull() | (F.size(parts) > 0) | F.coalesce(F.regexp_like(heading_of(section), F.concat(flag, stop_re)), F.lit(False))
        return section.rlike(r"(?i)^<h[2-4]\b") & stops

    def add(state: Column, section: Column) -> Column:
        own = F.regexp_like(heading_of(section), F.concat(flag, heading_re))
        opened = state["at"] == 0
        closed = (state["at"] == 2) | ((state["at"] == 1) & ends(section, state["parts"]))
        at = F.when(opened, F.when(own, 1).otherwise(0)).when(closed, 2).otherwise(1)
        return let(
            at, lambda now: F.struct(now.alias("at"), F.when(now == 1, F.concat(state["parts"], F.filter(F.array(body_of(section)), lambda p: p != ""))).otherwise(state["parts"]).alias("parts"))
        )

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    behind = F.aggregate(sections, empty, add, lambda state: state["parts"])
    under_heading = blank_to_null(F.substring(F.array_join(behind, " "), 1, limit))
    text = page_text(html)
    end_re = F.coalesce(
        F.concat(F.lit(r"(?=\n(?:"), stop_re, F.lit(r")|\z)")),
        F.lit(r"(?:\n(?-i:[A-Z])[^\n]{2,80}\n|\z)"),
    )
    pattern = F.concat(F.lit("(?is)(?:"), heading_re, F.lit(rf")\s*\n(.{{20,{limit}}}?)"), end_re)
    after_line = blank_to_null(F.substring(norm_ws(F.call_function("regexp_extract", text, pattern, F.lit(1))), 1, limit))
    return F.coalesce(under_heading, after_line)
