"""URL expressions. Parts are cut with the generic URI pattern, so odd URLs never fail a job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalodge.functions.text import let

# The generic URI split (RFC 3986, appendix B): scheme, authority, path, query, fragment.
URI_RE = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"
SCHEME, AUTHORITY, PATH, QUERY, FRAGMENT = 1, 2, 3, 4, 5


def url_part(url: Column, part: int) -> Column:
    return F.regexp_extract(url, URI_RE, part)


def host(url: Column) -> Column:
    return F.lower(url_part(url, AUTHORITY))


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(url, r"#.*$", "")


def clean_url(url: Column, keep_query: bool = False) -> Column:
    """Scheme, host and path with exactly one closing slash; query only on request, never a fragment."""
    path = F.rtrim(url_part(url, PATH), F.lit("/"))
    path = F.when(path == "", "").otherwise(F.concat(path, F.lit("/")))
    base = F.concat(url_part(url, SCHEME), F.lit("://"), url_part(url, AUTHORITY), path)
    if not keep_query:
        return base
    query = url_part(url, QUERY)
    return F.when(query == "", base).otherwise(F.concat(base, F.lit("?"), query))


def same_page_key(url: Column) -> Column:
    """Equal for URLs that differ only in scheme, a leading 'www.' or a closing slash."""
    name = F.regexp_replace(host(url), r"^www\.", "")
    path = F.rtrim(url_part(url, PATH), F.lit("/"))
    path = F.when(path == "", "/").otherwise(path)
    query = url_part(url, QUERY)
    return F.concat(name, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def snapshot_slug(url: Column) -> Column:
    """File name for a stored page: the whole path, then up to 60 characters of query, last 160 kept."""
    path = F.trim(url_part(url, PATH), F.lit("/"))
    path = F.when(path == "", "index").otherwise(path)
    name = F.regexp_replace(F.replace(path, F.lit("/"), F.lit("__")), r"[^A-Za-z0-9._-]+", "-")
    query = url_part(url, QUERY)
    tail = F.substring(F.regexp_replace(query, r"[^A-Za-z0-9]+", "-"), 1, 60)
    slug = F.when(query == "", name).otherwise(F.concat(name, F.lit("_"), tail))
    return F.right(slug, F.lit(160))


def last_segment(url: Column) -> Column:
    return F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1)


def query_value(url: Column, name: str) -> Column:
    """Decoded value of one query parameter, NULL when it is missing."""
    raw = F.regexp_extract(url_part(url, QUERY), rf"(?:^|&){name}=([^&]*)", 1)
    return F.try_url_decode(F.nullif(raw, F.lit("")))


def unwrap_redirect(url: Column, marker: str = "funnelback") -> Column:
    """Target of a search-result redirect (its ``url`` parameter); other URLs lose only the fragment."""
    target = F.coalesce(without_fragment(query_value(url, "url")), F.lit(""))
    return F.when(url_part(url, AUTHORITY).contains(marker), target).otherwise(without_fragment(url))


def drop_dot_segments(path: Column) -> Column:
    """Resolve '.' and '..' steps of a path."""
    steps = F.split(path, "/")
    walked = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda done, step: F.when(step == ".", done)
        .when(
            step == "..",
            F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))),
        )
        .otherwise(F.array_append(done, step)),
    )
    return F.array_join(walked, "/")


def _parts(url: Column) -> Column:
    """The URL's parts. One without a scheme or authority, as most links have it, is cut at its marks alone."""

    def cut(front: Column, rest: Column) -> Column:
        named = front.contains(":") | front.startswith("//")
        query = F.substr(rest, F.char_length(front) + 2)

        def parts(scheme: Column, authority: Column, path: Column) -> Column:
            return F.struct(url.alias("url"), scheme.alias("scheme"), authority.alias("authority"), path.alias("path"), query.alias("query"))

        return F.when(~named, parts(F.lit(""), F.lit(""), front)).otherwise(parts(*[url_part(front, n) for n in (SCHEME, AUTHORITY, PATH)]))

    before_fragment = F.substring_index(url, "#", 1)
    return let(before_fragment, lambda rest: let(F.substring_index(rest, "?", 1), lambda front: cut(front, rest)))


def base_parts(base: Column) -> Column:
    """What ``resolve_on`` needs of the page that links stand on."""

    def made(on: Column) -> Column:
        folder = F.regexp_replace(on["path"], r"[^/]*$", "")
        return F.struct(
            on["url"].alias("url"), on["scheme"].alias("scheme"), on["path"].alias("path"),
            F.concat(on["scheme"], F.lit("://"), on["authority"]).alias("root"), F.when(folder == "", "/").otherwise(folder).alias("folder"),
        )

    return let(_parts(base), made)


def resolve_on(on: Column, href: Column) -> Column:
    """The absolute, fragment-free URL a link points to, on a page with these ``base_parts``."""

    def joined(to: Column) -> Column:
        tail = F.when(to["query"] == "", "").otherwise(F.concat(F.lit("?"), to["query"]))
        path = F.concat(F.when(to["path"].startswith("/"), "").otherwise(on["folder"]), to["path"])
        path = let(path, lambda p: F.when(p.contains(".") & p.rlike(r"(^|/)\.{1,2}(/|$)"), drop_dot_segments(p)).otherwise(p))
        whole = (
            F.when(to["scheme"] != "", to["url"])
            .when(to["authority"] != "", F.concat(on["scheme"], F.lit(":"), to["url"]))
            .when((to["path"] == "") & (to["query"] == ""), on["url"])
            .when(to["path"] == "", F.concat(on["root"], on["path"], tail))
            .otherwise(F.concat(on["root"], path, tail))
        )
        return let(whole, lambda url: F.when(url.contains("#"), without_fragment(url)).otherwise(url))

    # A path from the root on without query, fragment or dots needs no parts.
    return let(
        F.trim(href), lambda to: F.when(to.rlike(r"^/(?!/)[^?#.]*\z"), F.concat(on["root"], to)).otherwise(let(_parts(to), joined))
    )


def resolve(base: Column, href: Column) -> Column:
    """The absolute, fragment-free URL a link on page ``base`` points to."""
    return let(base_parts(base), lambda on: resolve_on(on, href))


# Fixed value: course pages in year folders.
COURSE_PATH_RE = r"^/20\d{2}/([a-z]\d{3,4}/[a-z0-9-]+)/?$"


def canonical_course(url: Column, domain: str) -> Column:
    """Drop the year folder of a course page on ``domain`` so that each course has one URL."""
    path = url_part(url, PATH)
    course = F.regexp_extract(path, COURSE_PATH_RE, 1)
    scheme = F.coalesce(F.nullif(url_part(url, SCHEME), F.lit("")), F.lit("https"))
    return F.when(
        (url_part(url, AUTHORITY) == domain) & (course != ""),
        F.concat(scheme, F.lit("://"), F.lit(domain), F.lit("/"), course),
    ).otherwise(url)
