"""Date and number expressions over free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalodge.functions.text import let, norm_ws

# Weekday, money, range and date patterns as the results need them, and the date
# layouts, each with the shape a text must have to be tried. Exact
# shapes matter for speed too: a failed parse costs an exception per row.
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
SHORT_MONTHS = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"
DATE_LAYOUTS = (
    (rf"(?i)^\d{{1,2}} (?:{MONTHS}) \d{{4}}$", "d MMMM yyyy"),
    (rf"(?i)^\d{{1,2}} (?:{SHORT_MONTHS}) \d{{4}}$", "d MMM yyyy"),
    (rf"(?i)^(?:{MONTHS}) \d{{1,2}}, \d{{4}}$", "MMMM d, yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
)
WEEKDAY_RE = r"(?:Mon|Tues|Wednes|Thurs|Fri|Satur|Sun)day"
MONEY_RE = r"£\s*([\d,]+(?:\.\d{1,2})?)"
RANGE_RE = (
    r"(?i)(\d{1,2})(?:\s+([A-Za-z]+))?(?:\s+(20\d{2}))?\s*(?:-|to)\s*"
    r"(\d{1,2})\s+([A-Za-z]+)\s+(20\d{2})"
)
FULL_DATE_RE = r"\b\d{1,2}\s+[A-Za-z]+\s+20\d{2}\b"


def parse_date(text: Column) -> Column:
    """A DATE from one of the accepted layouts, else NULL."""

    def tried(clean: Column) -> Column:
        return F.coalesce(
            *[F.when(clean.rlike(shape), F.try_to_date(clean, layout)) for shape, layout in DATE_LAYOUTS]
        )

    return let(norm_ws(text), tried)


def loose_date(text: Column) -> Column:
    """Like parse_date, after a leading weekday and ordinal suffixes are dropped."""
    clean = F.regexp_replace(norm_ws(text), rf"(?i)^{WEEKDAY_RE},?\s+", "")
    return parse_date(F.regexp_replace(clean, r"(?i)(\d)(?:st|nd|rd|th)\b", "$1"))


def date_range(text: Column) -> Column:
    """struct<start: date, end: date> found in a text.

    A range takes a missing start month or year from its end; else the first two
    full dates count; a single full date is both start and end.
    """
    clean = norm_ws(F.translate(F.coalesce(text, F.lit("")), "–—", "--"))
    clean = F.regexp_replace(clean, r"\([^)]*\)", "")
    clean = F.regexp_replace(clean, rf"(?i)\b{WEEKDAY_RE},?\s+", "")
    clean = F.regexp_replace(clean, r"(?i)\b(\d{1,2})(?:st|nd|rd|th)\b", "$1")

    def ends(body: Column) -> Column:
        def part(group: int) -> Column:
            return F.regexp_extract(body, RANGE_RE, group)

        def or_end(group: int, fallback: int) -> Column:
            return F.coalesce(F.nullif(part(group), F.lit("")), part(fallback))

        singles = F.regexp_extract_all(body, F.lit(FULL_DATE_RE), F.lit(0))
        first = F.get(singles, F.lit(0))
        return F.when(
            body.rlike(RANGE_RE),
            F.array(
                F.concat_ws(" ", part(1), or_end(2, 5), or_end(3, 6)), F.concat_ws(" ", part(4), part(5), part(6))
            ),
        ).otherwise(F.array(first, F.coalesce(F.get(singles, F.lit(1)), first)))

    days = F.transform(let(clean, ends), lambda t: loose_date(t))
    return let(days, lambda d: F.struct(F.get(d, F.lit(0)).alias("start"), F.get(d, F.lit(1)).alias("end")))


def money(text: Column) -> Column:
    """The first pound amount of a text as DOUBLE, else NULL."""
    digits = F.replace(F.regexp_extract(F.coalesce(text, F.lit("")), MONEY_RE, 1), F.lit(","), F.lit(""))
    return digits.try_cast("double")


def academic_year(day: Column) -> Column:
    """'2026/27': the year label of the September-based year a day falls in."""
    first = F.year(day) - F.when(F.month(day) >= 9, 0).otherwise(1)
    return F.format_string("%d/%02d", first, F.pmod(first + 1, F.lit(100)))


def calendar_labels(country: Column, as_of: Column) -> Column:
    """The current and the next year label: calendar years in AU, September years elsewhere."""
    this_year = F.year(as_of)
    sept = this_year - F.when(F.month(as_of) >= 9, 0).otherwise(1)

    def label(first: Column) -> Column:
        return F.format_string("%d/%02d", first, F.pmod(first + 1, F.lit(100)))

    return F.when(
        country == "AU", F.array(this_year.cast("string"), (this_year + 1).cast("string"))
    ).otherwise(F.array(label(sept), label(sept + 1)))
