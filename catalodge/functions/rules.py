"""Ordered keyword rules. A rule list is data; the first rule that matches decides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values -----------------------------------------------------------
# Calendar wording -> event type, in order; the first match wins.
EVENT_RULES = (
    (("welcome", "induction", "o-week", "orientation"), "welcome_week"),
    (("academic year",), "other"),
    (("orientation",), "welcome_week"),
    (("reading week",), "reading_week"),
    (("resit",), "resit_period"),
    (("exam", "assessment", "revision"), "exam_period"),
    (("holiday",), "holiday"),
    (("vacation", "closure", "closed", "break"), "closure"),
    (("graduation",), "graduation"),
    (("term", "semester", "teaching"), "teaching_period"),
)
RESIT_MONTHS = (7, 8)

# Crawl order of page categories.
CATEGORY_PRIORITY = (
    "deadlines", "term_dates", "ug_admissions", "pg_admissions", "language_req",
    "china_page", "fees", "program_detail", "program_catalog", "faculty_list",
    "module_catalog", "staff_list", "research", "news", "other",
)

# Fee labels, exclusions and the plausible range.
FEE_INTL_LABELS = (
    "International & EU", "Overseas students", "International students",
    "Overseas fee", "International fee", "Overseas", "International",
)
FEE_HOME_LABELS = ("Home & RUK", "UK students", "Home students", "Home fee", "Home (UK)", "Home")
FEE_EXCLUDE = (
    "deposit", "application fee", "scholarship", "discount",
    "bursar", "living cost", "accommodation", "per year for books",
)
FEE_MIN, FEE_MAX = 3500, 70000

# Markers of a bot-check page.
CHALLENGE_MARKERS = (
    "Just a moment", "cf-challenge", "Checking your browser",
    "Pardon Our Interruption", "Human Verification",
    "Incapsula", "_Incapsula_Resource", "Request unsuccessful",
)

# A name that is only a placeholder or a piece of markup.
JUNK_NAME_RE = r'(?i)^\[|^["{<]|^(Modules?|Year [0-9]|Semester [0-9]|Optional|Core)$'

# Assessment wording -> class, in order.
ASSESSMENT_RULES = (
    (r"(?i)exam", "exam"),
    (r"(?i)course|assignment|essay|report|project|lab", "coursework"),
    (r"(?i)group|class|present|participation|quiz|test", "group"),
)
# -----------------------------------------------------------------------------


def contains_any(text: Column, words: Sequence[str]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word)
    return hit


def ordered(cases: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """First case whose condition holds, as one CASE expression."""
    chain = None
    for condition, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return default if chain is None else chain.otherwise(default)


def by_pattern(text: Column, shapes: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """Value of the first pattern that matches, for example the shape of a page from its URL."""
    return ordered([(text.rlike(pattern), value) for pattern, value in shapes], default)


def event_type(name: Column, start: Column | None = None) -> Column:
    """Calendar event type from its wording; an exam period in the resit months is a resit period."""
    lowered = F.lower(F.coalesce(name, F.lit("")))
    kind = ordered([(contains_any(lowered, words), kind) for words, kind in EVENT_RULES], "other")
    if start is None:
        return kind
    return F.when(
        (kind == "exam_period") & F.coalesce(F.month(start).isin(*RESIT_MONTHS), F.lit(False)),
        "resit_period",
    ).otherwise(kind)


def assessment_class(kind: Column) -> Column:
    return ordered([(kind.rlike(pattern), value) for pattern, value in ASSESSMENT_RULES], "other")


def is_junk_name(name: Column) -> Column:
    return name.rlike(JUNK_NAME_RE)


def is_runaway(translated: Column, original: Column) -> Column:
    """A translation far longer than its original is a repetition loop."""
    return F.char_length(translated) > F.greatest(F.lit(60), 3 * F.char_length(original))


def response_kind(
    status: Column, body_head: Column, moved: Column, method: Column, failed: Column | None = None
) -> Column:
    """Outcome of a fetch: challenge page, rate limit, dead, moved, transient, error or ok."""
    cases = [(contains_any(F.coalesce(body_head, F.lit("")), CHALLENGE_MARKERS), "cloudflare")]
    if failed is not None:
        cases.insert(0, (failed, "error"))
    cases += [
        (status == 429, "cloudflare"),
        (status == 404, "dead"),
        ((method != "portlet_post") & moved, "moved"),
        (status >= 500, "transient"),
        (status != 200, "error"),
    ]
    return ordered(cases, "ok")


def category_rank(category: Column) -> Column:
    """1-based crawl priority, 0 for a category that is not listed."""
    return F.array_position(F.array(*[F.lit(c) for c in CATEGORY_PRIORITY]), category)


def ielts(text: Column) -> Column:
    """struct<overall, minimum> of the language scores named near each mention.

    Scores with a decimal point count; only a mention without any falls back to a
    whole number right behind it. The minimum is set only if two scores differ.
    """
    spans = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?is)IELTS.{0,260}"), F.lit(0))

    def scores(span: Column) -> Column:
        exact = F.regexp_extract_all(span, F.lit(r"\b([4-9]\.[05])\b"), F.lit(1))
        whole = F.regexp_extract_all(span, F.lit(r"\bIELTS\D{0,30}\b([4-9])\b"), F.lit(1))
        return F.when(F.size(exact) > 0, exact).otherwise(whole)

    found = F.transform(F.flatten(F.transform(spans, scores)), lambda s: s.cast("double"))
    valid = F.filter(found, lambda v: v.between(4.0, 9.0))
    return F.struct(
        F.array_max(valid).alias("overall"),
        F.when(F.size(F.array_distinct(valid)) > 1, F.array_min(valid)).alias("minimum"),
    )


def band(text: Column, letters: str = "A-E", prefix: str = "band") -> Column:
    letter = F.regexp_extract(F.coalesce(text, F.lit("")), rf"(?i)\bBand\s+([{letters}])\b", 1)
    return F.when(letter != "", F.concat(F.lit(prefix + "-"), F.upper(letter)))
