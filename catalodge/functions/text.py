"""Text expressions: whitespace, keys, cutting, loose comparison, windows of text."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A note that contains one of these was written by a failed fetch.
FAILURE_MARKERS = ("失败", "Cloudflare", "待重试", "待下轮", "timeout", "异常")

# A plain decimal number, optionally signed, with optional exponent.
NUMBER_RE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once and bound to a name.

    Plain composition would copy the expression of ``value`` into every place that
    uses it; nested a few levels deep, such plans outgrow the optimizer.
    """
    return F.get(F.transform(F.array(value), lambda bound: body(bound)), F.lit(0))


def quoted(literal: str) -> str:
    """``literal`` as a Java regular expression that matches exactly itself."""
    return "\\Q" + literal.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def norm_ws(value: Column) -> Column:
    """Collapse every run of (Unicode) white space to one blank and trim; NULL becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), r"(?U)\s+", " "))


def _accent_tables() -> tuple[str, str]:
    """Accented Latin letters and their base letters, from the Unicode decompositions."""
    accented, base = [], []
    for code in range(0x00C0, 0x0250):
        char = chr(code)
        plain = unicodedata.normalize("NFD", char)[0]
        if plain != char and plain.isascii():
            accented.append(char)
            base.append(plain)
    return "".join(accented), "".join(base)


def ci_key(value: Column) -> Column:
    """Join/group key for text that the tables compare without case, accents or trailing blanks."""
    accented, base = _accent_tables()
    trimmed = F.rtrim(value)
    # Text of one byte for each character has no accents, and translating is the costly part.
    plain = F.octet_length(value) == F.char_length(value)
    return F.lower(F.when(plain, trimmed).otherwise(F.translate(trimmed, accented, base)))


def truncate(value: Column, limit: int) -> Column:
    """At most ``limit`` characters; a cut text ends in an ellipsis."""
    return F.when(
        F.char_length(value) > limit, F.concat(F.substring(value, 1, limit - 1), F.lit("…"))
    ).otherwise(value)


def as_number(value: Column) -> Column:
    """The number a text stands for, or NULL."""
    text = value.cast("string")
    return F.when(text.rlike(NUMBER_RE), F.trim(text).try_cast("double"))


def _strip(value: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def differs(old: Column, new: Column) -> Column:
    """Loose inequality: as numbers where both are numbers, else as text without outer white space.

    A missing side differs from a present one; two missing sides are equal.
    """
    a, b = as_number(old), as_number(new)
    both = a.isNotNull() & b.isNotNull()
    texts = _strip(old.cast("string")) != _strip(new.cast("string"))
    return (
        F.when(old.isNull() | new.isNull(), old.isNull() != new.isNull())
        .when(both, a != b)
        .otherwise(texts)
    )


def clean_failure_note(note: Column) -> Column:
    """Drop a note left by an earlier failure, keep any other note."""
    failed = F.lit(False)
    for marker in FAILURE_MARKERS:
        failed = failed | note.contains(marker)
    return F.when(~failed, note)


def title_case(text: Column) -> Column:
    """Capital first letter of every run of letters, the rest small."""
    runs = F.split(F.lower(text), r"(?<=[^a-z])(?=[a-z])")
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def first_match(text: Column, *patterns: str, ignore_case: bool = True) -> Column:
    """First capture group of the first pattern that matches, white space collapsed."""
    flag = "(?i)" if ignore_case else ""
    source = F.coalesce(text, F.lit(""))
    found = [
        F.when(source.rlike(flag + p), norm_ws(F.regexp_extract(source, flag + p, 1)))
        for p in patterns
    ]
    return F.coalesce(*found)


def pick(pairs: Column, labels: Sequence[str]) -> Column:
    """Value of a label/value map: exact key first, else the first key that contains a label."""
    lowered = [label.lower() for label in labels]
    exact = [F.try_element_at(pairs, F.lit(label)) for label in lowered]

    def mentions(key: Column, _value: Column) -> Column:
        hit = F.lit(False)
        for label in lowered:
            hit = hit | key.contains(label)
        return hit

    return F.coalesce(*exact, F.get(F.map_values(F.map_filter(pairs, mentions)), F.lit(0)))


def window_around(text: Column, needle: Column, size: int = 220) -> Column:
    """White-space-normal text from ``size`` characters before the needle to ``size`` after its start."""
    at = F.instr(text, needle)
    start = F.greatest(at - 1 - size, F.lit(0))
    return F.when(at > 0, norm_ws(F.substring(text, start + 1, at - 1 + size - start))).otherwise("")


def split_lines(text: Column) -> Column:
    return F.split(text, "\n")
