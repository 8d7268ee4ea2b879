"""Tuition amounts near a label, with the three passes tried in order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalodge.functions.dates import money
from catalodge.functions.rules import FEE_EXCLUDE, FEE_MAX, FEE_MIN, contains_any


def _plausible(amount: Column, context: Column) -> Column:
    in_range = F.coalesce(amount.between(FEE_MIN, FEE_MAX), F.lit(False))
    return F.when(in_range & ~contains_any(F.lower(context), FEE_EXCLUDE), amount)


def _first(values: Column) -> Column:
    return F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0))


def fee_near(text: Column, labels: Column) -> Column:
    """Amount that belongs to one of the labels (array<string>), else NULL.

    1. the first amount within 500 characters behind a label, labels in order;
    2. a line with an amount whose surroundings (4 lines before, 1 after) name a label;
    3. the first amount within 220 characters behind the first mention of a label.
    """
    body = F.coalesce(text, F.lit(""))

    def literal(label: Column, tail: str) -> Column:
        return F.concat(F.lit("(?is)\\Q"), label, F.lit("\\E" + tail))

    def behind(label: Column) -> Column:
        # The lookahead leaves the text behind a hit open for the next hit.
        tails = F.regexp_extract_all(body, literal(label, "(?=(.{0,500}))"), F.lit(1))
        return _first(F.transform(tails, lambda t: _plausible(money(t), F.substring(t, 1, 160))))

    lines = F.split(body, "\n")

    def in_context(line: Column, at: Column) -> Column:
        first = F.greatest(at - 4, F.lit(0))
        context = F.array_join(F.slice(lines, first + 1, at + 2 - first), " ")
        named = F.exists(labels, lambda label: F.contains(F.lower(context), F.lower(label)))
        return F.when(line.contains("£"), F.when(named, _plausible(money(line), context)))

    def first_mention(label: Column) -> Column:
        # Fixed value: how far behind a label its fee may stand.
        pattern = literal(label, r"[^£]{0,220}£\s*[\d,]+(?:\.\d{1,2})?")
        hit = F.call_function("regexp_extract", body, pattern, F.lit(0))
        return _plausible(money(hit), hit)

    found = F.coalesce(
        _first(F.transform(labels, behind)),
        _first(F.transform(lines, in_context)),
        _first(F.transform(labels, first_mention)),
    )
    return F.when(body.contains("£"), found)
