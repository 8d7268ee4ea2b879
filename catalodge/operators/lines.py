"""Operators on the text lines of one page, held as an array in its row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_value_pairs(lines: Column, is_label: Callable[[Column], Column]) -> Column:
    """array<struct<line_no, label, value>>: each label line with the line right behind it."""
    numbered = F.transform(
        lines,
        lambda line, at: F.struct(at.alias("line_no"), line.alias("label"), F.get(lines, at + 1).alias("value")),
    )
    return F.filter(numbered, lambda p: p["value"].isNotNull() & F.coalesce(is_label(p["label"]), F.lit(False)))
