"""Identity lookups: by one key, then by another; names against official lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalodge.functions.text import norm_ws
from catalodge.operators.identity import text_key
from catalodge.session import materialize


def _unique(target: DataFrame, keys: Sequence[str], id_column: str, key: str, alias: str, prefer: Sequence[Column] = ()) -> DataFrame:
    """One id per key: the preferred row, then the lowest id. Rows with a NULL key part match nothing."""
    rows = target.withColumn(key, text_key(target, keys)).where(F.col(key).isNotNull())
    rank = F.struct(*[p.alias(f"p{i}") for i, p in enumerate(prefer)], F.col(id_column))
    return rows.groupBy(key).agg(F.min_by(F.col(id_column), rank).alias(alias))


def _two_keys(
    records: DataFrame, target: DataFrame, id_column: str, first: Sequence[str], second: Sequence[str], prefer: Sequence[Column] = ()
) -> DataFrame:
    keyed = records.withColumns({"__k1": text_key(records, first), "__k2": text_key(records, second)})
    out = keyed.join(_unique(target, first, id_column, "__k1", "__id1"), "__k1", "left")
    return out.join(_unique(target, second, id_column, "__k2", "__id2", prefer), "__k2", "left")


def lookup_two_step(
    records: DataFrame, target: DataFrame, id_column: str, first: Sequence[str], second: Sequence[str]
) -> DataFrame:
    """Add ``id_column``: found by the first key, else by the second, else NULL. Text is compared by ``ci_key``."""
    out = _two_keys(records, target, id_column, first, second)
    return out.select(*records.columns, F.coalesce("__id1", "__id2").alias(id_column))


def lookup_code_or_name(
    records: DataFrame, target: DataFrame, id_column: str, scope: Sequence[str], code: str, name: str
) -> DataFrame:
    """Records with a code match by code alone; others match by name, coded rows first, then the lowest id."""
    out = _two_keys(records, target, id_column, [*scope, code], [*scope, name], prefer=[F.col(code).isNull()])
    found = F.when(F.col(code).isNotNull(), F.col("__id1")).otherwise(F.col("__id2"))
    return out.select(*records.columns, found.alias(id_column))


def name_lists(names: DataFrame, scope: Sequence[str], name: str, longest_first: bool = True) -> DataFrame:
    """One row per scope with its official names as an array, longest first or in list order.

    Official names come from configuration: a school lists a few dozen.
    """
    key = F.lower(F.replace(norm_ws(F.col(name)), F.lit(" and "), F.lit(" & ")))
    order = -F.char_length(name) if longest_first else F.coalesce(F.col("position"), F.lit(0))
    entries = names.groupBy(*scope).agg(
        F.array_sort(
            F.collect_set(F.struct(order.alias("rank"), F.col(name).alias("name"), F.lower(key).alias("key")))
        ).alias("names")
    )
    return entries


def longest_name_in(text: Column, names: Column) -> Column:
    """First (longest) listed name that occurs in the text and is not continued by a letter."""
    hay = F.replace(F.lower(norm_ws(text)), F.lit(" and "), F.lit(" & "))

    def occurs(entry: Column) -> Column:
        # The plain substring test is cheap and rules out nearly every name.
        exact = F.concat(F.lit("\\Q"), entry["key"], F.lit("\\E(?![a-z])"))
        return hay.contains(entry["key"]) & F.regexp_like(hay, exact)

    return F.get(F.filter(names, occurs), F.lit(0))["name"]


def canonical_mention(text: Column, mention_re: Column, names: Column) -> Column:
    """Official name of the first mention that equals or starts with one; list order breaks ties."""
    mentions = F.transform(
        F.regexp_extract_all(text, mention_re, F.lit(0)),
        lambda m: F.trim(F.regexp_replace(F.replace(F.lower(m), F.lit(" and "), F.lit(" & ")), r"\s+", " ")),
    )
    hits = F.transform(
        mentions, lambda m: F.get(F.filter(names, lambda n: m.startswith(n["key"])), F.lit(0))["name"]
    )
    return F.get(F.filter(hits, lambda h: h.isNotNull()), F.lit(0))


def top_ancestors(tree: DataFrame, id_column: str = "id", parent: str = "parent_id") -> DataFrame:
    """id -> top ancestor of a parent tree of any depth; a parent that does not exist ends the climb.

    Each round doubles the distance climbed, so a chain of n levels takes about log2(n)
    rounds. On a cycle, which a tree does not have, the climb ends after as many rounds as
    doublings fit the number of nodes.
    """
    nodes = tree.select(F.col(id_column).alias("id"), F.col(parent).alias("up"))
    known = nodes.select(F.col("id").alias("up"), F.col("id").alias("top"))
    # A top points to itself; each round a node takes what its present pointer points to.
    climb = nodes.join(known, "up", "left").select("id", F.coalesce("top", "id").alias("top"))
    climb = materialize(climb, "ancestors")
    for _ in range(max(1, climb.count()).bit_length()):
        above = climb.selectExpr("id AS top", "top AS next")
        step = materialize(climb.join(above, "top").select("id", F.col("next").alias("top"), (F.col("next") != F.col("top")).alias("moved")), "ancestors")
        climb = step.select("id", "top")
        if step.where("moved").isEmpty():
            break
    return climb.select(F.col("id").alias(id_column), F.col("top").alias("top_id"))


__all__ = [
    "lookup_two_step", "lookup_code_or_name", "name_lists",
    "longest_name_in", "canonical_mention", "top_ancestors",
]
