"""Votes, cards and grouped reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalodge.operators import ordered

from catalodge.operators.lookup import top_ancestors
from catalodge.session import materialize


def majority_vote(
    members: DataFrame, owner: str, choice: str, min_votes: int = 3
) -> DataFrame:
    """Owner -> choice that holds a strict majority with at least ``min_votes`` votes.

    Votes are counted per (owner, choice) with partial counts before the shuffle;
    the second step only sees one row per choice. A strict majority is unique, so
    the tie-break by choice never decides a result.
    """
    counted = members.filter(F.col(choice).isNotNull()).groupBy(owner, choice).agg(F.count(F.lit(1)).alias("votes"))
    best = counted.groupBy(owner).agg(
        F.max(F.struct(F.col("votes"), F.col(choice))).alias("best"), F.sum("votes").alias("total")
    )
    return best.filter((F.col("best.votes") >= min_votes) & (F.col("best.votes") * 2 > F.col("total"))).select(
        owner, F.col(f"best.{choice}").alias(choice), F.col("best.votes").alias("votes"), F.col("total").alias("total_votes")
    )


def unit_cards(
    tree: DataFrame, programs: DataFrame, modules: DataFrame, unit: str, level: str, first_level: str
) -> DataFrame:
    """Per top unit: programmes, first-level ones, others and modules; 0 stands for unclassified.

    Programmes without a known unit count as unclassified, modules without one are left out.
    Counts are taken per unit first; only those small counts climb the tree.
    """
    tops = top_ancestors(tree)
    p = programs.groupBy(unit).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(level) == first_level).alias("n_first")
    ).withColumn("n_modules", F.lit(0).cast("long"))
    m = modules.filter(F.col(unit).isNotNull()).groupBy(unit).agg(F.count(F.lit(1)).alias("n_modules"))
    m = m.select(unit, F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("n_first"), "n_modules")
    both = p.unionByName(m).join(tops, F.col(unit) == tops["id"], "left")
    out = both.groupBy(F.coalesce("top_id", F.lit(0)).alias("top_id")).agg(
        F.sum("n").alias("n"), F.sum("n_first").alias("n_first"), F.sum("n_modules").alias("n_modules")
    )
    return out.withColumn("n_other", F.col("n") - F.col("n_first")).filter("n + n_modules > 0")


def department_cards(programs: DataFrame, unit: str, level: str, first_level: str) -> DataFrame:
    """Per direct unit with at least one programme: totals by level."""
    return (
        programs.groupBy(F.coalesce(unit, F.lit(0)).alias(unit))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(level) == first_level).alias("n_first"))
        .withColumn("n_other", F.col("n") - F.col("n_first"))
    )


def ratio_text(part: Column, whole: Column) -> Column:
    return F.concat_ws("/", part.cast("string"), whole.cast("string"))


def exam_share(items: Column) -> Column:
    """Weight of the exam items of array<struct<type, weight>>."""
    exams = F.filter(items, lambda a: a["type"].rlike("(?i)exam"))
    return F.aggregate(exams, F.lit(0).cast("long"), lambda s, a: s + F.coalesce(a["weight"], F.lit(0)))


def total_weight(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda s, a: s + F.coalesce(a["weight"], F.lit(0)))


def chunked_lists(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], element: Column, limit: int = 10_000
) -> DataFrame:
    """(keys, chunk, n_chunks, items): sorted lists per key, cut into chunks of ``limit`` items.

    Chunks are numbered from 0 in the order of the key's rows, so laid end to end they are
    its whole sorted list; a short list is a single chunk. No task holds more than a chunk
    or a range of rows, and no row is dropped. Rows of keys with no more than ``limit`` rows
    are shuffled once; only those of larger keys are dealt into ranges and numbered.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit)
    large = materialize(sizes.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.lit(True).alias("__large")), "large-keys")
    if large.isEmpty():
        return _whole_lists(rows, keys, order, element)
    same = F.lit(True)
    for k in keys:
        same = same & rows[k].eqNullSafe(large[f"__k_{k}"])
    # At most one row for each ``limit`` rows of the table.
    marked = rows.join(F.broadcast(large), same, "left")
    short = marked.where("__large IS NULL").select(*rows.columns)
    long = marked.where("__large").select(*rows.columns)
    return _whole_lists(short, keys, order, element).unionByName(_numbered_lists(long, keys, order, element, limit))


def _whole_lists(rows: DataFrame, keys: Sequence[str], order: Sequence[str], element: Column) -> DataFrame:
    """Each key's sorted list as its only chunk."""
    entry = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], element.alias("e"))
    lists = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("__items"))
    one = {"chunk": F.lit(0), "n_chunks": F.lit(1), "items": F.transform("__items", lambda i: i["e"])}
    return lists.withColumns(one).select(*keys, *one)


def _numbered_lists(rows: DataFrame, keys: Sequence[str], order: Sequence[str], element: Column, limit: int) -> DataFrame:
    numbered = ordered.number_in_keys(rows.withColumn("__element", element), keys, order, "__number", "__total")
    placed = numbered.withColumns(
        {
            "chunk": F.floor((F.col("__number") - 1) / limit).cast("int"),
            "n_chunks": F.ceil(F.col("__total") / limit).cast("int"),
        }
    )
    items = F.array_sort(F.collect_list(F.struct("__number", F.col("__element").alias("e"))))
    return placed.groupBy(*keys, "chunk", "n_chunks").agg(F.transform(items, lambda i: i["e"]).alias("items"))
