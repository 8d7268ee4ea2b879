"""Joins against one row per key, and connected components of a link table, both safe for hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalodge.session import materialize, written

# A key counts as heavy from this share of the rows on, so there are at most as many heavy keys.
MAX_HEAVY_KEYS = 4096
# A table of no more keys than this is broadcast as a whole.
FEW_KEYS = 1 << 16


def hot_lookup(left: DataFrame, right: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join of many rows with a table that has one row for each key.

    ``right[count]`` says how many rows of ``left`` have the key. Keys with a
    MAX_HEAVY_KEYS-th of all rows or more are at most MAX_HEAVY_KEYS in number, which
    bounds the broadcast; their rows stay where they are. All other rows meet ``right``
    in a shuffled join, whose largest key is then small. With FEW_KEYS keys or fewer all stay.
    """
    keys, total = right.agg(F.count("*"), F.coalesce(F.sum(count), F.lit(0))).first()
    if keys <= FEW_KEYS:
        return left.join(F.broadcast(right), key)
    least = max(2, total // MAX_HEAVY_KEYS + 1)
    heavy = F.broadcast(right.where(F.col(count) >= least))
    light = right.where(F.col(count) < least)
    hot = left.join(heavy, key)
    cold = left.join(heavy.select(key), key, "left_anti").join(light.hint("merge"), key)
    return hot.unionByName(cold)


def _large_star(links: DataFrame, n: int) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    least = written(least.withColumn("m", F.least("u", "m")), "large-star", 2 * n)
    return hot_lookup(both.where("v > u"), least, "u", "n").selectExpr("v AS u", "m AS v").where("u != v").distinct()


def _small_star(links: DataFrame, n: int) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "small-star", n)
    others = hot_lookup(down, least, "u", "n").where("v != m").selectExpr("v AS u", "m AS v")
    return others.unionByName(least.selectExpr("u", "m AS v")).distinct()


def component_roots(links: DataFrame) -> DataFrame:
    """(u, v) links between numbers to (node, root): the smallest node of each linked node's component.

    Every round links each node with the smallest node it knows of, through partial
    aggregates and joins; no neighbour list is gathered. After about log(diameter) rounds
    each component is a star. Smallest nodes themselves and nodes without links are not
    listed. Repeated links, loops and an empty table are fine.
    """
    links = materialize(links.select("u", "v").where("u != v").distinct(), "links")
    state = F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    before = links.agg(*state).first()
    while n := before[0]:
        links = written(_large_star(links, n), "links", n)
        links = written(_small_star(links, n), "links", n)
        after = links.agg(*state).first()
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
