"""What can be reached over a table of links, round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalodge.session import materialize

# Rounds after which the tables of nodes seen are written as one.
COMPACT = 8


def reachable(seeds: DataFrame, edges: DataFrame, source: str, target: str) -> DataFrame:
    """(node, round): each node that ``seeds`` (node) lead to, with the round that found it first; seeds have round 0.

    Semi-naive: a round follows the links of the nodes of the round before only, and keeps
    those that no round has seen, so cycles end and every node is followed once. ``edges``
    has two columns of the same type; links to NULL are left out. Each round is written, so
    a lost executor costs the round at work and no plan grows with the number of rounds.
    """
    edges = edges.select(F.col(source).alias("node"), F.col(target).alias("next")).filter(F.col("next").isNotNull()).distinct()
    edges = materialize(edges, "closure-edges")
    fresh = materialize(seeds.select("node").filter(F.col("node").isNotNull()).distinct().withColumn("round", F.lit(0)), "closure")
    seen, number = fresh, 0
    while not fresh.isEmpty():
        number += 1
        found = fresh.select("node").join(edges, "node").select(F.col("next").alias("node")).distinct()
        fresh = materialize(found.join(seen.select("node"), "node", "left_anti").withColumn("round", F.lit(number)), "closure")
        seen = seen.unionByName(fresh)
        if number % COMPACT == 0:
            seen = materialize(seen, "closure-seen")
    return seen
