"""Configuration documents as rows: layered values, host policies, seeds, rule validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Politeness of a host no school lists.
DEFAULT_INTERVAL = 3.0
DEFAULT_CONCURRENCY = 1
DEFAULT_ENTRY_YEAR = "2026"

GLOBAL, COUNTRY, SCHOOL = 0, 1, 2


def resolve_layers(schools: DataFrame, values: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """(school, key, value) with the most specific layer winning key by key.

    ``schools`` is (school, country), ``defaults`` the global document, ``values``
    (layer, scope, key, value) with a country or a school as scope. Nested documents
    come with dotted keys, so a deep merge is a merge of keys.
    """
    items = [part for key, value in defaults.items() for part in (F.lit(key), F.lit(value))]
    by_country = values.filter(F.col("layer") == COUNTRY).select("layer", F.col("scope").alias("country"), "key", "value")
    by_school = values.filter(F.col("layer") == SCHOOL).select("layer", F.col("scope").alias("school"), "key", "value")
    layered = (
        schools.select("school", F.lit(GLOBAL).alias("layer"), F.explode(F.create_map(*items)).alias("key", "value"))
        .unionByName(schools.join(by_country, "country").select("school", "layer", "key", "value"))
        .unionByName(schools.join(by_school, "school").select("school", "layer", "key", "value"))
    )
    return layered.groupBy("school", "key").agg(F.max_by("value", "layer").alias("value"))


def host_policies(hosts: DataFrame, listed: DataFrame) -> DataFrame:
    """Policy of each host: the one of the first school (by code) that lists it, else the default."""
    first = listed.groupBy("host").agg(
        F.min_by(F.struct("interval", "concurrency"), F.col("school")).alias("p"), F.min("school").alias("school")
    )
    return hosts.join(first, "host", "left").select(
        "host",
        F.coalesce("school", F.lit("-")).alias("school"),
        F.coalesce("p.interval", F.lit(DEFAULT_INTERVAL)).alias("interval"),
        F.coalesce("p.concurrency", F.lit(DEFAULT_CONCURRENCY)).alias("concurrency"),
    )


def seed_rows(schools: DataFrame, seeds: str = "seed_pages") -> DataFrame:
    """One row per configured seed page of each school, in listed order."""
    return schools.select(
        "university_id", F.posexplode(seeds).alias("pos", "seed")
    ).select(
        "university_id",
        "pos",
        "seed.category",
        "seed.url",
        F.coalesce("seed.title", F.lit(None).cast("string")).alias("title"),
        F.coalesce("seed.crawl_freq", F.lit("monthly")).alias("crawl_freq"),
        F.coalesce("seed.fetch_method", F.lit("html")).alias("fetch_method"),
    )


def unknown_references(rules: DataFrame, schools: DataFrame, school: str = "school") -> DataFrame:
    """Rules that name a school no configuration knows."""
    return rules.join(schools.select(school), school, "left_anti")


def check_columns(rules: DataFrame, allowed: Sequence[str], where: str) -> DataFrame:
    """The rules unchanged; raises when a rule table carries a column that no job reads."""
    unknown = sorted(set(rules.columns) - set(allowed))
    if unknown:
        raise ValueError(f"{where} has unknown columns {unknown} (known: {sorted(allowed)})")
    return rules
