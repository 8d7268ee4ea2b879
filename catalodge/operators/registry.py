"""The page registry: what to fetch, what happened, what is new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalodge.functions.rules import category_rank
from catalodge.functions.text import clean_failure_note
from catalodge.operators import ordered

# ---- Fixed values --------------------------------------------------------------
FETCHABLE = ("html", "portlet_post", "cdp")
SKIPPED = ("js_render", "pdf")
DISCOVERY_CATEGORIES = ("program_catalog", "faculty_list", "module_catalog")
FREQUENCY_DAYS = {"daily": 1, "weekly": 7, "quarterly": 90}
OTHER_DAYS = 30
# ---------------------------------------------------------------------------------


def active_tasks(pages: DataFrame, school: str | None = None, category: str | None = None) -> DataFrame:
    """Active pages a plain fetch can read, optionally of one school or category."""
    out = pages.filter((F.col("status") == "active") & F.col("fetch_method").isin(*FETCHABLE))
    if school is not None:
        out = out.filter(F.col("uni_code") == school)
    if category is not None:
        out = out.filter(F.col("category") == category)
    return out


def with_schools(pages: DataFrame, schools: DataFrame) -> DataFrame:
    """Pages with ``uni_code`` and the Chinese name of their school; pages of unknown schools are no tasks.

    ``schools`` (university_id, code, name_zh) has one row for each school.
    """
    named = schools.select("university_id", F.col("code").alias("uni_code"), F.col("name_zh").alias("uni_name_zh"))
    return pages.join(named, "university_id")


def school_tasks(pages: DataFrame, schools: DataFrame, school: str | None = None, category: str | None = None) -> DataFrame:
    """The tasks of ``active_tasks`` with their school."""
    return active_tasks(with_schools(pages, schools), school, category)


def period_days(frequency: Column) -> Column:
    chain = None
    for name, days in FREQUENCY_DAYS.items():
        chain = F.when(frequency == name, days) if chain is None else chain.when(frequency == name, days)
    return chain.otherwise(OTHER_DAYS)


def is_due(as_of: Column, frequency: str = "crawl_freq", fetched: str = "last_fetched_at") -> Column:
    """Not manual, and never fetched or fetched longer ago than the page's period."""
    limit = as_of - F.make_dt_interval(period_days(F.col(frequency)))
    return (F.col(frequency) != "manual") & (F.col(fetched).isNull() | (F.col(fetched) < limit))


def is_discovery(category: str = "category", url: str = "url") -> Column:
    """Catalogue pages; below the module catalogue only its roots, not module pages."""
    return F.col(category).isin(*DISCOVERY_CATEGORIES) & ~(
        (F.col(category) == "module_catalog") & F.col(url).contains("/modules/")
    )


def by_priority(tasks: DataFrame, limit: int | None = None) -> DataFrame:
    """Crawl order: category priority, never fetched first, oldest first, id; top-n on request."""
    out = tasks.orderBy(
        category_rank(F.col("category")),
        F.col("last_fetched_at").isNotNull(),
        F.col("last_fetched_at"),
        F.col("id"),
    )
    return out.limit(limit) if limit else out


def in_focus(keywords: Column, note: Column, title: Column) -> Column:
    """Some keyword occurs in note or title; no configured keyword means everything is in scope."""
    text = F.lower(F.concat_ws(" ", note, title))
    named = (text != "") & F.exists(keywords, lambda k: F.contains(text, F.lower(k)))
    return F.when(keywords.isNull() | (F.size(keywords) == 0), True).otherwise(named)


def scoped_frequency(frequency: Column, category: Column, focus: Column) -> Column:
    return F.when((category == "program_detail") & ~focus, "manual").otherwise(frequency)


def new_pages(registered: DataFrame, discovered: DataFrame, order: Sequence[str]) -> DataFrame:
    """Discovered pages that are not registered, first occurrence per (school, URL)."""
    keys = ["university_id", "url"]
    fresh = discovered.join(registered.select(*keys), keys, "left_anti")
    return ordered.first_per_key(fresh, keys, order)


def moved_pages(log: DataFrame, registered: DataFrame, order: Sequence[str]) -> DataFrame:
    """Registry rows for the targets of moved pages; they inherit title, frequency and note."""
    moved = log.filter(F.col("kind") == "moved").join(
        registered.select("id", "university_id", "category", "title", "crawl_freq", "discovery_note"),
        F.col("page_id") == F.col("id"),
    )
    candidates = moved.select(
        "university_id", "category", F.col("final_url").alias("url"), "title", "crawl_freq", "discovery_note", *order
    )
    return new_pages(registered, candidates, order)


def apply_outcomes(pages: DataFrame, log: DataFrame, order: Sequence[str], at: str = "ts") -> DataFrame:
    """Registry after a batch of fetch outcomes.

    ok sets fetch time, hash and (if changed) change time and clears a failure note;
    dead and moved set the status; failed leaves the fetch time, so the page stays due.
    Everything is a per-page aggregate, combined before the shuffle.
    """
    seq = F.struct(*order)
    kind = F.col("kind")
    failed = kind.isin("failed", "error", "cloudflare")
    ok = kind == "ok"
    ending = kind.isin("dead", "moved")
    effects = log.groupBy("page_id").agg(
        F.max(F.when(~failed, F.col(at))).alias("__fetched"),
        F.max(F.when(ok & F.col("changed"), F.col(at))).alias("__changed"),
        F.max_by("content_hash", F.when(ok, seq)).alias("__hash"),
        F.max_by("kind", F.when(ending, seq)).alias("__status"),
        F.max_by("final_url", F.when(kind == "moved", seq)).alias("__redirect"),
        F.max_by(F.struct("kind", "note"), F.when(kind != "moved", seq)).alias("__last"),
        F.max(ok).alias("__ok"),
    )
    last = F.col("__last")
    out = pages.join(effects, pages["id"] == effects["page_id"], "left")
    note = (
        F.when(last.isNull(), F.col("failure_note"))
        .when(last["kind"] == "dead", "404")
        .when(last["kind"] == "ok", F.lit(None).cast("string"))
        .otherwise(last["note"])
    )
    new = {
        "last_fetched_at": F.coalesce("__fetched", "last_fetched_at"),
        "last_changed_at": F.coalesce("__changed", "last_changed_at"),
        "last_content_hash": F.coalesce("__hash", "last_content_hash"),
        "status": F.coalesce("__status", "status"),
        "redirect_to": F.coalesce("__redirect", "redirect_to"),
        "failure_note": note,
        # Any ok clears it; a failure after that does not bring it back.
        "discovery_note": F.when(F.col("__ok"), clean_failure_note(F.col("discovery_note"))).otherwise(F.col("discovery_note")),
    }
    return out.select(*[new[c].alias(c) if c in new else pages[c] for c in pages.columns])


def changed_versions(
    versions: DataFrame,
    page: str,
    order: Sequence[str],
    content_hash: str,
    known: DataFrame | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """Versions whose hash differs from the version before; the first one of a page counts as changed.

    ``known`` (page, last_hash) is what is stored from earlier runs.
    """
    out = ordered.neighbour(versions, [page], order, {content_hash: "previous_hash"}, bucket)
    if known is not None:
        stored = known.select(page, F.col("last_hash").alias("__stored"))
        out = out.join(stored, page, "left").withColumn(
            "previous_hash", F.coalesce("previous_hash", "__stored")
        ).drop("__stored")
    changed = F.col("previous_hash").isNull() | (F.col("previous_hash") != F.col(content_hash))
    return out.withColumn("changed", changed)


def latest_snapshots(snapshots: DataFrame, page: str, order: Sequence[str]) -> DataFrame:
    return ordered.last_per_key(snapshots, [page], order)


def replay_tasks(tasks: DataFrame, snapshots: DataFrame, page: str, order: Sequence[str]) -> DataFrame:
    """Tasks with their latest stored snapshot; snapshots without a path are skipped."""
    latest = latest_snapshots(snapshots, page, order).filter(F.col("content_path").isNotNull())
    return tasks.join(latest, page)


def count_by(df: DataFrame, *columns: str, name: str = "n") -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))
