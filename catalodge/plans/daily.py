"""The daily run: fetched pages in, updated tables and change log out.

Stages: keep pages whose content changed, extract records with the rule tables,
merge them into the entity tables, register new pages, derive missing fields.
``replay`` runs the same stages over the latest stored snapshots.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalodge.functions import urls
from catalodge.operators import merge, ordered, registry, rollup
from catalodge.plans import calendars, entities, extraction, site_rules
from catalodge.session import materialize
from catalodge.sources.config import DEFAULT_ENTRY_YEAR

PAGE_KEYS = ["page_id", "university_id", "school", "category", "url"]
ORDER = ["page_id", "pos"]
PAGE_RANGE = 10_000


@dataclass(frozen=True)
class Extracted:
    programs: DataFrame
    modules: DataFrame
    references: DataFrame
    calendar: DataFrame
    deadlines: DataFrame
    discovered: DataFrame
    notes: DataFrame


def _of(pages: DataFrame, category: str, *schools: str) -> DataFrame:
    return pages.filter((F.col("category") == category) & F.col("school").isin(*schools))


def all_programs(pages: DataFrame, fields: DataFrame, names: DataFrame, aliases: DataFrame) -> DataFrame:
    """Programmes of detail pages, result lists, search results and unit pages; the last only fill units."""
    detail = extraction.program_records(pages, fields, extraction.scoped_names(names)).withColumns(
        {"pos": F.lit(0).cast("long"), "of_detail": F.lit(True)}
    )
    code = F.array(F.concat(F.lit("handbook code: "), F.coalesce("code", F.lit("None"))))
    listed = extraction.listed_programs(_of(pages, site_rules.CATALOG, "melb")).withColumn("notes", code).drop("code")
    # A subject counts as a unit where the configuration maps it to one.
    official = aliases.groupBy(F.lit("sydney").alias("school")).agg(F.collect_set("dept").alias("fields"))
    searched = extraction.searched_programs(_of(pages, site_rules.CATALOG, "sydney"), official)
    units = _of(pages, site_rules.FACULTIES, "warwick")
    of_units = extraction.reverse_index(units, urls.query_value(F.col("url"), "uaDept"), site_rules.WARWICK_STUDY_RE).drop("school")
    school = pages.select("page_id", "school")
    out = detail
    for more in (listed, searched, of_units):
        shaped = more.withColumn("pos", F.col("pos").cast("long")).join(school, "page_id")
        out = out.unionByName(shaped, allowMissingColumns=True)
    return out.fillna({"of_detail": False, "backfill_only": False, "entry_year": DEFAULT_ENTRY_YEAR, "currency": "AUD"}).withColumn(
        "notes", F.coalesce("notes", F.array().cast("array<string>"))
    )


def all_modules(pages: DataFrame, fields: DataFrame) -> DataFrame:
    """Modules of module pages, result lists, unit tables and lists of articles."""
    out = extraction.module_records(pages, fields).withColumn("pos", F.lit(0).cast("long"))
    of = lambda school: _of(pages, site_rules.MODULES, school)
    school = pages.select("page_id", "school")
    unit_rows = extraction.unit_table_modules(of("man")).withColumn("pos", F.xxhash64("code"))
    for more in (extraction.listed_modules(of("melb")).join(school, "page_id"), unit_rows, extraction.article_modules(of("kcl"))):
        shaped = more.withColumnRenamed("name", "name_en").withColumn("pos", F.col("pos").cast("long"))
        out = out.unionByName(shaped, allowMissingColumns=True)
    return out


def all_deadlines(pages: DataFrame, rules_table: DataFrame) -> DataFrame:
    """Deadlines of wording rules, of tables with rounds, and of tables with a date and a description."""
    found = extraction.deadline_records(pages, rules_table).unionByName(extraction.deadline_rounds(pages), allowMissingColumns=True)
    rows = extraction.deadline_rows(_of(pages, "deadlines", "shef"))
    return found.unionByName(rows, allowMissingColumns=True).withColumn("pos", F.coalesce("pos", F.xxhash64("deadline_at", "note")))


def extract_all(spark: SparkSession, pages: DataFrame, names: DataFrame, aliases: DataFrame) -> Extracted:
    """All records of a set of pages. ``names`` is (school, name, position): the official unit lists; ``aliases`` (dept, official).

    The cut pages are written once, because every job reads them.
    """
    ready = materialize(extraction.prepared(pages), "pages")
    fields, checks = extraction.field_rules(spark), extraction.check_rules(spark)
    discovery, listing, wording = extraction.discovery_rules(spark), extraction.module_rules(spark), extraction.deadline_rules(spark)
    found = {
        "programs": materialize(all_programs(ready, fields, names, aliases), "extracted-programs"),
        "modules": materialize(all_modules(ready, fields), "extracted-modules"),
        "references": materialize(extraction.module_links(ready, listing).join(ready.select("page_id", "category"), "page_id"), "references"),
        "calendar": materialize(calendars.calendar_events(ready, spark), "extracted-calendar"),
        "deadlines": materialize(all_deadlines(ready, wording), "extracted-deadlines"),
        "discovered": materialize(extraction.discover(ready, discovery), "discovered"),
    }
    notes = extraction.page_checks(ready, checks).select("page_id", "kind", "message").unionByName(
        extraction.language_info(ready).select("page_id", "kind", "message")
    )
    # A page with rules that gave no row of any kind says so; pages that are only looked at are references.
    keyed = ["school", "category"]
    ruled = fields.select(*keyed).unionByName(discovery.select(*keyed)).unionByName(listing.select(*keyed)).unionByName(wording.select(*keyed))
    ruled = ruled.unionByName(ready.filter(F.col("category") == site_rules.TERMS).select(*keyed)).distinct()
    looked_at = checks.select(*keyed).distinct().join(ruled, keyed, "left_anti")
    counts = None
    for rows in found.values():
        counts = rows.select("page_id") if counts is None else counts.unionByName(rows.select("page_id"))
    counts = counts.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_records"))
    quality = extraction.quality_notes(ready, counts, ruled, looked_at).filter(F.col("kind") != "no rules")
    faults = extraction.page_faults(pages, fields)
    return Extracted(**found, notes=notes.unionByName(quality).unionByName(faults))


def changed_pages(fetched: DataFrame, known: DataFrame) -> DataFrame:
    """Fetched pages (page_id, html, ts, ...) whose content differs from the last stored version."""
    hashed = fetched.withColumn("content_hash", F.sha2(F.col("html").cast("binary"), 256))
    marked = registry.changed_versions(
        hashed, "page_id", ["ts"], "content_hash", known.select("page_id", F.col("content_hash").alias("last_hash")), F.to_date("ts")
    )
    return marked.filter("changed").drop("changed", "previous_hash")


def load(
    spark: SparkSession, tables: Mapping[str, DataFrame], pages: DataFrame, names: DataFrame, config: Mapping[str, DataFrame], fetched_at: Column,
    entry_year: str = DEFAULT_ENTRY_YEAR, crawl_modules: bool = False,
) -> dict[str, DataFrame]:
    """Extract and merge. Returns the new tables, 'change_log', 'new_pages' and 'notes'.

    ``tables`` holds programs, program_details, modules, program_modules, calendar_events,
    deadlines and source_pages; programmes and modules are identified by ``entity_key``.
    ``faculties`` (university_id, name_en, name_zh, parent) is kept as well where it is given.
    ``config`` holds overrides (slug, forced), aliases (dept, official), chinese (faculty, faculty_zh).
    """
    found = extract_all(spark, pages, names, config["aliases"])
    # Folds window inside ranges of pages, so a key that many pages name is not one task.
    bucket = F.floor(F.col("page_id") / PAGE_RANGE)
    owner = pages.select("page_id", "university_id", "discovery_note")
    at = fetched_at.alias("fetched_at")

    programs = found.programs.join(owner, "page_id").withColumn("slug", urls.last_segment(F.col("url")))
    programs = programs.withColumn("dept", F.coalesce("dept", "faculty")).drop("faculty").withColumnRenamed("discovery_note", "note")
    programs = entities.resolve_faculty(programs, config["overrides"], config["aliases"], config["chinese"]).drop("faculty_zh")
    merged, identified = entities.upsert_programs(tables["programs"], programs, ORDER, bucket)
    detail_rows = identified.filter(~F.col("backfill_only")).select("*", F.col("page_id").alias("source_page_id"), at)
    details = entities.upsert_details(tables["program_details"], detail_rows, ORDER, bucket)

    modules = found.modules.join(owner, "page_id").select(
        "page_id", "pos", "university_id", F.lit(entry_year).alias("entry_year"), "code", "name_en",
        F.col("dept").alias("faculty"), "credits", "level", "semester", "leader", "prerequisites",
        F.to_json("assessment").alias("assessment"), "description", "url", F.col("page_id").alias("source_page_id"), at,
        F.lit(None).cast("string").alias("module_type"), F.lit(False).alias("of_program"),
    )
    empty = F.lit(None).cast("string")
    listed = found.references.join(owner, "page_id").select(
        "page_id", (F.col("pos") + 1).cast("long").alias("pos"), "university_id", F.lit(entry_year).alias("entry_year"), "code", F.col("name").alias("name_en"), empty.alias("faculty"),
        F.lit(None).cast("int").alias("credits"), empty.alias("level"), empty.alias("semester"), empty.alias("leader"),
        empty.alias("prerequisites"), empty.alias("assessment"), empty.alias("description"), "url",
        F.col("page_id").alias("source_page_id"), at, "module_type", (F.col("category") == site_rules.DETAIL).alias("of_program"),
    )
    module_merge, resolved = entities.upsert_modules(tables["modules"], modules.unionByName(listed), ORDER, bucket)

    # The bridge names modules by the key that the module table has.
    keyed = identified.filter("of_detail").select("page_id", "entity_key", "level", F.col("entry_year").alias("own_year"))
    links = resolved.filter("of_program").select("page_id", "pos", "module_type", F.col("entity_key").alias("module_id")).join(
        keyed.select("page_id", F.col("entity_key").alias("program_id"), "level"), "page_id"
    )
    members = entities.replace_module_lists(tables["program_modules"], links, ORDER)

    # Of events with one key on a page the last one holds.
    calendar = found.calendar.join(owner, "page_id").select("*", F.col("page_id").alias("source_page_id"), at)
    events = entities.upsert_calendar(tables["calendar_events"], calendar, ORDER, bucket)
    deadline_rows = found.deadlines.join(owner, "page_id").join(
        keyed.select("page_id", F.col("entity_key").alias("program_key"), "own_year"), "page_id", "left"
    ).select(
        "page_id", "pos", "university_id", "program_key", F.coalesce("own_year", F.lit(entry_year)).alias("entry_year"), "audience",
        "deadline_type", "round_no", "deadline_at", "note", F.col("page_id").alias("source_page_id"), at,
        F.col("deadline_at").alias("log_label"),
    )
    deadlines = entities.upsert_deadlines(tables["deadlines"], deadline_rows, ORDER, bucket)

    discovered = found.discovered.join(owner.select("page_id", "university_id"), "page_id")
    linked = entities.module_pages(found.references.filter(F.col("category") == site_rules.DETAIL).join(owner, "page_id"), F.lit(crawl_modules))
    linked = linked.withColumn("page_id", F.lit(None).cast("long"))
    candidates = discovered.unionByName(linked, allowMissingColumns=True)
    new_pages = registry.new_pages(tables["source_pages"], candidates, [F.col("page_id").isNull().alias("linked"), "page_id", "title"])
    unnamed = entities.incomplete_programs(programs).select(
        "page_id", F.lit("incomplete").alias("kind"), F.concat_ws(" ", F.lit("programme without level or name:"), "url").alias("message")
    )
    notes = found.notes.unionByName(unnamed)
    log_columns = ["entity_type", "change_type", "field_name", "old_value", "new_value", "page_id"]
    logs = [m.log.select(*log_columns) for m in (merged, details, module_merge, events, deadlines)]
    log = logs[0]
    for more in logs[1:]:
        log = log.unionByName(more)
    units = {}
    if "faculties" in tables:
        named = programs.select("university_id", F.col("faculty").alias("name_en"), "page_id", "pos", entities.note_parent(F.col("note")).alias("parent"))
        fresh = entities.new_faculties(tables["faculties"].select("university_id", "name_en"), named, ORDER)
        # A unit named in front of another one is a unit as well.
        above = fresh.filter(F.col("parent").isNotNull()).select("university_id", F.col("parent").alias("name_en"), "page_id", "pos")
        above = entities.new_faculties(tables["faculties"].select("university_id", "name_en").unionByName(fresh.select("university_id", "name_en")), above, ORDER)
        grown = tables["faculties"].unionByName(fresh.unionByName(above, allowMissingColumns=True).drop("page_id", "pos"), allowMissingColumns=True)
        chinese = grown.select("university_id", "name_en").join(config["chinese"], F.col("name_en") == F.col("faculty"))
        units["faculties"] = entities.fill_chinese_names(grown, chinese.select("university_id", "name_en", F.col("faculty_zh").alias("name_zh")))
    derived = derive_faculties(merged.table, members, module_merge.table)
    return units | {
        "programs": derived, "program_details": details.table, "modules": module_merge.table, "program_modules": members,
        "calendar_events": events.table, "deadlines": deadlines.table, "change_log": log, "new_pages": new_pages, "notes": notes,
    }


def derive_faculties(programs: DataFrame, program_modules: DataFrame, modules: DataFrame) -> DataFrame:
    """Fill the missing unit of programmes by the majority of their modules."""
    units = modules.filter(F.col("faculty").isNotNull()).select(F.col("entity_key").alias("module_id"), "faculty")
    members = program_modules.select("program_id", "module_id").join(units, "module_id")
    votes = rollup.majority_vote(members, "program_id", "faculty").withColumnRenamed("program_id", "entity_key")
    return merge.fill_missing(programs, votes, ["entity_key"], "faculty")


def replay(
    spark: SparkSession, tables: Mapping[str, DataFrame], snapshots: DataFrame, names: DataFrame, config: Mapping[str, DataFrame], fetched_at: Column
) -> dict[str, DataFrame]:
    """The same run over the latest stored snapshot of every page; nothing is fetched."""
    latest = ordered.last_per_key(snapshots.filter(F.col("html").isNotNull()), ["page_id"], ["ts"])
    return load(spark, tables, latest, names, config, fetched_at)
