"""Views and lists that readers of the tables ask for. Tables have the columns that SURVEY §1 names.

Nothing here sorts a whole table for its own sake: a list with an order returns it as a
`place` column where the list is bounded, else as sort keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalodge.functions import dates
from catalodge.operators import ordered
from catalodge.session import spread

UPCOMING_DAYS = 90
SCHOOL_LEVEL = "(school)"


# ---- filters ---------------------------------------------------------------------------


def upcoming(rows: DataFrame, at: str, as_of: Column, days: int = UPCOMING_DAYS) -> DataFrame:
    """Rows whose time lies between ``as_of`` and ``days`` days later, both included."""
    return rows.filter(F.col(at).between(as_of, as_of + F.make_dt_interval(F.lit(days))))


def current_years(events: DataFrame, as_of: Column) -> DataFrame:
    """(university_id, academic_year, n_events): the years of unfinished events that a school's calendar shows.

    ``events`` (university_id, country, academic_year, start_date, end_date). Years that the
    country's calendar labels name are shown; a school without any of them shows all.
    """
    open_events = events.filter(F.coalesce("end_date", "start_date") >= as_of)
    # Counting first leaves one row per school and year; the rest works on those.
    counted = open_events.groupBy("university_id", "country", "academic_year").agg(F.count(F.lit(1)).alias("n_events"))
    flagged = counted.withColumn("wanted", F.array_contains(dates.calendar_labels(F.col("country"), as_of), F.col("academic_year")))
    some = F.max("wanted").over(Window.partitionBy("university_id"))
    return flagged.withColumn("some", some).filter("wanted OR NOT some").select("university_id", "academic_year", "n_events")


def current_calendar(events: DataFrame, as_of: Column) -> DataFrame:
    """The unfinished events of the years that ``current_years`` shows."""
    open_events = events.filter(F.coalesce("end_date", "start_date") >= as_of)
    return open_events.join(current_years(events, as_of), ["university_id", "academic_year"], "left_semi")


def name_contains(query: str, *names: str) -> Column:
    """The query occurs in one of the names, without case; an empty query matches all."""
    hit = F.lit(not query)
    for name in names:
        hit = hit | F.coalesce(F.contains(F.lower(F.col(name)), F.lower(F.lit(query))), F.lit(False))
    return hit


def search_programs(
    programs: DataFrame, query: str = "", level: str | None = None, faculty: str | None = None, names: Sequence[str] = ("name_en", "name_zh")
) -> DataFrame:
    """Programmes of a level and a faculty, where given, with the query in one of their names."""
    out = programs.filter(name_contains(query, *names))
    if level is not None:
        out = out.filter(F.col("level") == level)
    return out if faculty is None else out.filter(F.col("faculty") == faculty)


def filter_options(rows: DataFrame, column: str) -> DataFrame:
    """The distinct values of a list box with their place in order: a bounded vocabulary."""
    options = rows.select(column).filter(F.col(column).isNotNull()).distinct()
    return options.withColumn("place", F.row_number().over(Window.orderBy(column)).cast("long"))


# ---- views -----------------------------------------------------------------------------


def effective_score(own: str = "ielts_overall", band: str = "band_ielts") -> Column:
    """A programme's own language score, else that of its band."""
    return F.coalesce(own, band)


def program_full(programs: DataFrame, schools: DataFrame, faculties: DataFrame, details: DataFrame, bands: DataFrame) -> DataFrame:
    """Programmes with school, faculty, detail and the effective language score.

    ``programs`` (program_id, university_id, faculty_id, ...), ``schools`` (university_id, univ),
    ``faculties`` (faculty_id, faculty), ``details`` (program_id, tuition_intl, language_band,
    ielts_overall), ``bands`` (university_id, band_code, band_ielts): one row for each key.
    """
    out = programs.join(schools, "university_id").join(faculties, "faculty_id", "left").join(details, "program_id", "left")
    coded = bands.select("university_id", F.col("band_code").alias("language_band"), "band_ielts")
    return out.join(coded, ["university_id", "language_band"], "left").withColumn("ielts", effective_score())


def calendar_view(events: DataFrame, schools: DataFrame) -> DataFrame:
    """Calendar events with the code and Chinese name of their school; days as text."""
    days = {c: F.date_format(c, "yyyy-MM-dd") for c in ("start_date", "end_date") if c in events.columns}
    return events.join(schools.select("university_id", "code", "name_zh"), "university_id").withColumns(days).drop("university_id")


def bridge_view(members: DataFrame, programs: DataFrame, modules: DataFrame, schools: DataFrame) -> DataFrame:
    """Module lists with the names of school and module.

    ``members`` (program_id, module_id, ...), ``programs`` (program_id, university_id),
    ``modules`` (module_id, module_name, ...), ``schools`` (university_id, univ).
    """
    return members.join(programs, "program_id").join(modules, "module_id").join(schools, "university_id")


def deadline_view(deadlines: DataFrame, programs: DataFrame, as_of: Column, days: int = UPCOMING_DAYS) -> DataFrame:
    """Upcoming deadlines with the programme's name, or a mark for those of the school; minutes as text."""
    named = upcoming(deadlines, "deadline_at", as_of, days).join(programs.select("program_id", "program"), "program_id", "left")
    return named.withColumns(
        {"program": F.coalesce("program", F.lit(SCHOOL_LEVEL)), "deadline_at": F.date_format("deadline_at", "yyyy-MM-dd HH:mm")}
    )


def programs_of_modules(members: DataFrame) -> DataFrame:
    """(module_id, program_id, module_type, n_programs): the programmes that list a module.

    One row for each pair instead of a list for each module, so a module that occurs
    everywhere is never gathered in one task.
    """
    parents = members.groupBy("module_id", "program_id").agg(F.min("module_type").alias("module_type"))
    return parents.join(parents.groupBy("module_id").agg(F.count(F.lit(1)).alias("n_programs")), "module_id")


def unit_modules(members: DataFrame, programs: DataFrame, modules: DataFrame) -> DataFrame:
    """Distinct (unit, module_id): modules that programmes of a unit list, and those the unit owns.

    Repeats are dropped once, behind the join.
    """
    listed = spread(members.select("program_id", "module_id"), "program_id").join(programs.select("program_id", "unit"), "program_id")
    owned = modules.filter(F.col("unit").isNotNull()).select("unit", "module_id").distinct()
    return listed.select("unit", "module_id").unionByName(owned).distinct()


def newest_policies(policies: DataFrame, order: Sequence[str]) -> DataFrame:
    """The newest policy of each school, with the minimum score of each part out of its JSON detail."""
    newest = ordered.last_per_key(policies, ["university_id"], order)
    return newest.withColumn("minimum_each", F.get_json_object("detail", "$.minimum_each").cast("int"))


# ---- study plans -----------------------------------------------------------------------


def plan_credits(items: DataFrame) -> DataFrame:
    """Credits and items of each term of a plan: ``items`` (plan_id, term, credits)."""
    total = F.sum(F.col("credits").cast("decimal(18,2)")).cast("double")
    return items.groupBy("plan_id", "term").agg(total.alias("credits"), F.count(F.lit(1)).alias("n_items"))


def plan_sizes(plans: DataFrame, items: DataFrame) -> DataFrame:
    """How many items each plan has, and whether it has any."""
    counts = items.groupBy("plan_id").agg(F.count(F.lit(1)).alias("n"))
    return plans.join(counts, "plan_id", "left").withColumns(
        {"n_items": F.coalesce("n", F.lit(0)), "loaded": F.col("n").isNotNull()}
    ).drop("n")


# ---- lists -----------------------------------------------------------------------------


def top_rows(rows: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of an order with their place; only ``n`` rows of each task are sorted together."""
    top = rows.orderBy(*order).limit(n)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("long"))


def recent_changes(log: DataFrame, order: Sequence[str], n: int = 8, width: int = 21) -> DataFrame:
    """The newest ``n`` entries of a change log with a short text of the change."""
    change = F.concat_ws(" → ", F.substring("old_value", 1, width), F.substring("new_value", 1, width))
    return top_rows(log, [F.desc(c) for c in order], n).withColumn("change", change)


def all_deadlines(of_schools: DataFrame, of_programs: DataFrame) -> DataFrame:
    """School and programme deadlines as one list, told apart by ``kind``."""
    return of_schools.withColumn("kind", F.lit("school")).unionByName(of_programs.withColumn("kind", F.lit("program")), allowMissingColumns=True)


def next_deadlines(deadlines: DataFrame, as_of: Column, order: Sequence[str], n: int = 15) -> DataFrame:
    """The next ``n`` deadlines from ``as_of`` on; ``order`` starts with the time."""
    return top_rows(deadlines.filter(F.col(order[0]) >= as_of), [F.col(c) for c in order], n)


def nearest_deadlines(deadlines: DataFrame, key: str, at: str, as_of: Column) -> DataFrame:
    """For each key the next deadline, else the last one that has passed, and whether it is open."""
    future = F.min(F.when(F.col(at) >= as_of, F.col(at)))
    return deadlines.groupBy(key).agg(F.coalesce(future, F.max(at)).alias("deadline"), future.isNotNull().alias("is_open"))


# The orders of the exports, as sort keys in front of the id: units with the top ones first,
# sources with dead ones and then noted ones first, events with missing days first.
EXPORT_ORDERS = {
    "faculties": {"below": "CASE WHEN parent_id IS NULL THEN 0 ELSE 1 END"},
    "source_pages": {
        "alive": "CASE WHEN status = 'dead' THEN 0 ELSE 1 END",
        "unnoted": "CASE WHEN note IS NOT NULL THEN 0 ELSE 1 END",
        "sort_category": "category",
    },
    "calendar_events": {"day": "coalesce(CAST(start_date AS STRING), '')"},
}


def export_order(rows: DataFrame, kind: str, school: str = "university_id", range_size: int = 100_000) -> DataFrame:
    """Add ``place``: a row's number in its school's list of an export.

    The sort keys, with ids in ranges, make the bucket: a large school is numbered by several tasks.
    """
    keys = EXPORT_ORDERS[kind]
    keyed = rows.withColumns({k: F.expr(e) for k, e in keys.items()})
    bucket = F.struct(*keys, F.floor(F.col("id") / range_size).alias("id_range"))
    return ordered.number_rows(keyed, [school], [*keys, "id"], "place", bucket).drop(*keys)


def card_order() -> list[Column]:
    """Unit cards with most programmes first, then with most modules, then by unit."""
    return [F.desc("n"), F.desc("n_modules"), F.asc("top_id")]


def placed_cards(cards: DataFrame, n: int | None = None) -> DataFrame:
    """Unit cards of one school with their place; units are a vocabulary of a few hundred."""
    if n is not None:
        return top_rows(cards, card_order(), n)
    return cards.withColumn("place", F.row_number().over(Window.orderBy(*card_order())).cast("long"))


def code_order(modules: DataFrame, code: str = "code", missing: str = "zz") -> DataFrame:
    """Add ``place``: modules by code, those without one last, then by id, over the whole table.

    Rows are ranged by code and id, numbered inside their range, and moved by the rows of
    the ranges before: only the counts of the ranges meet in one task.
    """
    keyed = modules.withColumn("__code", F.coalesce(code, F.lit(missing)))
    return ordered.number_all(keyed, ["__code", "id"], "place").drop("__code")


def mark_parsed(snapshots: DataFrame, parsed: DataFrame) -> DataFrame:
    """Set ``parsed_ok`` of the snapshots that ``parsed`` (snapshot_id) lists; others keep their value."""
    marks = parsed.select("snapshot_id").distinct().withColumn("__parsed", F.lit(True))
    return snapshots.join(marks, "snapshot_id", "left").withColumn("parsed_ok", F.coalesce("__parsed", "parsed_ok")).drop("__parsed")
