"""Extracted records to entity tables: the upserts of the daily run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalodge.functions import urls
from catalodge.functions.text import blank_to_null
from catalodge.operators import identity, merge
from catalodge.operators.merge import MergeResult, MergeSpec, Unit
from catalodge.session import materialize

STUB_TEXT = "仅名称/代码来自专业页"  # fixed value: start of a stub description

PROGRAM_NAME = ["university_id", "level", "name_en"]
PROGRAM = MergeSpec.simple(
    "program", ("entity_key",), ("faculty", "url", "slug", "ucas_code", "duration"),
    insert_only=("university_id", "level", "name_en"), log_insert=True, label="name_en",
)
PROGRAM_DETAIL = MergeSpec.simple(
    "program_detail", ("entity_key", "entry_year"),
    ("tuition_home", "tuition_intl", "entry_req_text", "language_band", "ielts_overall", "ielts_detail",
     "app_open_date", "extra", "source_page_id", "fetched_at"),
    tracked=("tuition_home", "tuition_intl", "entry_req_text", "language_band", "ielts_overall", "app_open_date"),
    insert_only=("currency",),
)
MODULE = MergeSpec.simple(
    "module", ("entity_key",),
    ("faculty", "credits", "level", "semester", "leader", "prerequisites", "assessment", "description", "url",
     "source_page_id", "fetched_at"),
    tracked=("credits", "leader", "assessment", "semester"),
    insert_only=("university_id", "code", "name_en", "entry_year"),
)
DEADLINE = MergeSpec(
    "deadline",
    ("university_id", "program_key", "entry_year", "audience", "deadline_type", "round_no"),
    (Unit("deadline_at", ("deadline_at", "note", "source_page_id"), tracked=True), Unit("fetched_at", ("fetched_at",))),
    log_insert=True, null_safe=True, label="log_label",
)
CALENDAR = MergeSpec(
    "calendar_event",
    ("university_id", "academic_year", "calendar_track", "event_type", "name"),
    (
        Unit(
            "dates", ("start_date", "end_date", "source_page_id", "fetched_at"), tracked=True,
            compare="concat(coalesce(cast(start_date as string), 'None'), '~', coalesce(cast(end_date as string), 'None'))",
        ),
    ),
)
PLAN = MergeSpec.simple(
    "program_plan", ("program_id", "variant_label", "entry_year"), ("plan", "source_url", "variant_label_zh")
)


def note_faculty(note: Column) -> Column:
    """Last usable part of 'Faculty | Department'."""
    parts = F.filter(F.transform(F.split(note, r"\|"), lambda p: F.trim(p)), lambda p: p != "")
    return blank_to_null(F.try_element_at(parts, F.lit(-1)))


def note_parent(note: Column) -> Column:
    """First part of 'Faculty | Department' when a second, different one follows."""
    parts = F.filter(F.transform(F.split(note, r"\|"), lambda p: F.trim(p)), lambda p: p != "")
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    return F.when(second.isNotNull() & (second != first), first)


def resolve_faculty(
    programs: DataFrame, overrides: DataFrame, aliases: DataFrame, chinese: DataFrame, dept: str = "dept", note: str = "note"
) -> DataFrame:
    """Official faculty name of each programme: manual override, page text through aliases, then the note.

    ``overrides`` (slug, forced), ``aliases`` (dept, official) and ``chinese``
    (faculty, faculty_zh) are configuration; Spark broadcasts them while they are small.
    """
    out = programs.join(overrides, "slug", "left").join(
        aliases.select(F.col("dept").alias("__dept"), "official"), F.col(dept) == F.col("__dept"), "left"
    )
    noted = aliases.select(F.col("dept").alias("__note"), F.col("official").alias("__note_official"))
    out = out.withColumn("__from_note", note_faculty(F.col(note))).join(
        noted, F.col("__from_note") == F.col("__note"), "left"
    )
    faculty = F.coalesce("forced", "official", dept, "__note_official", "__from_note")
    out = out.withColumn("faculty", faculty).join(chinese, "faculty", "left")
    return out.select(*programs.columns, "faculty", "faculty_zh")


def new_faculties(
    stored: DataFrame, mentions: DataFrame, order: list[str]
) -> DataFrame:
    """Faculty rows to append: (university_id, name_en) named by records but not stored, first mention wins."""
    return merge.insert_if_absent(
        stored, mentions.filter(F.col("name_en").isNotNull()), ["university_id", "name_en"], order
    )


def fill_chinese_names(stored: DataFrame, chinese: DataFrame) -> DataFrame:
    """Configured Chinese names for faculties that have none yet."""
    return merge.fill_missing(stored, chinese, ["university_id", "name_en"], "name_zh")


def upsert_programs(
    stored: DataFrame, records: DataFrame, order: list[str], bucket: Column | None = None
) -> tuple[MergeResult, DataFrame]:
    """Merge programme records; returns the merge and the records with their entity key.

    A record matches by (school, level, name), else by (school, URL), as one record after
    another would; a match by URL keeps the stored name. Records marked ``backfill_only``
    never create a programme. Records without a level or a name are left out: see
    ``incomplete_programs``.
    """
    shaped = records.withColumn("slug", urls.last_segment(F.col("url")))
    identified = identity.resolve_in_order(
        shaped, stored.select(F.col("entity_key").alias("__id"), *PROGRAM_NAME, "url"),
        "__id", PROGRAM_NAME, ["university_id", "url"], order, F.col("backfill_only"),
    )
    # Several steps read the resolved records; resolving them is the costly part.
    kept = materialize(identified, "programs")
    return merge.merge_records(stored, kept, PROGRAM, order, bucket), kept


def incomplete_programs(records: DataFrame) -> DataFrame:
    """Programme records without a level or a name: they belong to the notes."""
    return identity.incomplete(records, PROGRAM_NAME)


def upsert_details(
    stored: DataFrame, identified: DataFrame, order: list[str], bucket: Column | None = None
) -> MergeResult:
    """Merge programme details per (programme, entry year); label, campus and notes become the extra object."""
    extra = F.to_json(
        F.struct(
            F.col("fee_year_label"), F.col("campus"),
            F.when(F.size("notes") > 0, F.col("notes")).alias("parse_notes"),
        )
    )
    shaped = identified.withColumn("extra", F.nullif(extra, F.lit("{}"))).withColumn(
        "ielts_detail",
        F.when(F.col("ielts_min_each").isNotNull(), F.to_json(F.struct(F.col("ielts_min_each").alias("minimum_each")))),
    )
    return merge.merge_records(stored, shaped, PROGRAM_DETAIL, order, bucket)


def without_stub_text(modules: DataFrame) -> DataFrame:
    """A stub description counts as missing, so that a real one may replace it."""
    stub = F.col("description").startswith(STUB_TEXT)
    return modules.withColumn("description", F.when(~F.coalesce(stub, F.lit(False)), F.col("description")))


def upsert_modules(
    stored: DataFrame, records: DataFrame, order: list[str], bucket: Column | None = None
) -> tuple[MergeResult, DataFrame]:
    """Merge module records: by code when there is one, else by name with coded rows first.

    Returns the merge and the records with their entity key.
    """
    found = identity.resolve_by_code(
        records, stored.select(F.col("entity_key").alias("__id"), "university_id", "entry_year", "code", "name_en"),
        "__id", ["university_id", "entry_year"], "code", "name_en", order,
    )
    resolved = materialize(found, "modules")
    return merge.merge_records(without_stub_text(stored), resolved, MODULE, order, bucket), resolved


def upsert_deadlines(stored: DataFrame, records: DataFrame, order: list[str], bucket: Column | None = None) -> MergeResult:
    return merge.merge_records(stored, records, DEADLINE, order, bucket)


def upsert_calendar(stored: DataFrame, records: DataFrame, order: list[str], bucket: Column | None = None) -> MergeResult:
    return merge.merge_records(stored, records, CALENDAR, order, bucket)


def upsert_plans(stored: DataFrame, records: DataFrame, order: list[str], bucket: Column | None = None) -> MergeResult:
    """Plans are replaced as a whole and not logged."""
    return merge.merge_records(stored, records, PLAN, order, bucket)


def replace_module_lists(
    stored: DataFrame, references: DataFrame, order: list[str]
) -> DataFrame:
    """Module lists of programmes that bring a non-empty one; year 1 for taught postgraduates."""
    year = F.when(F.col("level") == "PGT", 1).cast("int")
    return merge.replace_sets(
        stored, references.withColumn("year_of_study", year), ["program_id"], ["module_id"], order
    )


def module_pages(references: DataFrame, crawl_details: Column) -> DataFrame:
    """Registry candidates for linked modules; manual unless the school crawls module details."""
    return references.filter(F.col("url").isNotNull()).select(
        "university_id",
        F.lit("module_catalog").alias("category"),
        "url",
        F.trim(F.concat_ws(" ", F.coalesce("code", F.lit("")), "name")).alias("title"),
        F.when(crawl_details, "monthly").otherwise("manual").alias("crawl_freq"),
    )


def translation_backfill(
    rows: DataFrame, english: str, chinese: str, dictionary: Column, limit: int | None = None
) -> DataFrame:
    """Fill missing translations: a translation already known for the same text, else the dictionary.

    Equal texts share one known translation (the smallest, so a rerun gives the same).
    With ``limit``, only that many missing rows are filled.
    """
    known = rows.filter(F.col(chinese).isNotNull()).groupBy(english).agg(F.min(chinese).alias("__known"))
    out = rows.join(known, english, "left")
    filled = F.coalesce(chinese, "__known", dictionary)
    if limit is None:
        return out.withColumn(chinese, filled).select(*rows.columns)
    missing = rows.filter(F.col(chinese).isNull() & F.col(english).isNotNull()).orderBy("id").limit(limit)
    chosen = out.join(missing.select("id", F.lit(True).alias("__chosen")), "id", "left")
    return chosen.withColumn(
        chinese, F.when(F.col("__chosen"), filled).otherwise(F.col(chinese))
    ).select(*rows.columns)
