"""Nested documents per school, the index, and the append and overwrite sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalodge.operators import ordered
from catalodge.operators.rollup import chunked_lists

LIST_LIMIT = 10_000
RECORDS_PER_FILE = 100_000


def clean_json(text: Column) -> Column:
    """JSON text normalised, or the text unchanged when it does not parse."""
    return F.coalesce(F.to_json(F.try_parse_json(text)), text)


def iso_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def iso_time(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


def program_documents(
    programs: DataFrame,
    details: DataFrame,
    deadlines: DataFrame,
    members: DataFrame,
    plans: DataFrame | None = None,
    limit: int = LIST_LIMIT,
) -> DataFrame:
    """(university_id, program_id, part, body): one JSON object per programme.

    The newest detail is nested as an object, deadlines, module references and plans
    as ordered lists. A list longer than ``limit`` continues in further parts of the
    same programme; readers append the lists of the parts.
    """
    detail = ordered.last_per_key(details, ["program_id"], ["entry_year"])
    detail = detail.select("program_id", F.struct(*[c for c in detail.columns if c != "program_id"]).alias("detail"))

    def listed(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
        element = F.struct(*[c for c in rows.columns if c != "program_id"])
        chunks = chunked_lists(rows, ["program_id"], order, element, limit)
        return chunks.select("program_id", F.col("chunk").alias("part"), F.col("items").alias(name))

    lists = [
        listed(deadlines, [c for c in deadlines.columns if c != "program_id"], "deadlines"),
        listed(members, [c for c in members.columns if c != "program_id"], "modules"),
    ]
    if plans is not None:
        lists.append(listed(plans, ["variant_label"], "plans"))
    keyed = ["program_id", "part"]
    parts = lists[0]
    for more in lists[1:]:
        parts = parts.join(more, keyed, "full_outer")
    # A programme without any list still has its part 0; the school leads every part to its folder.
    first = programs.select("program_id", F.lit(0).alias("part"))
    parts = first.join(parts, keyed, "full_outer")
    body = parts.join(programs, "program_id").join(detail, "program_id", "left")
    listed_names = ["deadlines", "modules"] + (["plans"] if plans is not None else [])
    names = [c for c in programs.columns if c not in ("university_id", "program_id")] + ["detail", *listed_names]
    empty = {n: F.coalesce(n, F.array().cast(body.schema[n].dataType)) for n in listed_names}
    struct = F.struct(F.col("program_id").alias("id"), *[empty.get(n, F.col(n)).alias(n) for n in names])
    return body.select("university_id", "program_id", "part", F.to_json(struct).alias("body"))


def section_documents(rows: DataFrame, section: str, school: str = "university_id") -> DataFrame:
    """(university_id, section, body): one JSON object per row of a school-level list."""
    fields = [c for c in rows.columns if c != school]
    return rows.select(school, F.lit(section).alias("section"), F.to_json(F.struct(*fields)).alias("body"))


def write_school_documents(documents: DataFrame, schools: DataFrame, path: str) -> None:
    """JSON lines under country=/code=, several bounded files per large school, nothing in one task."""
    named = documents.join(schools.select("university_id", "country", "code"), "university_id")
    out = named.withColumn("country", F.lower(F.coalesce("country", F.lit("other")))).drop("university_id")
    (
        out.write.mode("overwrite")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .partitionBy("country", "code")
        .json(path)
    )


def index_summary(schools: DataFrame, modules: DataFrame, programs: DataFrame, events: DataFrame, pages: DataFrame) -> DataFrame:
    """Per active school: programmes, modules, whether it has a calendar, dead sources."""
    total = F.count(F.lit(1))
    parts = [
        programs.filter("is_active").groupBy("university_id").agg(total.alias("n_programs")),
        modules.filter("is_active").groupBy("university_id").agg(total.alias("n_modules")),
        events.groupBy("university_id").agg(total.alias("n_events")),
        pages.groupBy("university_id").agg(F.count_if(F.col("status") == "dead").alias("dead_sources")),
    ]
    out = schools.filter("is_active")
    for part in parts:
        out = out.join(part, "university_id", "left")
    out = out.fillna(0, subset=["n_programs", "n_modules", "n_events", "dead_sources"])
    return out.withColumn("has_calendar", F.col("n_events") > 0).drop("n_events", "is_active")


def write_index(summary: DataFrame, path: str) -> None:
    """The index of all schools as one JSON-lines file: a row for each school, so it stays small."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def append_change_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").parquet(path)


def append_snapshots(versions: DataFrame, path: str) -> None:
    """Only changed versions are stored, under the school and category they belong to."""
    versions.filter("changed").drop("changed", "previous_hash").write.mode("append").partitionBy(
        "school", "category"
    ).parquet(path)


def overwrite_partitions(table: DataFrame, path: str, partition: Sequence[str]) -> None:
    """Replace only the partitions the table has rows for; the others stay."""
    (
        table.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition)
        .parquet(path)
    )


def run_report(outcomes: DataFrame, kind: str = "kind", first: int = 10, order: Sequence[str] = ("ts", "event_id")) -> tuple[DataFrame, DataFrame]:
    """(counts per outcome, the first failures)."""
    counts = outcomes.groupBy(kind).agg(F.count(F.lit(1)).alias("n"))
    failures = outcomes.filter(F.col(kind).isin("failed", "error", "cloudflare")).orderBy(*order).limit(first)
    return counts, failures


def first_changes(log: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """The first ``n`` changes of a run, as its report lists them."""
    text = F.concat_ws(" ", F.concat(F.lit("["), "entity_type", F.lit("]")), "field_name", "old_value", F.lit("->"), "new_value")
    return log.orderBy(*order).limit(n).select(*order, text.alias("change"))
