"""Status and acceptance reports per school."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalodge.operators.quality import percent
from catalodge.operators.rollup import ratio_text


def n_rows():
    return F.count(F.lit(1))



def status_table(schools: DataFrame, modules: DataFrame, programs: DataFrame, events: DataFrame, pages: DataFrame) -> DataFrame:
    """Per school: programmes, modules, calendar and fetch health, one aggregate per table."""

    def pct(column: str):
        return F.concat(percent(F.count(column), n_rows()).cast("string"), F.lit("%"))

    parts = [
        programs.filter("is_active").groupBy("university_id").agg(n_rows().alias("n_programs"), pct("faculty_id").alias("faculty_pct")),
        modules.filter("is_active").groupBy("university_id").agg(n_rows().alias("n_modules"), pct("url").alias("url_pct")),
        events.groupBy("university_id").agg(
            n_rows().alias("n_events"), F.count_if(F.col("event_type") == "exam_period").alias("n_exams")
        ),
        pages.groupBy("university_id").agg(
            F.count("last_fetched_at").alias("n_fetched"),
            F.count_if(
                (F.col("status") == "active") & (F.col("crawl_freq") != "manual") & F.col("last_fetched_at").isNull()
            ).alias("n_never"),
        ),
    ]
    out = schools
    for part in parts:
        out = out.join(part, "university_id", "left")
    numbers = ["n_programs", "n_modules", "n_events", "n_exams", "n_fetched", "n_never"]
    return out.fillna(0, subset=numbers).fillna("—", subset=["faculty_pct", "url_pct"])


def status_matrix(pages: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """'fetched/expected' per school and category group, plus frozen and lost pages."""
    expected = (F.col("status") == "active") & (F.col("crawl_freq") != "manual")
    fetched = F.col("last_fetched_at").isNotNull()
    listed = [c for names in groups.values() for c in names]
    cells = {name: F.col("category").isin(*names) for name, names in groups.items()}
    cells["other"] = ~F.col("category").isin(*listed)
    return pages.groupBy("university_id").agg(
        *[
            ratio_text(F.count_if(test & expected & fetched), F.count_if(test & expected)).alias(name)
            for name, test in cells.items()
        ],
        F.count_if((F.col("crawl_freq") == "manual") & (F.col("status") == "active")).alias("frozen"),
        F.count_if(F.col("status") != "active").alias("lost"),
    )


def acceptance(rows: DataFrame, school: str, columns: Sequence[str]) -> DataFrame:
    """'filled/total' per field: how complete the extraction of a school is."""
    return rows.groupBy(school).agg(
        n_rows().alias("n_programs"), *[ratio_text(F.count(c), n_rows()).alias(c) for c in columns]
    )
