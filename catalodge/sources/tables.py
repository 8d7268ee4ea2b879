"""Table schemas and scans of the catalogue model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# Column layout of every catalogue table. Enumerations are strings, free JSON is a string.
SCHEMAS: dict[str, str] = {
    "universities": "id INT, code STRING, name_en STRING, name_zh STRING, country STRING, city STRING,"
    " term_system STRING, website STRING, extra STRING, cn_student_note STRING, is_active BOOLEAN",
    "faculties": "id INT, university_id INT, parent_id INT, name_en STRING, name_zh STRING, level STRING,"
    " url STRING, is_active BOOLEAN",
    "programs": "id BIGINT, university_id INT, faculty_id INT, level STRING, name_en STRING, name_zh STRING,"
    " slug STRING, url STRING, ucas_code STRING, duration STRING, subject_tags STRING, is_active BOOLEAN",
    "program_details": "id BIGINT, program_id BIGINT, entry_year STRING, tuition_home DECIMAL(10,2),"
    " tuition_intl DECIMAL(10,2), currency STRING, entry_req_text STRING, china_req_text STRING,"
    " language_band STRING, ielts_overall DECIMAL(2,1), ielts_detail STRING, app_open_date DATE,"
    " scholarships STRING, other_tests STRING, extra STRING, source_page_id BIGINT, fetched_at TIMESTAMP_NTZ",
    "modules": "id BIGINT, university_id INT, faculty_id INT, code STRING, name_en STRING, name_zh STRING,"
    " credits INT, level STRING, semester STRING, leader STRING, prerequisites STRING, assessment STRING,"
    " description STRING, url STRING, entry_year STRING, extra STRING, source_page_id BIGINT,"
    " fetched_at TIMESTAMP_NTZ, is_active BOOLEAN",
    "program_modules": "program_id BIGINT, module_id BIGINT, year_of_study INT, module_type STRING, note STRING",
    "module_contents": "id BIGINT, module_id BIGINT, content_type STRING, seq_no INT, title STRING, body STRING,"
    " url STRING, source STRING, source_note STRING, entry_year STRING, added_by STRING, verified BOOLEAN",
    "calendar_events": "id BIGINT, university_id INT, academic_year STRING, calendar_track STRING,"
    " event_type STRING, name STRING, name_zh STRING, start_date DATE, end_date DATE, source_page_id BIGINT,"
    " fetched_at TIMESTAMP_NTZ",
    "deadlines": "id BIGINT, university_id INT, program_id BIGINT, entry_year STRING, audience STRING,"
    " deadline_type STRING, round_no INT, deadline_at TIMESTAMP_NTZ, note STRING, source_page_id BIGINT,"
    " fetched_at TIMESTAMP_NTZ",
    "language_bands": "id INT, university_id INT, band_code STRING, band_label STRING,"
    " ielts_overall DECIMAL(2,1), ielts_detail STRING, other_tests STRING",
    "china_policies": "id INT, university_id INT, entry_year STRING, gaokao_accepted BOOLEAN, gaokao_req STRING,"
    " ug_pathway STRING, pgt_gpa_rule STRING, agent_list STRING, china_office STRING",
    "china_university_tiers": "id INT, university_id INT, entry_year STRING, cn_univ_name STRING, tier STRING",
    "staff": "id BIGINT, university_id INT, faculty_id INT, name STRING, title STRING, email STRING,"
    " research_areas STRING, url STRING",
    "faculty_info_items": "id BIGINT, university_id INT, faculty_id INT, info_type STRING, title STRING,"
    " body STRING, url STRING",
    "source_pages": "id BIGINT, university_id INT, faculty_id INT, category STRING, url STRING, title STRING,"
    " fetch_method STRING, crawl_freq STRING, status STRING, redirect_to STRING, discovery_note STRING,"
    " failure_note STRING, last_content_hash STRING, last_fetched_at TIMESTAMP_NTZ,"
    " last_changed_at TIMESTAMP_NTZ",
    "page_snapshots": "id BIGINT, source_page_id BIGINT, fetched_at TIMESTAMP_NTZ, http_status INT,"
    " content_hash STRING, content_path STRING, parsed_ok BOOLEAN",
    "change_log": "id BIGINT, university_id INT, entity_type STRING, entity_id STRING, change_type STRING,"
    " field_name STRING, old_value STRING, new_value STRING, snapshot_id BIGINT, detected_at TIMESTAMP_NTZ",
    "program_plans": "id BIGINT, program_id BIGINT, variant_label STRING, variant_label_zh STRING,"
    " entry_year STRING, plan ARRAY<STRUCT<year: INT, term: INT, items: ARRAY<STRUCT<code: STRING,"
    " label: STRING, label_zh: STRING, prereq: STRING, credits: INT>>>>, source_url STRING",
}

# Natural keys of the tables; a NULL part keeps rows apart except where a merge asks otherwise.
KEYS: dict[str, tuple[str, ...]] = {
    "universities": ("code",),
    "faculties": ("university_id", "name_en"),
    "programs": ("university_id", "level", "name_en"),
    "program_details": ("program_id", "entry_year"),
    "modules": ("university_id", "code", "entry_year"),
    "program_modules": ("program_id", "module_id"),
    "calendar_events": ("university_id", "academic_year", "calendar_track", "event_type", "name"),
    "deadlines": ("university_id", "program_id", "entry_year", "audience", "deadline_type", "round_no"),
    "language_bands": ("university_id", "band_code"),
    "china_policies": ("university_id", "entry_year"),
    "china_university_tiers": ("university_id", "entry_year", "cn_univ_name"),
    "staff": ("university_id", "name", "faculty_id"),
    "faculty_info_items": ("university_id", "faculty_id", "info_type", "title"),
    "source_pages": ("university_id", "url"),
    "program_plans": ("program_id", "variant_label", "entry_year"),
}


def table_schema(name: str) -> str:
    """Schema of a catalogue table as a DDL string."""
    return SCHEMAS[name]


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], table_schema(name))


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan of one Parquet table under ``root``: a file ``name.parquet`` or a folder ``name``."""
    if name in SCHEMAS:
        return spark.read.schema(table_schema(name)).parquet(f"{root}/{name}")
    return spark.read.parquet(f"{root}/{name}.parquet")


def read_jdbc_table(
    spark: SparkSession, url: str, name: str, partition_column: str, bounds: tuple[int, int], parts: int
) -> DataFrame:
    """Parallel scan of one table of a live database through the JDBC source."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", name)
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(bounds[0]))
        .option("upperBound", str(bounds[1]))
        .option("numPartitions", str(parts))
        .load()
    )
