"""Extraction on composed pages, the daily run, and streams against their batch jobs."""

import json
import time

import pytest
from pyspark.sql import functions as F

from catalodge.operators import merge, ordered, registry
from catalodge.operators.merge import MergeSpec
from catalodge.plans import calendars, daily, extraction
from catalodge.sinks import export
from catalodge.streaming import jobs
from catalodge.streaming.jobs import DeltaTable

PAGE = "page_id long, school string, category string, url string, html string"

SESSION = """<h1>Session</h1><table>
<tr><td><strong>2025</strong></td><td>September</td><td>Monday</td><td>15</td><td>Start of academic year / Orientation</td><td>&nbsp;</td></tr>
<tr><td>&nbsp;</td><td>&nbsp;</td><td>Monday</td><td>22</td><td>Start of Semester 1 teaching</td><td>&nbsp;</td></tr>
<tr><td>&nbsp;</td><td>December</td><td>Friday</td><td>5</td><td>End of Semester 1 teaching</td><td>Winter Vacation starts</td></tr>
<tr><td>2026</td><td>January</td><td>Friday</td><td>9</td><td>&nbsp;</td><td>Winter Vacation ends</td></tr>
<tr><td></td><td>April</td><td>Monday</td><td>27</td><td>Start of examination period</td><td></td></tr>
<tr><td></td><td>May</td><td>Friday</td><td>22</td><td>End of examination period</td><td></td></tr>
<tr><td></td><td>July</td><td>Monday</td><td>27</td><td>Start of examination period</td><td></td></tr>
<tr><td></td><td>August</td><td>Friday</td><td>14</td><td>End of examination period</td><td></td></tr>
<tr><td></td><td>September</td><td>Friday</td><td>11</td><td>End of academic year</td><td></td></tr></table>"""

MODULE = """<title>x</title><h1>Algorithms (COMP0005)</h1><dl><dt>Credit value</dt> <dd>15</dd></dl>
<h2>Intended teaching term:
              Term 2 &nbsp;
      Undergraduate (FHEQ Level 4)</h2><dl><dt>Methods</dt><dd><div>
   80%
     Exam   </div><div>
   20%
     Group activity </div></dd><dt>Module leader</dt><dd> Prof B </dd></dl><div class="module-description"><p>Aims</p></div>"""

PROGRAM = """<title>Site | King's College London</title><h1>Cyber Security MSc</h1><p>Duration</p><p>One year</p>
<p>Overseas fee</p><p>£31,000</p><p>IELTS 7.0 with 6.5 each</p><p>Band B</p><p>Faculty of Natural Sciences</p>
<p>Application deadline: 5 June 2026</p>"""


def test_points_open_and_close_intervals(spark):
    page = spark.createDataFrame([(1, "gla", "term_dates", "https://g/sessiondates/session2025-26/", SESSION)], PAGE)
    rows = calendars.from_points(extraction.prepared(page)).collect()
    got = {(r["name"], r["event_type"], str(r["start_date"]), str(r["end_date"])) for r in rows}
    assert got == {
        ("academic year / Orientation", "welcome_week", "2025-09-15", "2026-09-11"),
        ("Semester 1 teaching", "teaching_period", "2025-09-22", "2025-12-05"),
        ("Winter Vacation", "closure", "2025-12-05", "2026-01-09"),
        ("examination period", "exam_period", "2026-04-27", "2026-05-22"),
        ("examination period (Jul)", "resit_period", "2026-07-27", "2026-08-14"),
    }


def test_module_page(spark):
    page = spark.createDataFrame([(1, "ucl", "module_catalog", "https://u/module-catalogue/modules/algorithms-COMP0005", MODULE)], PAGE)
    row = extraction.module_records(extraction.prepared(page), extraction.field_rules(spark)).first()
    assert (row["code"], row["credits"], row["level"], row["leader"]) == ("COMP0005", 15, "FHEQ Level 4", "Prof B")
    assert [(a["weight"], a["type"]) for a in row["assessment"]] == [(80, "Exam"), (20, "Group activity")]
    assert row["semester"] == "              Term 2 \xa0" and row["description"] == "Aims"


@pytest.fixture(scope="module")
def empty_tables(spark):
    def table(schema):
        return spark.createDataFrame([], schema)

    return {
        "programs": table("entity_key string, university_id int, level string, name_en string, faculty string, url string, slug string, ucas_code string, duration string"),
        "program_details": table(
            "entity_key string, entry_year string, tuition_home double, tuition_intl double, entry_req_text string, language_band string,"
            " ielts_overall double, ielts_detail string, app_open_date date, extra string, source_page_id long, fetched_at string, currency string"),
        "modules": table(
            "entity_key string, university_id int, code string, name_en string, entry_year string, faculty string, credits int, level string,"
            " semester string, leader string, prerequisites string, assessment string, description string, url string, source_page_id long, fetched_at string"),
        "program_modules": table("program_id string, module_id string, year_of_study int, module_type string"),
        "calendar_events": table(
            "university_id int, academic_year string, calendar_track string, event_type string, name string, start_date date, end_date date, source_page_id long, fetched_at string"),
        "deadlines": table(
            "university_id int, program_key string, entry_year string, audience string, deadline_type string, round_no int, deadline_at string, note string,"
            " source_page_id long, fetched_at string"),
        "source_pages": table("university_id int, url string"),
    }


def test_daily_run_and_rerun(spark, empty_tables):
    pages = spark.createDataFrame(
        [
            (1, 7, "kcl", "program_detail", "https://k/study/postgraduate-taught/courses/cyber", PROGRAM, None),
            (2, 8, "ucl", "module_catalog", "https://u/module-catalogue/modules/algorithms-COMP0005", MODULE, None),
            (3, 9, "gla", "term_dates", "https://g/sessiondates/session2025-26/", SESSION, None),
            (4, 9, "gla", "term_dates", "https://g/sessiondates/", '<a href="session2026-27/">2026-27</a>', None),
        ],
        "page_id long, university_id int, school string, category string, url string, html string, discovery_note string",
    )
    names = spark.createDataFrame([("kcl", "Faculty of Natural Sciences", 0)], "school string, name string, position int")
    config = {
        "overrides": spark.createDataFrame([], "slug string, forced string"),
        "aliases": spark.createDataFrame([], "dept string, official string"),
        "chinese": spark.createDataFrame([], "faculty string, faculty_zh string"),
    }
    first = daily.load(spark, empty_tables, pages, names, config, F.lit("2026-01-01"))
    program = first["programs"].first()
    assert (program["name_en"], program["level"], program["faculty"]) == ("Cyber Security MSc", "PGT", "Faculty of Natural Sciences")
    detail = first["program_details"].first()
    assert (detail["tuition_intl"], detail["ielts_overall"], detail["language_band"]) == (31000.0, 7.0, "band-B")
    assert json.loads(detail["ielts_detail"]) == {"minimum_each": 6.5}
    assert first["deadlines"].first()["deadline_at"] == "2026-06-05 23:59:00"
    assert first["modules"].first()["code"] == "COMP0005" and first["calendar_events"].count() == 5
    assert [r["url"] for r in first["new_pages"].collect()] == ["https://g/sessiondates/session2026-27/"]
    assert sorted(r["entity_type"] for r in first["change_log"].collect()) == ["deadline", "program"]

    changed = pages.withColumn("html", F.replace("html", F.lit("£31,000"), F.lit("£32,500")))
    tables = {**empty_tables, **{k: first[k] for k in empty_tables if k != "source_pages"}}
    second = daily.load(spark, tables, changed, names, config, F.lit("2026-01-02"))
    log = [(r["entity_type"], r["field_name"], r["old_value"], r["new_value"]) for r in second["change_log"].collect()]
    assert log == [("program_detail", "tuition_intl", "31000.0", "32500.0")]
    assert second["programs"].count() == 1 and second["calendar_events"].count() == 5


def test_export_continues_large_lists(spark, tmp_path):
    programs = spark.createDataFrame([(1, 10, "UG"), (1, 11, "PGT")], "university_id int, program_id int, level string")
    details = spark.createDataFrame([(10, "2025", 1), (10, "2026", 2)], "program_id int, entry_year string, fee int")
    deadlines = spark.createDataFrame([(10, "2026-01-01")], "program_id int, at string")
    members = spark.createDataFrame([(10, i) for i in range(50)], "program_id int, module_id int")
    documents = export.program_documents(programs, details, deadlines, members, limit=10)
    bodies = [json.loads(r["body"]) for r in documents.collect()]
    assert sorted(m["module_id"] for b in bodies for m in b["modules"]) == list(range(50))
    assert {b["id"]: b.get("detail", {}).get("fee") for b in bodies} == {10: 2, 11: None}
    schools = spark.createDataFrame([(1, "UK", "gla")], "university_id int, country string, code string")
    export.write_school_documents(documents, schools, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out" / "country=uk" / "code=gla")).count() == len(bodies)


def drop_file(spark, folder, rows, schema):
    """Put one more input file into a stream folder; file times must differ to keep their order."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
    time.sleep(1.1)


def test_change_stream_over_batches_equals_batch(spark, tmp_path):
    schema = "page long, ts timestamp_ntz, h string"
    versions = [
        [(1, "2024-01-01 00:00:00", "a"), (1, "2024-01-02 00:00:00", "a"), (2, "2024-01-01 00:00:00", "x")],
        [(1, "2024-01-03 00:00:00", "b"), (2, "2024-01-03 00:00:00", "x")],
        [(1, "2024-01-04 00:00:00", "b"), (1, "2024-01-05 00:00:00", "a"), (3, "2024-01-05 00:00:00", "z")],
    ]
    import datetime as dt

    state = DeltaTable(str(tmp_path / "state"), ("page",), "page BIGINT, last_hash STRING", full_every=2)
    for rows in versions:
        typed = [(p, dt.datetime.fromisoformat(t), h) for p, t, h in rows]
        drop_file(spark, tmp_path / "in", typed, schema)
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        jobs.change_stream(
            stream, "page", ["ts"], "h", state, str(tmp_path / "out"), str(tmp_path / "cp"), F.to_date("ts")
        ).awaitTermination()
    streamed = jobs.read_batches(spark, str(tmp_path / "out"), "page BIGINT, ts TIMESTAMP_NTZ, h STRING")
    everything = spark.read.schema(schema).parquet(str(tmp_path / "in"))
    batch = registry.changed_versions(everything, "page", ["ts"], "h", bucket=F.to_date("ts")).filter("changed").select("page", "ts", "h")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert {r["page"]: r["last_hash"] for r in state.read(spark, 3).collect()} == {1: "a", 2: "x", 3: "z"}


def test_upsert_stream_equals_batch(spark, tmp_path):
    schema = "k long, seq long, fee string"
    spec = MergeSpec.simple("program_detail", ("k",), ("fee",), tracked=("fee",))
    state = DeltaTable(str(tmp_path / "state"), ("k",), "k BIGINT, fee STRING")
    for rows in ([(1, 1, "5"), (2, 2, None)], [(1, 3, None), (2, 4, "7"), (1, 5, "6")], [(1, 6, "6.0"), (2, 7, "8")]):
        drop_file(spark, tmp_path / "in", rows, schema)
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        jobs.upsert_stream(stream, spec, ["seq"], state, str(tmp_path / "log"), str(tmp_path / "cp")).awaitTermination()
    everything = spark.read.schema(schema).parquet(str(tmp_path / "in"))
    want = merge.merge_records(spark.createDataFrame([], "k long, fee string"), everything, spec, ["seq"])
    assert sorted(map(tuple, state.read(spark, 3).collect())) == sorted(map(tuple, want.table.collect()))
    log = spark.read.parquet(str(tmp_path / "log")).select("k", "old_value", "new_value", "seq")
    assert sorted(map(tuple, log.collect())) == sorted(map(tuple, want.log.select("k", "old_value", "new_value", "seq").collect()))


def test_snapshot_sink_stores_only_changes(spark, tmp_path):
    rows = [("x", "news", 1, 1, "a"), ("x", "news", 1, 2, "a"), ("x", "news", 1, 3, "b")]
    versions = spark.createDataFrame(rows, "school string, category string, page int, seq int, h string")
    export.append_snapshots(registry.changed_versions(versions, "page", ["seq"], "h"), str(tmp_path / "snap"))
    stored = spark.read.parquet(str(tmp_path / "snap"))
    assert sorted(r["seq"] for r in stored.collect()) == [1, 3]
    assert ordered.last_per_key(stored, ["page"], ["seq"]).first()["h"] == "b"
