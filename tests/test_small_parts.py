"""Small parts that no query binds: sinks, rule checks, names, script data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalodge.operators import ordered, registry
from catalodge.plans import entities, views
from catalodge.session import shared_dir
from catalodge.sinks import export
from catalodge.sources import config, feeds


def test_rule_tables_are_checked(spark):
    rules = spark.createDataFrame([("ucl", "a"), ("xyz", "b")], "school string, pattern string")
    schools = spark.createDataFrame([("ucl",)], "school string")
    assert [r["school"] for r in config.unknown_references(rules, schools).collect()] == ["xyz"]
    assert config.check_columns(rules, ["school", "pattern"], "rules") is rules
    with pytest.raises(ValueError, match="pattern"):
        config.check_columns(rules, ["school"], "rules")


def test_assigned_object(spark):
    page = spark.createDataFrame([('<script>var data = {"a": {"b": 1}};</script>',), ("<p>none</p>",)], "h string")
    assert [r[0] for r in page.select(feeds.assigned_object(F.col("h"), "data")).collect()] == ['{"a": {"b": 1}}', None]


def test_notes_name_units(spark):
    notes = spark.createDataFrame([("Faculty of X | Maths",), ("Faculty of X",), (" | ",), (None,)], "n string")
    found = [tuple(r) for r in notes.select(entities.note_faculty(F.col("n")), entities.note_parent(F.col("n"))).collect()]
    assert found == [("Maths", "Faculty of X"), ("Faculty of X", None), (None, None), (None, None)]


def test_change_log_is_appended_and_partitions_replaced(spark, tmp_path):
    log = spark.createDataFrame([("program", 1)], "entity_type string, page_id int")
    for _ in range(2):
        export.append_change_log(log, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    for rows in ([("a", 1), ("b", 2)], [("b", 3)]):
        export.overwrite_partitions(spark.createDataFrame(rows, "k string, v int"), str(tmp_path / "t"), ["k"])
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [("a", 1), ("b", 3)]


def test_index_is_one_file(spark, tmp_path):
    summary = spark.createDataFrame([("ucl", 3), ("kcl", 1)], "code string, n_programs int").repartition(2)
    export.write_index(summary, str(tmp_path / "index"))
    assert len(list((tmp_path / "index").glob("part-*.json"))) == 1 and spark.read.json(str(tmp_path / "index")).count() == 2


def test_numbers_over_a_whole_table(spark):
    rows = spark.createDataFrame([((i * 37) % 101, i) for i in range(300)] + [(None, 999)], "a int, b int").repartition(5)
    numbered = sorted((r["n"], r["a"], r["b"]) for r in ordered.number_all(rows, ["a", "b"], "n").collect())
    assert [n for n, _, _ in numbered] == list(range(1, 302))
    assert [(a, b) for _, a, b in numbered] == [(None, 999)] + sorted(((i * 37) % 101, i) for i in range(300))
    assert ordered.number_all(rows.limit(0), ["a", "b"], "n").count() == 0


def test_current_calendar_follows_the_years_shown(spark):
    day = dt.date
    events = spark.createDataFrame(
        [(1, "UK", "1997/98", day(1998, 2, 1), None), (1, "UK", "2005/06", day(2005, 9, 9), None), (2, "UK", "2005/06", day(2005, 9, 9), None)],
        "university_id int, country string, academic_year string, start_date date, end_date date",
    )
    shown = views.current_calendar(events, F.lit("1998-01-01").cast("date"))
    assert sorted((r["university_id"], r["academic_year"]) for r in shown.collect()) == [(1, "1997/98"), (2, "2005/06")]


def test_tasks_need_a_known_school(spark):
    pages = spark.createDataFrame([(1, 7, "active", "html", "news"), (2, 8, "active", "html", "news")], "id int, university_id int, status string, fetch_method string, category string")
    schools = spark.createDataFrame([(7, "ucl", "名")], "university_id int, code string, name_zh string")
    assert [(r["id"], r["uni_code"]) for r in registry.school_tasks(pages, schools, school="ucl").collect()] == [(1, "ucl")]


def test_shared_folder_is_required_on_clusters(spark):
    assert shared_dir(spark, "x").endswith("/x")
