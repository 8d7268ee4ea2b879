"""Plans that must not put a whole table into one task: page tables, texts, items without a code, short lists."""

import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from catalodge.functions.text import ci_key
from catalodge.llm import token_counts
from catalodge.operators import identity, merge, rollup
from catalodge.operators.merge import MergeSpec, Unit
from catalodge.plans import extraction as jobs
from catalodge.plans import study_plans
from catalodge.queries import all_queries
from catalodge.queries.registry import ROWS_PER_TASK, dealt
from catalodge.sources import feeds, html


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def pages(spark, n: int):
    rows = [(i, "gla", "program_detail", "u", f"<ul><li>x{i} (20 credits)</li></ul>") for i in range(n)]
    return spark.createDataFrame(rows, "page_id long, school string, category string, url string, html string")


def test_narrow_rows_are_dealt_by_their_number(spark):
    few, many = dealt(spark.range(10, numPartitions=1)), dealt(spark.range(3 * ROWS_PER_TASK + 1, numPartitions=1))
    assert few.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() == 4
    assert sorted(r["id"] for r in many.collect()) == list(range(3 * ROWS_PER_TASK + 1))
    assert dealt(spark.range(0)).count() == 0


def test_rules_are_broadcast_and_pages_are_not(spark):
    plan = plan_of(jobs.with_rules(pages(spark, 5), jobs.module_rules(spark), "html"))
    assert re.search(r"BroadcastHashJoin \[school[^\n]*BuildRight", plan)


def test_texts_stay_where_focus_words_are_joined(spark, tmp_path):
    spark.createDataFrame([(1, "en", "src1", "theth"), (2, None, "src9", "x"), (3, "fr", "src9", "no")], "doc_id long, lang string, source string, text string").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    found = all_queries()[0]["focus_scope"](spark, str(tmp_path))
    assert "hashpartitioning(lang" not in plan_of(found)
    assert {(r["doc_id"], r["in_focus"]) for r in found.collect()} == {(1, True), (2, True), (3, False)}


def test_items_without_a_code_are_spread_over_partitions(spark):
    item = "doc long, page long, top long, university_id int, code string, label string"
    rows = [(i, 1, 1, 1, None, "Free Electives") for i in range(400)] + [(900, 1, 1, 1, "COMP1", "Topic"), (901, 1, 1, 2, "COMP1", "Topic")]
    modules = spark.createDataFrame([(1, "COMP1", "模块"), (1, None, "空")], "university_id int, code string, name_zh string")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = study_plans.with_chinese_labels(spark.createDataFrame(rows, item), modules)
        got = found.withColumn("part", F.spark_partition_id()).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len({r["part"] for r in got if r["code"] is None}) > 1
    assert {r["label_zh"] for r in got if r["code"] is None} == {"自由选修"}
    assert {r["doc"]: r["label_zh"] for r in got if r["code"]} == {900: "模块", 901: None}
    assert len(got) == 402


@pytest.mark.parametrize("limit", [3, 100])
def test_short_lists_are_shuffled_once_and_long_ones_cut(spark, limit):
    rows = [("a", i % 4, i) for i in range(10)] + [("b", 1, 7), ("b", None, 8), (None, 2, 1), (None, 1, 2)]
    df = spark.createDataFrame(rows, "k string, o int, i int").repartition(5)
    found = rollup.chunked_lists(df, ["k"], ["o", "i"], F.col("i"), limit=limit)
    if limit == 100:
        assert "rangepartitioning" not in plan_of(found) and plan_of(found).count("Exchange hashpartitioning") == 1
    lists = {}
    for r in sorted(found.collect(), key=lambda r: (str(r["k"]), r["chunk"])):
        assert len(r["items"]) <= limit and r["n_chunks"] == -(-sum(k == r["k"] for k, _, _ in rows) // limit)
        lists.setdefault(r["k"], []).extend(r["items"])
    order = lambda row: (row[1] is not None, row[1] or 0, row[2])
    assert lists == {k: [i for _, _, i in sorted((r for r in rows if r[0] == k), key=order)] for k in ("a", "b", None)}


def test_token_counts_do_not_depend_on_the_sample(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i} and the other {'x' * i} text") for i in range(40)] + [(None, None), (1, "")], "doc_id long, text string")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    counted = lambda: sorted(map(tuple, token_counts.token_counts(docs, tokenizer).collect()), key=str)
    whole = counted()
    monkeypatch.setattr(token_counts, "frequent_lengths", lambda *_: (b"", b""))
    assert counted() == whole and len(whole) == 42


def test_unit_modules_spread_by_rows(spark, monkeypatch):
    from catalodge import session
    from catalodge.plans import views

    monkeypatch.setattr(session, "SPREAD_ROWS", 10)
    members = spark.range(100).selectExpr("id % 20 AS program_id", "id % 7 AS module_id")
    assert session.spread(members, "program_id").rdd.getNumPartitions() == 10
    programs = spark.range(20).selectExpr("id AS program_id", "id % 3 AS unit")
    owned = spark.createDataFrame([(5, 99), (None, 98), (5, 99)], "unit long, module_id long")
    found = views.unit_modules(members, programs, owned)
    want = {(i % 20 % 3, i % 7) for i in range(100)} | {(5, 99)}
    assert sorted(map(tuple, found.collect())) == sorted(want)
    # Sort or join memory of a task is bounded by rows: the join has as many partitions as the members need.
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().toString()


def test_pages_of_a_task_are_bounded_whatever_the_shuffle_partitions(spark, monkeypatch):
    from catalodge import session

    few = {name: sorted(map(str, made.collect())) for name, made in made_of_pages(spark).items()}
    monkeypatch.setattr(session, "PAGES_PER_TASK", 5)
    for name, made in made_of_pages(spark).items():
        exchanges = re.findall(r"hashpartitioning\(page_id#\d+L?, (\d+)\), REPARTITION_BY_NUM", plan_of(made))
        assert "10" in exchanges, name
        assert sorted(map(str, made.collect())) == few[name] and len(few[name]) >= 50


def made_of_pages(spark):
    some = pages(spark, 50)
    rows = some.withColumn("html", F.concat(F.lit("<title>T | King's College London</title><h1>A</h1>"), "html"))
    rule = ("gla", "program_detail", "name_en", 1, "h1", None, None)
    rules = spark.createDataFrame([rule], "school string, category string, field string, rank int, source string, pattern string, args array<string>")
    return {"modules": jobs.module_links(some, jobs.module_rules(spark)), "fields": jobs.extract_fields(jobs.prepared(rows), rules)}


def coded_records(spark):
    rows = [(i, 1 + i % 2, ("C1", "c1 ", "Ç1", None, "")[i % 5], ("Logic", "LÓGIC", "Sets", None)[i % 4]) for i in range(60)]
    return spark.createDataFrame([*rows, (60, None, "C1", "Logic"), (61, None, None, "Sets")], "seq int, s int, code string, name string")


def test_records_are_made_once_to_find_their_modules(spark, tmp_path):
    coded_records(spark).write.parquet(str(tmp_path / "records"))
    records = spark.read.parquet(str(tmp_path / "records"))
    stored = spark.createDataFrame([("m1", 2, "c1", "Logic")], "sid string, s int, code string, name string")
    found = identity.resolve_by_code(records, stored, "sid", ["s"], "code", "name", ["seq"])
    # Whatever made the records is not in the plan any more, so neither scan nor join of theirs is repeated.
    assert not [f for f in found.inputFiles() if str(tmp_path) in f]
    got = {r["seq"]: r["entity_key"] for r in found.collect()}
    assert len(got) == 62 and got[60] is None and got[61] is None
    # Case, accents and trailing blanks make no other code or name; a school of its own does.
    assert {got[i] for i in range(60) if i % 2 and i % 5 < 2} == {"m1"}
    assert {got[i] for i in range(0, 60, 2) if i % 5 < 2} == {"1\x01C1"}
    assert {got[i] for i in range(60) if i % 5 == 2} == {"1\x01C1", "m1"}


@pytest.mark.parametrize("split", [False, True])
def test_a_batch_is_shuffled_once_and_joined_with_nothing(spark, split):
    draw = random.Random(3)
    rows = [(draw.choice([1, 1, 1, 2, 3, None]), i, draw.choice([None, "20", "20.0", "30", " x"]), f"n{i}") for i in range(200)]
    spec = MergeSpec("deadline", ("k",), (Unit("fee", ("fee", "note"), tracked=True),), insert_only=("note",), label="fee")
    batch = spark.createDataFrame(rows, "k int, seq int, fee string, note string")
    _, summary = merge.fold_batch(batch, spec, ["seq"], F.when(F.col("seq") >= 20, F.floor(F.col("seq") / 20)) if split else None)
    plan = plan_of(summary)
    assert len(re.findall(r"Scan ExistingRDD", plan)) == 1 and "Join" not in plan
    got = {r["k"]: r for r in summary.collect()}
    for key in (1, 2, 3):
        mine = [r for r in rows if r[0] == key]
        given = [r for r in mine if r[2] is not None]
        value = lambda text: text.strip() if "x" in text else float(text)
        moves = [b for a, b in zip([None, *given], given) if a is None or value(a[2]) != value(b[2])]
        r = got[key]
        assert (r["__seq"]["seq"], r["__insert"]["note"], r["__label"]) == (mine[0][1], mine[0][3], mine[0][2])
        assert (r["__f_fee"]["at"]["seq"], r["__f_fee"]["value"]) == (given[0][1], given[0][2])
        assert (r["__l_fee"]["fee"], r["__l_fee"]["note"], r["__n_fee"]) == (*moves[-1][2:], len(moves) - 1)
    assert got[None]["__seq"]["seq"] == min(r[1] for r in rows if r[0] is None)


def test_text_without_accents_is_not_translated(spark):
    rows = spark.createDataFrame([("Plain ",), ("Café ",), ("ÉCOLE",), ("名 A",), (None,), ("",)], "w string")
    assert [r[0] for r in rows.select(ci_key(F.col("w"))).collect()] == ["plain", "cafe", "ecole", "名 a", None, ""]
    assert "octet_length" in plan_of(rows.select(ci_key(F.col("w"))))


def test_pages_are_put_together_only_for_the_kinds_of_their_rules(spark):
    def of(school, category, url, body):
        columns = {"page_id": F.col("id"), "school": F.lit(school), "category": F.lit(category), "url": F.lit(url)}
        page = F.concat(F.lit(body), F.when(F.col("id") < 0, f"made-{school}").otherwise(""))
        return spark.range(4).select(*[c.alias(n) for n, c in columns.items()], page.alias("html"))

    some = of("melb", "program_catalog", "https://h/s", '<nav class="pagination"><a href="?page=3">3</a></nav><a href="?page=9">o</a>')
    other = of("anu", "program_catalog", "https://p/CourseSearch/GetCourses?PageIndex=1", '{"Items":[{"CourseCode":"A1"},{},null,7]}')
    found = jobs.discover(some.unionByName(other), jobs.discovery_rules(spark))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # The html of each school is made once: for rules on links or for rules on JSON, not for each kind there is.
    assert plan.count("made-anu") == 1 and plan.count("made-melb") == 1
    want = [f"https://h/s?page={n}" for n in (2, 3)] + ["https://programsandcourses.anu.edu.au/2026/course/A1"]
    assert sorted((r["page_id"], r["url"]) for r in found.collect()) == sorted((i, u) for i in range(4) for u in want)


def test_urls_alone_are_those_of_the_links(spark):
    rows = [
        (1, "https://h/a/b?x=1", "<a href='/p/q'>A</a><!-- <a href=\"/no\">n</a> --><a href=\"../c?d=1&amp;e#f\">B</a><a class=x href=//k/l>C</a>"),
        (2, "https://h/a/b?x=1", '<a href="?y">A</a><a href="">B</a><a href="#f">C</a><a href="mailto:x">D</a><a href="/p/./q.html">E</a><a href="/r:s">F</a>'),
        (3, None, '<a href="/p">A</a><a href="q">B</a><a href="https://k/l">C</a><a href="//k">D</a>'),
        (4, "https://h", None),
    ]
    got = spark.createDataFrame(rows, "page_id int, url string, html string").select(
        "page_id", html.link_urls(F.col("html"), F.col("url")).alias("alone"), F.col("html").alias("html"), F.col("url").alias("url")
    ).withColumn("links", html.links(F.col("html"), F.col("url")))
    found = {r["page_id"]: (r["alone"], r["links"] and [link["url"] for link in r["links"]]) for r in got.collect()}
    want = {
        1: ["https://h/p/q", "https://h/c?d=1&e", "https://k/l"],
        2: ["https://h/a/b?y", "https://h/a/b?x=1", "https://h/a/b?x=1", "mailto:x", "https://h/p/q.html", "https://h/r:s"],
        3: [None, None, "https://k/l", None],
        4: None,
    }
    assert found == {page: (urls, urls) for page, urls in want.items()}


def test_items_are_counted_whatever_they_are(spark):
    bodies = {
        '{"Items":[{},{"a":1},null,"x",[1],true,2.5]}': 7, '{"results":[1,{"b":[2]}]}': 2, '{"Items":"x","results":[1]}': 1,
        '{"Items":[]}': 0, '{"Items":{"a":1}}': None, "[1,2]": None, "no": None, None: None,
    }
    rows = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = rows.select("body", feeds.json_count(F.col("body")).alias("n"), F.size(feeds.json_items(F.col("body"))).alias("m")).collect()
    assert {r["body"]: r["n"] for r in got} == bodies and {r["body"]: r["m"] for r in got} == bodies
