"""Set-based operators against row-at-a-time references written here."""

import random

import pytest
from pyspark.sql import functions as F

from catalodge.functions.text import differs
from catalodge.operators import identity, lookup, merge, ordered, quality, rollup
from catalodge.operators.merge import MergeSpec, Unit


@pytest.fixture(scope="module")
def points(spark):
    """Random points; key 1 holds half of all rows."""
    rng = random.Random(7)
    rows = []
    for i in range(600):
        key = 1 if rng.random() < 0.5 else rng.randint(2, 9)
        value = rng.choice([None, "a", "b", "c"])
        rows.append((key, rng.randint(0, 999), i, value, rng.choice(["start", "end", "other"])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, t int, id int, v string, kind string")


def bucket():
    return F.floor(F.col("t") / 50)


def by_key(rows):
    out = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        out.setdefault(row[0], []).append(row)
    return out


@pytest.mark.parametrize("split", [False, True])
def test_neighbours_and_fill(spark, points, split):
    b = bucket() if split else None
    df = frame(spark, points)
    prev = {r["id"]: r["p"] for r in ordered.neighbour(df, ["k"], ["t", "id"], {"id": "p"}, b).collect()}
    after = {r["id"]: r["n"] for r in ordered.neighbour(df, ["k"], ["t", "id"], {"id": "n"}, b, following=True).collect()}
    fill = {r["id"]: r["f"] for r in ordered.last_known(df, ["k"], ["t", "id"], {"v": "f"}, b).collect()}
    before = {r["id"]: r["f"] for r in ordered.last_known(df, ["k"], ["t", "id"], {"v": "f"}, b, include_current=False).collect()}
    number = {r["id"]: r["n"] for r in ordered.number_rows(df, ["k"], ["t", "id"], "n", b).collect()}
    total = {r["id"]: r["s"] for r in ordered.running_sum(df, ["k"], ["t", "id"], {"t": "s"}, b).collect()}
    for rows in by_key(points).values():
        last, running = None, 0
        for i, row in enumerate(rows):
            assert prev[row[2]] == (rows[i - 1][2] if i else None)
            assert after[row[2]] == (rows[i + 1][2] if i + 1 < len(rows) else None)
            assert before[row[2]] == last
            last = row[3] if row[3] is not None else last
            running += row[1]
            assert fill[row[2]] == last and number[row[2]] == i + 1 and total[row[2]] == running


@pytest.mark.parametrize("split", [False, True])
def test_pair_points_is_first_in_first_out(spark, points, split):
    df = frame(spark, points)
    found = ordered.pair_points(
        df, ["k"], ["t", "id"], F.col("kind") == "start", F.col("kind") == "end", "id", bucket() if split else None
    )
    got = sorted((r["k"], r["kind"], r["start"], r["end"] or -1) for r in found.collect())
    want = []
    for key, rows in by_key(points).items():
        queue = []
        for row in rows:
            if row[4] == "start":
                queue.append(row[2])
            elif row[4] == "end":
                want.append((key, "pair", queue.pop(0), row[2]) if queue else (key, "point", row[2], -1))
        want += [(key, "open", start, -1) for start in queue]
    assert got == sorted(want)


def apply_one_by_one(stored, records, tracked):
    """Each record in turn: values that differ replace, tracked changes of known values are logged."""
    table, log = {k: dict(v) for k, v in stored.items()}, []

    def differ(a, b):
        if a is None or b is None:
            return a is not b
        try:
            return float(a) != float(b)
        except ValueError:
            return str(a).strip() != str(b).strip()

    for key, seq, values in records:
        row = table.setdefault(key, {f: None for f in values})
        for field, new in values.items():
            if new is None or not differ(row[field], new):
                continue
            if field in tracked and row[field] is not None:
                log.append((key, field, row[field], new, seq))
            row[field] = new
    return table, log


@pytest.mark.parametrize("split", [False, True])
def test_merge_equals_record_by_record(spark, split):
    rng = random.Random(11)
    pick = lambda: {"fee": rng.choice([None, "100", "200", "300"]), "band": rng.choice([None, "A", "B"])}
    stored = {k: pick() for k in range(0, 6)}
    records = [(1 if rng.random() < 0.5 else rng.randint(0, 9), seq, pick()) for seq in range(200)]
    want_table, want_log = apply_one_by_one(stored, records, {"fee"})
    spec = MergeSpec.simple("program_detail", ("k",), ("fee", "band"), tracked=("fee",))
    old = spark.createDataFrame([(k, v["fee"], v["band"]) for k, v in stored.items()], "k int, fee string, band string")
    new = spark.createDataFrame([(k, s, v["fee"], v["band"]) for k, s, v in records], "k int, seq int, fee string, band string")
    result = merge.merge_records(old, new, spec, ["seq"], F.floor(F.col("seq") / 20) if split else None)
    assert {r["k"]: {"fee": r["fee"], "band": r["band"]} for r in result.table.collect()} == want_table
    got_log = sorted((r["k"], r["field_name"], r["old_value"], r["new_value"], r["seq"]) for r in result.log.collect())
    assert got_log == sorted(want_log)
    again = merge.merge_records(result.table, new.groupBy("k").agg(
        F.max("seq").alias("seq"), F.max_by("fee", F.when(F.col("fee").isNotNull(), F.col("seq"))).alias("fee"),
        F.max_by("band", F.when(F.col("band").isNotNull(), F.col("seq"))).alias("band"),
    ), spec, ["seq"])
    assert again.log.count() == 0
    assert sorted(map(tuple, again.table.collect())) == sorted(map(tuple, result.table.collect()))


def test_merge_keeps_equal_values_and_follows_units(spark):
    spec = MergeSpec(
        "deadline", ("k", "round"), (Unit("at", ("at", "note"), tracked=True),), log_insert=True, null_safe=True
    )
    old = spark.createDataFrame([(1, None, "46700.00", "first")], "k int, round int, at string, note string")
    new = spark.createDataFrame([(1, None, "46700.0", "same", 1), (2, 1, "5", "new", 2)], "k int, round int, at string, note string, seq int")
    result = merge.merge_records(old, new, spec, ["seq"])
    assert sorted((r["k"], r["at"], r["note"]) for r in result.table.collect()) == [(1, "46700.00", "first"), (2, "5", "new")]
    assert [(r["k"], r["change_type"]) for r in result.log.collect()] == [(2, "insert")]


def test_backfill_never_inserts(spark):
    spec = MergeSpec.simple("program", ("k",), ("v",), tracked=("v",), insert_missing=False)
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "b", 1), (9, "c", 2), (9, "d", 3)], "k int, v string, seq int")
    result = merge.merge_records(old, new, spec, ["seq"])
    assert [tuple(r) for r in result.table.collect()] == [(1, "b")]
    assert [r["k"] for r in result.log.collect()] == [1]


def fold_programs(stored, records):
    """Each record in turn: by name, else by the URL that a programme has at that moment, else a new one."""
    table = [{"id": i, "name": n.rstrip().lower(), "url": u and u.lower()} for i, n, u in stored]
    found = {}
    for seq, name, url, backfill in records:
        if name is None:
            continue
        key, address = name.rstrip().lower(), url and url.lower()
        row = next((r for r in table if r["name"] == key), None)
        row = row or next((r for r in table if address and r["url"] == address), None)
        if row is None and backfill:
            continue
        if row is None:
            row = {"id": f"1\x01{name}", "name": key, "url": None}
            table.append(row)
        if address:
            row["url"] = address
        found[seq] = row["id"]
    return found


def identities(spark, stored, records):
    old = spark.createDataFrame([(i, 1, n, u) for i, n, u in stored], "sid string, s int, name string, url string")
    new = spark.createDataFrame([(s, 1, n, u, b) for s, n, u, b in records], "seq int, s int, name string, url string, b boolean")
    found = identity.resolve_in_order(new, old, "sid", ["s", "name"], ["s", "url"], ["seq"], F.col("b"))
    return {r["seq"]: r["entity_key"] for r in found.collect()}, identity.incomplete(new, ["s", "name"]).count()


def test_identity_follows_urls(spark):
    stored = [("p1", "Law", "u/law")]
    rows = [(1, "Law", "u/x", False), (2, "Renamed Law", "u/law", False), (3, "Art", "u/art", False), (4, "Art", "u/art2", False), (5, "Fine Art", "u/art", False)]
    found, _ = identities(spark, stored, rows)
    assert found[1] == "p1" and found[2] == "1\x01Renamed Law" and found[3] == found[4] == "1\x01Art" and found[5] == "1\x01Fine Art"
    rows = [(1, "A", "u1", False), (2, "B", "u1", False), (3, "B", "u2", False), (4, "C", "u2", False)]
    found, _ = identities(spark, [], rows)
    assert found == {1: "1\x01A", 2: "1\x01A", 3: "1\x01B", 4: "1\x01B"}


@pytest.mark.parametrize("seed", range(4))
def test_identity_equals_record_by_record(spark, seed):
    rng = random.Random(seed)
    names = [f"{n}{end}" for n in ("Law", "law", "Art", "Fine Art", "Maths", "BIO", "Bio") for end in ("", " ")] + [None]
    urls = [f"u/{k}" for k in range(8)] + ["U/3", None]
    stored = [(f"p{i}", n, f"u/{i}") for i, n in enumerate(("Law", "History", "Chem"))]
    records = [(seq, rng.choice(names), rng.choice(urls), rng.random() < 0.2) for seq in range(60)]
    found, unnamed = identities(spark, stored, records)
    assert found == fold_programs(stored, records)
    assert unnamed == sum(r[1] is None for r in records)


def fold_modules(stored, records):
    table, found = [{"id": i, "code": c and c.lower(), "name": n.lower()} for i, c, n in stored], {}
    for seq, code, name in records:
        if code:
            row = next((r for r in table if r["code"] == code.lower()), None)
        else:
            row = next((r for r in table if r["name"] == name.lower() and r["code"]), None)
            row = row or next((r for r in table if r["name"] == name.lower()), None)
        if row is None:
            row = {"id": f"1\x01{code or name}", "code": code and code.lower(), "name": name.lower()}
            table.append(row)
        found[seq] = row["id"]
    return found


@pytest.mark.parametrize("seed", range(4))
def test_module_identity_equals_record_by_record(spark, seed):
    rng = random.Random(seed)
    stored = [("m1", "C1", "Logic"), ("m2", None, "Sets"), ("m3", None, "Logic")]
    records = [(s, rng.choice(("C1", "c2", "C2", "C3", None, None, None)), rng.choice(("Logic", "Sets", "sets", "Rings", "Fields", "fields"))) for s in range(40)]
    old = spark.createDataFrame([(i, 1, c, n) for i, c, n in stored], "sid string, s int, code string, name string")
    new = spark.createDataFrame([(q, 1, c, n) for q, c, n in records], "seq int, s int, code string, name string")
    out = identity.resolve_by_code(new, old, "sid", ["s"], "code", "name", ["seq"])
    assert {r["seq"]: r["entity_key"] for r in out.collect()} == fold_modules(stored, records)


def test_lookups_compare_without_case(spark):
    target = spark.createDataFrame([(1, "Café ", "u/1"), (2, "cafe", "u/2")], "id int, name string, url string")
    records = spark.createDataFrame([("CAFE", "u/9"), ("x", "U/2"), ("y", None)], "name string, url string")
    found = lookup.lookup_two_step(records, target, "id", ["name"], ["url"])
    assert {r["name"]: r["id"] for r in found.collect()} == {"CAFE": 1, "x": 2, "y": None}


def test_differs_strips_all_white_space(spark):
    rows = spark.createDataFrame([("abc\n", "abc"), ("\t1.0", "1"), ("a", "b"), (None, "")], "a string, b string")
    assert [r[0] for r in rows.select(differs(F.col("a"), F.col("b"))).collect()] == [False, False, True, True]


def test_top_ancestors(spark):
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 99)], "id int, parent_id int")
    assert sorted(map(tuple, lookup.top_ancestors(tree).collect())) == [(1, 1), (2, 1), (3, 1), (4, 4)]
    chain = spark.createDataFrame([(i, i - 1 if i > 1 else None) for i in range(1, 24)], "id int, parent_id int")
    assert {r["top_id"] for r in lookup.top_ancestors(chain).collect()} == {1}
    assert lookup.top_ancestors(chain.limit(0)).count() == 0


def test_chunked_lists_lose_nothing(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 900, 1).otherwise(2).alias("k"), "id")
    out = rollup.chunked_lists(rows, ["k"], ["id"], F.col("id"), limit=100).collect()
    assert sorted(i for r in out for i in r["items"]) == list(range(1000))
    assert {r["k"]: r["n_chunks"] for r in out} == {1: 9, 2: 1}
    assert all(r["items"] == sorted(r["items"]) and len(r["items"]) <= 100 for r in out)


def test_chunks_laid_end_to_end_are_the_sorted_list(spark):
    draw = random.Random(5)
    rows = [(draw.choice(("a", "b", None)), draw.randrange(40), i) for i in range(70)] + [("c", 1, 99)]
    out = rollup.chunked_lists(spark.createDataFrame(rows, "k string, o int, i int").repartition(5), ["k"], ["o", "i"], F.col("i"), limit=3)
    found = {}
    for r in out.orderBy("k", "chunk").collect():
        assert r["chunk"] == len(found.setdefault(r["k"], [])) / 3 and r["n_chunks"] == -(-sum(k == r["k"] for k, *_ in rows) // 3)
        found[r["k"]] += r["items"]
    assert found == {k: [i for _, o, i in sorted((r for r in rows if r[0] == k), key=lambda r: r[1:])] for k in ("a", "b", None, "c")}
    assert rollup.chunked_lists(spark.createDataFrame([], "k string, o int, i int"), ["k"], ["o"], F.col("i")).count() == 0


def test_majority_vote_needs_a_strict_majority(spark):
    votes = [(1, "a")] * 3 + [(1, "b")] * 2 + [(2, "a")] * 3 + [(2, "b")] * 3 + [(3, "a")] * 2 + [(4, None)] * 5
    found = rollup.majority_vote(spark.createDataFrame(votes, "p int, f string"), "p", "f")
    assert [tuple(r) for r in found.collect()] == [(1, "a", 3, 5)]


def test_scorecard_skips_and_softens(spark):
    wide = spark.createDataFrame(
        [(1, "walled off", True, 0, None, None, None, 0, 0, 0, 0, None, 0, 0, 0, 0)],
        "university_id int, modules_skip string, exam_skip boolean, n_modules int, module_url_pct int, module_zh_pct int,"
        " module_faculty_pct int, junk_names int, duplicate_codes int, runaway int, n_programs int, program_faculty_pct int,"
        " future_events int, future_exams int, never_fetched int, dead_pct int",
    )
    limits = quality.thresholds(wide.select("university_id"), spark.createDataFrame([], "university_id int, rule_key string, value int"), "university_id")
    card = {r["rule"]: r["light"] for r in quality.scorecard(wide, limits).collect()}
    assert card == {
        "modules (skipped)": "△", "programs": "✗", "future events": "✗", "future exams": "△", "never fetched": "✓", "dead pages %": "✓",
    }
