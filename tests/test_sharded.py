"""Merges into sharded tables equal merges into whole ones and leave other files alone."""

import os
import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from catalodge.operators import merge
from catalodge.operators.merge import MergeSpec
from catalodge.operators.sharded import ShardedTable
from catalodge.session import shared_dir

SPEC = MergeSpec.simple("thing", ("school", "id"), ("price", "name"), ("price",), log_insert=True)
SCHEMA = "school string, id bigint, price int, name string"
BATCH = f"{SCHEMA}, pos int"


def new_table(spark, **more):
    return ShardedTable(spark, f"{shared_dir(spark, 'test-sharded')}/{uuid.uuid4().hex}", SPEC.keys, SCHEMA, **more)


def drawn(draw, n, ids):
    return [(draw.choice("ab"), draw.randrange(ids), draw.choice((None, 1, 2, 3)), draw.choice((None, "x", "y")), pos) for pos in range(n)]


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def files(path):
    return {os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")}


LOG = ["entity_type", "school", "id", "change_type", "field_name", "old_value", "new_value", "pos"]


def test_merges_equal_those_of_a_whole_table(spark):
    draw, table = random.Random(4), new_table(spark, shards=5)
    whole = spark.createDataFrame([], SCHEMA)
    for n in (40, 0, 25, 3):
        batch = spark.createDataFrame(drawn(draw, n, 12), BATCH)
        want = merge.merge_records(whole, batch, SPEC, ["pos"])
        log = table.merge(batch, SPEC, ["pos"])
        assert rows(log, *LOG) == rows(want.log, *LOG)
        whole = spark.createDataFrame(want.table.collect(), SCHEMA)
        assert rows(table.read(), "school", "id", "price", "name") == rows(whole, "school", "id", "price", "name")
    assert table.merge(batch, SPEC, ["pos"]).count() == 0 or whole.count()


def test_other_shards_keep_their_files(spark):
    table = new_table(spark, shards=7)
    table.merge(spark.createDataFrame([("a", i, 1, "x", i) for i in range(60)], BATCH), SPEC, ["pos"])
    before = files(table.path)
    batch = spark.createDataFrame([("a", 3, 2, None, 0), ("a", 5, 9, None, 1)], BATCH)
    touched = table.touched(batch)
    assert 0 < len(touched) <= 2
    log = table.merge(batch, SPEC, ["pos"])
    assert rows(log, "id", "old_value", "new_value") == [(3, "1", "2"), (5, "1", "9")]
    after = files(table.path)
    in_touched = lambda path: any(f"shard={s}/" in path for s in touched)
    assert {p: t for p, t in before.items() if not in_touched(p)} == {p: t for p, t in after.items() if not in_touched(p)}
    assert table.read().count() == 60


@pytest.mark.parametrize("how", ["reopened", "in place"])
def test_stored_rows_are_not_exchanged(spark, how):
    table = new_table(spark, shards=3)
    table.merge(spark.createDataFrame([("a", i, 1, "x", i) for i in range(30)], BATCH), SPEC, ["pos"])
    if how == "reopened":
        table.close()
        table = ShardedTable(spark, table.path, SPEC.keys, SCHEMA, shards=99)
        assert table.shards == 3
    batch = spark.createDataFrame([("a", 3, 2, None, 0)], BATCH)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge.merge_records(table.read(table.touched(batch)), batch, SPEC, ["pos"]).table
        plan = merged._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    at = next(i for i, line in enumerate(plan) if "Scan parquet" in line and table.name in line)
    assert "Bucketed: true" in plan[at] and re.search(r"PartitionFilters: \[.*shard", plan[at])
    depth = lambda line: len(re.match(r"[ :+|\-]*", line)[0])
    level, above = depth(plan[at]), []
    for line in reversed(plan[:at]):
        if depth(line) < level:
            level = depth(line)
            above.append(line)
    join = next(i for i, line in enumerate(above) if "Join" in line)
    assert not any("Exchange" in line for line in above[: join + 1])


def test_member_lists(spark):
    table = ShardedTable(spark, f"{shared_dir(spark, 'test-sharded')}/{uuid.uuid4().hex}", ["owner"], "owner bigint, member string, note string", shards=4)
    table.replace_sets(spark.createDataFrame([(i, m, "1", 0) for i in range(9) for m in "abc"], "owner bigint, member string, note string, pos int"), ["member"], ["pos"])
    table.replace_sets(spark.createDataFrame([(2, "z", "2", 0), (2, "z", "3", 1), (4, "a", "2", 0)], "owner bigint, member string, note string, pos int"), ["member"], ["pos"])
    got = {(r["owner"], r["member"], r["note"]) for r in table.read().collect()}
    assert got == {(i, m, "1") for i in range(9) if i not in (2, 4) for m in "abc"} | {(2, "z", "2"), (4, "a", "2")}
    assert table.read().where(F.col("owner").isNull()).count() == 0
