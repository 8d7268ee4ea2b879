import hashlib
import random
import re
import uuid
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from texts import prose

from catalodge.llm import simhash
from catalodge.llm.exact_dedup import DigestIndex, exact_dedup
from catalodge.operators import graph
from catalodge.operators.graph import component_roots
from catalodge.session import shared_dir


def new_index(spark):
    return DigestIndex(spark, f"{shared_dir(spark, 'test-index')}/{uuid.uuid4().hex}", 4)


def brute_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, sha) for i in ids]
    return sorted(out, key=repr)


def test_exact_dedup(spark, odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    for batches in (1, 3):
        got = exact_dedup(odd_docs, new_index(spark), batches)
        assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
        assert sorted(map(tuple, got.collect()), key=repr) == brute_groups(rows)


def test_exact_dedup_of_nothing(spark, no_docs):
    assert exact_dedup(no_docs, new_index(spark)).count() == 0


def test_index_keeps_what_it_has(spark):
    index = new_index(spark)
    old = spark.createDataFrame([(50, "a"), (51, "b")], "doc_id long, text string")
    new = spark.createDataFrame([(60, "b"), (61, "c"), (62, "c")], "doc_id long, text string")
    exact_dedup(old, index)
    again = DigestIndex(spark, index.path, 4)
    got = {(r["doc_id"], r["keep_id"], r["kept"]) for r in exact_dedup(new, again).collect()}
    assert got == {(60, 51, False), (61, 62, False), (62, 62, True)}
    exact_dedup(new, again)
    assert again.table().count() == 3


def test_ids_over_all_64_bits(spark):
    rows = [(-(2**63), "a"), (2**63 - 1, "a"), (0, "b"), (-9 * 10**18, "b"), (9 * 10**18, "c"), (9 * 10**18 + 1, "c"), (None, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for batches in (1, 2, 5):
        got = exact_dedup(docs, new_index(spark), batches)
        assert sorted(map(tuple, got.collect()), key=repr) == brute_groups(rows)


def test_reopened_with_another_number_of_buckets(spark):
    old = spark.createDataFrame([(i, f"t{i}") for i in range(500)], "doc_id long, text string")
    path = f"{shared_dir(spark, 'test-index')}/{uuid.uuid4().hex}"
    exact_dedup(old, DigestIndex(spark, path, 8))
    again = DigestIndex(spark, path, 4)
    assert again.buckets == 8 and not any(r["kept"] for r in exact_dedup(old.selectExpr("doc_id + 1000 AS doc_id", "text"), again).collect())


def test_compacted_index_has_one_file_a_bucket_and_all_digests(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(300)], "doc_id long, text string")
    index = new_index(spark)
    exact_dedup(docs, index, 5)
    small = index.compacted(f"{index.path}-new", 3)
    assert len(small.table().inputFiles()) <= 3 < len(index.table().inputFiles())
    assert sorted(map(tuple, small.table().collect())) == sorted(map(tuple, index.table().collect()))
    assert not any(r["kept"] for r in exact_dedup(docs.selectExpr("doc_id - 1000 AS doc_id", "text"), small).collect())
    small.close()
    assert not spark.catalog.tableExists(small.name) and len(DigestIndex(spark, small.path).table().inputFiles()) <= 3


def test_many_copies(spark):
    rows = [(i, "hot" if i % 3 else f"t{i}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, exact_dedup(docs, new_index(spark)).collect()), key=repr) == brute_groups(rows)


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, radius):
    parent = list(range(len(ids)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[top(i)] = top(j)
    least = {}
    for i, doc_id in enumerate(ids):
        if doc_id is not None:
            least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return [least.get(top(i)) for i in range(len(ids))]


def test_near_duplicates(spark, odd_docs):
    words = prose(9, 400).split()
    draw = random.Random(4)
    near = []
    for i in range(60):
        copy = list(words)
        copy[draw.randrange(400)] = "edit"
        near.append((100 + i, " ".join(copy)))
    docs = spark.createDataFrame(near, "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    fps = [brute_fingerprint(t) for _, t in rows]
    want = sorted(zip([i for i, _ in rows], [f"{f:016x}" for f in fps], brute_components([i for i, _ in rows], fps, 4), strict=True), key=repr)
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=repr) == want
    assert len({c for i, _, c in want if (i or 0) >= 100}) < 60
    clashing = simhash.near_duplicates(odd_docs)
    assert clashing.columns == ["doc_id", "fingerprint", "component_id"] and clashing.count() == odd_docs.count()


def test_near_duplicates_of_nothing(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0


def test_forest_connects_what_pairs_connect():
    draw = np.random.default_rng(1)
    for size in (3, 700, 1500):
        seeds = draw.integers(0, 1 << 63, 40, np.uint64)
        flips = (np.uint64(1) << draw.integers(0, 64, size, np.uint64)) ^ (np.uint64(1) << draw.integers(0, 64, size, np.uint64))
        left = np.unique(seeds[draw.integers(0, 40, size)] ^ flips)
        right = np.unique(seeds[draw.integers(0, 40, size)] ^ (np.uint64(1) << draw.integers(0, 64, size, np.uint64)))
        u, v = simhash.forest(left, right, 4)
        nodes = [*left.tolist(), *right.tolist()]
        parent = {n: n for n in nodes}

        def top(n):
            while parent[n] != n:
                n = parent[n]
            return n

        for a in left.tolist():
            for b in np.array(right)[np.bitwise_count(right ^ np.uint64(a)) <= 4].tolist():
                parent[top(a)] = top(b)
        one = {n: top(n) for n in parent}
        parent = {n: n for n in nodes}
        for a, b in zip(u.view(np.uint64).tolist(), v.view(np.uint64).tolist(), strict=True):
            parent[top(a)] = top(b)
        two = {n: top(n) for n in parent}
        assert len(u) < len(parent)
        assert len(set(one.values())) == len(set(two.values())) == len({(one[n], two[n]) for n in parent})


def test_component_roots(spark):
    draw = random.Random(7)
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(1000, 1001 + i) for i in range(300)]
    loose = [(draw.randrange(2000, 2080), draw.randrange(2000, 2080)) for _ in range(50)]
    links = chain + star + loose + [(5, 5), (1, 0)]
    parent = {n: n for pair in links for n in pair}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    want = {n: top(n) for n in parent if top(n) != n}
    got = component_roots(spark.createDataFrame(links, "u long, v long")).collect()
    assert {r["node"]: r["root"] for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("few", [1 << 16, 0])
def test_rounds_of_few_links_write_no_file_for_each_shuffle_partition(spark, monkeypatch, few):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 100), (200, 100)]
    written, files = graph.written, []

    def noted(df, name, rows):
        out = written(df, name, rows)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(graph, "written", noted)
    monkeypatch.setattr(graph, "FEW_KEYS", few)
    held = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in held}
    try:
        for key, value in held.items():
            spark.conf.set(key, value)
        got = {tuple(row) for row in component_roots(spark.createDataFrame(links, "u long, v long")).collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == {(i, 0) for i in range(1, 41)} | {(i, 100) for i in (*range(101, 130), 200)}
    assert files and max(files) <= spark.sparkContext.defaultParallelism
