"""Radix trees, and the prefix trie against a plain version over all prefixes."""

import hashlib
import random
import re
import zlib

import __spark_entry__
from oracle import compare, connect

from catalodge.llm import prefix_trie as trie
from catalodge.llm.radix_tree import Direct, Indexed, RadixTree, Small

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """All nodes of the trie of rebuilt conversations, by dictionaries of prefixes."""
    lists = {}
    key = lambda r: (r[1] is not None, r[1] or 0, turn_hash(r))
    for row in sorted((r for r in rows if r[0] is not None), key=key):
        lists.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    members, done = {}, {}
    for c, own in lists.items():
        h = zlib.crc32(str(c).encode()) % 4
        turns = tuple(lists.get(c - c % 20, [])[:h] + own[h:])
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        done.setdefault(turns, []).append(c)
    leaves, saved, children = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for start in sorted(members, key=len, reverse=True):
        leaves[start] = leaves[start] or 1
        if start:
            saved[start] += (len(members[start]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", start[-1][1]))
            children[start[:-1]] += 1
            leaves[start[:-1]] += leaves[start]
            saved[start[:-1]] += saved[start]
    return sorted(
        (
            min(found),
            len(start),
            min(members[start[:-1]]) if start else None,
            len(found),
            children[start],
            leaves[start],
            saved[start],
            hashlib.sha256(",".join(map(str, sorted(done.get(start, [])))).encode()).hexdigest(),
        )
        for start, found in members.items()
    ) if members else []


def turn_hash(row):
    role, text = row[2] or "", row[3] or ""
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def drawn(seed, conversations, roles=("user", "bot", None), words=("a", "b c", "", None, "d e f")):
    draw = random.Random(seed)
    rows = []
    for c in range(conversations):
        for turn in range(draw.choice((0, 1, 1, 2, 3, 6))):
            rows.append((c, turn or None, draw.choice(roles), draw.choice(words)))
    return rows


def got(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted(map(tuple, trie.prefix_trie(trie.rebuilt(frame)).collect()), key=lambda r: (r[0], r[1], r))


def same(spark, rows):
    assert got(spark, rows) == sorted(plain(rows), key=lambda r: (r[0], r[1], r))


def test_random_conversations(spark):
    same(spark, drawn(1, 300))


def test_runs_of_one_key_and_levels_of_merges(spark, monkeypatch):
    rows = drawn(2, 120) + [(1000 + 20 * i, t, "user", "copy") for i in range(60) for t in range(2)]
    found = spark.createDataFrame(rows, SCHEMA)
    lists = [(r["conv_id"], [(t["id"], t["words"]) for t in r["turns"]]) for r in trie.rebuilt(found).collect()]
    lists.sort(key=lambda one: (bytes.fromhex("".join(i for i, _ in one[1])), one[0]))
    pending, nodes, ends = [], [], {}
    for conv_id, turns in lists:  # every conversation is a run of its own
        key, words = bytes.fromhex("".join(i for i, _ in turns)), [w for _, w in turns]
        rows_of_run, ends_of_run = trie.run_nodes([key], [conv_id], [words])
        trie.with_parents(rows_of_run)
        for ident, piece in ends_of_run:
            ends.setdefault(ident, []).append(piece)
        pending, closed = trie.merge_open(pending, rows_of_run) if pending else (rows_of_run, [])
        nodes += closed
    nodes += trie.merge_open(pending, [], final=True)[1]
    by_id = {row["id"]: row for row in nodes}
    assert len(by_id) == len(nodes)
    told = sorted(
        (
            (
                row["conv_id"],
                row["depth"],
                by_id[row["parent"]]["conv_id"] if row["depth"] else None,
                *(row[name] for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
                hashlib.sha256(b",".join(ends.get(row["id"], []))).hexdigest(),
            )
            for row in nodes
        ),
        key=lambda r: (r[0], r[1], r),
    )
    assert told == sorted(plain(rows), key=lambda r: (r[0], r[1], r))


def test_long_conversation_and_hot_first_turn(spark):
    rows = [(7, t, "user", f"t{t % 3}") for t in range(700)]
    rows += [(100 + c, t, "user", "hello" if t == 0 else f"{c % 11}") for c in range(200) for t in range(2)]
    same(spark, rows)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(None, 1, "user", "x"), (3, None, None, None), (3, None, None, None), (3, 2, "a", "bc"), (4, 2, "ab", "c"), (23, 1, "a", "bc")]
    same(spark, rows)
    frame = spark.createDataFrame([(*r, b"k", 1, "x") for r in rows], SCHEMA + ", key binary, part int, turns string")
    assert trie.prefix_trie(trie.rebuilt(frame)).count() == len(plain(rows))


def test_empty_table(spark):
    assert got(spark, []) == []


def test_all_in_a_few_ranges_and_many(spark):
    rows = drawn(3, 150)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "70"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            same(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    problem = compare(connect(sf), __spark_entry__.queries()["op13_prefix_trie"](spark, sf), __spark_entry__.oracle_sql()["op13_prefix_trie"])
    assert problem is None


def test_nodes_grow_and_keep_the_order_of_edges():
    node, shapes = Small(), set()
    edges = random.Random(4).sample(range(256), 256)
    for n, edge in enumerate(edges, 1):
        node = node.put(edge, n)
        shapes.add((type(node), getattr(node, "room", None)))
        assert [e for e, _ in node] == sorted(edges[:n]) and node.get(edge) == n
        assert n == 256 or node.get(edges[n]) is None
    assert shapes == {(Small, 4), (Small, 16), (Indexed, None), (Direct, None)}
    assert node.put(edges[0], -1).get(edges[0]) == -1


def test_tree_holds_what_was_put_in():
    draw, tree, kept = random.Random(6), RadixTree(), {}
    for number in range(3000):
        key = bytes(draw.choice((0, 1, 255)) for _ in range(draw.randrange(9)))
        tree.add(key, number)
        kept.setdefault(key, []).append(number)
    seen, stack = {}, [(tree.root, b"")]
    while stack:
        node, above = stack.pop()
        path = above + node.path
        if node.values:
            seen[path] = node.values
        children = [child for _, child in node.children]
        assert node.values or len(children) != 1 or path == b""
        stack += [(child, path) for child in children]
    assert seen == kept
