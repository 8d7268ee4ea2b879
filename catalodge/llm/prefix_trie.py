"""The prefix trie of conversations, built from adaptive radix trees over fixed-width turn ids.

A turn's id is 16 bytes of the SHA-256 of its role and text; a conversation's key is the
ids of its turns one after the other. Keys are dealt by ranges, and each task builds one
radix tree after the other over a bounded run of sorted keys. Inner places of a compressed
path emit a trie node only where a turn ends. Nodes that lie on the path of the first or
last key of a run may go on in other runs: these stay open and are merged with those of
their neighbours, level by level, until all are closed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalodge.llm.radix_tree import RadixTree, common_start
from catalodge.operators.graph import hot_lookup
from catalodge.session import materialize

WIDTH = 16
# Conversations and key bytes in one radix tree, ranges merged in one step, ids in one piece of a list.
RUN_KEYS = 20_000
RUN_BYTES = 2 << 20
FAN = 64
ROOT = bytes(WIDTH)
WORD = r"[^\x20\x09-\x0D]+"

NODE = "id binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
CLOSED = f"{NODE}, ends_sha256 string, ends_open boolean"
# Open nodes: sums so far, the words of the last turn, and on which border of their run they lie.
OPEN = f"{NODE}, words long, part int, on_first boolean, on_last boolean"


def turn_id() -> Column:
    """32 hex digits for role and text; the length of the role keeps (a, bc) and (ab, c) apart."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    return F.left(F.sha2(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "UTF-8"), 256), F.lit(2 * WIDTH))


def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: array of (id, words) in the order of turn, null first, then of id; texts are not moved."""
    text = F.coalesce(F.col("text"), F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("known"),
            F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
            turn_id().alias("id"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        ).alias("t"),
    )
    return turns.groupBy("conv_id").agg(F.expr("transform(array_sort(collect_list(t)), x -> struct(x.id, x.words))").alias("turns"))


def rebuilt(conversations: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """conv_id, turns: the first h turns of conversation c - c % group, then c's own after its first h; h = crc32(c) % heads."""
    own = materialize(turn_lists(conversations), "turn-lists")
    first = own.where(F.pmod("conv_id", F.lit(group)) == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, max(1, heads - 1)).alias("start")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    with_base = own.withColumn("base", F.col("conv_id") - F.pmod("conv_id", F.lit(group))).join(first, "base", "left")
    none = F.expr("cast(array() AS array<struct<id: string, words: bigint>>)")
    head = F.when(h > 0, F.slice(F.coalesce("start", none), F.lit(1), h)).otherwise(none)
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    return with_base.select("conv_id", F.concat(head, rest).alias("turns"))


def new_node(parent: int, depth: int, words: int, ident: bytes | None) -> dict:
    """A trie node of a run; `parent` is the place of its parent in the list, and only open nodes have an id."""
    place = {"id": ident, "open": ident is not None, "parent_at": parent, "parent": None, "parent_conv_id": None}
    counts = {"conv_id": None, "n_convs": 0, "n_children": 0, "n_leaves": 0, "saved_tokens": 0}
    return place | {"depth": depth, "words": words} | counts


def close(rows: list[dict]) -> None:
    """Finish the closed nodes of a list that has parents first: children, leaves and saved tokens flow up.

    Members have been counted before; what open nodes hold stays theirs.
    """
    for row in reversed(rows):
        if row["open"]:
            continue
        row["n_leaves"] = row["n_leaves"] or 1
        row["saved_tokens"] += (row["n_convs"] - 1) * row["words"]
        if row["parent_at"] >= 0:
            above = rows[row["parent_at"]]
            above["n_children"] += 1
            above["n_leaves"] += row["n_leaves"]
            above["saved_tokens"] += row["saved_tokens"]


def chain_ids(key: bytes) -> list[bytes]:
    """The id of the node at each depth along a key: the root, then a running hash of the turn ids."""
    ids = [ROOT]
    for at in range(0, len(key), WIDTH):
        ids.append(hashlib.sha256(ids[-1] + key[at : at + WIDTH]).digest()[:WIDTH])
    return ids


def id_list(conv_ids: list[int]) -> bytes:
    return ",".join(map(str, conv_ids)).encode()


def run_nodes(keys: list[bytes], conv_ids: list[int], words: list[list[int]]) -> tuple[list[dict], list[tuple[bytes, bytes]]]:
    """The trie nodes of one run of keys sorted by (key, conv_id), and (node id, id list) of the ends of open nodes."""
    tree = RadixTree()
    for number, key in enumerate(keys):
        tree.add(key, number)
    borders = keys[0], keys[-1]
    chains = tuple(map(chain_ids, borders))
    rows, ends = [new_node(-1, 0, 0, ROOT)], []
    # (radix node, bytes above it, trie node above it, bytes that it shares with the first and the last key)
    stack = [(tree.root, 0, 0, 0, 0)]
    while stack:
        node, start, above, *shared = stack.pop()
        stop = start + len(node.path)
        for side, border in enumerate(borders):
            if shared[side] == start:
                rest = border[start:stop]
                if rest == node.path:
                    shared[side] = stop
                else:
                    shared[side] += common_start(rest, node.path)
        for depth in range(start // WIDTH + 1, stop // WIDTH + 1):
            at = depth * WIDTH
            side = next((s for s in (0, 1) if shared[s] >= at), None)
            ident = chains[side][depth] if side is not None else None
            rows.append(new_node(above, depth, int(words[node.sample][depth - 1]), ident))
            above = len(rows) - 1
        if node.values:
            row = rows[above]
            members = [conv_ids[i] for i in node.values]
            row["n_convs"], row["conv_id"] = len(members), members[0]
            if row["open"]:
                ends.append((row["id"], id_list(members)))
            else:
                row["ends_sha256"] = hashlib.sha256(id_list(members)).hexdigest()
        stack += [(child, stop, above, *shared) for _, child in node.children]
    for row in reversed(rows):
        if row["parent_at"] >= 0:
            parent = rows[row["parent_at"]]
            parent["n_convs"] += row["n_convs"]
            if parent["conv_id"] is None or row["conv_id"] < parent["conv_id"]:
                parent["conv_id"] = row["conv_id"]
    first, last = map(set, chains)
    for row in rows:
        row["on_first"], row["on_last"] = row["id"] in first, row["id"] in last
    close(rows)
    return rows, ends


def with_parents(rows: list[dict]) -> None:
    for row in rows:
        if row["parent_at"] >= 0:
            parent = rows[row["parent_at"]]
            row["parent"], row["parent_conv_id"] = parent["id"], None if parent["open"] else parent["conv_id"]


def merge_open(older: list[dict], newer: list[dict], final: bool = False) -> tuple[list[dict], list[dict]]:
    """The open nodes of two neighbouring ranges of keys as one: (still open, closed now).

    Open are those on the first path of the older range or the last path of the newer one;
    with `final`, none.
    """
    by_id: dict[bytes, dict] = {}
    for rows, is_new in ((older, False), (newer, True)):
        for row in rows:
            border = {"on_first": row["on_first"] and not is_new, "on_last": row["on_last"] and is_new}
            known = by_id.get(row["id"])
            if known is None:
                by_id[row["id"]] = row | border
                continue
            known["on_first"] |= border["on_first"]
            known["on_last"] |= border["on_last"]
            known["conv_id"] = min(known["conv_id"], row["conv_id"])
            for name in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                known[name] += row[name]
    rows = sorted(by_id.values(), key=lambda row: row["depth"])
    places = {row["id"]: at for at, row in enumerate(rows)}
    for row in rows:
        row["parent_at"] = places.get(row["parent"], -1)
        row["open"] = not final and (row["on_first"] or row["on_last"])
    close(rows)
    for row in rows:
        if row["parent_at"] >= 0 and not rows[row["parent_at"]]["open"]:
            row["parent_conv_id"] = rows[row["parent_at"]]["conv_id"]
    return [row for row in rows if row["open"]], [row for row in rows if not row["open"]]


def _batch(rows: list[dict], schema: pa.Schema, **constants) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{name: row.get(name) for name in schema.names} | constants for row in rows], schema)


FIELDS = [("id", pa.binary()), ("parent", pa.binary())] + [
    (name, pa.int64()) for name in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
]
ALL = pa.schema(
    [
        *FIELDS,
        ("ends_sha256", pa.string()),
        ("ends_open", pa.bool_()),
        ("words", pa.int64()),
        ("part", pa.int32()),
        ("on_first", pa.bool_()),
        ("on_last", pa.bool_()),
        ("open", pa.bool_()),
        ("piece", pa.int64()),
        ("id_list", pa.binary()),
    ]
)
ALL_SQL = f"{CLOSED}, words long, part int, on_first boolean, on_last boolean, open boolean, piece long, id_list binary"
NOTHING = hashlib.sha256(b"").hexdigest()


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of sorted keys: closed nodes, pieces of id lists of open nodes, and at the end the open nodes themselves."""
    pending: list[dict] = []
    part = pieces = 0

    def runs():
        keys, ids, words, size = [], [], [], 0
        for batch in batches:
            for number, key, conv_id, counts in zip(*(batch.column(i) for i in range(4)), strict=True):
                nonlocal part
                part = number.as_py()
                keys.append(key.as_py())
                ids.append(conv_id.as_py())
                words.append(counts.values.to_numpy(zero_copy_only=False))
                size += len(keys[-1])
                if len(keys) >= RUN_KEYS or size >= RUN_BYTES:
                    yield keys, ids, words
                    keys, ids, words, size = [], [], [], 0
        if keys:
            yield keys, ids, words

    for keys, ids, words in runs():
        rows, ends = run_nodes(keys, ids, words)
        with_parents(rows)
        closed = [row for row in rows if not row["open"]]
        fresh = [row for row in rows if row["open"]]
        pending, done = merge_open(pending, fresh) if pending else (fresh, [])
        for row in done:
            row["ends_open"] = True
        for rows in (closed, done):
            if rows:
                yield _batch(rows, ALL)
        if ends:
            yield _batch([{"id": ident, "id_list": piece, "piece": pieces + i} for i, (ident, piece) in enumerate(ends)], ALL, part=part)
            pieces += len(ends)
    if pending:
        yield _batch(pending, ALL, part=part, open=True)


def _merger(final: bool):
    def merge(table: pa.Table) -> pa.Table:
        return _merge_group(table, final)

    return merge


def _merge_group(table: pa.Table, final: bool) -> pa.Table:
    """Open nodes of neighbouring ranges, by ascending part, merged into one range."""
    parts: dict[int, list[dict]] = {}
    for row in table.to_pylist():
        parts.setdefault(row["part"], []).append(row)
    order = sorted(parts)
    left, done = parts[order[0]], []
    for part in order[1:]:
        left, closed = merge_open(left, parts[part])
        done += closed
    if final:
        left, closed = merge_open(left, [], final=True)
        done += closed
    for row in left + done:
        row["part"] = order[0] // FAN
    for row in done:
        row["open"], row["ends_open"] = False, True
    return pa.Table.from_batches([_batch(left + done, ALL)])


def ends_of_open(pieces: DataFrame) -> DataFrame:
    """id, sha: the hash of each open node's whole id list, streamed piece by piece in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for batch in batches:
            done = []
            for ident, piece in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if ident != current:
                    if digest is not None:
                        done.append((current, digest.hexdigest()))
                    current, digest = ident, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(piece.as_buffer())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*done, strict=True)], ["id", "sha"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current]), pa.array([digest.hexdigest()])], ["id", "sha"])

    ordered = pieces.repartition("id").sortWithinPartitions("id", "part", "piece")
    return ordered.select("id", "id_list").mapInArrow(run, "id binary, sha string")


def prefix_trie(lists: DataFrame) -> DataFrame:
    """One row for each distinct start of the turn lists of (conv_id, turns: array of (id, words)).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. The root has depth 0, and its parent is null; a
    list without turns ends there. A list's keys and counts (24 bytes a turn) must fit into
    a task; the lists themselves may be any number, equal or not: equal ones are counted in
    runs of bounded size. An empty table gives an empty result.
    """
    spark = lists.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = lists.select(
        F.unhex(F.array_join("turns.id", "")).alias("key"), "conv_id", F.col("turns.words").alias("words")
    )
    dealt = keys.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    found = dealt.select(F.spark_partition_id().alias("part"), "key", "conv_id", "words").mapInArrow(_ranges, ALL_SQL)
    found = materialize(found, "trie-ranges")

    names = [field.split()[0] for field in CLOSED.split(", ")]
    closed = found.where("NOT open").select(*names)
    level = found.where("open")
    late, final = None, False
    while not final:
        final = parts <= FAN
        merged = level.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(_merger(final), ALL_SQL)
        merged = materialize(merged, "trie-level")
        done = merged.where("NOT open").select(*names)
        late = done if late is None else late.unionByName(done)
        level, parts = merged.where("open"), -(-parts // FAN)
    ends = ends_of_open(found.where("piece IS NOT NULL").select("id", "part", "piece", "id_list"))
    late = late.drop("ends_sha256").join(ends.withColumnRenamed("sha", "ends_sha256"), "id", "left")
    late = materialize(late.select(*names), "trie-late")
    # Children of nodes that were open when they were closed themselves learn the parent's smallest member now.
    rows = closed.unionByName(late)
    above = late.select(F.col("id").alias("parent"), F.col("conv_id").alias("theirs"), "n_children")
    known = rows.where("parent IS NULL OR parent_conv_id IS NOT NULL")
    asked = rows.where("parent IS NOT NULL AND parent_conv_id IS NULL").withColumnRenamed("n_children", "children")
    told = hot_lookup(asked, above, "parent", "n_children").drop("n_children")
    told = told.withColumn("parent_conv_id", F.col("theirs")).withColumnRenamed("children", "n_children")
    return known.unionByName(told.select(*names)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )
