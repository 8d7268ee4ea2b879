"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are put into tiles by the population counts of their two halves.
The sum of the differences of population counts is never more than the Hamming distance,
so two tiles that differ by more than the radius hold no link and are not compared. The
others are compared in full with numpy, exclusive-or and bit count, and each comparison
returns a spanning forest of its links, never all pairs of a group of copies.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalodge.llm.common import column, slices, utf8
from catalodge.operators.graph import component_roots, hot_lookup
from catalodge.session import materialize, written

SEED = 42
WORDS = 4
RADIUS = 4
# Fingerprints in one row of a tile, and in one step of the comparison inside it.
TILE = 1 << 15
STEP = 256
HASHES_AT_ONCE = 1 << 16
LOW_HALF = 0xFFFFFFFF
# Blocks of tiles: about so many, each within these bounds on its fingerprints.
BLOCKS, LEAST_IN_BLOCK, MOST_IN_BLOCK = 16, 1 << 12, 1 << 20


def bit_sums(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, lowest first."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def shingle_hashes(body: bytes, width: int = WORDS) -> Iterator[np.ndarray]:
    """XXH64 of each run of `width` words of a text in UTF-8 with A-Z in lower case, in pieces; all words where there are fewer."""
    words = body.lower().split()
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(width, len(words))
    starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), HASHES_AT_ONCE):
        spans = zip(starts[at : at + HASHES_AT_ONCE].tolist(), ends[at : at + HASHES_AT_ONCE].tolist(), strict=True)
        yield np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint_of(hashes: Iterable[np.ndarray]) -> int:
    total, n = np.zeros(64, np.int64), 0
    for some in hashes:
        total += bit_sums(some)
        n += len(some)
    return int(np.packbits(2 * total > n, bitorder="little").view("<i8")[0]) if n else 0


def fingerprint(body: bytes, width: int = WORDS) -> int:
    """The signed 64-bit SimHash of a text in UTF-8: a bit is 1 if over half of the shingle hashes have it.

    A text without words has fingerprint 0.
    """
    return fingerprint_of(shingle_hashes(body, width))


def fingerprints(docs: DataFrame, text: str = "text", width: int = WORDS) -> DataFrame:
    """doc_id, fp (signed 64 bits) for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [fingerprint(body, width) for body in column(batch, "body")]
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("body")).mapInArrow(
        run, "doc_id long, fp long"
    )


def part_counts(fps: np.ndarray) -> np.ndarray:
    """Population counts of the four quarters, then of the eight eighths, one row for each fingerprint."""
    quarters, eighths = fps.view(np.uint16).reshape(-1, 4), fps.view(np.uint8).reshape(-1, 8)
    return np.concatenate((np.bitwise_count(quarters), np.bitwise_count(eighths)), axis=1).astype(np.int16)


def forest(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) that connect what pairs of left and right fingerprints within the radius connect.

    Both sides are sorted by the counts of their parts and compared in steps; two steps
    whose ranges of counts are further apart than the radius, by quarters or by eighths,
    are skipped.
    """
    sides, boxes = [], []
    for fps in (left, right):
        counts = part_counts(fps)
        # The halves of a tile are fixed, so one quarter of each half and one eighth of each quarter say it all.
        order = np.lexsort(counts[:, [10, 8, 6, 4, 2, 0]].T)
        fps, counts = fps[order], counts[order]
        starts = np.arange(0, len(fps), STEP)
        sides.append(fps)
        boxes.append((np.minimum.reduceat(counts, starts), np.maximum.reduceat(counts, starts)))
    (low_l, high_l), (low_r, high_r) = boxes
    gaps = np.maximum(np.maximum(low_l[:, None] - high_r[None], low_r[None] - high_l[:, None]), 0)
    gaps = np.maximum(gaps[:, :, :4].sum(axis=2), gaps[:, :, 4:].sum(axis=2))
    left, right = sides
    parent = np.arange(len(left) + len(right))
    for a, b in np.argwhere(gaps <= radius):
        x, y = left[a * STEP : (a + 1) * STEP], right[b * STEP : (b + 1) * STEP]
        near = np.flatnonzero(np.bitwise_count(x[:, None] ^ y[None]) <= radius)
        i, j = near // len(y) + a * STEP, near % len(y) + b * STEP + len(left)
        while len(i):
            one, two = parent[i], parent[j]
            apart = one != two
            i, j, one, two = i[apart], j[apart], one[apart], two[apart]
            np.minimum.at(parent, np.maximum(one, two), np.minimum(one, two))
            while True:
                above = parent[parent]
                if np.array_equal(above, parent):
                    break
                parent = above
    nodes = np.concatenate((left, right))
    moved = nodes != nodes[parent]
    return nodes[moved].view(np.int64), nodes[parent][moved].view(np.int64)


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v) links between distinct fingerprints that connect all that lie within the radius.

    Tiles are put into blocks in the order of their counts, and a task compares two blocks,
    so a fingerprint moves once for each block near its own, not for each tile.
    """
    halves = nodes.select(
        "fp",
        F.bit_count(F.col("fp").bitwiseAND(F.lit(LOW_HALF))).alias("a"),
        F.bit_count(F.shiftrightunsigned("fp", 32)).alias("b"),
    )
    # 33 x 33 tiles at most; a tile of more than TILE fingerprints is dealt into parts by hash.
    parts = halves.groupBy("a", "b").agg(F.ceil(F.count("*") / TILE).cast("int").alias("parts"))
    tiles = materialize(
        halves.join(F.broadcast(parts), ["a", "b"])
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .groupBy("a", "b", "part")
        .agg(F.collect_list("fp").alias("fps"), F.count("*").alias("n")),
        "tiles",
    )
    # One row for each tile: a few for each million fingerprints, beside the 1,089 counts.
    names = tiles.select("a", "b", "part", "n")
    total = names.agg(F.sum("n")).first()[0] or 0
    size = min(MOST_IN_BLOCK, max(LEAST_IN_BLOCK, -(-total // BLOCKS)))
    before = F.sum("n").over(Window.orderBy("a", "b", "part").rowsBetween(Window.unboundedPreceding, -1))
    placed = names.withColumn("block", F.floor(F.coalesce(before, F.lit(0)) / size)).drop("n")
    blocks = materialize(
        tiles.join(placed, ["a", "b", "part"])
        .groupBy("block")
        .agg(F.collect_list(F.struct("a", "b", "part", "fps")).alias("tiles"), F.min("a").alias("low"), F.max("a").alias("high")),
        "blocks",
    )
    near = blocks.select("block", F.explode(F.sequence(F.col("low") - radius, F.col("high") + radius)).alias("a"))
    reached = blocks.select(F.col("block").alias("block2"), F.explode(F.sequence("low", "high")).alias("a"))
    pairs = near.join(reached, "a").where("block <= block2").select("block", "block2").distinct()
    compared = pairs.join(blocks.selectExpr("block", "tiles AS left"), "block").join(
        blocks.selectExpr("block AS block2", "tiles AS right"), "block2"
    )

    def unpacked(row: pa.StructScalar) -> list[tuple[tuple[int, int, int], np.ndarray]]:
        return [
            (tuple(tile[name].as_py() for name in ("a", "b", "part")), tile["fps"].values.to_numpy(zero_copy_only=False).view(np.uint64))
            for tile in row
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for same, one, two in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                left, right = unpacked(one), unpacked(two)
                for (name, fps), (name2, fps2) in itertools.product(left, right):
                    if abs(name[0] - name2[0]) + abs(name[1] - name2[1]) > radius or same and name > name2:
                        continue
                    u, v = forest(fps, fps2, radius)
                    if len(u):
                        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return compared.select(F.expr("block = block2").alias("same"), "left", "right").mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, text: str = "text", width: int = WORDS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id reachable over links) for each row.

    Two rows are linked when their fingerprints differ in `radius` bits or fewer. Null and
    empty texts have fingerprint 0 and are linked like any other. Rows that repeat keep a
    row each; a null id never is a component's id unless all its ids are null. An empty
    table gives an empty result. Other columns are not read.
    """
    found = materialize(fingerprints(docs, text, width), "fingerprints")
    rows = found.count()
    nodes = written(found.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "nodes", rows)
    roots = component_roots(links(nodes, radius))
    # A root is its own member; then each root's smallest document.
    known = roots.unionByName(roots.selectExpr("root AS node", "root").distinct())
    members = written(known.join(nodes, known["node"] == nodes["fp"]).drop("node"), "members", rows)
    smallest = members.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("members"))
    linked = hot_lookup(members, smallest, "root", "members").select("fp", "n", "component_id")
    alone = nodes.join(members.select("fp"), "fp", "left_anti").selectExpr("fp", "n", "first AS component_id")
    classes = written(linked.unionByName(alone), "classes", rows)
    return hot_lookup(found, classes, "fp", "n").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
