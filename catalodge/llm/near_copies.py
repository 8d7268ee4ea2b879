"""Near copies by SimHash candidates and exact Jaccard similarity.

Fingerprints within a wide radius put documents into candidate groups; inside a group two
documents are linked when the Jaccard similarity of their shingle sets reaches a
threshold. Groups are compared in blocks of bounded size, each returns a spanning forest,
and pairs that are connected already are not compared again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalodge.llm.common import column, slices, utf8
from catalodge.llm.simhash import fingerprint_of, near_duplicates, shingle_hashes
from catalodge.operators.graph import component_roots, hot_lookup
from catalodge.session import materialize, written

WORDS = 5
SIMILARITY = 0.8
# Two texts of this similarity differ in about eight bits; nearly all differ in no more than twelve.
RADIUS = 12
# Documents and shingles in a block.
BLOCK_DOCS, BLOCK_SHINGLES = 1024, 1 << 21
# Documents in a tile of the comparison of fingerprints and sizes alone.
TILE_DOCS = 1 << 15
# A level of blocks is followed by one more if it leaves this share of its documents at most.
SHRINK = 0.75
# With fewer candidates than this, pairs are compared one by one.
FEW = 16

MEMBER = "grp long, doc_id long, fp long, size long, shingles binary"
LINK = "u long, v long"
MEETING = [*((name, pa.int64()) for name in ("grp", "doc_id", "outer", "other")), ("outside", pa.bool_())]


def jaccard(one: np.ndarray, two: np.ndarray) -> float:
    """Similarity of two sorted sets of hashes; two empty sets are equal."""
    if not len(one) and not len(two):
        return 1.0
    both = len(np.intersect1d(one, two, assume_unique=True))
    return both / (len(one) + len(two) - both)


class Block:
    """Documents of a candidate group, by ascending id, and what is known of their classes."""

    def __init__(self, table: pa.Table):
        order = np.argsort(table["doc_id"].to_numpy(), kind="stable")
        self.ids = table["doc_id"].to_numpy()[order]
        self.fps = table["fp"].to_numpy()[order].view(np.uint64)
        bodies = table["shingles"].to_pylist()
        self.sets = [np.frombuffer(bodies[i], np.uint64) for i in order]
        self.sizes = np.array([len(s) for s in self.sets])
        self.postings: tuple[np.ndarray, np.ndarray] | None = None


    def overlaps(self, one: np.ndarray) -> np.ndarray:
        """How many hashes of a set each document has, by one look at the sorted hashes of all of them."""
        if self.postings is None:
            values, owners = np.concatenate(self.sets), np.repeat(np.arange(len(self.sets)), self.sizes)
            order = np.argsort(values, kind="stable")
            self.postings = values[order], owners[order]
        values, owners = self.postings
        low, high = np.searchsorted(values, one, "left"), np.searchsorted(values, one, "right")
        sizes = high - low
        before = np.cumsum(sizes) - sizes
        found = owners[np.arange(int(sizes.sum())) + np.repeat(low - before, sizes)]
        return np.bincount(found, minlength=len(self.sets))

    def similar(self, one: np.ndarray, may: np.ndarray, similarity: float) -> np.ndarray:
        """Places among `may` of documents whose similarity with a set reaches the threshold."""
        places = np.flatnonzero(may)
        if len(places) < FEW:
            return np.array([j for j in places if jaccard(one, self.sets[j]) >= similarity], int)
        both = self.overlaps(one)[places]
        union = len(one) + self.sizes[places] - both
        return places[(both >= similarity * union) | (union == 0)]


def candidates(block: Block, i: int, other: Block, radius: int, similarity: float) -> np.ndarray:
    """Places in `other` that may be similar to document i: by fingerprint and by size."""
    near = np.bitwise_count(block.fps[i] ^ other.fps) <= radius
    size = block.sizes[i]
    return near & (np.minimum(size, other.sizes) >= similarity * np.maximum(size, other.sizes))


def linked(block: Block, radius: int, similarity: float) -> np.ndarray:
    """For each document the place of the smallest one that similar pairs connect it with."""
    root = np.arange(len(block.ids))
    for i in range(len(root)):
        may = candidates(block, i, block, radius, similarity) & (root != root[i])
        may[: i + 1] = False
        for j in block.similar(block.sets[i], may, similarity):
            low, high = sorted((root[i], root[j]))
            root[root == high] = low
    return root


def _links(table: pa.Table, radius: int, similarity: float) -> pa.Table:
    block = Block(table)
    root = linked(block, radius, similarity)
    return pa.table({"u": pa.array(block.ids, pa.int64()), "v": pa.array(block.ids[root], pa.int64())})


def _cross_links(left: pa.Table, right: pa.Table, radius: int, similarity: float) -> pa.Table:
    """Links between documents of two blocks that are in different classes so far."""
    one, two = Block(left), Block(right)
    class_of = [dict(zip(t["doc_id"].to_pylist(), t["class_id"].to_pylist(), strict=True)) for t in (left, right)]
    mine, theirs = (np.array([c[i] for i in b.ids.tolist()]) for c, b in zip(class_of, (one, two), strict=True))
    u, v, done = [], [], set()
    for i in range(len(one.ids)):
        may = candidates(one, i, two, radius, similarity) & (theirs != mine[i])
        for j in two.similar(one.sets[i], may, similarity):
            pair = mine[i], theirs[j]
            if pair not in done:
                done.add(pair)
                u.append(one.ids[i])
                v.append(two.ids[j])
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _blocked(members: DataFrame) -> DataFrame:
    """Members with the block of their group that they are dealt into, and how many blocks it has."""
    sizes = members.groupBy("grp").agg(F.count("*").alias("n"), F.sum("size").alias("total"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_DOCS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("long")
    # Groups of several blocks have BLOCK_DOCS members or BLOCK_SHINGLES shingles: few beside the members, which stay where they are.
    several = sizes.select("grp", blocks.alias("blocks")).where("blocks > 1")
    dealt = members.join(F.broadcast(several), "grp", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    return dealt.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))


def _meeting(left: pa.Table, right: pa.Table, radius: int, similarity: float) -> pa.Table:
    """Which documents of two tiles must meet: those outside with all that may be similar and are of other classes.

    One row (doc_id, outer, other, outside) for each document and pair of blocks, however many pairs it has there.
    """
    mine, theirs = ({name: t[name].to_numpy(zero_copy_only=False) for name in t.column_names} for t in (left, right))
    theirs = {name: values[np.argsort(theirs["size"], kind="stable")] for name, values in theirs.items()}
    sizes, fps = theirs["size"], theirs["fp"].view(np.uint64)
    found = []
    for outer in np.unique(mine["block"]):
        hit = np.zeros(len(sizes), bool)
        for i in np.flatnonzero(mine["block"] == outer):
            size, doc = mine["size"][i], mine["doc_id"][i]
            # Sizes ascend, so all that fit are in one run.
            run = slice(max(0, np.searchsorted(sizes, np.floor(similarity * size)) - 1), np.searchsorted(sizes, np.ceil(size / similarity), "right") + 1)
            near = np.bitwise_count(fps[run] ^ mine["fp"][i].view(np.uint64)) <= radius
            near &= np.minimum(size, sizes[run]) >= similarity * np.maximum(size, sizes[run])
            near &= (theirs["class_id"][run] != mine["class_id"][i]) & (~theirs["outside"][run] | (theirs["doc_id"][run] > doc))
            if near.any():
                hit[run] |= near
                others = np.unique(theirs["block"][run][near])
                found.append((np.full(len(others), doc), np.full(len(others), outer), others, np.ones(len(others), bool)))
        n = int(hit.sum())
        found.append((theirs["doc_id"][hit], np.full(n, outer), theirs["block"][hit], np.zeros(n, bool)))
    names = "doc_id", "outer", "other", "outside"
    return pa.table({name: np.concatenate([f[k] for f in found]) for k, name in enumerate(names)})


def meetings(classed: DataFrame, radius: int, similarity: float) -> DataFrame:
    """(grp, doc_id, outer, other, outside): documents of large groups that must meet, by pairs of blocks.

    `classed` has grp, doc_id, fp, size, block, class_id and no shingles. Documents outside a
    group's largest class meet all others that fingerprints and sizes allow, so that no link is lost.
    """
    counts = classed.groupBy("grp", "class_id").agg(F.count("*").alias("n"))
    top = counts.groupBy("grp").agg(F.max_by("class_id", F.struct("n", "class_id")).alias("top"), F.sum("n").alias("all"))
    tiles = top.select("grp", "top", F.ceil(F.col("all") / TILE_DOCS).cast("long").alias("tiles"))
    # One row for each group of several blocks.
    dealt = classed.join(F.broadcast(tiles), "grp").withColumns(
        {"tile": F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("tiles")), "outside": F.col("class_id") != F.col("top")}
    )
    left = dealt.where("outside").withColumn("tile2", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    right = dealt.withColumnRenamed("tile", "tile2").withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    keys, wanted = ["grp", "tile", "tile2"], ["doc_id", "fp", "size", "class_id", "block", "outside"]

    def meet(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = _meeting(left.select(wanted), right.select(wanted), radius, similarity) if left.num_rows and right.num_rows else None
        if found is None:
            return pa.table({name: pa.array([], kind) for name, kind in MEETING})
        return found.add_column(0, "grp", pa.array(np.full(found.num_rows, key[0].as_py())))

    met = left.select(*keys, *wanted).groupBy(*keys).cogroup(_renewed(right.select(*keys, *wanted)).groupBy(*keys))
    return met.applyInArrow(meet, "grp long, doc_id long, outer long, other long, outside boolean").distinct()


def _renewed(rows: DataFrame) -> DataFrame:
    """The same rows with columns of their own, for a table that meets one made from the same rows."""
    return rows.select(*[F.col(name).alias(name) for name in rows.columns])


def _of_groups(members: DataFrame, wanted: DataFrame) -> DataFrame:
    """Members of the groups in `wanted`, groups of several blocks and thus few; the others are not shuffled."""
    return members.join(F.broadcast(wanted.select("grp").distinct()), "grp", "left_semi")


def with_ids(docs: DataFrame, text: str) -> DataFrame:
    """doc_id, text of the rows that have an id."""
    return docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))


def near_copies(docs: DataFrame, width: int = WORDS, radius: int = RADIUS, similarity: float = SIMILARITY, text: str = "text") -> DataFrame:
    """doc_id, class_id for each document with an id: the smallest id that links lead to, itself included.

    Two documents are linked when their fingerprints differ in `radius` bits or fewer and
    the Jaccard similarity of their shingles of `width` words, A-Z in lower case, is
    `similarity` or more; no link is lost that both hold for, in groups of any size. Null
    texts count as empty, and texts without words are equal. Rows that share an id are one
    document, linked by each of its texts. Rows without an id are left out; an empty table
    gives an empty result; other columns are not read.
    """
    known = with_ids(docs, text)
    found = near_duplicates(known, radius, "text", width).select("doc_id", F.col("component_id").alias("grp"))
    return verified_classes(known, materialize(found.distinct(), "candidate-groups"), width, radius, similarity)


def verified_classes(known: DataFrame, groups: DataFrame, width: int, radius: int, similarity: float) -> DataFrame:
    """Classes of documents (doc_id, text) linked by exact similarity inside candidate groups (doc_id, grp)."""

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in MEMBER.split(", ")]
        for batch in slices(batches, 64):
            hashes = [list(shingle_hashes(body, width)) for body in column(batch, "body")]
            sets = [np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64) for found in hashes]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(batch.schema.get_field_index(name)) for name in ("grp", "doc_id")),
                    pa.array(map(fingerprint_of, hashes), pa.int64()),
                    pa.array(map(len, sets), pa.int64()),
                    pa.array([found.tobytes() for found in sets], pa.binary()),
                ],
                names,
            )

    sizes = written(groups.groupBy("grp").agg(F.count("*").alias("n")).where("n > 1"), "group-sizes", groups.count())
    in_groups = hot_lookup(groups, sizes, "grp", "n").select("doc_id", "grp")
    rows = known.select("doc_id", utf8("text").alias("body")).join(in_groups, "doc_id").select("grp", "doc_id", "body")
    members = materialize(rows.mapInArrow(shingled, MEMBER), "members")

    def compare(table: pa.Table) -> pa.Table:
        return _links(table, radius, similarity)

    def cross(left: pa.Table, right: pa.Table) -> pa.Table:
        return _cross_links(left, right, radius, similarity)

    # Blocks first, then the smallest documents of their classes in blocks again, as long as that leaves far fewer.
    # Shingles are written once: a level is named by its ids, and what blocks do not settle is settled below.
    level, parts = members, []
    while True:
        parts.append(materialize(_blocked(level).groupBy("grp", "block").applyInArrow(compare, LINK), "block-links"))
        large = _blocked(level.select("grp", "doc_id", "size")).where("blocks > 1").select("grp", "doc_id")
        firsts = parts[-1].where("u = v").select(F.col("u").alias("doc_id")).distinct()
        most = large.count()
        again = written(large.distinct().join(firsts, "doc_id"), "level", most)
        n = again.count()
        if not n or n > SHRINK * most:
            break
        level = _of_groups(members, again).join(again, ["grp", "doc_id"], "left_semi")
    links = parts[0]
    for part in parts[1:]:
        links = links.unionByName(part)
    # Groups of several blocks: only documents that may still be linked are sent on, to the blocks where they may be.
    light = materialize(_blocked(members.drop("shingles")).where("blocks > 1"), "large-groups")
    if not light.isEmpty():
        roots = component_roots(links)
        classed = materialize(
            light.join(roots, light["doc_id"] == roots["node"], "left").withColumn("class_id", F.coalesce("root", "doc_id")).drop("node", "root"),
            "classed-members",
        )
        needed = materialize(meetings(classed, radius, similarity), "meetings")
        known_class = classed.select("grp", "doc_id", "class_id").distinct()
        bodies = _of_groups(members, needed).join(known_class, ["grp", "doc_id"]).join(needed, ["grp", "doc_id"])
        sent = bodies.where("outside").drop("outside"), _renewed(bodies.where("NOT outside").drop("outside"))
        keys = ["grp", "outer", "other"]
        links = links.unionByName(sent[0].groupBy(*keys).cogroup(sent[1].groupBy(*keys)).applyInArrow(cross, LINK))
    roots = component_roots(links)
    ids = known.select("doc_id").distinct()
    return ids.join(roots, ids["doc_id"] == roots["node"], "left").select("doc_id", F.coalesce("root", "doc_id").alias("class_id"))
