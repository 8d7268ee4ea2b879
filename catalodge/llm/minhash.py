"""MinHash fingerprints of whole texts, their likeness, and near copies by banded signatures.

A text is the set of its shingles of five words. Each of 128 universal hash functions
x -> (a x + b) mod 2^64, a odd, is a permutation of the shingle hashes; the smallest value
under each, sixteen bits of it, is one place of the signature. The share of equal places
of two signatures estimates the Jaccard similarity of their shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalodge.llm.common import ChunkCodes, column, hash_share, slices, utf8
from catalodge.llm.near_copies import verified_classes, with_ids
from catalodge.operators.graph import component_roots, hot_lookup
from catalodge.session import materialize

WORDS = 5
PLACES = 128
# Shingles hashed in one step: the matrix of a step stays in the processor's cache.
AT_ONCE = 1024
# Places in a band: 21 bands and two places left over.
ROWS = 6
# Ids sampled for each range of ids: they set the sizes of ranges and no result.
SAMPLED = 64

_draw = np.random.default_rng(20_240_501)
FACTORS = _draw.integers(0, 1 << 64, PLACES, np.uint64) | np.uint64(1)
TERMS = _draw.integers(0, 1 << 64, PLACES, np.uint64)
PLACE_IN_SHINGLE = _draw.integers(0, 1 << 64, WORDS, np.uint64) | np.uint64(1)
LAST_MIX = np.uint64(0x9E3779B97F4A7C15)
NO_SHINGLE = np.full(PLACES, np.iinfo(np.uint64).max, np.uint64)


def word_codes() -> ChunkCodes:
    """64-bit hashes of words, kept in the worker."""
    return ChunkCodes(lambda word: xxhash.xxh64_intdigest(word) - (1 << 63))


def shingle_hashes(codes: np.ndarray) -> np.ndarray:
    """One hash for each run of WORDS word codes, in order; the whole sequence where there are fewer words."""
    codes = codes.view(np.uint64)
    width = min(WORDS, len(codes))
    if width == 0:
        return codes
    hashes = np.full(len(codes) - width + 1, width, np.uint64)
    for place in range(width):
        hashes += codes[place : place + len(hashes)] * PLACE_IN_SHINGLE[place]
    hashes ^= hashes >> np.uint64(31)
    return hashes * LAST_MIX


def minima(hashes: np.ndarray) -> np.ndarray:
    """The smallest value of the hashes under each permutation."""
    least = NO_SHINGLE.copy()
    for start in range(0, len(hashes), AT_ONCE):
        values = hashes[start : start + AT_ONCE, None] * FACTORS
        values += TERMS
        np.minimum(least, values.min(axis=0), out=least)
    return least


def signature_of(least: np.ndarray) -> np.ndarray:
    """Sixteen bits of each minimum; equal minima give equal bits, others in one of 65,536 cases."""
    return ((least * LAST_MIX) >> np.uint64(48)).astype("<u2")


def signature(codes: np.ndarray) -> np.ndarray:
    return signature_of(minima(shingle_hashes(codes)))


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """Share of equal places of two signatures: 0 to 1."""
    return float((one == two).mean())


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, signature (256 bytes: 128 little-endian 16-bit places) for each row.

    Words are what lies between blanks (space and 0x09 to 0x0D), as they are. Null and
    empty texts have no shingle and share one signature. Rows that repeat keep a row each,
    null ids stay, an empty table gives an empty result and other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_codes()
        for batch in slices(batches):
            found = [signature(codes).tobytes() for codes in words.codes(column(batch, "body"))]
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.binary())], ["doc_id", "signature"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("body"))
    return rows.mapInArrow(run, "doc_id long, signature binary")


def band_groups(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, grp: documents that bands of their signatures connect; those that share no band with another are left out.

    A signature's places are cut into bands of ROWS. Documents with an equal band are joined
    with the smallest id that has it, so a group of any size gives one link for each member
    and band, and a band that holds a large share of all documents is no task of its own.
    """
    found = materialize(fingerprints(docs, text).distinct(), "signatures")
    # Equal signatures are one node: the smallest of their ids.
    nodes = materialize(found.groupBy("signature").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "signature-nodes")
    bands = [F.struct(F.lit(i).alias("band"), F.xxhash64(F.substring("signature", 2 * ROWS * i + 1, 2 * ROWS)).alias("value")) for i in range(PLACES // ROWS)]
    rows = nodes.select("first", F.explode(F.array(*bands)).alias("b")).select("first", F.xxhash64("b.band", "b.value").alias("key"))
    rows = materialize(rows, "bands")
    shared = rows.groupBy("key").agg(F.min("first").alias("least"), F.count("*").alias("members")).where("members > 1")
    links = hot_lookup(rows, materialize(shared, "shared-bands"), "key", "members").select(F.col("first").alias("u"), F.col("least").alias("v"))
    copies = hot_lookup(found, nodes.where("n > 1"), "signature", "n").select(F.col("doc_id").alias("u"), F.col("first").alias("v"))
    roots = component_roots(links.unionByName(copies))
    return roots.select(F.col("node").alias("doc_id"), F.col("root").alias("grp")).unionByName(
        roots.select(F.col("root").alias("doc_id"), F.col("root").alias("grp")).distinct()
    )


def near_copies(docs: DataFrame, similarity: float = 0.8, text: str = "text") -> DataFrame:
    """doc_id, class_id for each document with an id: the smallest id that similar pairs lead to.

    Candidates share a band of their signatures: of pairs with a similarity of 0.8 about 998
    in 1,000 do. Inside the groups that bands connect, all pairs are held to the exact
    Jaccard similarity of their five-word shingles (A-Z in lower case), in blocks. Rows
    without an id are left out; null texts count as empty; rows that share an id are one
    document; an empty table gives an empty result; other columns are not read.
    """
    known = with_ids(docs, text)
    return verified_classes(known, materialize(band_groups(known), "band-groups"), WORDS, 64, similarity)


def _ranged(rows: DataFrame, ids: DataFrame, parts: int) -> DataFrame:
    """`rows` with the number `range` of the range of ids that doc_id lies in.

    Bounds are quantiles of a sample of about SAMPLED ids for each range, as in a sort.
    Null ids come last, in 256 ranges of the hash `tie` that orders them.
    """
    share = SAMPLED * parts / max(1, ids.count())
    sample = ids.where(hash_share("doc_id", share) & F.col("doc_id").isNotNull())
    found = np.sort(np.array([float(row[0]) for row in sample.toLocalIterator()]))
    bounds = np.unique(found[np.linspace(0, len(found) - 1, parts + 1).astype(int)[1:]]) if len(found) else [0.0]
    splits = [float("-inf"), *map(float, bounds), float("inf")]
    into = Bucketizer(splits=splits, inputCol="id_number", outputCol="range", handleInvalid="keep")
    dealt = into.transform(rows.withColumn("id_number", F.col("doc_id").cast("double"))).drop("id_number")
    without = F.shiftright("tie", 56) + 128 + len(splits)
    return dealt.withColumn("range", F.when(F.col("doc_id").isNull(), without).otherwise(F.col("range")).cast("int"))


def neighbours(docs: DataFrame, text: str = "text") -> DataFrame:
    """Texts dealt by ranges of ids, in order within a partition, with the first text of the next range behind.

    Columns: range, extra (true for that first text), doc_id, body. Each text moves once;
    besides, one text for each range is repeated. Equal ids are ordered by a hash of the text.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("body"))
    dealt = _ranged(rows.withColumn("tie", F.xxhash64("body")), rows.select("doc_id"), parts)
    dealt = dealt.withColumn(
        "place", F.struct(F.col("doc_id").isNull().alias("last"), F.coalesce("doc_id", F.lit(0)).alias("id"), "tie")
    )
    # One row for each range: no more than partitions, and 256 for null ids.
    heads = sorted((row["range"], row["head"]) for row in dealt.groupBy("range").agg(F.min("place").alias("head")).collect())
    ahead = [(before[0], tuple(after[1])) for before, after in zip(heads, heads[1:] + heads[:1], strict=True)]
    wanted = spark.createDataFrame(ahead, "before int, place struct<last boolean, id long, tie long>")
    first = dealt.join(F.broadcast(wanted), "place").dropDuplicates(["before"])
    first = first.selectExpr("before AS range", "true AS extra", "place", "doc_id", "body")
    both = dealt.selectExpr("range", "false AS extra", "place", "doc_id", "body").unionByName(first)
    return both.repartitionById(parts, "range").sortWithinPartitions("range", "extra", "place").drop("place")


def edited(body: bytes, following: bytes) -> tuple[bytes, int]:
    """The text with its last quarter of code points replaced by the first ones of the following text; code points before."""
    whole = body.decode()
    cut = len(whole) // 4
    start = following[: 4 * cut].decode(errors="ignore")[:cut]
    return (whole[: len(whole) - cut] + start).encode(), len(whole)


def edited_likeness(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, signature, edited_signature, near_edited, near_next for each row.

    A text's edit has its last quarter of code points (rounded down) replaced by as many
    first ones of the next document's text, or all of it if that is shorter; the next
    document has the next larger id, and after the last one comes the first. `near_edited`
    and `near_next` are the likeness of a text's signature to those of its edit and of the
    next text. Null texts count as empty. Equal ids follow each other by a hash of their
    texts, null ids come last. A table of one row has that row as its next. An empty table
    gives an empty result; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, before = word_codes(), None
        for batch in slices(batches):
            bodies = column(batch, "body")
            found, edits = [], []
            rows = zip(*(column(batch, name) for name in ("range", "extra", "doc_id")), bodies, strict=True)
            for (part, extra, doc_id, body), codes in zip(rows, words.codes(bodies), strict=True):
                own = signature(codes)
                if before is not None and before[0] == part:
                    edit, n_chars = edited(before[2], body)
                    edits.append(edit)
                    found.append((before[1], n_chars, before[3], likeness(before[3], own)))
                before = None if extra else (part, doc_id, body, own)
            if found:
                ids, sizes, signatures, near_next = zip(*found, strict=True)
                theirs = [signature(codes) for codes in words.codes(edits)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([hashlib.sha256(edit).hexdigest() for edit in edits], pa.string()),
                        pa.array([one.tobytes() for one in signatures], pa.binary()),
                        pa.array([two.tobytes() for two in theirs], pa.binary()),
                        pa.array(map(likeness, signatures, theirs), pa.float64()),
                        pa.array(near_next, pa.float64()),
                    ],
                    names,
                )

    names = ["doc_id", "n_chars", "edited_sha256", "signature", "edited_signature", "near_edited", "near_next"]
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, signature binary, edited_signature binary, "
        "near_edited double, near_next double"
    )
    return neighbours(docs, text).mapInArrow(run, schema)
