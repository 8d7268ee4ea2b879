"""From raw documents to packed sequences: quality, exact copies, near copies, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the
columns of `docs`. An id names one document: rows that share an id stay or go together,
and rows that share id and text are kept once.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalodge.llm import quality
from catalodge.llm.decontaminate import without_leaks
from catalodge.llm.exact_dedup import DigestIndex, digest_of, exact_dedup
from catalodge.llm.near_copies import near_copies
from catalodge.llm.packing import pack
from catalodge.llm.queries import new_folder, table
from catalodge.session import materialize


def _only(docs: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """Rows of `docs`, all its columns, whose key is in `keys`: one row for each key, shuffled once."""
    rows = docs.select(F.struct("*").alias("row"), key.alias("key"))
    return rows.join(keys.distinct(), "key", "left_semi").dropDuplicates(["key"]).select("row.*")


def _id(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("null"))


def rank_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels"), at=0.3))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id."""
    index = DigestIndex(spark, new_folder(spark, "digest-index"))
    decided = exact_dedup(docs, index)
    index.close()
    keys = decided.where("kept").select(F.concat_ws(":", "text_sha256", _id()).alias("key"))
    return _only(docs, F.concat_ws(":", F.lower(F.hex(digest_of())), _id()), keys)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents linked by a similarity of 0.8 of their five-word shingles, the one with the smallest id.

    Documents without an id stay.
    """
    dropped = near_copies(docs).where("doc_id != class_id").select(_id().alias("key"))
    rows = docs.select(F.struct("*").alias("row"), _id().alias("key"))
    return rows.join(dropped, "key", "left_anti").select("row.*")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, neither exact nor edited."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of 4096 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json")).drop("ids")


STAGES = [
    ("quality", rank_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]

# Ranking, fingerprint classes, alignment and a tokenizer are beyond SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table; each reads what the one before it has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
