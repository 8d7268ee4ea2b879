"""The registered queries of this folder: name -> callable, name -> SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalodge.llm import language, minhash, pii, quality, toxicity
from catalodge.llm.alignment import align
from catalodge.llm.common import fold
from catalodge.llm.decontaminate import find_leaks
from catalodge.llm.exact_dedup import DigestIndex, exact_dedup
from catalodge.llm.packing import pack
from catalodge.llm.prefix_trie import prefix_trie, rebuilt
from catalodge.llm.simhash import near_duplicates
from catalodge.llm.token_counts import token_counts
from catalodge.llm.warc import archive_round_trip
from catalodge.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark, name)}/{uuid.uuid4().hex}"


def decided(scored: DataFrame, folds: int, held: int, at: float) -> DataFrame:
    return scored.select(
        "doc_id",
        (fold("doc_id", folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= at).cast("int").alias("predicted"),
    )


@query(
    "op1_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    index = DigestIndex(spark, new_folder(spark, "digest-index"))
    found = exact_dedup(table(spark, sf, "documents"), index)
    index.close()
    return found


@query("op2_language")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = language.languages(docs, language.train(docs, folds=4, held=2))
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query("op3_personal_data")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return pii.personal_data(docs, pii.train(docs))


@query("op4_packing")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return pack(table(spark, sf, "documents"), TOKENIZER).drop("ids")


@query(
    "op5_warc",
    # Base 32 by hand: hex digits to bits, five bits to a sign.
    """
    WITH hashed AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex,
               min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
        FROM pages),
    bits AS (
        SELECT *, array_to_string(list_transform(range(1, 41), lambda i: substring(
            '0000000100100011010001010110011110001001101010111100110111101111',
            4 * instr('0123456789abcdef', substring(hex, i, 1)) - 3, 4)), '') AS b
        FROM hashed)
    SELECT page_id, payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda i: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + list_sum(list_transform(range(1, 6), lambda k: CAST(substring(b, 5 * i + k, 1) AS INT) << (5 - k)))::INT, 1)), '')
               AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM bits
    """,
)
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return archive_round_trip(table(spark, sf, "pages"), new_folder(spark, "archives"), min_bytes=0)


@query("op6_quality_ranking")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    scored = quality.score_documents(docs, quality.train(docs, table(spark, sf, "labels"), at=0.3))
    return decided(scored, 5, 0, 0.3)


@query("op7_simhash")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"))


@query("op8_decontamination")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op9_toxicity")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return decided(toxicity.toxicity(docs, toxicity.train(docs, table(spark, sf, "labels"))), 5, 0, 0.5)


@query("op10_token_counts")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts(table(spark, sf, "documents"), TOKENIZER)


@query("op11_alignment")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    byte_bpe, piece_bpe = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align(table(spark, sf, "documents"), byte_bpe, piece_bpe)


@query("op12_minhash")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    found = minhash.edited_likeness(table(spark, sf, "documents"))
    hexed = {
        "fingerprint": F.lower(F.hex("signature")),
        "edited_fingerprint": F.lower(F.hex("edited_signature")),
    }
    return found.withColumns(hexed).drop("signature", "edited_signature")


@query(
    "op13_prefix_trie",
    # crc32 by hand: eight shifts for each decimal digit.
    """
    WITH lists AS (
        SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                             ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    heads AS (
        SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT,
                          list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
                      lambda a, x: list_reduce(list_prepend(xor(a, x), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                          lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 4 AS h
        FROM lists),
    rebuilt AS (
        SELECT o.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, o.h), list_slice(o.turns, o.h + 1, len(o.turns))) AS turns
        FROM heads o LEFT JOIN lists b ON b.conv_id = o.conv_id - o.conv_id % 20),
    starts AS (
        SELECT conv_id, len(turns) AS n, d AS depth, list_slice(turns, 1, d) AS start
        FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
    nodes AS (
        SELECT start, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
        FROM starts GROUP BY start, depth),
    families AS (
        SELECT p.start, p.depth, p.conv_id, p.n_convs, p.ends_sha256, count(c.depth) AS n_children,
               (p.n_convs - 1) * len(regexp_extract_all(
                   CASE WHEN p.depth = 0 THEN '' ELSE p.start[p.depth].text END, '[^\x20\x09-\x0D]+')) AS saved
        FROM nodes p LEFT JOIN nodes c ON c.depth = p.depth + 1 AND list_slice(c.start, 1, p.depth) = p.start
        GROUP BY ALL),
    subtrees AS (
        SELECT start, depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
        FROM (SELECT list_slice(start, 1, k) AS start, k AS depth, n_children, saved
              FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM families))
        GROUP BY start, depth)
    SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children,
           CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
    FROM families f JOIN subtrees s ON s.depth = f.depth AND s.start = f.start
    LEFT JOIN nodes p ON p.depth = f.depth - 1 AND p.start = list_slice(f.start, 1, f.depth - 1)
    """,
)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie(rebuilt(table(spark, sf, "conversations")))
