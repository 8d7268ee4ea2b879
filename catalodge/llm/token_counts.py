"""Token counts by a map-side lookup in two tiers.

The first tier is a compact table of frequent pre-tokens and their token counts, fitted
on a bounded sample of documents and broadcast. The second tier is each worker's cache
of the other pre-tokens, filled by the tokenizer library. No pre-token is shuffled.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalodge.llm.common import column, in_bites, slices, utf8
from catalodge.llm.pretokens import PreTokenCache

# Bounds of the sample and the table: a larger table is faster, and no bound changes a count.
SAMPLE_DOCS = 3000
SAMPLE_BYTES = 20_000
FREQUENT = 1 << 16


def frequent_lengths(docs: DataFrame, tokenizer: str, text: str = "text") -> tuple[bytes, bytes]:
    """(pre-tokens joined by blanks, their token counts as little-endian 16-bit numbers): at most FREQUENT of them.

    Fitted on about SAMPLE_DOCS documents of at most SAMPLE_BYTES bytes each.
    """
    body = docs.select(utf8(text).alias("body"))
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    sample = body.where(F.octet_length("body") <= SAMPLE_BYTES).sample(share, seed=7)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches):
            for body in column(batch, "body"):
                counts.update(body.split())
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["chunk", "n"]
            )

    total: Counter = Counter()
    for chunk, n in sample.mapInArrow(counted, "chunk binary, n long").toLocalIterator():
        total[bytes(chunk)] += n
    cache = PreTokenCache(tokenizer, len, operator.add)
    kept = [chunk for chunk, _ in total.most_common(FREQUENT)]
    cache.load(kept)
    kept = [chunk for chunk in kept if cache.table[chunk] < 1 << 16]
    return b" ".join(kept), np.array([cache.table[c] for c in kept], "<u2").tobytes()


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row: the library's count for the whole text.

    Special strings inside a text count as the library counts them by default. Null and
    empty texts have no token. Rows that repeat are counted each, an empty table gives an
    empty result, other columns are not read.
    """
    tier = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, tokenizer, text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, lengths = tier.value
        first = dict(zip(chunks.split(), np.frombuffer(lengths, "<u2").tolist(), strict=True))
        cache = PreTokenCache(tokenizer, len, operator.add, first)
        for batch in slices(batches):
            bodies, totals = column(batch, "body"), []
            for start, end in in_bites(bodies):
                split = cache.split(bodies[start:end])
                totals += [sum(map(cache.table.__getitem__, chunks)) for chunks in split]
            sizes = [len(body) for body in bodies]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")),
                    pa.array(sizes, pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array([n > limit for n in totals], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("body"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
