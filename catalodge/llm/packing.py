"""Cost-balanced packing of documents into sequences.

The attention cost of a piece of n tokens is estimated as LINEAR * n + QUADRATIC * n * n.
Pieces are dealt in descending length, each to the sequence of lowest cost that has room
for it. Packing runs in blocks of documents inside the task that tokenizes them, so
neither text nor ids are shuffled, and a block bounds memory.
"""

from __future__ import annotations

import operator
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalodge.llm.common import column, in_bites, slices, utf8
from catalodge.llm.pretokens import PreTokenCache

# Multiply-adds of the dense layers and of attention for each token, as a ratio.
LINEAR, QUADRATIC = 1.0, 1.0 / 4096
BLOCK_TOKENS = 1 << 21

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def capacities(total: int, limit: int) -> np.ndarray:
    """Room of the sequences of a block: full ones, then powers of two for what is left, so that nothing is padded."""
    left = total % limit
    tail = [1 << b for b in reversed(range(limit.bit_length())) if left >> b & 1]
    return np.array([limit] * (total // limit) + tail, np.int64)


def assign(lengths: list[int], limit: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece, for documents of these token counts.

    Documents longer than `limit` are cut into full sequences first. A piece that no
    sequence has room for is cut where the roomiest one is full; ties go to the first.
    """
    room = capacities(sum(lengths), limit)
    size, cost = room.copy(), np.zeros(len(room))
    pieces = [(limit, d, s) for d, n in enumerate(lengths) for s in range(0, n - limit + 1, limit)]
    pieces += [(n % limit, d, n - n % limit) for d, n in enumerate(lengths) if n % limit]
    pieces.sort(key=lambda p: (-p[0], p[1], p[2]))
    placed = []
    for length, d, start in pieces:
        while length:
            fits = room >= length
            k = int(np.argmin(np.where(fits, cost, np.inf))) if fits.any() else int(np.argmax(room))
            take = min(length, int(room[k]))
            placed.append((d, start, take, k, int(size[k] - room[k])))
            room[k] -= take
            cost[k] += LINEAR * take + QUADRATIC * take * take
            start, length = start + take, length - take
    return placed


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, limit: int = 4096, text: str = "text") -> DataFrame:
    """Pieces with their place and token ids (little-endian 32-bit numbers): columns of SCHEMA.

    Each document is its tokens and `end_id`; each id lies in exactly one piece. `limit`
    is a power of two. Null and empty texts are one token, `end_id`. Rows with a repeated
    id are packed as documents of their own. Sequence ids are unique in one result: the
    number of the task, then a number within it. An empty table gives no piece.
    """
    if limit & (limit - 1):
        raise ValueError("the limit must be a power of two")
    end = end_id.to_bytes(4, "little")

    def emit(ids: list, tokens: list[bytes], first: int) -> tuple[pa.RecordBatch, int]:
        lengths = [len(t) // 4 for t in tokens]
        placed = assign(lengths, limit)
        cut = [tokens[d][4 * s : 4 * (s + n)] for d, s, n, _, _ in placed]
        arrays = [
            pa.array([ids[p[0]] for p in placed], pa.int64()),
            pa.array([p[1] for p in placed], pa.int64()),
            pa.array([p[2] for p in placed], pa.int64()),
            pa.array(map(zlib.crc32, cut), pa.int64()),
            pa.array([lengths[p[0]] for p in placed], pa.int64()),
            pa.array([first + p[3] for p in placed], pa.int64()),
            pa.array([p[4] for p in placed], pa.int64()),
            pa.array(cut, pa.binary()),
        ]
        used = 1 + max(p[3] for p in placed)
        return pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in SCHEMA.split(", ")]), first + used

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def words(ids: list[int]) -> bytes:
            return struct.pack(f"<{len(ids)}I", *ids)

        cache = PreTokenCache(tokenizer, words, operator.add)
        number = TaskContext.get().partitionId() << 32
        ids, tokens, held = [], [], 0
        for batch in slices(batches):
            doc_ids, bodies = column(batch, "doc_id"), column(batch, "body")
            for start, stop in in_bites(bodies):
                split = cache.split(bodies[start:stop])
                for doc_id, chunks in zip(doc_ids[start:stop], split, strict=True):
                    ids.append(doc_id)
                    tokens.append(b"".join(map(cache.table.__getitem__, chunks)) + end)
                    held += len(tokens[-1]) // 4
                if held >= BLOCK_TOKENS:
                    out, number = emit(ids, tokens, number)
                    ids, tokens, held = [], [], 0
                    yield out
        if ids:
            yield emit(ids, tokens, number)[0]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("body"))
    return rows.mapInArrow(run, SCHEMA)
