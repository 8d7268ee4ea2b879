"""What several operators of this folder share."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_of(name: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def utf8(name: str = "text") -> Column:
    """The whole text as bytes, so that Python workers need not decode and encode it."""
    return F.encode(text_of(name), "UTF-8")


def bucket_of(doc_id: int, n: int) -> int:
    """crc32 of the id as text, modulo n: the folds that the contracts name."""
    return zlib.crc32(str(doc_id).encode()) % n


def fold(name: str, n: int) -> Column:
    return F.crc32(F.col(name).cast("string").cast("binary")) % n


def hash_share(key: str, share: float) -> Column:
    """True for a share of the rows, by a hash of `key`: a sample that each task takes for itself."""
    return F.pmod(F.xxhash64(key), F.lit(1 << 32)) / (1 << 32) < min(1.0, share)


def labelled_sample(rows: DataFrame, label: str, sizes: dict, per_class: int, key: str) -> DataFrame:
    """About `per_class` rows of each label value, chosen by a hash of `key`: a bounded training sample.

    `sizes` has the number of rows of each value that is wanted. A value's share of rows is
    kept in every task, without a shuffle, so no value is gathered in one place.
    """
    kept = F.lit(False)
    for value, n in sizes.items():
        kept = kept | ((F.col(label) == value) & hash_share(key, per_class / max(1, n)))
    return rows.where(kept)


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches a few hundred at a time, so that Python holds little text at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def in_bites(values: list, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of byte strings with about `size` bytes each."""
    start = seen = 0
    for i, value in enumerate(values):
        seen += len(value)
        if seen >= size:
            yield start, i + 1
            start, seen = i + 1, 0
    if start < len(values):
        yield start, len(values)


class ChunkCodes:
    """White-space-delimited chunks of texts as numbers, each chunk coded once and kept in the worker.

    The table is emptied when it holds `capacity` chunks, which changes no result.
    """

    def __init__(self, code: Callable[[bytes], int], capacity: int = 300_000):
        self.code, self.capacity, self.table = code, capacity, {}

    def codes(self, bodies: list[bytes]) -> Iterator[np.ndarray]:
        split = [body.split() for body in bodies]
        unseen = set().union(*split).difference(self.table)
        if len(self.table) + len(unseen) > self.capacity:
            self.table = {}
            unseen = set().union(*split)
        for chunk in unseen:
            self.table[chunk] = self.code(chunk)
        for chunks in split:
            yield np.fromiter(map(self.table.__getitem__, chunks), np.int64, len(chunks))
