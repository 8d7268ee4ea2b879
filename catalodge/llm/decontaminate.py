"""Benchmark decontamination: rare words as seeds, exact bounds, then Smith-Waterman alignment.

Test items are read as words without case and signs. An alignment that reaches the
threshold leaves only so many words of its item unmatched; of any set of more words than
that it matches some. The item's rarest words in the corpus are that set, so a document
without them needs no alignment and no leak is lost. What is left is aligned with the item
word by word, so that edited and paraphrased copies are scored as well.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalodge.llm.common import column, in_bites, slices, text_of, utf8

# Seed words that a window must hold: more of them let commoner words in, fewer leave more windows.
HITS = 4
# Items of fewer words are never found.
SHORTEST = 3
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
# Text of the test items that is broadcast at once; more items are taken in blocks.
BLOCK_BYTES = 16 << 20
CELLS = 1 << 18
UNKNOWN, PADDING = 0, -2
SIGNS = re.compile(r"[^\w\s]|_")
ASCII_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
# First bytes of characters other than ASCII and Latin-1 letters, in UTF-8.
RARE_BYTES = bytes([0xC2, *range(0xC4, 0x100)])


def plain_words(body: bytes) -> list[bytes]:
    """The words of a text in UTF-8: lower case, without signs; what is signs only is no word."""
    text = body.decode("utf-8", "replace").lower()
    if len(body.translate(None, RARE_BYTES)) < len(body) or "×" in text or "÷" in text:
        text = " ".join(SIGNS.sub("", text).split())
    return text.encode("utf-8", "replace").translate(None, ASCII_SIGNS).split()


class Items(NamedTuple):
    """A block of test items: words as numbers from 1 on."""

    ids: list
    words: list  # of arrays
    vocabulary: dict


def index_items(rows: list[tuple[int, str]]) -> Items:
    vocabulary: dict[bytes, int] = {}
    ids, words = [], []
    for item_id, text in sorted(rows):
        ids.append(item_id)
        plain = plain_words(text.encode("utf-8", "replace"))
        words.append(np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in plain], np.int64))
    return Items(ids, words, vocabulary)


class Seeds(NamedTuple):
    """For each word the items of which it is a seed, and for each item what a leak of it must hold."""

    first: np.ndarray  # for each word: its first place in `item`
    item: np.ndarray
    hits: np.ndarray  # for each item: words of a leak that are seeds, at least
    least: np.ndarray  # words of a leak that match, at least
    span: np.ndarray  # words of a document that a leak covers, at most
    members: np.ndarray  # item * (words + 1) + word of all words of all items, sorted


def seeds_of(items: Items, counts: np.ndarray, threshold: float) -> Seeds:
    """The rarest words of each item.

    Matches score 2 and all else -1, so an item of n words reaches the threshold with
    threshold * n matches at least, over (3 - 2 * threshold) * n words of a document at
    most. Of the n - least + hits rarest words it matches `hits` or more.
    """
    size = len(items.vocabulary) + 1
    lengths = np.array([len(w) for w in items.words], np.int64)
    least = np.array([max(1, math.ceil(threshold * n - 1e-9)) for n in lengths.tolist()], np.int64)
    hits = np.minimum(HITS, least)
    pairs = [np.zeros(0, np.int64)]
    for i, words in enumerate(items.words):
        if len(words) < SHORTEST:
            continue
        rarest = words[np.argsort(counts[words], kind="stable")[: lengths[i] - least[i] + hits[i]]]
        pairs.append(np.unique(rarest) * len(items.words) + i)
    pairs = np.sort(np.concatenate(pairs))
    first = np.searchsorted(pairs, np.arange(size + 1) * len(items.words))
    members = np.unique(np.concatenate([np.zeros(0, np.int64), *(w + i * size for i, w in enumerate(items.words))]))
    span = np.floor((3 - 2 * threshold) * lengths + 1e-9).astype(np.int64)
    return Seeds(first, pairs % max(1, len(items.words)), hits, least, span, members)


def align(items: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each row: (score, last word of the item, last word of the window)."""
    rows, width = windows.shape
    slope = -GAP * np.arange(width)
    above = np.zeros((rows, width), np.int32)
    best, item_end, end = np.zeros(rows, np.int32), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    for i in range(items.shape[1]):
        step = np.where(windows == items[:, i : i + 1], MATCH, MISMATCH).astype(np.int32)
        step[:, 1:] += above[:, :-1]
        now = np.maximum(np.maximum(step, above + GAP), 0)
        # A gap in the item: the best cell to the left, less a step of GAP for each word between.
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        top = now.max(axis=1)
        better = top > best
        best[better], item_end[better] = top[better], i
        end[better] = now[better].argmax(axis=1)
        above = now.astype(np.int32)
    return best, item_end, end


def padded(rows: list[np.ndarray], fill: int) -> np.ndarray:
    out = np.full((len(rows), max(map(len, rows))), fill, np.int64)
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return out


class Matcher:
    """Finds aligned test items in texts; lives in one Python worker."""

    def __init__(self, items: Items, seeds: Seeds, threshold: float):
        self.items, self.seeds, self.threshold = items, seeds, threshold

    def windows(self, codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, start, end) of parts of the texts, end to end in `codes`, in one of which any leak of the item lies whole."""
        seeds = self.seeds
        dealt = np.diff(seeds.first)[codes]
        places = np.flatnonzero(dealt)
        dealt = dealt[places]
        nth = np.arange(dealt.sum()) - np.repeat(np.cumsum(dealt) - dealt, dealt)
        item = seeds.item[np.repeat(seeds.first[codes[places]], dealt) + nth]
        order = np.argsort(item, kind="stable")
        item, place = item[order], np.repeat(places, dealt)[order]
        text = np.searchsorted(bounds, place, "right") - 1
        # Enough seeds within the length of a leak: such groups, and all that a leak around one may cover.
        last = np.arange(len(item)) + seeds.hits[item] - 1
        inside = np.flatnonzero(last < len(item))
        last = last[inside]
        span = seeds.span[item[inside]]
        near = (item[last] == item[inside]) & (text[last] == text[inside]) & (place[last] - place[inside] < span)
        inside, last, span = inside[near], last[near], span[near]
        item, text = item[inside], text[inside]
        start = np.maximum(bounds[text], place[last] - span + 1)
        end = np.minimum(bounds[text + 1], place[inside] + span)
        # Parts of an item that meet are one, cut into windows of two spans, one span apart.
        opens = np.ones(len(item), bool)
        opens[1:] = (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (start[1:] > end[:-1])
        closes = np.append(opens[1:], True)[: len(opens)]
        item, start, end, span = item[opens], start[opens], end[closes], span[opens]
        steps = np.maximum(1, -(-(end - start) // span) - 1)
        nth = np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps)
        item, span = np.repeat(item, steps), np.repeat(span, steps)
        start = np.repeat(start, steps) + nth * span
        return item, start, np.minimum(start + 2 * span, np.repeat(end, steps))

    def hopeful(self, item: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Whether an alignment in each row can reach the threshold: a word that is none of the item's costs 1, others bring 2 at most."""
        members = self.seeds.members
        key = item[:, None] * (len(self.items.vocabulary) + 1) + cut
        held = (cut > 0) & (members[np.minimum(np.searchsorted(members, key), len(members) - 1)] == key)
        total = np.cumsum(np.where(held, MATCH, MISMATCH), axis=1)
        before = np.minimum.accumulate(np.minimum(total - np.where(held, MATCH, MISMATCH), MATCH * cut.shape[1]), axis=1)
        lengths = np.array([len(self.items.words[i]) for i in item])
        return (total - before).max(axis=1) >= self.threshold * MATCH * lengths - 1e-9

    def matches(self, bodies: list[bytes]) -> list[tuple[int, int, float, int, int]]:
        """(text, item, share of the best score, first word, last word): the best alignment of each pair above the threshold."""
        texts = list(coded(self.items, bodies))
        bounds = np.cumsum([0, *map(len, texts)])
        codes = np.concatenate([*texts, np.zeros(0, np.int64)])
        items, starts, ends = self.windows(codes, bounds)
        order = np.lexsort((starts, items, ends - starts))
        items, starts, ends = items[order], starts[order], ends[order]
        widths = ends - starts
        work, at = [], 0
        while at < len(items):
            stop = min(np.searchsorted(widths, 1.25 * widths[at] + 4, "right"), at + max(1, CELLS // int(widths[at])))
            some = slice(at, stop)
            column = np.arange(widths[stop - 1])[None]
            cut = np.where(column < widths[some, None], codes[np.minimum(starts[some, None] + column, len(codes) - 1)], UNKNOWN)
            for k in (at + np.flatnonzero(self.hopeful(items[some], cut))).tolist():
                item, a = int(items[k]), int(starts[k])
                text = int(np.searchsorted(bounds, a, "right")) - 1
                work.append((len(self.items.words[item]), text, item, a - int(bounds[text]), int(ends[k] - bounds[text])))
            at = stop
        return self.aligned(texts, sorted(work))

    def aligned(self, texts: list[np.ndarray], work: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, float, int, int]]:
        best: dict[tuple[int, int], tuple] = {}
        at = 0
        while at < len(work):
            longest, stop = work[at][0], at + 1
            while stop < len(work) and work[stop][0] <= 1.25 * longest + 4 and (stop - at) * 4 * longest < CELLS:
                stop += 1
            some = work[at:stop]
            cut = [texts[t][a:b] for _, t, _, a, b in some]
            words = [self.items.words[item] for _, _, item, _, _ in some]
            score, item_end, end = align(padded(words, PADDING), padded(cut, UNKNOWN))
            for k in np.flatnonzero(score >= self.threshold * MATCH * np.array([w[0] for w in some])):
                length, t, item, a, _ = some[k]
                share = float(score[k]) / (MATCH * length)
                if share > best.get((t, item), (0.0,))[0]:
                    # The same alignment backwards from its last word gives its first word.
                    back = words[k][: item_end[k] + 1][::-1], cut[k][: end[k] + 1][::-1]
                    _, _, far = align(back[0][None], back[1][None])
                    best[t, item] = (share, a + int(end[k]) - int(far[0]), a + int(end[k]))
            at = stop
        return [(t, item, *found) for (t, item), found in sorted(best.items())]


def coded(items: Items, bodies: list[bytes]) -> Iterator[np.ndarray]:
    """Each text as numbers of its words, UNKNOWN where no item has the word."""
    number = items.vocabulary.get
    for body in bodies:
        words = plain_words(body)
        yield np.fromiter(map(number, words, repeat(UNKNOWN)), np.int64, len(words))


def word_counts(docs: DataFrame, items: Items, text: str) -> np.ndarray:
    """How often each word of the items occurs in the whole corpus."""
    size = len(items.vocabulary) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in slices(batches):
            bodies = column(batch, "body")
            for a, b in in_bites(bodies):
                for codes in coded(items, bodies[a:b]):
                    counts += np.bincount(codes, minlength=size)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["word", "n"])

    total = np.zeros(size, np.int64)
    # One row for each word of the block at most.
    for row in docs.select(utf8(text).alias("body")).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        total[row["word"]] = row["n"]
    return total


def item_blocks(benchmark: DataFrame, text: str = "text") -> Iterator[Items]:
    """The test items in blocks of about BLOCK_BYTES of text. Null and empty texts are no items."""
    rows = benchmark.select("item_id", text_of(text).alias("text")).where("item_id IS NOT NULL AND text != ''")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield index_items([(r["item_id"], r["text"]) for r in part.toLocalIterator()])


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """One row for each document and test item it holds: doc_id, item_id, score, first_word, last_word.

    The score is the share of the item's greatest possible alignment score, for the best
    alignment; words are counted without those that are signs only. Null and empty texts
    hold nothing; an item listed twice is found twice; rows of `docs` that repeat are
    searched each. Without items or documents the result is empty. Items of fewer than
    SHORTEST words are not searched for, and so are items in scripts without blanks, whose
    text is one word.
    """
    found = None
    for items in item_blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast((tuple(items), tuple(seeds_of(items, word_counts(docs, items, text), threshold))))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            items = Items(*held.value[0])
            matcher = Matcher(items, Seeds(*held.value[1]), threshold)
            for batch in slices(batches):
                ids, bodies = column(batch, "doc_id"), column(batch, "body")
                for a, b in in_bites(bodies):
                    rows = [(ids[a + t], items.ids[i], *rest) for t, i, *rest in matcher.matches(bodies[a:b])]
                    if rows:
                        kinds = pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()
                        arrays = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "item_id", "score", "first_word", "last_word"])

        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("body")).mapInArrow(
            run, "doc_id long, item_id long, score double, first_word long, last_word long"
        )
        found = rows if found is None else found.unionByName(rows)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that hold no test item, as `find_leaks` finds them.

    Null and empty texts hold nothing and stay; rows that repeat stay or go together;
    without items all rows stay; an empty table stays empty.
    """
    for items in item_blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast((tuple(items), tuple(seeds_of(items, word_counts(docs, items, text), threshold))))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(Items(*held.value[0]), Seeds(*held.value[1]), threshold)
            for batch in slices(batches):
                bodies = [(body or "").encode("utf-8", "replace") for body in column(batch, text)]
                clean = np.ones(len(bodies), bool)
                for a, b in in_bites(bodies):
                    clean[[a + m[0] for m in matcher.matches(bodies[a:b])]] = False
                if len(clean):
                    yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
