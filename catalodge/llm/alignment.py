"""Alignment of two tokenizers over a corpus: which tokens of one end where tokens of the other end.

Every text is encoded by a byte-level vocabulary (A) and a piece vocabulary (B). Byte
offsets at which tokens of both end cut the text into groups, and the two tokens that end
there are linked. How often a pair of ids is linked corpus-wide is counted outside memory:

1. Tasks encode texts, and for every million links or so write a *run*: the pairs of
   ids with the documents that hold them, sorted, radix-partitioned by the low bits of the
   B id, as zstd frames.
2. For each partition a k-way heap merge goes through the counts of all runs, B id first,
   so that all pairs of one B id follow each other and its highest count is known as soon
   as they have passed. Each run gets back the totals of its own pairs, in its own order.
   More runs than one merge takes are first merged in groups, and totals go back down.
3. Each run adds the totals up over its documents.

A hot pair is one entry of each run, so no task gets more of it than there are runs in a merge.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import os
import re
import sys
import uuid
from collections.abc import Iterable, Iterator
from typing import NamedTuple

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
import sentencepiece  # noqa: E402
import zstandard  # noqa: E402
from pyspark import TaskContext  # noqa: E402
from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from catalodge.llm.common import column, slices  # noqa: E402
from catalodge.llm.pretokens import BYTE_SIGNS  # noqa: E402
from catalodge.session import materialize, shared_dir  # noqa: E402

# Partitions by the low bits of a B id; links in a run; runs in one merge; pairs in one frame.
BITS = 7
RUN_LINKS = 1 << 20
FAN = 256
FRAME = 1 << 13
# Characters encoded at once, and what a worker keeps of known chunks: no result depends on these.
BITE = 1 << 20
KEPT_CHUNKS = 300_000
KEPT_LINKS = 3_000_000

# Signs that no tokenizer takes for white space. Words are keys of a worker's table: bare ones stand behind a blank,
# others begin with the line end before them, and chunks of any other shape are behind a mark.
PLAIN = r"[^\s\x00-\x1f\x7f\u180e\u200b-\u200f\ufeff]"
CUT = re.compile(f"(?<={PLAIN})(?=[ \n])")
WORD = re.compile(f"\n?{PLAIN}+")
MARK = "\0"
# Words that are encoded as lines of one text.
LINES = 256


def worker_aligner(byte_bpe: str, piece_bpe: str) -> Aligner:
    """The aligner of this Python worker, which outlives a task: vocabularies are read and frequent words encoded once."""
    kept = sys.__dict__.setdefault("_catalodge_aligners", {})
    if (byte_bpe, piece_bpe) not in kept:
        kept.clear()
        kept[byte_bpe, piece_bpe] = Aligner(byte_bpe, piece_bpe)
    return kept[byte_bpe, piece_bpe]


class Aligned(NamedTuple):
    """A whole text: (A tokens, B tokens, groups), the hash of its groups, and the pairs of its links with how often each occurs."""

    counts: tuple[int, int, int]
    digest: str
    keys: np.ndarray
    times: np.ndarray


class Aligner:
    """Texts -> their groups and links, by words and other chunks that are encoded once and kept in the worker."""

    def __init__(self, byte_bpe: str, piece_bpe: str):
        self.a, self.b = Tokenizer.from_file(byte_bpe), sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        self.a.encode_special_tokens = True
        byte_of = {sign: byte for byte, sign in enumerate(BYTE_SIGNS)}
        self.a_bytes = {}
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            known = all(sign in byte_of for sign in token)
            self.a_bytes[i] = bytes(map(byte_of.__getitem__, token)) if known else token.encode()
        ids = range(self.b.get_piece_size())
        pieces = [self.b.id_to_piece(i) for i in ids]
        self.b_bytes = [
            bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in zip(ids, pieces, strict=True)
        ]
        if max(max(self.a_bytes), len(pieces)) >= 1 << 24:
            raise ValueError("ids of 2^24 and more have no place in a pair")
        self.a_sizes = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_sizes[list(self.a_bytes)] = list(map(len, self.a_bytes.values()))
        self.b_sizes = np.array(list(map(len, self.b_bytes)), np.int64)
        self.may_cut = self.cuts_at([p for i, p in zip(ids, pieces, strict=True) if not self.b.is_byte(i)])
        self.forget()

    def cuts_at(self, pieces: list[str]) -> bool:
        """True if neither tokenizer joins a blank or line end with a plain sign before it.

        A starts a new pre-token there in any text. B joins only what one of its pieces
        holds, so these must not go on across a blank nor hold a line end; and it must
        change no white space.
        """
        probe = "\n a  b \n\tc"
        joined = b"".join(self.b_bytes[i] for i in self.b.encode(probe, num_threads=1))
        return joined == b" " + probe.encode() and not any(re.search("[^▁]▁|\n", piece) for piece in pieces)

    def forget(self) -> None:
        """Empty the table, but for keys that more than one text has used since it was last emptied."""
        before = getattr(self, "table", {})
        kept = [key for key, at in before.items() if self.uses[at] > 1]
        kept = kept if len(kept) < KEPT_CHUNKS // 2 else []
        codes = np.array([before[key] for key in kept], np.int64)
        if kept:
            texts, facts = [self.texts[at] for at in codes], self.facts[codes]
            pairs = self.links(facts[:, 4], facts[:, 2])
        self.table: dict[str, int] = {}
        self.texts: list[bytes] = []
        # For each key: A tokens, B tokens, groups, whether the tokens give it back, first place among the pairs; uses.
        self.facts = np.empty((1 << 12, 5), np.int64)
        self.uses = np.zeros(1 << 12, np.int32)
        self.pairs = np.empty(1 << 14, np.int64)
        self.n_pairs = 0
        if kept and len(pairs) < KEPT_LINKS // 2:
            self.add(kept, texts, facts[:, :4], pairs)

    # ---- texts to keys

    def words(self, text: str) -> list[str]:
        """A text as words behind blanks and line ends; right where all of them are plain."""
        return text.replace("\n", " \n").split(" ")

    def chunks(self, text: str) -> Iterator[list[str]]:
        """Keys of a text of any shape, about BITE signs at a time."""
        whole, start = " " + text, 0
        while start < len(whole):
            border = CUT.search(whole, start + BITE) if self.may_cut and start + BITE < len(whole) else None
            stop = border.start() if border else len(whole)
            pieces = CUT.split(whole[start:stop]) if self.may_cut else [whole]
            yield [self.key(piece) for piece in pieces]
            start = stop

    def key(self, piece: str) -> str:
        bare = piece[1:] if piece[0] == " " else piece
        plain = self.may_cut and WORD.fullmatch(bare) and (bare is piece) == (bare[0] == "\n")
        return bare if plain else MARK + piece

    def documents(self, texts: list[str | None]) -> Iterator[Aligned]:
        """Each whole text aligned, in order; short ones have their new words encoded together."""
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (size == 0 or size + len(texts[stop] or "") <= BITE):
                size += len(texts[stop] or "")
                stop += 1
            yield from self.some(texts[start:stop], size <= BITE and self.may_cut)
            start = stop

    def some(self, texts: list[str | None], short: bool) -> Iterator[Aligned]:
        split = [self.words(text) if text and short else [] for text in texts]
        unseen = set().union(*split).difference(self.table)
        odd = {word for word in unseen if not WORD.fullmatch(word)}
        if odd:
            split = [words if odd.isdisjoint(words) else [] for words in split]
        self.know(itertools.chain.from_iterable(split))
        for text, words in zip(texts, split, strict=True):
            try:
                codes = list(map(self.table.__getitem__, words))
            except KeyError:  # a text of another shape has emptied the table in between
                codes = []
            if codes:
                yield self.put_together([codes])
            else:
                yield self.put_together(self.known(self.chunks(text)) if text else [])

    def known(self, bites: Iterable[list[str]]) -> Iterator[list[int]]:
        for keys in bites:
            self.know(keys)
            yield list(map(self.table.__getitem__, keys))

    def know(self, keys: Iterable[str]) -> None:
        """Put the keys into the table; what it held before may go."""
        keys = set(keys)
        unseen = keys.difference(self.table)
        if unseen and (len(self.table) + len(unseen) > KEPT_CHUNKS or self.n_pairs > KEPT_LINKS):
            self.forget()
            unseen = keys.difference(self.table)
        plain = [key for key in unseen if key[0] != MARK]
        self.add_words(plain)
        self.add_each([key for key in unseen if key not in self.table])

    def put_together(self, bites: Iterable[list[int]]) -> Aligned:
        """A text from the places of its keys in the table."""
        total, digest, found = np.zeros(3, np.int64), hashlib.sha256(), []
        for codes in bites:
            facts = self.facts[codes]
            self.uses[codes] += 1
            if not facts[:, 3].all():
                found = []
                break
            digest.update((b";" if found else b"") + b";".join(map(self.texts.__getitem__, codes)))
            total += facts[:, :3].sum(axis=0)
            found.append(self.links(facts[:, 4], facts[:, 2]))
        if not found:
            return Aligned((0, 0, 0), "", np.empty(0, np.int64), np.empty(0, np.int64))
        if len(found) == 1:
            return Aligned(tuple(total.tolist()), digest.hexdigest(), found[0], np.ones(len(found[0]), np.int64))
        keys, times = np.unique(np.concatenate(found), return_counts=True)
        return Aligned(tuple(total.tolist()), digest.hexdigest(), keys, times)

    # ---- keys to groups and pairs

    def add(self, keys: list[str], texts: list[bytes], facts: np.ndarray, pairs: np.ndarray) -> None:
        """Add keys with their groups as text, their first four facts and the pairs of all of them."""
        at, sizes = len(self.texts), facts[:, 2]
        while at + len(keys) > len(self.facts):
            self.facts = np.concatenate((self.facts, np.empty_like(self.facts)))
            self.uses = np.concatenate((self.uses, np.zeros_like(self.uses)))
        if self.n_pairs + len(pairs) > len(self.pairs):
            self.pairs = np.concatenate((self.pairs, np.empty(max(len(pairs), len(self.pairs)), np.int64)))
        self.facts[at : at + len(keys), :4] = facts
        self.facts[at : at + len(keys), 4] = self.n_pairs + np.cumsum(sizes) - sizes
        self.pairs[self.n_pairs : self.n_pairs + len(pairs)] = pairs
        self.n_pairs += len(pairs)
        self.table.update(zip(keys, range(at, at + len(keys)), strict=True))
        self.texts += texts

    def add_words(self, words: list[str]) -> None:
        """Encode plain words as lines of texts; those of a text that its tokens do not give back are left out."""
        blocks = [words[at : at + LINES] for at in range(0, len(words), LINES)]
        texts = ["\n".join(("", *[w if w[0] == "\n" else " " + w for w in block], "")) for block in blocks]
        found_a = self.a.encode_batch_fast(texts, add_special_tokens=False)
        found_b = self.b.encode(texts, num_threads=1)
        for block, text, a, b in zip(blocks, texts, found_a, found_b, strict=True):
            body, a, b = text.encode(), a.ids, b[1:]  # B puts a blank before a text
            if not self.given_back(body, a, b):
                continue
            pairs, groups, ends, ends_a, ends_b = self.aligned(a, b)
            # A line end is a group of its own before and behind each line; a word may begin with one more.
            line_ends = np.flatnonzero(np.frombuffer(body, np.uint8) == 10)
            opens = np.array([w[0] == "\n" for w in block])
            borders = line_ends[np.cumsum(np.concatenate(([0], 1 + opens)))] + 1
            first, last = np.searchsorted(ends, borders[:-1]) + 1, np.searchsorted(ends, borders[1:])
            n_a, n_b = (np.diff(np.searchsorted(e, borders)) - 1 for e in (ends_a, ends_b))
            own = np.ones(len(pairs), bool)
            own[np.searchsorted(ends, borders)] = False
            texts_of = [";".join(groups[i:j]).encode() for i, j in zip(first.tolist(), last.tolist(), strict=True)]
            self.add(block, texts_of, np.stack((n_a, n_b, last - first, np.ones(len(block), np.int64)), axis=1), pairs[own])

    def add_each(self, keys: list[str]) -> None:
        """Encode chunks each for itself."""
        chunks = [key[1:] if key[0] == MARK else key if key[0] == "\n" else " " + key for key in keys]
        ids_a = [found.ids for found in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        if self.may_cut:
            # Behind a line end a chunk is encoded as inside a text: the blank and the line end before it are dropped.
            ids_b = [ids[2:] for ids in self.b.encode(["\n" + chunk for chunk in chunks], num_threads=1)]
        else:
            ids_b = [self.b.encode(chunk[1:], num_threads=1) for chunk in chunks]
        for key, chunk, a, b in zip(keys, chunks, ids_a, ids_b, strict=True):
            good = self.given_back(chunk.encode(), a, b)
            pairs, groups, *_ = self.aligned(a, b) if good else (np.empty(0, np.int64), [])
            self.add([key], [";".join(groups).encode()], np.array([[len(a), len(b), len(groups), good]], np.int64), pairs)

    def given_back(self, body: bytes, a: list[int], b: list[int]) -> bool:
        return b"".join([self.a_bytes[i] for i in a]) == body == b"".join([self.b_bytes[i] for i in b])

    def aligned(self, a: list[int], b: list[int]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(pairs of the tokens that end together, groups as text, byte offsets of their ends, of A's, of B's)."""
        ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = np.cumsum(self.a_sizes[ids_a]), np.cumsum(self.b_sizes[ids_b])
        ends, last_a, last_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        names_a, names_b, groups, i, j = list(map(str, a)), list(map(str, b)), [], 0, 0
        for to_a, to_b in zip((last_a + 1).tolist(), (last_b + 1).tolist(), strict=True):
            one = names_a[i] if to_a == i + 1 else ",".join(names_a[i:to_a])
            two = names_b[j] if to_b == j + 1 else ",".join(names_b[j:to_b])
            groups.append(f"{one}|{two}")
            i, j = to_a, to_b
        return pair_key(ids_a[last_a], ids_b[last_b]), groups, ends, ends_a, ends_b

    def links(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The pairs of all chunks, one chunk after the other."""
        before = np.cumsum(sizes) - sizes
        return self.pairs[np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)]


def pair_key(a: int | np.ndarray, b: int | np.ndarray) -> int | np.ndarray:
    """A pair as a number: low bits of the B id, its other bits, the A id."""
    return ((b & ((1 << BITS) - 1)) << 48) | ((b >> BITS) << 24) | a


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending pairs with their counts as zstd frames of FRAME pairs, each frame behind its length."""
    out, press = [], zstandard.ZstdCompressor(level=3)
    for start in range(0, len(keys), FRAME):
        some = keys[start : start + FRAME]
        body = np.diff(some, prepend=0).astype("<i8").tobytes() + counts[start : start + FRAME].astype("<i8").tobytes()
        frame = press.compress(body)
        out += [len(frame).to_bytes(4, "little"), frame]
    return b"".join(out)


def frames(blob: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pairs, counts) of each frame that pack() wrote."""
    view, at, press = memoryview(blob), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        size = int.from_bytes(view[at : at + 4], "little")
        body = np.frombuffer(press.decompress(view[at + 4 : at + 4 + size]), "<i8")
        at += 4 + size
        yield np.cumsum(body[: len(body) // 2]), body[len(body) // 2 :]


def merge(blobs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]]:
    """K-way heap merge of packed counts: (pairs, sums, [(blob, its pairs among them)]), pairs ascending throughout.

    The heap holds the head of each blob's current frame. A step takes all that is not
    beyond the nearest end of a frame, so one frame of each blob is in memory.
    """
    sources = [frames(blob) for blob in blobs]
    current: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heads: list[tuple[int, int]] = []
    ends: list[tuple[int, int]] = []

    def advance(i: int) -> None:
        frame = next(sources[i], None)
        if frame is not None:
            current[i] = frame
            heapq.heappush(heads, (int(frame[0][0]), i))
            heapq.heappush(ends, (int(frame[0][-1]), i))

    for i in range(len(blobs)):
        advance(i)
    while heads:
        bound = ends[0][0]
        taken, parts = [], []
        while heads and heads[0][0] <= bound:
            _, i = heapq.heappop(heads)
            keys, counts = current.pop(i)
            n = int(np.searchsorted(keys, bound, "right"))
            taken.append((i, keys[:n]))
            parts.append(counts[:n])
            if n < len(keys):
                current[i] = keys[n:], counts[n:]
                heapq.heappush(heads, (int(keys[n]), i))
        while ends and ends[0][0] <= bound:
            advance(heapq.heappop(ends)[1])
        keys, places = np.unique(np.concatenate([k for _, k in taken]), return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, places, np.concatenate(parts))
        yield keys, sums, sorted(taken, key=lambda one: one[0])


def totals(blobs: list[bytes]) -> list[bytes]:
    """For each blob the corpus-wide count of each of its pairs, doubled, plus one if no pair of its B id has more."""
    answers: list[list[np.ndarray]] = [[] for _ in blobs]

    def settle(keys: np.ndarray, sums: np.ndarray, taken: list[tuple[int, np.ndarray]]) -> None:
        side = keys >> 24
        starts = np.flatnonzero(np.diff(side, prepend=-1))
        highest = np.repeat(np.maximum.reduceat(sums, starts), np.diff(np.append(starts, len(keys))))
        values = 2 * sums + (sums == highest)
        for i, own in taken:
            answers[i].append(values[np.searchsorted(keys, own)])

    # Steps are held back until the last B id in them is complete.
    held: list[tuple[np.ndarray, np.ndarray, list]] = []

    def whole(steps):
        return np.concatenate([s[0] for s in steps]), np.concatenate([s[1] for s in steps]), [t for s in steps for t in s[2]]

    for keys, sums, taken in merge(blobs):
        if held and held[-1][0][-1] >> 24 != keys[0] >> 24:
            settle(*whole(held))
            held = []
        cut = int(np.searchsorted(keys, (keys[-1] >> 24) << 24))
        if cut:
            held.append((keys[:cut], sums[:cut], [(i, own[own < keys[cut]]) for i, own in taken]))
            settle(*whole(held))
            held = []
        held.append((keys[cut:], sums[cut:], [(i, own[own >= keys[cut]]) for i, own in taken]))
    if held:
        settle(*whole(held))
    return [pack_values(np.concatenate(found) if found else np.empty(0, np.int64)) for found in answers]


def pack_values(values: np.ndarray, kind: str = "<i8") -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(values.astype(kind).tobytes())


def unpack_values(blob: bytes, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), kind)


PART = "struct<part: int, counts: binary, holders: binary, docs: binary, times: binary>"
RUN = (
    "run long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    f"groups_sha256 array<string>, parts array<{PART}>"
)
_PARTS = pa.list_(
    pa.struct([("part", pa.int32()), ("counts", pa.binary()), ("holders", pa.binary()), ("docs", pa.binary()), ("times", pa.binary())])
)
RUN_ARROW = pa.schema(
    [("run", pa.int64()), ("doc_id", pa.list_(pa.int64()))]
    + [(name, pa.list_(pa.int64())) for name in ("n_a", "n_b", "n_groups")]
    + [("groups_sha256", pa.list_(pa.string())), ("parts", _PARTS)]
)


def spill(keys: np.ndarray, docs: np.ndarray, times: np.ndarray, n_docs: int) -> list[dict]:
    """A run's links as one entry for each partition: pair counts, and for each pair the documents that hold it."""
    if not len(keys):
        return []
    pairs, places = np.unique(keys, return_inverse=True)
    held = places * n_docs + docs
    del keys, places
    order = np.argsort(held, kind="stable")
    held = held[order]
    starts = np.flatnonzero(np.diff(held, prepend=-1))
    times, held = np.add.reduceat(times[order], starts), held[starts]
    of_pair = held // n_docs
    firsts = np.flatnonzero(np.diff(of_pair, prepend=-1))
    counts, holders = np.add.reduceat(times, firsts), np.diff(np.append(firsts, len(held)))
    ends = np.append(firsts, len(held))
    entries = []
    parts = pairs >> 48
    for part in np.unique(parts).tolist():
        low, high = np.searchsorted(parts, [part, part + 1])
        rows = slice(ends[low], ends[high])
        entries.append(
            {
                "part": part,
                "counts": pack(pairs[low:high], counts[low:high]),
                "holders": pack_values(holders[low:high], "<u4"),
                "docs": pack_values(held[rows] % n_docs, "<u4"),
                "times": pack_values(times[rows], "<u4"),
            }
        )
    return entries


def runs(docs: DataFrame, byte_bpe: str, piece_bpe: str, text: str = "text", run_links: int = RUN_LINKS) -> DataFrame:
    """Texts encoded and their links spilled: one row for each run of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_aligner(byte_bpe, piece_bpe)
        number = TaskContext.get().partitionId() << 32
        rows, links, size = [], [], 0

        def flush() -> pa.RecordBatch:
            keys, times = (np.concatenate(found) for found in zip(*links, strict=True))
            owners = np.repeat(np.arange(len(rows)), [len(found[0]) for found in links])
            ids, n_a, n_b, n_groups, hashes = map(list, zip(*rows, strict=True))
            entry = {"run": number, "doc_id": ids, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "groups_sha256": hashes}
            return pa.RecordBatch.from_pylist([entry | {"parts": spill(keys, owners, times, len(rows))}], RUN_ARROW)

        for batch in slices(batches):
            found = aligner.documents(column(batch, "body"))
            for doc_id, text in zip(column(batch, "doc_id"), found, strict=True):
                rows.append((doc_id, *text.counts, text.digest))
                links.append((text.keys, text.times))
                size += len(text.keys)
                if size >= run_links or len(rows) >= run_links >> 4:
                    yield flush()
                    number, rows, links, size = number + 1, [], [], 0
        if rows:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("body"))
    found = rows.mapInArrow(run, RUN)
    # Few runs in a file: a reader takes a file's rows at once.
    path = f"{shared_dir(docs.sparkSession, 'stages')}/runs-{uuid.uuid4().hex}"
    found.write.option("maxRecordsPerFile", 8).parquet(path)
    return docs.sparkSession.read.schema(found.schema).parquet(path)


def _up(table: pa.Table) -> pa.Table:
    merged = [pack(keys, sums) for keys, sums, _ in merge(table["counts"].to_pylist())]
    first = table.slice(0, 1)
    return pa.table({"part": first["part"], "run": first["group"], "counts": pa.array([b"".join(merged)], pa.binary())})


def _top(table: pa.Table) -> pa.Table:
    return pa.table({"part": table["part"], "run": table["run"], "answer": pa.array(totals(table["counts"].to_pylist()), pa.binary())})


def _down(left: pa.Table, right: pa.Table) -> pa.Table:
    """The answers of one merged run handed to the runs that it was merged from."""
    blobs = left["counts"].to_pylist()
    values, at = unpack_values(right["answer"][0].as_py()), 0
    answers: list[list[np.ndarray]] = [[] for _ in blobs]
    for keys, _, taken in merge(blobs):
        some = values[at : at + len(keys)]
        at += len(keys)
        for i, own in taken:
            answers[i].append(some[np.searchsorted(keys, own)])
    packed = [pack_values(np.concatenate(found)) for found in answers]
    return pa.table({"part": left["part"], "run": left["run"], "answer": pa.array(packed, pa.binary())})


def corpus_totals(spilled: DataFrame, fan: int = FAN) -> DataFrame:
    """(part, run, answer): for each run and partition the corpus-wide totals of its pairs, in its order."""
    level = spilled.select("run", F.explode("parts").alias("p")).select("p.part", "run", "p.counts")
    levels, n = [], spilled.count()
    while n > fan:
        n = -(-n // fan)
        level = level.withColumn("group", F.pmod(F.xxhash64("run"), F.lit(n)))
        levels.append(level)
        merged = level.groupBy("part", "group").applyInArrow(_up, "part int, run long, counts binary")
        level = materialize(merged, "merged-runs")
    answers = level.groupBy("part").applyInArrow(_top, "part int, run long, answer binary")
    for level in reversed(levels):
        answers = materialize(answers.withColumnRenamed("run", "group"), "answers")
        both = level.groupBy("part", "group").cogroup(answers.groupBy("part", "group"))
        answers = both.applyInArrow(_down, "part int, run long, answer binary")
    return answers


ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The totals of each run added up over its documents."""
    names = [field.split()[0] for field in ALIGNED.split(", ")]
    for batch in batches:
        for at in range(batch.num_rows):
            row = {name: batch.column(i)[at] for i, name in enumerate(batch.schema.names)}
            ids = row["doc_id"].values
            told = row["answers"].as_py() or ()
            answers = {one["part"]: one["answer"] for one in told}
            best, total = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            links = np.zeros(len(ids), np.int64)
            for entry in row["parts"]:
                values = unpack_values(answers[entry["part"].as_py()])
                holders, docs, times = (unpack_values(entry[name].as_py(), "<u4") for name in ("holders", "docs", "times"))
                values, times = np.repeat(values, holders), times.astype(np.int64)
                np.add.at(links, docs, times)
                np.add.at(best, docs, times * (values & 1))
                np.add.at(total, docs, times * (values >> 1))
            plain = [row[name].values for name in ("n_a", "n_b", "n_groups")]
            sums = [pa.array(found) for found in (links, best, total)]
            yield pa.RecordBatch.from_arrays([ids, *plain, *sums, row["groups_sha256"].values], names)


def align(
    docs: DataFrame, byte_bpe: str, piece_bpe: str, text: str = "text", run_links: int = RUN_LINKS, fan: int = FAN
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row.

    `n_links` counts pairs of tokens that end together, `count_sum` adds up how often each
    of their id pairs is linked corpus-wide, `n_best` counts links whose pair is the most
    frequent of its B id, ties included. Null and empty texts, and texts that the tokens do
    not give back byte by byte, have no tokens: zeros and an empty hash. Rows that repeat
    count each, null ids stay, an empty table gives an empty result, other columns are not read.
    """
    spilled = runs(docs, byte_bpe, piece_bpe, text, run_links)
    answers = corpus_totals(spilled, fan).groupBy("run").agg(F.collect_list(F.struct("part", "answer")).alias("answers"))
    return spilled.join(answers, "run", "left").mapInArrow(_shares, ALIGNED)
