"""Language of words and documents by a linear-chain conditional random field.

Each word has features: affixes and n-grams of its letters and membership in learned
lexicons. Transitions between the languages of neighbouring words are learned as well, on
training texts that are switched between documents. Forward-backward gives each word of
a text a probability for each language; a document's are the means over its words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalodge.llm.common import ChunkCodes, column, fold, in_bites, slices, utf8
from catalodge.llm.crf import chains, expected

# Bounds of the training sample: documents of a language, bytes of each, parts of longer ones, lexicon words of a language.
DOCS_PER_LANGUAGE = 200
SAMPLE_BYTES = 1 << 15
PARTS = 4
LEXICON = 400
HASH_BITS = 15
EDGE = 0x1F
AFFIX = 5
# Training sequences: so many at least, and so many for each language.
SEQUENCES, PER_LANGUAGE, LENGTH, BATCH, ROUNDS = 2048, 32, 64, 128, 6
UNKNOWN = "und"


def letters(chunk: bytes) -> str:
    """The word in a chunk of text: its letters in lower case."""
    return "".join(filter(str.isalpha, chunk.decode("utf-8", "replace"))).lower()


def word_features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(word, feature) pairs: 1- to 4-grams with marked edges, affixes of AFFIX - 1 letters, lexicons of the word.

    The edge marks make n-grams at a word's ends its affixes.
    """
    mark = chr(EDGE)
    text = np.frombuffer((mark + mark.join(words) + mark).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    edges = text == EDGE
    owner = np.cumsum(edges) - 1
    # The word to the right of an edge mark owns it as its start; as an end it belongs to the word before.
    pairs = []
    value = np.zeros(len(text), np.uint64)
    for n in range(1, AFFIX + 1):
        m = len(text) - n + 1
        if m <= 0:
            break
        value = value[:m] * np.uint64(0x100000001B3) + text[n - 1 :]
        crossed = np.zeros(m, bool)
        for k in range(1, n - 1):
            crossed |= edges[k : k + m]
        keep = ~crossed & ~(edges[:m] & edges[n - 1 :])
        if n == 1:
            keep = ~edges
        if n == AFFIX:
            keep &= edges[:m] | edges[n - 1 :]
        at = np.flatnonzero(keep)
        mixed = (value[at] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        pairs.append((owner[at], (mixed >> np.uint64(64 - HASH_BITS)).astype(np.int64)))
    members = [(w, lexicon[word]) for w, word in enumerate(words) if word in lexicon]
    pairs.append((np.array([m[0] for m in members], np.int64), np.array([m[1] for m in members], np.int64) + (1 << HASH_BITS)))
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def sums(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of `values` by owner."""
    return np.stack([np.bincount(owner, values[:, k], n) for k in range(values.shape[1])], axis=1)


class LanguageModel(NamedTuple):
    languages: list
    lexicon: dict  # word -> number of the set of languages in whose lexicon it is
    weights: np.ndarray  # (features, languages)
    switch: np.ndarray  # (languages, languages): log weight of a language after another

    def emissions(self, words: list[str]) -> np.ndarray:
        owner, feature = word_features(words, self.lexicon)
        return sums(owner, self.weights[feature], len(words))


def switched(texts: list[list[int]], labels: list[int], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Training sequences (words, labels) of LENGTH words: runs of 3 to LENGTH words from random documents, end to end."""
    draw = np.random.default_rng(seed)
    by_label: dict[int, list[int]] = {}
    for k, label in enumerate(labels):
        if texts[k]:
            by_label.setdefault(label, []).append(k)
    kinds = sorted(by_label)
    n = max(SEQUENCES, PER_LANGUAGE * len(kinds))
    words, gold = np.zeros((n, LENGTH), np.int64), np.zeros((n, LENGTH), np.int64)
    for s in range(n):
        at = 0
        while at < LENGTH:
            label = kinds[draw.integers(len(kinds))]
            text = texts[by_label[label][draw.integers(len(by_label[label]))]]
            begin = int(draw.integers(len(text)))
            run = text[begin : begin + int(draw.integers(3, LENGTH + 1))][: LENGTH - at]
            words[s, at : at + len(run)], gold[s, at : at + len(run)] = run, label
            at += len(run)
    return words, gold


def fit(rows: list[tuple[str, bytes]], seed: int = 5) -> LanguageModel:
    """A model from (language, text) rows. With no row that has a word it knows no language."""
    texts = [[w for w in map(letters, body.split()) if w] for _, body in rows]
    rows = [(lang, words) for (lang, _), words in zip(rows, texts, strict=True) if words]
    languages = sorted({lang for lang, _ in rows})
    n = len(languages)
    if n < 2:
        return LanguageModel(languages, {}, np.zeros((1 << HASH_BITS, max(n, 1))), np.zeros((max(n, 1), max(n, 1))))
    counts = {lang: Counter() for lang in languages}
    for lang, words in rows:
        counts[lang].update(words)
    member: dict[str, int] = {}
    for k, lang in enumerate(languages):
        for word, _ in counts[lang].most_common(LEXICON):
            member[word] = member.get(word, 0) | 1 << k
    kinds = {bits: k for k, bits in enumerate(sorted(set(member.values())))}
    lexicon = {word: kinds[bits] for word, bits in member.items()}
    size = (1 << HASH_BITS) + len(kinds)

    vocabulary: dict[str, int] = {}
    coded = [[vocabulary.setdefault(w, len(vocabulary)) for w in words] for _, words in rows]
    words, gold = switched(coded, [languages.index(lang) for lang, _ in rows], seed)
    owner, feature = word_features(list(vocabulary), lexicon)
    order = np.argsort(owner, kind="stable")
    owner, feature = owner[order], feature[order]
    bounds = np.searchsorted(owner, np.arange(len(vocabulary) + 1))
    weights, switch = np.zeros((size, n)), np.zeros((n, n))
    past_w, past_s = np.full((size, n), 1e-8), np.full((n, n), 1e-8)
    draw = np.random.default_rng(seed + 1)
    for _ in range(ROUNDS):
        shuffled = draw.permutation(len(words))
        for a in range(0, len(words), BATCH):
            x, y = words[shuffled[a : a + BATCH]], gold[shuffled[a : a + BATCH]]
            used, inverse = np.unique(x, return_inverse=True)
            pairs = np.concatenate([np.arange(bounds[u], bounds[u + 1]) for u in used])
            own = np.repeat(np.arange(len(used)), bounds[used + 1] - bounds[used])
            emission = sums(own, weights[feature[pairs]], len(used))[inverse.reshape(x.shape)]
            node, edge = expected(emission, switch)
            node -= np.eye(n)[y]
            edge -= np.einsum("sti,stj->ij", np.eye(n)[y[:, :-1]], np.eye(n)[y[:, 1:]])
            word_grad = sums(inverse.ravel(), node.reshape(-1, n), len(used)) / len(x)
            grad = sums(feature[pairs], word_grad[own], size) + 1e-4 * weights
            past_w += grad**2
            weights -= 0.3 * grad / np.sqrt(past_w)
            edge /= len(x)
            past_s += edge**2
            switch -= 0.3 * edge / np.sqrt(past_s)
    return LanguageModel(languages, lexicon, weights, switch)


class Words(ChunkCodes):
    """pre-token (bytes) -> row of `emission`; -1 without a letter."""

    def __init__(self, model: LanguageModel):
        super().__init__(None)
        self.model = model
        self.emission = np.zeros((0, model.weights.shape[1]))

    def codes(self, bodies: list[bytes]) -> Iterator[np.ndarray]:
        split = [body.split() for body in bodies]
        unseen = set().union(*split).difference(self.table)
        if len(self.table) + len(unseen) > self.capacity:
            self.table, self.emission = {}, self.emission[:0]
            unseen = set().union(*split)
        words: dict[str, int] = {}
        base = len(self.emission)
        for chunk in unseen:
            word = letters(chunk)
            self.table[chunk] = base + words.setdefault(word, len(words)) if word else -1
        if words:
            self.emission = np.concatenate((self.emission, self.model.emissions(list(words))))
        for chunks in split:
            yield np.fromiter(map(self.table.__getitem__, chunks), np.int64, len(chunks))


def train(docs: DataFrame, folds: int = 4, held: int = 2, text: str = "text") -> LanguageModel:
    """A model from the texts and non-null languages of documents whose fold is not `held`.

    Every language of those with a text is a class. About DOCS_PER_LANGUAGE documents of
    each are learned from, and of a text longer than SAMPLE_BYTES so many bytes, in PARTS
    spread over it. One row for each language is broadcast.
    """
    known = docs.select("doc_id", "lang", F.octet_length(utf8(text)).alias("size")).where(
        (fold("doc_id", folds) != held) & F.col("lang").isNotNull()
    )
    usable = known.where("size > 0")
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) / (1 << 32)
    # About DOCS_PER_LANGUAGE rows of an id and a language for each language.
    chosen = usable.join(F.broadcast(sizes), "lang").where(place < DOCS_PER_LANGUAGE / F.col("n")).select("doc_id", "lang").distinct()
    rows = docs.select("doc_id", "lang", utf8(text).alias("body")).join(F.broadcast(chosen), ["doc_id", "lang"])
    size, part = F.octet_length("body"), SAMPLE_BYTES // PARTS
    parts = [F.substring("body", F.floor((size - part) * k / (PARTS - 1)).cast("int") + 1, F.lit(part)) for k in range(PARTS)]
    rows = rows.select("doc_id", "lang", F.when(size > SAMPLE_BYTES, F.array(*parts)).otherwise(F.array("body")).alias("parts"))
    # An id that repeats with a language counts once.
    rows = rows.groupBy("lang", "doc_id").agg(F.min("parts").alias("parts"))
    got = sorted((r["lang"], r["doc_id"], [bytes(x) for x in r["parts"]]) for r in rows.toLocalIterator())
    return fit([(lang, part) for lang, _, parts in got for part in whole_words(parts)])


def whole_words(parts: list[bytes]) -> list[bytes]:
    """Parts of a text without the words that were cut at their ends; a part of one word stays."""
    out = []
    for k, part in enumerate(parts):
        words = part.split()
        first, last = int(k > 0), len(words) - int(k < len(parts) - 1)
        out.append(b" ".join(words[first:last]) if first < last else part)
    return out


def languages(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for each row: the language with the greatest mean probability over all words.

    `und` with score 0 where the text is null or has no letter, or no language is known.
    Ties go to the first language in order. Rows that repeat keep a row each, an empty table
    gives an empty result, other columns are not read.
    """
    n = len(model.languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(model)
        for batch in slices(batches):
            bodies, found = column(batch, "body"), []
            for a, b in in_bites(bodies):
                codes = [c[c >= 0] for c in words.codes(bodies[a:b])]
                lengths = np.array([len(c) for c in codes])
                rows = np.concatenate(codes)
                share = chains(words.emission[rows], lengths, model.switch) if n and len(rows) else np.zeros((len(rows), n))
                doc = np.repeat(np.arange(len(codes)), lengths)
                mean = sums(doc, share, len(codes)) / np.maximum(lengths, 1)[:, None] if n else np.zeros((len(codes), 0))
                for k, length in enumerate(lengths):
                    best = int(mean[k].argmax()) if n and length else -1
                    found.append((model.languages[best], min(1.0, float(mean[k, best]))) if best >= 0 else (UNKNOWN, 0.0))
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("body")).mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )
