"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features are lexicon densities, the nearness of lexicon words to words of address,
capitals, punctuation and obfuscation rates. The lexicon is a short fixed list and the
word pieces that tell the two labels apart in one part of the training rows; the trees
are grown on the other part and calibrated on a third.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalodge.llm.common import ChunkCodes, column, fold, in_bites, labelled_sample, slices, utf8

# Bounds of the training sample and of the learned lexicon.
SAMPLE_PER_LABEL = 3000
SAMPLE_BYTES = 1 << 14
PIECES = 512
PIECE_LENGTHS = range(4, 9)
TREES, DEPTH, RATE, BINS, LEAST = 80, 3, 0.15, 32, 8.0

# Insults, and words that address a reader in the four languages.
INSULTS = frozenset(
    "bastard clown crap creep cretin damn disgusting dumb fool freak garbage hateful idiot idiotic imbecile jerk loser "
    "lunatic moron pathetic pig rubbish scum stupid trash ugly vermin worthless "
    "abschaum arschloch dummkopf idiotin mistkerl trottel connard crétin débile imbécile ordure salaud "
    "basura cabrón estúpido gilipollas imbécil".split()
)
ADDRESS = frozenset(
    "you your yours yourself u ur ye tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer "
    "tú ti usted ustedes vosotros vuestro".split()
)
DISGUISE = str.maketrans("013457@$!|", "oieastasii")
LETTERS = re.compile(r"[^\W\d_]+")
EDGE_SIGNS = ".,;:!?\"'()[]{}<>*#%&$|~`^_=+/\\-"

LEXICON, DISGUISED, ADDRESSED, CAPITALS, MIXED = 1, 2, 4, 8, 16
WEIGHT_BITS = 5
WEIGHT_UNIT = 16


def pieces(word: str) -> Iterator[str]:
    """The word, its prefixes and suffixes of PIECE_LENGTHS letters, with marked edges."""
    yield f"^{word}$"
    for n in PIECE_LENGTHS:
        if n < len(word):
            yield f"^{word[:n]}"
            yield f"{word[-n:]}$"


class Words(ChunkCodes):
    """pre-token (bytes) -> its flags and learned weight in one number."""

    def __init__(self, learned: dict[str, float]):
        super().__init__(self.flags)
        self.learned = learned

    def flags(self, chunk: bytes) -> int:
        raw = chunk.decode("utf-8", "replace")
        bare = raw.strip(EDGE_SIGNS)
        low = bare.lower()
        code = 0
        if low in INSULTS:
            code |= LEXICON
        if low in ADDRESS:
            code |= ADDRESSED
        if len(bare) > 2 and bare.isupper():
            code |= CAPITALS
        if low and not low.isalpha() and any(map(str.isalpha, low)):
            code |= MIXED
            plain = "".join(LETTERS.findall(low.translate(DISGUISE)))
            if plain in INSULTS and not code & LEXICON:
                code |= DISGUISED
        weight = max((self.learned.get(p, 0.0) for w in LETTERS.findall(low) for p in pieces(w)), default=0.0)
        return code | int(weight * WEIGHT_UNIT) << WEIGHT_BITS


def nearness(hits: np.ndarray, address: np.ndarray) -> float:
    """1 / distance in words of the closest lexicon word and word of address, at most 1; 0 without a pair."""
    if not len(hits) or not len(address):
        return 0.0
    at = np.searchsorted(address, hits)
    after = np.abs(address[np.minimum(at, len(address) - 1)] - hits)
    before = np.abs(hits - address[np.maximum(at - 1, 0)])
    return 1.0 / max(1.0, float(np.minimum(after, before).min()))


def features(body: bytes, codes: np.ndarray) -> list[float]:
    """Dense features of a whole text in UTF-8 with the codes of its words."""
    n, size = max(1, len(codes)), max(1, len(body))
    hist = np.bincount(np.frombuffer(body, np.uint8), minlength=128)
    fixed, disguised = (codes & LEXICON) > 0, (codes & DISGUISED) > 0
    weights = (codes >> WEIGHT_BITS) / WEIGHT_UNIT
    learned = weights > 0
    strong = np.sort(weights)[-3:].sum() if len(weights) else 0.0
    hits = np.flatnonzero(fixed | disguised | (weights >= 2))
    return [
        float(np.log1p(len(codes))),
        float(fixed.sum()),
        fixed.sum() / n,
        float(disguised.sum()),
        disguised.sum() / n,
        float(learned.sum()),
        learned.sum() / n,
        float(weights.max(initial=0.0)),
        float(strong),
        float(weights.sum()) / n,
        nearness(hits, np.flatnonzero(codes & ADDRESSED)),
        ((codes & ADDRESSED) > 0).sum() / n,
        ((codes & CAPITALS) > 0).sum() / n,
        hist[65:91].sum() / size,
        hist[33] / size,
        hist[63] / size,
        (hist[33:48].sum() + hist[58:65].sum() + hist[91:97].sum() + hist[123:127].sum()) / size,
        ((codes & MIXED) > 0).sum() / n,
    ]


def learn_pieces(texts: list[str], labels: np.ndarray) -> dict[str, float]:
    """Word pieces that are far more common under label 1, with their log odds ratio: at most PIECES."""
    in_all, in_toxic = Counter(), Counter()
    for text, label in zip(texts, labels, strict=True):
        found = {p for word in set(LETTERS.findall(text.lower())) for p in pieces(word)}
        in_all.update(found)
        if label == 1:
            in_toxic.update(found)
    toxic = max(1, int((labels == 1).sum()))
    other = max(1, len(labels) - toxic)
    scored = []
    for piece, hits in in_toxic.items():
        rest = in_all[piece] - hits
        odds = np.log((hits + 0.5) / (toxic + 1)) - np.log((rest + 0.5) / (other + 1))
        if hits >= max(5, 0.004 * toxic) and odds > 1.5:
            scored.append((odds * np.sqrt(hits), piece, odds))
    scored.sort(reverse=True)
    return {piece: float(min(odds, 60)) for _, piece, odds in scored[:PIECES]}


class Tree(NamedTuple):
    """A complete tree of DEPTH levels: node k has the children 2k + 1 and 2k + 2."""

    feature: np.ndarray
    above: np.ndarray
    value: np.ndarray

    def leaf(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.feature[node]] > self.above[node])
        return self.value[node - (2**DEPTH - 1)]


def grow(binned: np.ndarray, cuts: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> Tree:
    """One tree on gradient statistics; a node that no split improves passes its rows to the right child unsplit."""
    inner = 2**DEPTH - 1
    feature, above = np.zeros(inner, np.int64), np.full(inner, -np.inf)
    node = np.zeros(len(binned), np.int64)
    for k in range(inner):
        rows = np.flatnonzero(node == k)
        best = 1e-6
        g, h = grad[rows].sum(), hess[rows].sum()
        for f in range(binned.shape[1]):
            gs = np.cumsum(np.bincount(binned[rows, f], grad[rows], BINS))[:-1]
            hs = np.cumsum(np.bincount(binned[rows, f], hess[rows], BINS))[:-1]
            gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
            gain[(hs < LEAST) | (h - hs < LEAST)] = 0
            if gain.max(initial=0) > best:
                best = gain.max()
                feature[k], above[k] = f, cuts[f, int(gain.argmax())]
                right = binned[rows, f] > int(gain.argmax())
        node[rows] = 2 * k + 1 + (right if best > 1e-6 else 1)
    leaves = node - inner
    sums = np.bincount(leaves, grad, 2**DEPTH), np.bincount(leaves, hess, 2**DEPTH)
    return Tree(feature, above, RATE * sums[0] / (sums[1] + 1))


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps (from x on, value) of the non-decreasing fit, by pooling adjacent violators."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for a, b, w in zip(x[order], y[order], weight[order], strict=True):
        blocks.append([a, b * w, w])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            _, s, w = blocks.pop()
            blocks[-1][1] += s
            blocks[-1][2] += w
    return np.array([b[0] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


class ToxicityModel(NamedTuple):
    learned: dict
    base: float
    trees: list
    knots: np.ndarray
    values: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((tree.leaf(x) for tree in self.trees), np.zeros(len(x)))

    def score(self, x: np.ndarray) -> np.ndarray:
        """The calibrated value, moved within 0.02 by the margin so that equal steps keep an order."""
        margin = self.margin(x)
        step = self.values[np.maximum(np.searchsorted(self.knots, margin, side="right") - 1, 0)]
        return np.clip(0.98 * step + 0.02 / (1 + np.exp(-np.clip(margin, -30, 30))), 0, 1)


def fit(texts: list[bytes], labels: np.ndarray, share: float) -> ToxicityModel:
    """Texts by thirds: lexicon, trees, calibration. `share` is the share of label 1 among all labelled rows."""
    part = np.arange(len(texts)) % 5
    for_words, for_trees, for_knots = part < 2, (part == 2) | (part == 3), part == 4
    learned = learn_pieces([t.decode("utf-8", "replace") for t, k in zip(texts, for_words, strict=True) if k], labels[for_words])
    words = Words(learned)
    width = len(features(b"", np.zeros(0, np.int64)))
    x = np.array([features(t, next(words.codes([t]))) for t in texts]).reshape(len(texts), width)
    good = labels == 1
    weight = np.where(good, share / max(1, good.sum()), (1 - share) / max(1, (~good).sum())) * len(labels)
    cuts = np.quantile(x[for_trees], np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T if for_trees.any() else np.zeros((x.shape[1], BINS - 1))
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    base = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    trees, margin = [], np.full(len(x), base)
    y = good.astype(float)
    for _ in range(TREES if 0 < share < 1 else 0):
        p = 1 / (1 + np.exp(-margin))
        grown = grow(binned[for_trees], cuts, (weight * (y - p))[for_trees], (weight * p * (1 - p))[for_trees])
        trees.append(grown)
        margin += grown.leaf(x)
    knots, values = isotonic(margin[for_knots], y[for_knots], weight[for_knots])
    if not len(knots):
        knots, values = np.array([0.0]), np.array([share])
    return ToxicityModel(learned, base, trees, knots, values)


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, text: str = "text") -> ToxicityModel:
    """A model from labelled rows whose fold is not 0: about SAMPLE_PER_LABEL of each label, of SAMPLE_BYTES at most.

    A null id or label is no labelled row; of an id with several labels the largest counts.
    Longer texts are scored in full, only not learned from.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(fold("doc_id", folds) != 0)
    known = known.groupBy("doc_id").agg((F.max("toxic") == 1).cast("int").alias("label"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = labelled_sample(known, "label", sizes, SAMPLE_PER_LABEL, "doc_id")
    # About SAMPLE_PER_LABEL rows of 12 bytes for each of the two labels.
    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("body"))
    rows = body.where(F.octet_length("body") <= SAMPLE_BYTES).join(F.broadcast(chosen), "doc_id")
    got = sorted((row["doc_id"], row["label"], bytes(row["body"])) for row in rows.toLocalIterator())
    got = sorted(got, key=lambda g: (g[1], g[0] * 2654435761 % (1 << 32)))
    total = max(1, sum(sizes.values()))
    return fit([g[2] for g in got], np.array([g[1] for g in got], np.int64), sizes.get(1, 0) / total)


def toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """doc_id and score for each row; null counts as empty, which is scored like any text.

    Rows that repeat are scored each, null ids stay, an empty table gives an empty result,
    and other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(model.learned)
        for batch in slices(batches):
            bodies, scores = column(batch, "body"), []
            for a, b in in_bites(bodies):
                found = [features(t, c) for t, c in zip(bodies[a:b], words.codes(bodies[a:b]), strict=True)]
                scores.append(model.score(np.array(found)))
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([ids, pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("body")).mapInArrow(
        run, "doc_id long, score double"
    )
