"""Quality scores by Bradley-Terry pairwise ranking.

A document's strength is linear in steps of shape features. It is learned from preference
pairs, one document of label 1 and one of label 0 each, by logistic loss on the difference
of their features. The threshold is a quantile of the strengths of the training rows; the
score maps strengths to 0..1 so that the threshold lies at a given score.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalodge.llm.common import column, fold, slices, utf8
from catalodge.operators import ordered
from catalodge.session import materialize

# Every labelled row is in a pair, and there are so many pairs at least.
PAIRS = 24_000
PAIRS_AT_ONCE = 8192
# Rows of the more frequent label in a bucket of training rows, and of each label at least.
BUCKET_ROWS, LEAST_IN_BUCKET = 4096, 64
# Sums of a Newton step that reach the driver, and accuracy of the steps' ranks (1 / ACCURACY of all rows).
PARTS, ACCURACY = 16, 10_000
STEPS = 8
RIDGE = 2.0
SIGNS = [c for c in range(33, 127) if not chr(c).isalnum()]
REPEATS = 1 << 16


def shape(body: bytes) -> list[float]:
    """Shape features of a whole text in UTF-8: shares of bytes by kind, word and line repetition, lengths."""
    n = max(1, len(body))
    hist = np.bincount(np.frombuffer(body, np.uint8), minlength=256)
    signs = hist[SIGNS]
    upper, lower, digits, high = hist[65:91].sum(), hist[97:123].sum(), hist[48:58].sum(), hist[128:].sum()
    words = body.split()
    count = max(1, len(words))
    counts = Counter(words)
    same = sum(map(operator.eq, words, islice(words, 1, None)))
    # Distinct triples in runs of REPEATS words, so that a very long text needs no large set.
    triples = sum(len(set(zip(r, r[1:], r[2:], strict=False))) for r in (words[a : a + REPEATS] for a in range(0, len(words), REPEATS)))
    lines = [line for line in body.split(b"\n") if line]
    letters = max(1, upper + lower + high)
    return [
        np.log1p(len(body)),
        np.log1p(len(words)),
        len(body) / count,
        (upper + lower + high) / n,
        upper / letters,
        high / letters,
        digits / n,
        hist[10] / n,
        signs.sum() / count,
        len(counts) / count,
        max(counts.values(), default=0) / count,
        same / count,
        triples / count,
        len(set(lines)) / max(1, len(lines)),
        len(lines) / count,
        *(signs / count),
    ]


class QualityModel(NamedTuple):
    steps: np.ndarray  # (features, STEPS): values at which a feature's steps lie
    weights: np.ndarray
    scale: float
    threshold: float
    at: float

    def strength(self, shapes: np.ndarray) -> np.ndarray:
        return expand(shapes, self.steps) @ self.weights

    def score(self, shapes: np.ndarray) -> np.ndarray:
        shift = np.log(self.at / (1 - self.at))
        return 1 / (1 + np.exp(-np.clip(self.scale * (self.strength(shapes) - self.threshold) + shift, -30, 30)))


def expand(shapes: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Each feature as steps: 1 above the value of the step, else 0."""
    return (shapes[:, :, None] > steps[None]).reshape(len(shapes), -1).astype(np.float64)


def newton(x: np.ndarray, y: np.ndarray, sample: np.ndarray, ridge: float, rounds: int = 12) -> np.ndarray:
    """Weights of a logistic regression with a ridge penalty."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (sample * (p - y)) + ridge * w
        hess = (x * (sample * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(shapes: np.ndarray, labels: np.ndarray, share: float, at: float, seed: int = 11) -> QualityModel:
    """`share` is the share of label 1 among all labelled rows, `at` the score that the threshold gets."""
    quantiles = np.quantile(shapes, np.linspace(0, 1, STEPS + 2)[1:-1], axis=0).T
    x, good, bad = expand(shapes, quantiles), np.flatnonzero(labels == 1), np.flatnonzero(labels != 1)
    if not len(good) or not len(bad):
        return QualityModel(quantiles, np.zeros(x.shape[1]), 1.0, -1.0 if len(good) else 1.0, at)
    draw = np.random.default_rng(seed)
    winners, losers = draw.choice(good, PAIRS), draw.choice(bad, PAIRS)
    w = newton(x[winners] - x[losers], np.ones(PAIRS), np.ones(PAIRS), RIDGE)
    strength = x @ w
    weight = np.where(labels == 1, share / len(good), (1 - share) / len(bad))
    # The quantile of the training strengths, rows weighted as the labels are spread, that errs least.
    order = np.argsort(strength, kind="stable")
    wrong = np.cumsum(np.where(labels == 1, weight, -weight)[order])
    best = int(np.argmin(wrong))
    threshold = float(strength[order[best : best + 2]].mean()) if wrong[best] < 0 else float(strength.min()) - 1
    slope = newton(np.c_[strength - threshold, np.ones(len(x))], (labels == 1).astype(float), weight * len(x), 1.0)[0]
    return QualityModel(quantiles, w, max(float(slope), 1e-3), threshold, at)


def _shapes(bodies: list[bytes]) -> np.ndarray:
    return np.array([shape(body) for body in bodies])


def _labelled_shapes(docs: DataFrame, known: DataFrame, folds: int, text: str) -> DataFrame:
    """doc_id, label, shape of every labelled row: shapes are made where the texts lie, and only they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = pa.array(list(_shapes(column(batch, "body"))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(column(batch, "doc_id"), pa.int64()), values], ["doc_id", "shape"])

    rows = docs.where("doc_id IS NOT NULL").where(fold("doc_id", folds) != 0)
    shapes = rows.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("body")).mapInArrow(run, "doc_id long, shape array<double>")
    return shapes.join(known, "doc_id").select("doc_id", "label", "shape")


def _bucketed(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """(bucket, labels, shapes): all rows dealt into buckets that hold both labels, one row for each bucket.

    Rows of a label too rare for that are in several buckets.
    """
    buckets = -(-max(counts.values()) // BUCKET_ROWS)
    copies = F.lit(1)
    for label, n in counts.items():
        copies = F.when(F.col("label") == label, min(buckets, -(-buckets * LEAST_IN_BUCKET // n))).otherwise(copies)
    dealt = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("doc_id") + F.col("copy"), F.lit(buckets)))

    def pack(table: pa.Table) -> pa.Table:
        found = sorted(zip(table["doc_id"].to_pylist(), table["label"].to_pylist(), table["shape"].to_pylist(), strict=True))
        labels, shapes = np.array([f[1] for f in found], np.int8), np.array([f[2] for f in found], np.float64)
        return pa.table({"bucket": table["bucket"][:1], "labels": pa.array([labels.tobytes()], pa.binary()), "shapes": pa.array([shapes.tobytes()], pa.binary())})

    packed = dealt.select("bucket", "doc_id", "label", "shape").groupBy("bucket").applyInArrow(pack, "bucket long, labels binary, shapes binary")
    return materialize(packed, "quality-buckets")


def _pairs(bucket: int, labels: np.ndarray, least: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Winners and losers of a bucket: every row is in a pair, and there are `least` pairs or more."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels != 1)
    if not len(good) or not len(bad):
        return good[:0], bad[:0]
    draw, n = np.random.default_rng((seed, bucket)), max(len(good), len(bad), least)
    return tuple(np.concatenate([draw.permutation(side) for _ in range(-(-n // len(side)))])[:n] for side in (good, bad))


def _ranked(buckets: DataFrame, steps: np.ndarray, least: int, seed: int = 11, rounds: int = 12) -> np.ndarray:
    """Bradley-Terry weights by Newton steps; gradient and Hessian are sums over all buckets."""
    size = steps.size
    w = np.zeros(size)
    for _ in range(rounds):
        now = w

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grad, hess = np.zeros(size), np.zeros((size, size))
            for batch in slices(batches, 1):
                for bucket, labels, shapes in zip(*(column(batch, c) for c in ("bucket", "labels", "shapes")), strict=True):
                    x = expand(np.frombuffer(shapes).reshape(-1, len(steps)), steps)
                    winners, losers = _pairs(bucket, np.frombuffer(labels, np.int8), least, seed)
                    for at in range(0, len(winners), PAIRS_AT_ONCE):
                        d = x[winners[at : at + PAIRS_AT_ONCE]] - x[losers[at : at + PAIRS_AT_ONCE]]
                        p = 1 / (1 + np.exp(-np.clip(d @ now, -30, 30)))
                        grad += d.T @ (p - 1)
                        hess += (d * (p * (1 - p))[:, None]).T @ d
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([task % PARTS]), pa.array([task]), pa.array([np.append(grad, hess).tobytes()], pa.binary())], ["part", "task", "sums"])

        def added(table: pa.Table) -> pa.Table:
            total = np.sum([np.frombuffer(one) for one in table.sort_by("task")["sums"].to_pylist()], axis=0)
            return pa.table({"part": table["part"][:1], "sums": pa.array([total.tobytes()], pa.binary())})

        # A task has one row of about a megabyte; PARTS of them reach the driver.
        found = buckets.mapInArrow(sums, "part long, task long, sums binary").groupBy("part").applyInArrow(added, "part long, sums binary").collect()
        total = np.sum([np.frombuffer(r["sums"]) for r in sorted(found)], axis=0)
        step = np.linalg.solve(total[size:].reshape(size, size) + RIDGE * np.eye(size), total[:size] + RIDGE * w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _strengths(rows: DataFrame, steps: np.ndarray, w: np.ndarray) -> DataFrame:
    """Each strength with the numbers of rows of both labels that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            if batch.num_rows:
                found = expand(np.array(column(batch, "shape")), steps) @ w
                yield pa.RecordBatch.from_arrays([pa.array(column(batch, "label"), pa.int32()), pa.array(found)], ["label", "strength"])

    found = rows.select("label", "shape").mapInArrow(run, "label int, strength double")
    return materialize(found.groupBy("strength").agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") != 1).alias("bad")), "strengths")


def _threshold(strengths: DataFrame, good: float, bad: float) -> float:
    """The cut between all strengths that errs least, where a row of label 1 below it costs `good`, one of label 0 above it `bad`."""
    low, high = strengths.agg(F.min("strength"), F.max("strength")).first()
    signed = strengths.withColumn("signed", good * F.col("good") - bad * F.col("bad"))
    bucket = F.floor((F.col("strength") - low) / max(high - low, 1e-9) * 1024)
    wrong = F.round("wrong", 12)
    cuts = ordered.running_sum(signed, [], ["strength"], {"signed": "wrong"}, bucket)
    least, best = cuts.agg(F.min(wrong), F.min_by("strength", F.struct(wrong, "strength"))).first()
    if least >= 0:
        return low - 1
    above = strengths.where(F.col("strength") > best).agg(F.min("strength")).first()[0]
    return best if above is None else (best + above) / 2


def _slope(strengths: DataFrame, threshold: float, good: float, bad: float, rounds: int = 12) -> float:
    """Slope of a logistic regression of the label on the strength, over all rows, by Newton steps."""
    w = np.zeros(2)
    x = F.col("strength") - threshold
    for _ in range(rounds):
        z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), x * float(w[0]) + float(w[1])))
        p = 1 / (1 + F.exp(-z))
        miss = F.col("bad") * bad * p - F.col("good") * good * (1 - p)
        curve = (F.col("good") * good + F.col("bad") * bad) * p * (1 - p)
        g0, g1, h00, h01, h11 = strengths.agg(*[F.sum(v) for v in (miss * x, miss, curve * x * x, curve * x, curve)]).first()
        step = np.linalg.solve(np.array([[h00 + 1, h01], [h01, h11 + 1]]), np.array([g0, g1]) + w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0])


def train(docs: DataFrame, labels: DataFrame, at: float = 0.3, folds: int = 5, text: str = "text") -> QualityModel:
    """A model from all labelled rows whose fold is not 0.

    Labels are joined to documents by id; a null id or label is no labelled row. Of an id
    with several labels the largest counts. With one label only, all documents get it.
    Steps, pairs, threshold and slope are those of `fit`, made by Spark over all rows.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(fold("doc_id", folds) != 0)
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("quality") == 1).cast("int").alias("label"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    rows = materialize(_labelled_shapes(docs, known, folds, text), "quality-rows")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n = len(shape(b""))
    if len(counts) < 2:
        return QualityModel(np.zeros((n, STEPS)), np.zeros(n * STEPS), 1.0, 1.0 if 0 in counts else -1.0, at)
    shares = [float(q) for q in np.linspace(0, 1, STEPS + 2)[1:-1]]
    steps = np.array(rows.agg(*[F.percentile_approx(F.get("shape", F.lit(k)), shares, F.lit(ACCURACY)) for k in range(n)]).first(), float)
    buckets = _bucketed(rows, counts)
    w = _ranked(buckets, steps, -(-PAIRS // max(1, -(-max(counts.values()) // BUCKET_ROWS))))
    share = sizes[1] / sum(sizes.values())
    total = sum(counts.values())
    good, bad = share / counts[1], (1 - share) / counts[0]
    strengths = _strengths(rows, steps, w)
    threshold = _threshold(strengths, good, bad)
    return QualityModel(steps, w, max(_slope(strengths, threshold, good * total, bad * total), 1e-3), threshold, at)


def score_documents(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """doc_id and score for each row; null counts as empty, which is scored like any text.

    Rows that repeat are scored each, null ids stay, an empty table gives an empty result,
    and other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = model.score(_shapes(column(batch, "body"))) if batch.num_rows else []
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays([ids, pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("body")).mapInArrow(
        run, "doc_id long, score double"
    )


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, whose score reaches the threshold.

    Null counts as empty; rows that repeat stay or go together; an empty table stays empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            if batch.num_rows:
                bodies = [(body or "").encode("utf-8", "replace") for body in column(batch, text)]
                yield batch.filter(pa.array(model.score(_shapes(bodies)) >= model.at))

    return docs.mapInArrow(run, docs.schema)
