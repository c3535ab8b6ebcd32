"""Quality classifier by positive-unlabelled learning.

A linear model on text-shape features is trained by minimising the
non-negative unbiased risk: with class prior p, positives P and unlabelled
text U, the risk is  p * mean_P loss(+) + max(0, mean_U loss(-) - p * mean_P
loss(-)).  Negative labels are not used for training. The prior is estimated
from the data: a first model that tells P from U is applied to held-back
positives and unlabelled rows, and the prior is the smallest ratio, over
thresholds, of the share of U to the share of P above the threshold (with the
sampling error of the shares added), since U holds at least the positives'
part.

Features are computed by the task that reads a text, over all its bytes; only
the training sample, bounded by ``SAMPLE`` rows of each kind, is gathered.
Scores are calibrated so that a share of about ``KEPT_POSITIVES`` of positives
lies above the threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.common import bytes_of, map_arrow, saved, slices, table, text_of

#: Contract of the registered query.
THRESHOLD = 0.7

#: Most rows of positives, and of unlabelled rows, that a model is fitted on.
SAMPLE = 8_000
#: Share of positives that the calibration aims to keep.
KEPT_POSITIVES = 0.995
#: Room below that share's score, as a part of its distance from the median positive.
MARGIN = 0.5

STEPS, RATE, DECAY = 300, 0.05, 1e-4

#: Byte classes: lower, upper, digit, space, line end, beyond ASCII, and kinds of punctuation.
CLASSES = 16
_STOPS, _QUOTES, _JOINS, _MARKS, _BARS, _BRACKETS = b".,;:", b"'\"`", b"-_/\\", b"!?", b"|<>=+~^", b"()[]{}"
_LINE_HASH = np.uint64(0x9E3779B97F4A7C15)


def _class_table() -> np.ndarray:
    kind = np.full(256, 15, np.uint8)
    kind[:32], kind[127], kind[128:] = 14, 14, 5
    kind[ord("a"):ord("z") + 1], kind[ord("A"):ord("Z") + 1], kind[ord("0"):ord("9") + 1] = 0, 1, 2
    kind[[9, 11, 12, 13, 32]], kind[10] = 3, 4
    for k, group in enumerate((_STOPS, _QUOTES, _JOINS, _MARKS, _BARS, _BRACKETS, b"#*", b"$%&@"), 6):
        kind[list(group)] = k
    return kind


_KIND = _class_table()
#: Numbers of a text: shares of class pairs, then shape, then its weight (see ``features``).
SHAPE = 8
WIDTH = CLASSES * CLASSES + SHAPE + 1
#: Bytes of text at which its numbers count for half of what they say.
HALF_WEIGHT = 60


def features(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row of ``WIDTH`` numbers per text, over all its bytes.

    Root shares of its pairs of neighbouring byte classes; logarithm of its
    mean word length; share of words that begin a line; share of upper case
    among letters; shares of words that repeat the word before, of words of up
    to three bytes, and of different words among the root of all; share of
    lines that repeat an earlier line; one if there is no word. Last, the
    weight from 0 to 1 that a text of its length carries.
    """
    n = len(ends) - 1
    sizes = np.diff(ends)
    kind = _KIND[data].astype(np.int64)
    owner = np.repeat(np.arange(n), sizes)
    inside = owner[1:] == owner[:-1]
    pairs = (owner[:-1] * CLASSES * CLASSES + kind[:-1] * CLASSES + kind[1:])[inside]
    shares = np.bincount(pairs, minlength=n * CLASSES * CLASSES).reshape(n, -1)
    out = np.zeros((n, WIDTH), np.float32)
    out[:, :CLASSES * CLASSES] = np.sqrt(shares / np.maximum(1, sizes - 1)[:, None])

    def per_text(at: np.ndarray) -> np.ndarray:
        return np.bincount(at, minlength=n)

    blank = (kind == 3) | (kind == 4)
    begins = np.flatnonzero(~blank & np.r_[True, blank[:-1] | ~inside]) if len(kind) else np.zeros(0, np.int64)
    owners, hashes, lengths = owner[begins], _hashed(data, begins, ~blank), _lengths(begins, blank, len(data), ends)
    words = np.maximum(1, per_text(owners))
    letters, upper = np.maximum(1, per_text(owner[kind <= 1])), per_text(owner[kind == 1])
    same = np.r_[False, (hashes[1:] == hashes[:-1]) & (owners[1:] == owners[:-1])] if len(begins) else owners
    shape = [
        np.log1p(np.bincount(owners, lengths, n) / words),
        (per_text(owner[kind == 4]) + 1) / words,
        upper / letters,
        per_text(owners[same.astype(bool)]) / words,
        per_text(owners[lengths <= 3]) / words,
        per_text(owners) - _repeats(owners, hashes, n),
        _repeated_lines(data, kind, owner, ends),
        per_text(owners) == 0,
    ]
    shape[5] = shape[5] / words ** 0.8
    out[:, CLASSES * CLASSES:-1] = np.stack(shape, 1)
    out[:, -1] = sizes / (sizes + HALF_WEIGHT)
    out[shape[7], -1] = 1
    return out


def _hashed(data: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit sum for each run of bytes from one of ``begins`` to the next; only bytes that count."""
    if not len(begins):
        return np.zeros(0, np.uint64)
    place = np.arange(len(data), dtype=np.uint64)
    place[begins[0]:] -= np.repeat(begins, np.diff(np.r_[begins, len(data)])).astype(np.uint64)
    letter = (data.astype(np.uint64) + np.uint64(1)) * ((place + np.uint64(1)) * _LINE_HASH | np.uint64(1))
    return np.add.reduceat(np.where(counts, letter ^ (letter >> np.uint64(29)), np.uint64(0)), begins)


def _lengths(begins: np.ndarray, blank: np.ndarray, n: int, ends: np.ndarray) -> np.ndarray:
    """Bytes of each word that begins at ``begins``: up to the next blank or the text's end."""
    if not len(begins):
        return np.zeros(0, np.int64)
    stops = np.union1d(np.flatnonzero(blank), np.r_[ends[1:], n])
    return stops[np.searchsorted(stops, begins, "right")] - begins


def _repeats(owners: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """How many entries of each owner repeat an earlier one of it."""
    order = np.lexsort((hashes, owners))
    o, h = owners[order], hashes[order]
    again = (o[1:] == o[:-1]) & (h[1:] == h[:-1])
    return np.bincount(o[1:][again], minlength=n)


def _repeated_lines(data: np.ndarray, kind: np.ndarray, owner: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Share of a text's lines, of 20 bytes or more, that repeat an earlier line of it."""
    n = len(ends) - 1
    if not len(data):
        return np.zeros(n)
    starts = np.union1d(np.flatnonzero(kind[:-1] == 4) + 1, ends[:-1][np.diff(ends) > 0])
    hashes = _hashed(data, starts, kind != 4)
    long_ = np.diff(np.r_[starts, len(data)]) >= 20
    owners = owner[starts][long_]
    return _repeats(owners, hashes[long_], n) / np.maximum(1, np.bincount(owners, minlength=n))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    shift: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Quality from 0 to 1."""
        return _sigmoid(_standard(x, self.mean, self.scale) @ self.weights + self.bias + self.shift)


def _descend(gradient, width: int) -> np.ndarray:
    """Adam from zero on ``gradient(weights)``; the last entry is the bias."""
    w, m, v = (np.zeros(width + 1, np.float32) for _ in range(3))
    for t in range(1, STEPS + 1):
        g = (gradient(w) + DECAY * np.r_[w[:-1], 0]).astype(np.float32)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Distances from the usual text in its spreads, less for short texts, which tell little."""
    return (x[:, :-1] - mean) / scale * x[:, -1:]


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.c_[x, np.ones(len(x), x.dtype)]


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives in ``unlabelled``, from scores of rows held back from the scorer."""
    p, u = np.sort(positive), np.sort(unlabelled)
    cuts = np.quantile(p, np.linspace(0, 0.9, 91))
    share_p = 1 - np.searchsorted(p, cuts) / len(p)
    share_u = 1 - np.searchsorted(u, cuts) / len(u)
    error = np.sqrt(share_u * (1 - share_u) / len(u) + (share_u / share_p) ** 2 * share_p * (1 - share_p) / len(p))
    return float(np.clip(((share_u + error) / share_p).min(), 0.05, 0.95))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """A model from features of trusted positives and of unlabelled rows.

    Without positives, or without unlabelled rows, every text scores 0.5.
    """
    width = positive.shape[1] - 1
    both = np.concatenate([positive, unlabelled])[:, :-1]
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 0.0, 0.5)
    # features are single precision, which is exact enough for sums over a sample
    mean, scale = both.mean(0), both.std(0) + np.float32(1e-3)
    p, u = (_with_one(_standard(x, mean, scale)) for x in (positive, unlabelled))

    # the prior: tell P from U on even rows, compare the scores of the odd ones
    pe, ue = p[::2], u[::2]
    telling = _descend(lambda w: -((1 - _sigmoid(pe @ w)) @ pe) / len(pe) / 2 + (_sigmoid(ue @ w) @ ue) / len(ue) / 2, width)
    prior = class_prior(p[1::2] @ telling, u[1::2] @ telling) if len(p) > 1 and len(u) > 1 else 0.5

    def gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = p @ w, u @ w
        plus = -((1 - _sigmoid(zp)) @ p) / len(p)
        minus = (_sigmoid(zu) @ u) / len(u) - prior * (_sigmoid(zp) @ p) / len(p)
        risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        # where the estimate of the negative part falls below 0, step back up
        return prior * plus + minus if risk >= 0 else -minus

    w = _descend(gradient, width)
    # calibration: a share of KEPT_POSITIVES of the positives lies above the threshold
    # with room for what the model makes of positives it has not seen
    low, middle = np.quantile(p @ w, [1 - KEPT_POSITIVES, 0.5])
    shift = np.log(THRESHOLD / (1 - THRESHOLD)) - (low - MARGIN * (middle - low))
    return Model(mean, scale, w[:-1], float(w[-1]), float(shift), prior)


def _stream(name: str = "text"):
    """A kernel's (batch, features) in runs of bounded size."""
    def runs(batches):
        for batch in slices(batches, name, 1 << 20):
            yield batch, features(*bytes_of(batch.column(name).fill_null("")))
    return runs


def sample_features(rows: DataFrame) -> np.ndarray:
    """Features of a bounded sample, in the order of its hash."""
    runs = _stream()

    def kernel(batches):
        for batch, x in runs(batches):
            yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array(list(x), pa.list_(pa.float32()))], ["h", "x"])

    got = map_arrow(rows.select("h", text_of().alias("text")), kernel, "h long, x array<float>").toArrow()
    got = got.sort_by("h")
    return got["x"].combine_chunks().flatten().to_numpy().reshape(-1, WIDTH)


def learn(docs: DataFrame, labels: DataFrame, held_out: Column) -> Model:
    """A model from ``labels(doc_id, quality)``, without the rows where ``held_out`` holds.

    Positives are rows labelled 1. Unlabelled are rows of any label or none,
    whose label is not looked at, so that they are spread like the whole table,
    as the risk and the prior assume. Of each at most ``SAMPLE`` rows, those
    with the smallest hashes of doc_id, are used.
    Rows without doc_id are never used.
    """
    known = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.col("quality").cast("int")).alias("__quality")))
    # only doc_id is read to choose the sample; the texts of chosen rows are read after
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull() & ~held_out).distinct()
    ids = saved(ids.join(known, "doc_id", "left").withColumn("h", F.xxhash64(F.lit(8), "doc_id")), "training-ids")
    positive = ids.where("__quality = 1").orderBy("h", "doc_id").limit(SAMPLE)
    unlabelled = ids.orderBy("h", "doc_id").limit(SAMPLE)
    chosen = saved(positive.withColumn("p", F.lit(1)).union(unlabelled.withColumn("p", F.lit(0)))
                   .select(F.col("doc_id").alias("__id"), "h", "p"), "training-sample")
    # of rows with equal doc_id one stands for all, so that the sample stays within its bound
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), "text").join(F.broadcast(chosen), "__id")
    texts = saved(texts.groupBy("__id", "h", "p").agg(F.min_by("text", F.xxhash64("text")).alias("text")), "training-texts")
    return fit(sample_features(texts.where("p = 1")), sample_features(texts.where("p = 0")))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs(doc_id, text)`` as (doc_id, score, predicted); the score reads the whole text only."""
    runs = _stream()
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def kernel(batches):
        for batch, x in runs(batches):
            s = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return map_arrow(rows, kernel, "doc_id long, score double, predicted int")


def held_out_fold(doc_id: Column) -> Column:
    """The rows that the registered query never learns from (null doc_id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text is predicted to be poor; columns as they were."""
    model = learn(docs, labels, held_out_fold(F.col("doc_id")))
    runs = _stream()

    def kernel(batches):
        for batch, x in runs(batches):
            yield batch.filter(pa.array(model.score(x) >= THRESHOLD))

    return map_arrow(docs, kernel, docs.schema)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: doc_id, held_out, score, predicted.

    Null text counts as empty and is scored like any other; rows without
    doc_id are scored and not held out; repeated rows give repeated rows. If a
    doc_id has several labels the highest holds. Other columns, labels, lang
    and source among them, are never inputs of a score.
    """
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"), held_out_fold(F.col("doc_id")))
    return scored(docs, model).select("doc_id", held_out_fold(F.col("doc_id")).alias("held_out"), "score", "predicted")
