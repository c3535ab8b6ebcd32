"""Toxicity by a convolutional text classifier, trained in numpy.

A word is the sum of the hashed embeddings of itself, its beginnings and its
ends. Filters of ``WIDTHS`` neighbouring words slide over a whole text; of
every filter the ``TOPS`` largest responses are kept (max pooling), and a
logistic unit reads them. Embeddings, filters and unit are trained together by
gradient descent from labelled rows. Training starts from embeddings whose
first number is the log odds of toxic against other texts that hold the
feature, less two standard errors, so that a marker of a few texts counts from
the start and chance finds do not.

Thresholds are set by language on labelled rows that the weights have not
seen, and a text's language is read off its own function words: a score depends
on the text alone. Scores are shifted so that the threshold of every language
lies at ``THRESHOLD``; languages with fewer than ``LEAST`` toxic rows to set
one by share the threshold of all.

All labelled rows train the model. At most ``TOXIC`` and ``OTHERS`` rows of
either kind and ``SAMPLE_BYTES`` of their whole texts are fitted at once. Where
there are more, that net is only the start: the rows are dealt into shards of
about ``SHARD_BYTES``, and in each of ``ROUNDS`` rounds every shard trains the
net in a task of its own and the changes are averaged, those of an embedding
over the shards that changed it. Log odds are counted, and thresholds set, over
all rows; then scores to set thresholds by are rounded to 1 / ``STEPS``.
"""

from __future__ import annotations

import copy
import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.common import bytes_of, map_arrow, record, release, saved, ship, slices, table, text_of

#: Contract of the registered query.
THRESHOLD = 0.7

#: Most rows of either kind, and bytes of their texts, that are fitted at once.
TOXIC, OTHERS, SAMPLE_BYTES = 3_000, 5_000, 48 << 20
#: Bytes of texts that a task trains on at once, and rounds over all of them.
SHARD_BYTES, ROUNDS = 16 << 20, 4
#: Steps to which a score is rounded where thresholds are set over many rows, and the largest score told apart.
STEPS, FARTHEST = 256, 64
#: Toxic rows kept from training that a threshold of a language's own takes.
LEAST = 8

BUCKETS, NUMBERS = 1 << 18, 8
#: Words that a net scores at a time, and bytes that are cut into words at a time.
RUN, PIECE = 50_000, 1 << 20
WIDTHS, FILTERS, TOPS = (1, 2, 3), 8, 3
EPOCHS, BATCH, RATE, DECAY = 6, 64, 0.05, 1e-4
#: Bytes of a word's beginnings and ends that have embeddings of their own.
BEGINNINGS, ENDINGS = (4, 5, 6, 7, 8), (4, 6)
FEATURES = 1 + len(BEGINNINGS) + len(ENDINGS)

# Frequent function words by which a text's language is told.
FUNCTION_WORDS = {
    "en": "the of and to in that is was for with",
    "de": "der die und den von zu das mit sich auf",
    "fr": "le les des et est une dans du pour sur",
    "es": "el los del que y en un las por con",
}
LANGUAGES = [*FUNCTION_WORDS, "other"]

_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt * 0xD6E8FEB86659FD93 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) >> np.uint64(24)


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and the Latin-1 capitals in lower case."""
    out = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:] += capital.astype(np.uint8) * np.uint8(32)
    return out


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to ``n`` of the base and of its inverse."""
    power, unpower = (np.cumprod(np.r_[np.uint64(1), np.full(n, base, np.uint64)]) for base in (_BASE, _UNBASE))
    return power, unpower


@functools.cache
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers_to(PIECE)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    power, unpower = _kept_powers() if n < len(_kept_powers()[0]) else _powers_to(n)
    return power[:n + 1], unpower[:n + 1]


@dataclass(frozen=True)
class Words:
    """Words of some texts: ``at`` numbers the different ones along all texts, ``ends`` bounds each text's
    words, ``hashes`` and ``features`` (buckets, 0 for none) are of the different words."""

    at: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    features: np.ndarray


def words(data: np.ndarray, ends: np.ndarray) -> Words:
    """Runs of letters, digits and bytes beyond ASCII, in lower case."""
    data = lowered(data)
    n = len(data)
    inside = (data >= 0x80) | ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57))
    border = np.zeros(n + 1, bool)
    border[ends] = True
    starts = np.flatnonzero(inside & (np.r_[True, ~inside[:-1]] | border[:-1])) if n else np.zeros(0, np.int64)
    stops = np.flatnonzero(inside & (np.r_[~inside[1:], True] | border[1:])) + 1 if n else np.zeros(0, np.int64)
    # a run's hash is a difference of running sums, divided by the power at its start
    power, unpower = _powers(n)
    sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n])]

    def run(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (sums[b] - sums[a]) * unpower[a]

    hashes, first, at = np.unique(run(starts, stops), return_index=True, return_inverse=True)
    a, b = starts[first], stops[first]
    features = np.zeros((len(first), FEATURES), np.int32)
    features[:, 0] = _mixed(hashes, 1) % np.uint64(BUCKETS - 1) + np.uint64(1)
    parts = [(k, a, a + k) for k in BEGINNINGS] + [(k, b - k, b) for k in ENDINGS]
    for column, (k, u, v) in enumerate(parts, 1):
        longer = b - a > k
        found = _mixed(run(u[longer], v[longer]), column + 1) % np.uint64(BUCKETS - 1) + np.uint64(1)
        features[longer, column] = found
    return Words(at, np.searchsorted(starts, ends), hashes, features)


def words_of(texts: list[bytes]) -> Words:
    """``words`` of many texts, some at a time."""
    parts, first = [], 0
    sizes = np.cumsum([0, *map(len, texts)])
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(sizes, sizes[first] + PIECE, "right")) - 1)
        own = texts[first:last]
        parts.append(words(np.frombuffer(b"".join(own), np.uint8), np.cumsum([0, *map(len, own)])))
        first = last
    hashes, index, back = np.unique(np.concatenate([p.hashes for p in parts]), return_index=True, return_inverse=True)
    shift = np.cumsum([0, *(len(p.hashes) for p in parts)])
    counts = np.concatenate([np.diff(p.ends) for p in parts])
    return Words(np.concatenate([back[p.at + s].astype(np.int32) for p, s in zip(parts, shift)]), np.r_[0, np.cumsum(counts)],
                 hashes, np.concatenate([p.features for p in parts])[index])


def _hash_of(word: str) -> int:
    return int(words(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word.encode())])).hashes[0])


_FUNCTION_HASHES = [np.array([_hash_of(w) for w in FUNCTION_WORDS[k].split()], np.uint64) for k in FUNCTION_WORDS]


def language(w: Words) -> np.ndarray:
    """Number in ``LANGUAGES`` of each text: whose function words it has most of, the last if none."""
    n = len(w.ends) - 1
    text = np.repeat(np.arange(n), np.diff(w.ends))
    counts = np.stack([np.bincount(text, np.isin(w.hashes, own)[w.at], n) for own in _FUNCTION_HASHES], 1)
    return np.where(counts.max(1, initial=0) > 0, counts.argmax(1), len(LANGUAGES) - 1)


#: Words of zeros after every text: enough for the widest filter and for pooling a text without words.
_PAD = max(WIDTHS) - 1 + TOPS


def padded(w: Words, texts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word of each place, -1 where padded; first place of each text; whether a filter may start there)."""
    texts = np.arange(len(w.ends) - 1) if texts is None else texts
    sizes = (w.ends[1:] - w.ends[:-1])[texts]
    starts = np.cumsum(sizes + _PAD) - (sizes + _PAD)
    total = int((sizes + _PAD).sum())
    offset = np.arange(total) - np.repeat(starts, sizes + _PAD)
    real = offset < np.repeat(sizes, sizes + _PAD)
    place = np.full(total, -1, np.int64)
    place[real] = w.at[(np.repeat(w.ends[:-1][texts], sizes + _PAD) + offset)[real]]
    return place, starts, offset < np.repeat(sizes + TOPS, sizes + _PAD)


class Net:
    """Embeddings, filters by width, and the logistic unit."""

    def __init__(self, odds: np.ndarray):
        rng = np.random.default_rng(13)
        self.odds = odds
        self.embedding = rng.normal(0, 0.02, (BUCKETS, NUMBERS)).astype(np.float32)
        self.embedding[:, 0] = odds
        self.embedding[0] = 0
        self.filters = [rng.normal(0, 0.1, (w, NUMBERS, FILTERS)).astype(np.float32) for w in WIDTHS]
        for own in self.filters:
            own[:, 0, 0] += 1 / len(own)
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.unit = rng.normal(0, 0.01, (TOPS, len(WIDTHS) * FILTERS)).astype(np.float32)
        self.unit[:, ::FILTERS] += 0.05
        self.constant = np.float32(-2)

    def vectors(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), NUMBERS), np.float32)
        for column in range(FEATURES):
            out += self.embedding[features[:, column]]
        return out

    def responses(self, v: np.ndarray, valid: np.ndarray) -> np.ndarray:
        """Of every filter at every place; zero or more."""
        behind = np.concatenate([v, np.zeros((max(WIDTHS) - 1, NUMBERS), np.float32)])
        z = np.concatenate([sum(behind[j:j + len(v)] @ own[j] for j in range(len(own))) for own in self.filters], 1)
        return np.maximum(z + self.bias, 0) * valid[:, None]

    def logits(self, w: Words) -> np.ndarray:
        """Of every text, in runs of texts with about ``RUN`` words."""
        n = len(w.ends) - 1
        out, first = np.full(n, float(self.constant)), 0
        # of the different words, and last of a padded place
        vectors = self.vectors(np.concatenate([w.features, np.zeros((1, FEATURES), w.features.dtype)]))
        while first < n:
            last = max(first + 1, int(np.searchsorted(w.ends, w.ends[first] + RUN, "right")) - 1)
            place, starts, valid = padded(w, np.arange(first, min(last, n)))
            tops = largest(self.responses(vectors[place], valid), starts)
            out[first:last] += np.einsum("kdf,kf->d", tops, self.unit)
            first = last
        return out


def largest(z: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ``TOPS`` largest values of each column in each run of rows, falling."""
    return pooled(z, starts)[0]


def pooled(z: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``TOPS`` largest values of each column in each run of rows, falling, and their rows, the first of equal ones.
    No value is negative."""
    columns = z.T.copy()
    every = np.arange(len(columns))
    tops = np.empty((TOPS, len(starts), len(columns)), z.dtype)
    at = np.empty(tops.shape, np.int32)
    for i, (a, b) in enumerate(zip(starts.tolist(), [*starts[1:].tolist(), len(z)])):
        own = columns[:, a:b]
        for k in range(TOPS):
            first = own.argmax(1)
            tops[k, i] = own[every, first]
            at[k, i] = first + a
            own[every, first] = -1
    return tops, at


def log_odds(w: Words, toxic: np.ndarray) -> np.ndarray:
    """By bucket: log odds of toxic against other texts that hold it, two standard errors nearer to zero."""
    return odds_of(*held_by(w, toxic), (toxic == 0).sum(), toxic.sum())


def held_by(w: Words, toxic: np.ndarray) -> list[np.ndarray]:
    """By bucket: how many of the other texts, and of the toxic ones, hold it."""
    text = np.repeat(np.arange(len(toxic)), np.diff(w.ends))
    own = np.unique(text * len(w.hashes) + w.at)   # different words of a text
    text, word = own // max(1, len(w.hashes)), own % max(1, len(w.hashes))
    held = [np.zeros(BUCKETS), np.zeros(BUCKETS)]
    for kind in (0, 1):
        own_kind = toxic[text] == kind
        for column in range(FEATURES):
            pairs = np.sort(text[own_kind] * BUCKETS + w.features[word[own_kind], column])
            pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]][:len(pairs)]]
            held[kind] += np.bincount(pairs % BUCKETS, minlength=BUCKETS)
    return held


def odds_of(in_others: np.ndarray, in_toxic: np.ndarray, others: int, toxic: int) -> np.ndarray:
    n, p = in_others + 0.5, in_toxic + 0.5
    odds = np.log(p / (toxic + 1)) - np.log(n / (others + 1))
    sure = np.maximum(0, np.abs(odds) - 2 * np.sqrt(1 / p + 1 / n))
    return (np.sign(odds) * sure).astype(np.float32)


def train(w: Words, toxic: np.ndarray, rows: np.ndarray) -> Net:
    """A net fitted to the texts ``rows``."""
    chosen = Words(*_texts(w, rows))
    net = Net(log_odds(chosen, toxic[rows]))
    descend(net, chosen, toxic[rows], EPOCHS, weight_of((toxic[rows] == 0).sum(), toxic[rows].sum()))
    return net


def weight_of(others: int, toxic: int) -> float:
    """What a toxic text counts in training, against another one."""
    return min(4.0, max(1.0, others / max(1, toxic)))


def descend(net: Net, chosen: Words, toxic: np.ndarray, epochs: int, heavy: float) -> None:
    """Train ``net`` on all texts; each step follows the gradient, scaled by the root of its past squares."""
    parts = [net.embedding, *net.filters, net.bias, net.unit]
    squares = [np.full(p.shape, 0.1, np.float32) for p in parts]
    # a last row for padded places, which have no features
    every = np.concatenate([chosen.features, np.zeros((1, FEATURES), np.int32)])
    own_row = np.empty(len(every), np.int32)
    constant_squares = 0.1
    rng = np.random.default_rng(17)
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(toxic)), max(1, len(toxic) // BATCH)):
            y = toxic[batch]
            place, starts, valid = padded(chosen, batch)
            here = np.zeros(len(every), bool)
            here[place] = True
            kinds = np.flatnonzero(here)   # each different word has its vector summed once
            own_row[kinds] = np.arange(len(kinds))
            v = net.vectors(every[kinds])[own_row[place]]
            tops, at = pooled(net.responses(v, valid), starts)
            z = np.einsum("kdf,kf->d", tops, net.unit) + net.constant
            d = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * np.where(y == 1, heavy, 1) / len(y)).astype(np.float32)
            into = d[None, :, None] * net.unit[:, None, :] * (tops > 0)
            slopes = [None, *[np.zeros_like(f) for f in net.filters], into.sum((0, 1)),
                      np.einsum("d,kdf->kf", d, tops) + DECAY * net.unit]
            touched, pulls = [], []
            behind = np.concatenate([v, np.zeros((max(WIDTHS) - 1, NUMBERS), np.float32)])
            for i, own in enumerate(net.filters):
                columns = slice(i * FILTERS, (i + 1) * FILTERS)
                g, p = into[:, :, columns].reshape(-1, FILTERS), at[:, :, columns].reshape(-1, FILTERS)
                for j in range(len(own)):
                    slopes[1 + i][j] = np.einsum("nf,nfe->ef", g, behind[p + j])
                    live = g != 0
                    touched.append((p + j)[live])
                    pulls.append((g[:, :, None] * own[j].T[None])[live])
                slopes[1 + i] += DECAY * own
            where, pull = np.concatenate(touched), np.concatenate(pulls)
            places, back = np.unique(where, return_inverse=True)
            by_place = np.zeros((len(places), NUMBERS), np.float32)
            np.add.at(by_place, back, pull)
            there = places < len(place)
            buckets = every[place[places[there]]]
            ids, slot = np.unique(buckets, return_inverse=True)
            moved = np.zeros((len(ids), NUMBERS), np.float32)
            np.add.at(moved, slot.ravel(), np.repeat(by_place[there], FEATURES, axis=0))
            moved[ids == 0] = 0
            squares[0][ids] += moved ** 2
            net.embedding[ids] -= RATE * moved / np.sqrt(squares[0][ids])
            for part, square, slope in zip(parts[1:], squares[1:], slopes[1:]):
                square += slope ** 2
                part -= RATE * slope / np.sqrt(square)
            constant_squares += float(d.sum()) ** 2
            net.constant = np.float32(net.constant - RATE * d.sum() / np.sqrt(constant_squares))


def _texts(w: Words, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of some texts, as the fields of ``Words``."""
    sizes = (w.ends[1:] - w.ends[:-1])[rows]
    ends = np.r_[0, np.cumsum(sizes)]
    at = w.at[np.arange(ends[-1]) + np.repeat(w.ends[:-1][rows] - ends[:-1], sizes)]
    return at, ends, w.hashes, w.features


def threshold(z: np.ndarray, toxic: np.ndarray, times: np.ndarray | None = None) -> float:
    """The middle of the widest gap among those cuts that misjudge the smallest shares of both kinds together.

    ``times``: how many rows each score stands for.
    """
    order = np.argsort(z, kind="stable")
    times = np.ones(len(z), np.int64) if times is None else times[order]
    z, toxic = z[order], toxic[order]
    bad, good = times * (toxic == 1), times * (toxic == 0)
    missed = np.r_[0, np.cumsum(bad)] / max(1, bad.sum())
    wrong = 1 - np.r_[0, np.cumsum(good)] / max(1, good.sum())
    cost = missed + wrong
    # a cut lies between two rows; beyond the ends it lies one away
    low, high = np.r_[z[0] - 2, z], np.r_[z, z[-1] + 2]
    between = np.flatnonzero(high > low)   # not among equal scores
    best = between[cost[between] <= cost[between].min() + 1e-12]
    widest = best[np.argmax((high - low)[best])]
    return float((low[widest] + high[widest]) / 2)


@dataclass(frozen=True)
class Model:
    net: Net | None
    thresholds: np.ndarray

    def score(self, w: Words) -> np.ndarray:
        """Toxicity from 0 to 1 of each text."""
        if self.net is None:
            return np.full(len(w.ends) - 1, 0.5)
        z = self.net.logits(w) - self.thresholds[language(w)] + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(texts: list[bytes], toxic: np.ndarray) -> Model:
    """A model from whole texts and their labels; with labels of one kind only every text scores 0.5.

    Every fourth text of either kind sets thresholds and is not trained on.
    """
    kinds = np.unique(toxic)
    if len(kinds) < 2:
        return Model(None, np.zeros(len(LANGUAGES)))
    w = words_of(texts)
    apart = set_apart(toxic)
    if len(np.unique(toxic[apart])) < 2:
        apart = np.zeros(len(toxic), bool)
    net = train(w, toxic, np.flatnonzero(~apart))
    judge = np.flatnonzero(apart) if apart.any() else np.arange(len(toxic))
    return Model(net, thresholds(net.logits(Words(*_texts(w, judge))), toxic[judge], language(w)[judge],
                                 np.ones(len(judge), np.int64)))


def set_apart(toxic: np.ndarray) -> np.ndarray:
    """Every fourth text of either kind."""
    number = np.zeros(len(toxic), np.int64)
    for kind in np.unique(toxic):
        number[toxic == kind] = np.arange((toxic == kind).sum())
    return number % 4 == 3


def thresholds(z: np.ndarray, toxic: np.ndarray, spoken: np.ndarray, times: np.ndarray) -> np.ndarray:
    """By language; ``times`` as for ``threshold``."""
    cuts = np.full(len(LANGUAGES), threshold(z, toxic, times))
    for k in range(len(LANGUAGES)):
        own = spoken == k
        if min(times[own & (toxic == 1)].sum(), times[own & (toxic == 0)].sum()) >= LEAST:
            cuts[k] = threshold(z[own], toxic[own], times[own])
    return cuts


def _flat(net: Net) -> np.ndarray:
    """All that is trained, in rows of ``NUMBERS``: the embeddings first."""
    rest = np.concatenate([*[f.ravel() for f in net.filters], net.bias, net.unit.ravel(), [net.constant]])
    rest = np.r_[rest, np.zeros(-len(rest) % NUMBERS)].astype(np.float32)
    return np.concatenate([net.embedding, rest.reshape(-1, NUMBERS)])


def _moved(net: Net, change: np.ndarray) -> None:
    """Add a change in the form of ``_flat``."""
    net.embedding += change[:BUCKETS]
    rest, at = change[BUCKETS:].ravel(), 0
    for part in (*net.filters, net.bias, net.unit):
        part += rest[at:at + part.size].reshape(part.shape)
        at += part.size
    net.constant = np.float32(net.constant + rest[at])


def _shard_of(rows: pa.Table) -> tuple[Words, np.ndarray]:
    """The texts of a shard, in an order of their own, and whether they are toxic."""
    rows = rows.sort_by([("h", "ascending"), ("id", "ascending")])
    return words_of([t.encode() for t in rows["text"].to_pylist()]), rows["y"].to_numpy().astype(np.int64)


def carried_on(start: Model | None, rows: DataFrame) -> Model:
    """``start`` trained further on ``rows(id, h, y, text, apart, shard)``, whose ``apart`` ones set the thresholds."""
    counts = {(r["apart"], r["y"]): r["n"] for r in rows.groupBy("apart", "y").agg(F.count("*").alias("n")).collect()}
    if not any(y for _, y in counts) or all(y for _, y in counts):
        return Model(None, np.zeros(len(LANGUAGES)))
    learnt = rows.where(~F.col("apart")) if counts.get((False, 0)) and counts.get((False, 1)) else rows
    judging = rows.where("apart") if counts.get((True, 0)) and counts.get((True, 1)) else rows
    others, toxic = (sum(n for (apart, y), n in counts.items() if y == k and (learnt is rows or not apart)) for k in (0, 1))
    ship(rows.sparkSession)

    def count(shard: pa.Table) -> pa.Table:
        in_others, in_toxic = held_by(*_shard_of(shard))
        at = np.flatnonzero(in_others + in_toxic)
        return pa.table({"key": at, "n": in_others[at].astype(np.int64), "p": in_toxic[at].astype(np.int64)})

    found = (learnt.groupBy("shard").applyInArrow(count, "key long, n long, p long")
             .groupBy("key").agg(F.sum("n").alias("n"), F.sum("p").alias("p")).toArrow())   # BUCKETS rows at most
    held = np.zeros((2, BUCKETS))
    held[:, found["key"].to_numpy()] = found["n"].to_numpy(), found["p"].to_numpy()
    release(rows.sparkSession)
    odds = odds_of(*held, others, toxic)
    net = start.net if start and start.net else Net(odds)
    # the odds of all rows in the place of those that the start began with; what it learnt besides stays
    net.embedding[1:, 0] += (odds - net.odds)[1:]
    net.odds = odds
    names = [f"c{i}" for i in range(NUMBERS)]

    def step(shard: pa.Table) -> pa.Table:
        own = copy.deepcopy(net)
        descend(own, *_shard_of(shard), 1, weight_of(others, toxic))
        change = _flat(own) - _flat(net)
        at = np.flatnonzero((change != 0).any(1) | (np.arange(len(change)) >= BUCKETS))
        return pa.table({"key": at} | {c: change[at, i].astype(np.float64) for i, c in enumerate(names)})

    for _ in range(ROUNDS):
        got = (learnt.groupBy("shard").applyInArrow(step, "key long, " + ", ".join(f"{c} double" for c in names))
               .groupBy("key").agg(*[F.avg(c).alias(c) for c in names]).toArrow())   # the net's own size at most
        change = np.zeros(_flat(net).shape, np.float32)
        change[got["key"].to_numpy()] = np.stack([got[c].to_numpy() for c in names], 1)
        _moved(net, change)
        release(rows.sparkSession)   # a round shuffles all texts

    schema = pa.schema([("cell", pa.int32()), ("spoken", pa.int32()), ("y", pa.int32())])

    def judge(batches):
        for batch in slices(batches, limit=1 << 20):
            w = words(*bytes_of(batch.column("text")))
            cell = np.floor(np.clip(net.logits(w), -FARTHEST, FARTHEST) * STEPS)
            yield record(schema, cell.astype(np.int32), language(w).astype(np.int32), batch.column("y"))

    cells = (map_arrow(judging.select("text", "y"), judge, "cell int, spoken int, y int")
             .groupBy("cell", "spoken", "y").agg(F.count("*").alias("n")).toArrow())   # bounded by the steps
    cell, spoken, y, n = (cells[c].to_numpy() for c in ("cell", "spoken", "y", "n"))
    return Model(net, thresholds((cell + 0.5) / STEPS, y, spoken, n))


def learn(docs: DataFrame, labels: DataFrame, held_out: Column) -> Model:
    """A model from ``labels(doc_id, toxic)``, without the rows where ``held_out`` holds.

    All of them are used. Of each kind, the rows with the smallest hashes of
    doc_id are fitted first, up to the bounds of one fit; if there are more, all
    train the net further. Texts that come twice are used once. If a doc_id has
    several labels the highest holds; rows without doc_id or label are not
    used. Only doc_id and text are read of ``docs``.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("y")))
    # rows that are never used are left out here, before their texts would be shuffled
    docs = docs.where(F.col("doc_id").isNotNull() & ~held_out)
    ids = (docs.select(F.col("doc_id").cast("long").alias("id"), F.octet_length(text_of()).alias("size"))
           .groupBy("id").agg(F.max("size").alias("size")))
    ids = saved(ids.join(known, "id").withColumn("h", F.xxhash64(F.lit(13), "id")), "training-ids")
    order, chosen = ["h", "id"], []
    for kind, most in ((1, TOXIC), (0, OTHERS)):
        rows = ids.where(F.col("y") == kind).orderBy(*order).limit(most).toArrow()
        fits = np.cumsum(rows["size"].to_numpy()) <= SAMPLE_BYTES // 2
        chosen += rows.filter(pa.array(fits)).select(["id", "h", "y"]).to_pylist()
    spark = docs.sparkSession
    picked = spark.createDataFrame([(r["id"], r["h"], r["y"]) for r in chosen], "id long, h long, y int")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_of().alias("text")).join(F.broadcast(picked), "id")
    texts = texts.groupBy("id", "h", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    got = texts.toArrow().sort_by([("h", "ascending"), ("id", "ascending")])
    unlike, first = {}, {}
    for text, y, own in zip(got["text"].to_pylist(), got["y"].to_pylist(), got["id"].to_pylist()):
        unlike[text] = max(y, unlike.get(text, 0))
        first.setdefault(text, own)
    toxic = np.array([*unlike.values()], np.int64)
    start = fit([t.encode() for t in unlike], toxic)
    rows, size = ids.agg(F.count("*"), F.sum("size")).first()
    if rows == len(chosen):
        return start
    # what the start was trained on sets no thresholds
    told = spark.createDataFrame(list(zip(first.values(), set_apart(toxic).tolist())), "id long, told boolean")
    shards = -(-size // SHARD_BYTES)
    # digests tell which rows train, so that texts are shuffled once here and only those that train are written
    told_by = docs.select(F.col("doc_id").cast("long").alias("id"), F.sha2(text_of(), 256).alias("digest"),
                          F.xxhash64(text_of()).alias("order"))
    training = (told_by.join(ids, "id").groupBy("id", "h", "y").agg(F.min_by("digest", "order").alias("digest"))
                .groupBy("digest").agg(F.min(F.struct("h", "id")).alias("first"), F.max("y").alias("y"))
                .select("first.*", "y", "digest").join(F.broadcast(told), "id", "left")
                .select("id", "digest", "h", "y",
                        F.coalesce("told", F.pmod(F.xxhash64(F.lit(4), "id"), F.lit(4)) == 3).alias("apart"),
                        F.pmod("h", F.lit(max(1, shards))).alias("shard")))
    training = saved(training, "training-rows")
    release(spark)
    # a row may come twice, with the same text; grouped as joined, texts are neither shuffled nor sorted again
    every = (docs.select(F.col("doc_id").cast("long").alias("id"), F.sha2(text_of(), 256).alias("digest"),
                         text_of().alias("text")).join(training, ["id", "digest"])
             .groupBy("id", "digest").agg(*[F.any_value(c).alias(c) for c in ("h", "y", "text", "apart", "shard")])
             .select("id", "h", "y", "text", "apart", "shard"))
    every = saved(every, "training-texts")
    release(spark)
    return carried_on(start, every)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs(doc_id, text)`` as (doc_id, score, predicted); the score reads the whole text only."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def kernel(batches):
        for batch in slices(batches, limit=1 << 20):
            s = model.score(words(*bytes_of(batch.column("text"))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return map_arrow(rows, kernel, "doc_id long, score double, predicted int")


def held_out_fold(doc_id: Column) -> Column:
    """The rows that the registered query never learns from (null doc_id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: doc_id, held_out, score, predicted.

    Null text counts as empty and is scored like any other; rows without
    doc_id are scored and not held out; repeated rows give repeated rows. Other
    columns, labels, lang and source among them, are never inputs of a score.
    """
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"), held_out_fold(F.col("doc_id")))
    return scored(docs, model).select("doc_id", held_out_fold(F.col("doc_id")).alias("held_out"), "score", "predicted")
