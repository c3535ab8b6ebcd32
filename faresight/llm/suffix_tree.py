"""Language-model scores from a probabilistic suffix tree over words.

Symbols are the words of the training texts, an end symbol after each text,
and one symbol for every word that training has not seen. A state of the tree
is a context of any number of symbols (a text's beginning counts as one); levels
are added until no candidate of a level becomes a state. Contexts
that training holds ``FLOOR`` times are candidates, and symbols that follow one
``LEAST`` times are listed, however large the training is; a
candidate becomes a state if its next-symbol distribution diverges from that of
its longest shorter state by more than its own size explains: the log-likelihood
it gains on its counts has to exceed half a logarithm of its count for each
symbol that it lists; from contexts of three symbols on, by the logarithm of the
number of candidates of two symbols too, since of many some gain by chance. Distributions are smoothed with the shorter state's, the
root's by absolute discounting, whose mass is the unseen symbol's. A text is
scored with the longest suffix state at every place.

Data flow: a task cuts its documents into blocks of about ``BLOCK_BYTES`` and
writes each as token numbers with the block's own vocabulary, bucketed by
block. Counts of a vocabulary entry meet by the word's 64-bit hash and go back
to their block, so that what is shuffled is a row per block and word, never a
row per token. Words are counted over all training texts; context counts too,
level by level. The model of up to ``SMALL`` training tokens is sent whole to
the tasks (``learn``). A larger one is nowhere whole (``joined``): for each of
the first levels, each block sends its different pairs of a candidate and a symbol to
buckets by context, where counts of all blocks meet and the test is made; the
counts and what states leave to the shorter one go back to the block, which
knows with them the probabilities that the next level starts from. Frequent
words are sent as numbers of two bytes, probabilities only where they do not
follow from counts, and a symbol that a context has not
listed is no longer counted in the contexts that end with it. The pairs of
contexts with at least ``HEAD_SHARE`` of training, 1 / HEAD_SHARE a level at
most, are dealt to buckets by pair instead, and their test is made on the sums
of all buckets. What a longer context needs is all with those that end alike, so
that from level ``DEEP`` on (``_deep``) each token that is still alive is sent once, with the symbols
before it, to the bucket of its context, which goes on alone for many levels;
tokens that outlive the symbols sent start another round, with four times as many.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.common import bytes_of, give_back, map_arrow, record, release, slices, table, text_of
from faresight.session import delete_path, fresh_path

#: Least count of a context that is a candidate, and of a symbol that is listed after it.
FLOOR, LEAST = 4, 2
#: Training tokens up to which the model is sent whole: at most half as many listed symbols a level.
SMALL = 1_000_000
#: From this share of training on, a context's pairs are spread over all buckets.
HEAD_SHARE = 2e-4
#: Training tokens for each bucket of pairs.
BUCKET_TOKENS = 1_000_000
#: Different pairs, all blocks' together, for each bucket of a level after the first.
BUCKET_PAIRS = 500_000
#: Level from which buckets go on alone, and how often a context may occur then at most. The symbols that they are sent in the
#: first round, four times as many in each round after, and tokens for each bucket.
DEEP, CROWD = 4, 1_000_000
WINDOW, ROUND_ROWS = 10, 200_000
#: Weight, in counts, of the shorter state in a state's distribution.
PRIOR = 20.0

#: Most words that are sent as numbers of two bytes, and the number of all others.
NUMBERED = (1 << 16) - 1

BLOCK_BYTES = 4 << 20

#: Hashes of any symbol that cannot be listed, the end symbol and a text's beginning; words hash to XXH64 with seed 42.
RARE, END, BEGIN = 0, 1, 2

_BLOCK = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
                    ("sizes", pa.list_(pa.int32())), ("tokens", pa.binary()), ("hashes", pa.list_(pa.int64())),
                    ("counts", pa.list_(pa.int32())), ("entries", pa.int64())])
_BLOCK_SQL = ("block long, doc_ids array<long>, held array<boolean>, sizes array<int>, tokens binary, "
              "hashes array<long>, counts array<int>, entries long")


def _is_held(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def _block_kernel(batches):
    """One row per block. Its vocabulary ascends by hash, so that token 0 is the end symbol."""
    for batch in slices(batches, limit=BLOCK_BYTES):
        ids = batch.column(0).to_pylist()
        held = np.array([_is_held(i) for i in ids])
        parts = pc.ascii_split_whitespace(pc.ascii_lower(batch.column(1)))
        flat, ends = parts.flatten(), np.cumsum(pc.list_value_length(parts).to_numpy())
        real = pc.binary_length(flat).to_numpy() > 0    # space at either end leaves an empty part
        sizes = np.diff(np.r_[0, np.cumsum(real)[ends - 1]]).astype(np.int32) + np.int32(1)
        coded = flat.filter(pa.array(real)).dictionary_encode()
        tokens = np.zeros(int(sizes.sum()), np.uint32)
        word = np.ones(len(tokens), bool)
        word[np.cumsum(sizes) - 1] = False
        tokens[word] = coded.indices.to_numpy() + 1
        data, ends = bytes_of(coded.dictionary)
        data, ends = data.tobytes(), ends.tolist()
        learnt = np.bincount(tokens[np.repeat(~held, sizes)], minlength=len(ends))
        hashes = np.fromiter((xxhash.xxh64_intdigest(data[a:b], 42) for a, b in zip([0, *ends], ends)), np.uint64, len(ends))
        hashes[hashes <= BEGIN] += np.uint64(BEGIN + 1)
        hashes[0] = END
        order = np.argsort(hashes)
        entry = np.empty(len(order), np.uint32)
        entry[order] = np.arange(len(order), dtype=np.uint32)
        yield record(_BLOCK, [uuid.uuid4().int >> 65], [ids], [held.tolist()], [sizes], [entry[tokens].tobytes()],
                     [hashes[order].view(np.int64)], [learnt[order].astype(np.int32)], [len(order)])


def _bucketed(parts: Iterable[DataFrame], spark: SparkSession, label: str, buckets: int, placed: bool) -> tuple[DataFrame, str]:
    """``parts`` as one table bucketed by block, so that joins on block read it in place; and its folder.

    ``placed``: rows are few and large and are written from where they are;
    else they are gathered by bucket first. What a part shuffles is freed before the next.
    """
    name = f"{label}_{uuid.uuid4().hex}"
    folder = fresh_path(spark, label)
    for k, df in enumerate(parts):
        if k:
            release(spark)
        rows = df if placed else df.repartition(buckets, "block")
        writer = rows.write.mode("append") if k else rows.write
        writer.bucketBy(buckets, "block").option("path", folder).option("compression", "zstd").saveAsTable(name)
        del df, rows, writer
    return spark.table(name), folder


@dataclass
class Level:
    """States of one context length. ``codes`` ascending; -1 in ``states`` for candidates that failed."""

    codes: np.ndarray
    states: np.ndarray


@dataclass
class Tree:
    """The model. Contexts are coded by frequent words: of length one the word's number, longer
    ones (place of what comes before the last word in its level) * len(words) + number."""

    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))   # hashes of frequent words, ascending
    levels: list[Level] = field(default_factory=list)
    symbols: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # hashes of listed symbols, ascending
    entries: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # state * len(symbols) + symbol, ascending
    logs: np.ndarray = field(default_factory=lambda: np.zeros(0))
    parent: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))   # of each state, -1 the root
    rest: np.ndarray = field(default_factory=lambda: np.zeros(0))               # log weight of the parent for what is not listed


def _find(sorted_: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted number, -1 if absent."""
    if not len(sorted_):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
    return np.where(sorted_[at] == wanted, at, -1)


def _contexts(tree: Tree, tokens: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, depth: int) -> list[np.ndarray]:
    """For each token and each length up to ``depth``, the code of its context, -1 if it is no candidate's."""
    number = _find(tree.words, hashes)
    begin = int(_find(tree.words, np.array([BEGIN]))[0])
    first = np.cumsum(sizes) - sizes
    own = number[tokens]
    one = np.r_[-1, own[:-1]]
    one[first] = begin
    out = [one]
    for level in tree.levels[:depth - 1]:
        before = np.r_[-1, _find(level.codes, out[-1])[:-1]]
        before[first] = -1
        out.append(np.where((one >= 0) & (before >= 0), before * len(tree.words) + one, -1))
    return out


def _rows(batch: pa.RecordBatch):
    """(doc_ids, held, sizes, tokens, hashes, totals) of each block."""
    for i in range(batch.num_rows):
        value = {n: batch.column(n)[i] for n in batch.schema.names}
        hashes = value["hashes"].values.to_numpy(zero_copy_only=False)
        totals = _whole(_told(value["totals"]).field("totals"), np.int64)
        yield (value["doc_ids"].values, value["held"].values.to_numpy(zero_copy_only=False),
               value["sizes"].values.to_numpy(zero_copy_only=False).astype(np.int64),
               np.frombuffer(value["tokens"].as_buffer(), np.uint32).astype(np.int64), hashes, totals)


def _next_counts(blocks: DataFrame, tree: Tree, depth: int, candidates: np.ndarray, least: int) -> pa.Table:
    """(context, symbol, n): how often each candidate context (by place) of this length is
    followed by each symbol in training, of at least ``least`` times."""
    schema = pa.schema([("context", pa.int64()), ("symbol", pa.int64()), ("n", pa.int64())])

    def kernel(batches):
        for batch in batches:
            for _, held, sizes, tokens, hashes, totals in _rows(batch):
                code = _contexts(tree, tokens, sizes, hashes, depth)[depth - 1]
                place = _find(candidates, code)
                use = (place >= 0) & np.repeat(~held, sizes) & (totals[tokens] >= least)
                pair, n = np.unique(place[use] * len(hashes) + tokens[use], return_counts=True)
                yield record(schema, pair // len(hashes), hashes[pair % len(hashes)], n)

    counted = map_arrow(blocks, kernel, "context long, symbol long, n long")
    return (counted.groupBy("context", "symbol").agg(F.sum("n").alias("n")).where(F.col("n") >= least)).toArrow()


def _prob(tree: Tree, roots: dict[int, float], states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Log probability of each symbol hash in each state (-1: the root), for listed symbols."""
    out = np.zeros(len(states))
    open_ = np.arange(len(states))
    states = states.copy()
    number = _find(tree.symbols, symbols)
    while len(open_):
        root = states[open_] < 0
        if root.any():
            out[open_[root]] += [roots[s] for s in symbols[open_[root]].tolist()]
            open_ = open_[~root]
        at = _find(tree.entries, np.where(number[open_] >= 0, states[open_] * len(tree.symbols) + number[open_], -1))
        hit = at >= 0
        out[open_[hit]] += tree.logs[at[hit]]
        open_ = open_[~hit]
        out[open_] += tree.rest[states[open_]]
        states[open_] = tree.parent[states[open_]]
    return out


def _judged(totals: np.ndarray, listed: np.ndarray, n: np.ndarray, mass: np.ndarray, below_mass: np.ndarray,
            gain: np.ndarray, depth: int, candidates: int) -> tuple[np.ndarray, np.ndarray]:
    """Which candidates pass the divergence test, and the log weight of the shorter state for what they do not list.

    ``totals``: how often each occurs. Of its listed symbols: ``listed`` the number, ``n`` the counts,
    ``mass`` and ``below_mass`` the probabilities in it and in the shorter state, ``gain`` the log-likelihood gained.
    ``candidates``: those of two symbols.
    """
    rest = np.log(np.maximum(1 - mass, 1e-12)) - np.log(np.maximum(1 - below_mass, 1e-12))
    cost = 0.5 * np.log(np.maximum(2, totals)) * listed
    if depth > 2:
        # without an end to the levels there are many candidates, some of which gain by chance
        cost = cost + math.log(candidates)
    return (gain + np.maximum(0, totals - n) * rest > cost) & (listed > 0), rest


def _grow(tree: Tree, found: pa.Table, totals: np.ndarray, parents: np.ndarray, roots: dict[int, float],
          codes: np.ndarray, candidates: int) -> Tree:
    """The tree with the candidates that pass the divergence test as states of a new level.

    ``found``: listed symbols of the candidates; ``totals``: how often each
    candidate occurs; ``parents``: their longest shorter states; ``codes``: ascending.
    """
    context, symbol, n = (found[c].to_numpy() for c in ("context", "symbol", "n"))
    order = np.lexsort((symbol, context))
    context, symbol, n = context[order], symbol[order], n[order].astype(np.float64)
    below = np.exp(_prob(tree, roots, parents[context], symbol))
    smooth = (n + PRIOR * below) / (totals[context] + PRIOR)
    listed = np.bincount(context, minlength=len(codes))
    mass, below_mass = np.bincount(context, smooth, len(codes)), np.bincount(context, below, len(codes))
    kept, rest = _judged(totals, listed, np.bincount(context, n, len(codes)), mass, below_mass,
                         np.bincount(context, n * (np.log(smooth) - np.log(below)), len(codes)),
                         len(tree.levels) + 1, candidates)
    first = len(tree.parent)
    states = np.where(kept, first + np.cumsum(kept) - 1, -1)
    use = kept[context]
    symbols = np.union1d(tree.symbols, symbol[use])
    old = tree.entries // max(1, len(tree.symbols)) * len(symbols) + np.searchsorted(
        symbols, tree.symbols[tree.entries % max(1, len(tree.symbols))]) if len(tree.entries) else tree.entries
    new = states[context[use]] * len(symbols) + np.searchsorted(symbols, symbol[use])
    return Tree(tree.words, [*tree.levels, Level(codes, states)], symbols, np.r_[old, new],
                np.r_[tree.logs, np.log(smooth[use])], np.r_[tree.parent, parents[kept]], np.r_[tree.rest, rest[kept]])


def _states(tree: Tree, contexts: list[np.ndarray]) -> np.ndarray:
    """The longest suffix state at each place, -1 the root."""
    state = np.full(len(contexts[0]) if contexts else 0, -1, np.int64)
    for level, code in zip(tree.levels, contexts):
        at = _find(level.codes, code)
        own = np.where(at >= 0, level.states[np.maximum(at, 0)] if len(level.states) else -1, -1)
        state = np.where(own >= 0, own, state)
    return state


@dataclass(frozen=True)
class Root:
    """Symbol counts of training: tokens, different symbols, and the discount."""

    tokens: int
    kinds: int
    discount: float

    def log(self, total: np.ndarray) -> np.ndarray:
        """Log probability of symbols by their counts; 0 stands for the unseen symbol."""
        if not self.tokens:
            return np.zeros(len(total))
        unseen = self.discount * self.kinds / self.tokens
        return np.log(np.where(total > 0, (total - self.discount) / self.tokens, unseen))

    def base_log10(self, total: np.ndarray) -> np.ndarray:
        return np.log10((total + 0.1) / (self.tokens + 0.1 * (self.kinds + 1)))


def root_of(words: DataFrame) -> Root:
    """``words``: (hash, total) of all symbols."""
    tokens, kinds, ones, twos = words.where("total > 0").agg(
        F.coalesce(F.sum("total"), F.lit(0)), F.count("*"), F.count(F.when(F.col("total") == 1, 1)),
        F.count(F.when(F.col("total") == 2, 1))).first()
    return Root(tokens, kinds, ones / (ones + 2 * twos) if ones and twos else 0.5)


def learn(blocks: DataFrame, words: DataFrame, root: Root) -> Tree:
    """The tree, whole. ``blocks`` with totals by vocabulary entry; ``words`` as for ``root_of``."""
    seen = words.where("total > 0")
    frequent = seen.where(F.col("total") >= FLOOR).toArrow()
    counts = dict(zip(frequent["hash"].to_pylist(), frequent["total"].to_pylist()))
    counts[BEGIN] = counts.pop(END, 0)  # as a context, the beginning stands for the end before it
    tree = Tree(words=np.sort(np.array([h for h, n in counts.items() if n >= FLOOR], np.int64)))
    if not len(tree.words):
        return tree
    codes = np.arange(len(tree.words))
    totals = np.array([counts[h] for h in tree.words.tolist()], np.int64)
    roots: dict[int, float] = {}
    # of each candidate: its place without the first symbol, and the longest shorter state
    suffix, below = np.full(len(codes), -1, np.int64), np.full(len(codes), -1, np.int64)
    candidates = 0
    while len(codes):
        depth = len(tree.levels) + 1
        found = _next_counts(blocks, tree, depth, codes, LEAST)
        new = np.setdiff1d(np.unique(found["symbol"].to_numpy()), np.array(list(roots), np.int64))
        if len(new):
            listed = words.sparkSession.createDataFrame(pa.table({"hash": new}))
            got = seen.join(listed, "hash").toArrow()
            roots.update(zip(got["hash"].to_pylist(), root.log(got["total"].to_numpy()).tolist()))
        candidates = len(codes) if depth == 2 else candidates
        grown = _grow(tree, found, totals, below, roots, codes, candidates)
        states = grown.levels[-1].states
        if depth > 1 and not (states >= 0).any():
            break
        tree = grown
        # contexts that are one longer: a context and a frequent word that follows it
        after = _find(tree.words, found["symbol"].to_numpy())
        n = found["n"].to_numpy()
        use = (after >= 0) & (n >= FLOOR)
        before, after, n = found["context"].to_numpy()[use], after[use], n[use]
        order = np.lexsort((after, before))
        before, after, totals = before[order], after[order], n[order]
        last, longer = codes, before * len(tree.words) + after
        # a context without its first symbol occurs as often at least, so it is in the last level
        shorter = after if depth == 1 else _find(last, suffix[before] * len(tree.words) + after)
        codes, below = longer, np.where(states >= 0, states, below)[shorter]
        suffix = shorter
    return tree


_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


_SCORED_SQL = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
               "score double")


def _score_kernel(tree: Tree, root: Root):
    def kernel(batches):
        for batch in batches:
            for ids, held, sizes, tokens, hashes, totals in _rows(batch):
                state = _states(tree, _contexts(tree, tokens, sizes, hashes, len(tree.levels))) if tree.levels else \
                    np.full(len(tokens), -1, np.int64)
                number = _find(tree.symbols, hashes)[tokens]
                logs = np.zeros(len(tokens))
                open_ = np.flatnonzero(state >= 0)
                while len(open_):
                    code = np.where(number[open_] >= 0, state[open_] * len(tree.symbols) + number[open_], -1)
                    at = _find(tree.entries, code)
                    hit = at >= 0
                    logs[open_[hit]] += tree.logs[at[hit]]
                    state[open_[hit]] = -2  # done
                    open_ = open_[~hit]
                    logs[open_] += tree.rest[state[open_]]
                    state[open_] = tree.parent[state[open_]]
                    open_ = open_[state[open_] >= 0]
                at_root = state == -1
                logs[at_root] += root.log(totals)[tokens[at_root]]
                first = np.cumsum(sizes) - sizes
                base = np.add.reduceat(root.base_log10(totals)[tokens], first)
                known = np.add.reduceat((totals > 0)[tokens].astype(np.int64), first)
                yield record(_SCORED, ids, held, sizes, known, np.full(len(sizes), root.tokens), base,
                             np.add.reduceat(logs, first) / math.log(10))
    return kernel


# --- a model that is nowhere whole ------------------------------------------------------------

_ASKED = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), *[(n, pa.binary()) for n in (
    "symbols", "other_symbols", "counts", "below", "last", "contexts", "near", "other_contexts", "seen", "sizes", "alive")]])
_ASKED_SQL = "bucket int, block long, " + ", ".join(f"{n} binary" for n in _ASKED.names[2:])
_ANSWERED = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("totals", pa.binary()), ("rests", pa.binary()), ("alive", pa.binary()),
                       ("states", pa.int64()), ("longer", pa.int64()), ("pairs", pa.int64()), ("hottest", pa.int64()), ("head", pa.int64()),
                       ("sums", pa.list_(pa.float64())), ("named", pa.binary()), ("named_rests", pa.binary())])


@dataclass(frozen=True)
class Plan:
    """How pairs are dealt: the number of buckets, and the count from which a context is spread over them.
    Of words that are sent as numbers: hashes, ascending, log probabilities in the root, how often they occur as contexts
    and, after the first level, what a state of theirs leaves to the root, else nan."""

    buckets: int
    head: float
    words: np.ndarray
    logs: np.ndarray
    root: Root = Root(0, 0, 0.5)
    seen: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    rests: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        found = _find(self.words, hashes)
        return np.where(found < 0, NUMBERED, found).astype(np.uint16)

    def hashes(self, numbers: np.ndarray, others: np.ndarray) -> np.ndarray:
        """What ``numbers`` was given; ``others``: those without a number."""
        out = self.words[np.minimum(numbers, len(self.words) - 1)]
        out[numbers == NUMBERED] = others
        return out


def plan_of(words: DataFrame, root: Root, buckets: int) -> Plan:
    """``words`` as for ``root_of``: those from a frequency on that ``NUMBERED`` at most reach have numbers."""
    step = F.floor(F.log2("total") * 16)
    steps = sorted(words.where(F.col("total") >= LEAST).groupBy(step.alias("step")).count().collect(), reverse=True)
    reached = np.cumsum([n for _, n in steps]) <= NUMBERED - 3
    named, often = {RARE: 0, BEGIN: 0}, F.col("hash") == END
    if reached.any():
        often |= (F.col("total") >= LEAST) & (step >= steps[int(reached.sum()) - 1][0])
    own = words.where(often).toArrow()
    named |= zip(own["hash"].to_numpy().view(np.uint64).tolist(), own["total"].to_pylist())
    hashes = np.array(sorted(named), np.uint64)
    totals = np.array([named[h] for h in hashes.tolist()])
    # as a context, the beginning stands for the end before it
    return Plan(max(buckets, math.ceil(root.tokens / BUCKET_TOKENS)), max(FLOOR, HEAD_SHARE * root.tokens), hashes, root.log(totals),
                root, np.where(hashes == BEGIN, named.get(END, 0), totals))


@dataclass(frozen=True)
class Heads:
    """The contexts of a level that are spread and are states: codes, ascending, and logs of the shorter state's weight."""

    codes: np.ndarray
    rests: np.ndarray


#: Of levels that a walk has before it: what is spread, how pairs were dealt, and how many levels come after it, as far as it is known.
Levels = dict[int, tuple[Heads, Plan, int | None]]


def _mixed(keys: np.ndarray) -> np.ndarray:
    x = keys + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _coded(contexts: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """A pair's code is that of the context which it makes together, and odd where it ends a text."""
    return (_mixed(_mixed(contexts) ^ symbols) & ~np.uint64(1)) | (symbols == END)


class Cells:
    """Where runs of a column begin and end, one run per row that is sent; runs follow each other."""

    def __init__(self, starts: np.ndarray, stops: np.ndarray):
        self.edges = np.r_[starts, stops[-1:]] if len(starts) else np.zeros(1, np.int64)

    def of(self, kept: np.ndarray) -> Cells:
        """The same runs of what is left where ``kept`` holds."""
        out = Cells(self.edges[:0], self.edges[:0])
        out.edges = np.r_[0, np.cumsum(kept)][self.edges]
        return out

    def packed(self, values: np.ndarray) -> pa.Array:
        """A binary value per run. Signed integers, none negative, take a byte for seven bits, others all their bytes."""
        first, last = int(self.edges[0]), int(self.edges[-1])
        values, at = values[first:last], self.edges - first
        if values.dtype == np.int64:
            data, ends = _varied(values)
            at = ends[at]
        else:
            data, at = np.ascontiguousarray(values), at * values.dtype.itemsize
        return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])


def _varied(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits a byte, low ones first, the last byte below 128; and where each number begins, one more."""
    values, size = values.astype(np.uint64), np.ones(len(values), np.int64)
    more = np.flatnonzero(values > 127)
    left = values[more] >> np.uint64(7)
    while len(more):
        size[more] += 1
        more, left = more[left > 127], left[left > 127] >> np.uint64(7)
    ends = np.r_[0, np.cumsum(size)]
    out = np.empty(int(ends[-1]), np.uint8)
    more, left, at = size > 1, values, ends[:-1]
    while len(at):
        out[at] = (left & np.uint64(127)).astype(np.uint8) | (more.astype(np.uint8) << 7)
        at, left, size = at[more] + 1, left[more] >> np.uint64(7), (size[more] - 1)
        more = size > 1
    return out, ends


def _unpacked(data, kind: type) -> np.ndarray:
    """Values of one packed run, or of several that follow each other."""
    data = np.frombuffer(data, np.uint8)
    if kind is not np.int64:
        return data.view(kind)
    ends = np.flatnonzero(data < 128)
    at = np.r_[0, ends[:-1] + 1] if len(ends) else ends
    out = (data[at] & 127).astype(np.int64)
    more, bits = np.flatnonzero(ends > at), 7
    at, ends = at[more] + 1, ends[more]
    while len(more):
        out[more] |= (data[at] & 127).astype(np.int64) << bits
        on = ends > at
        more, at, ends, bits = more[on], at[on] + 1, ends[on], bits + 7
    return out


def _whole(column: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    """Values of all rows of a packed column, one after the other."""
    if isinstance(column, pa.ChunkedArray):
        return np.concatenate([_whole(c, kind) for c in column.chunks] or [np.zeros(0, kind)])
    return _unpacked(bytes_of(column)[0], kind)


def _lengths(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """Number of values of each row of a packed column that is not of signed integers."""
    return pc.binary_length(column).to_numpy().astype(np.int64) // np.dtype(kind).itemsize


def _told(answers: pa.ListScalar) -> pa.StructArray:
    """What buckets have told a block, in the order of buckets."""
    rows = answers.values
    return rows.take(pa.array(np.argsort(rows.field("bucket").to_numpy(zero_copy_only=False))))


def _order(keys: np.ndarray) -> np.ndarray:
    """Places of ascending 64-bit keys, equal ones in the order of places."""
    # numbers sort faster than places by numbers: the low bits of the keys give way to the places
    low = np.uint64((1 << max(1, len(keys)).bit_length()) - 1)
    order = (np.sort((keys & ~low) | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)
    found = keys[order]
    return np.argsort(keys, kind="stable") if (found[1:] < found[:-1]).any() else order


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different codes ascending, a place of each, and the number of each place's code."""
    order = _order(codes)
    codes = codes[order]
    new = np.ones(len(codes), bool)
    new[1:] = codes[1:] != codes[:-1]
    back = np.empty(len(codes), np.int64)
    back[order] = np.cumsum(new) - 1
    return codes[new], order[new], back


class Walk:
    """The tokens of a block, level by level. Those whose next longer context is a candidate are open: ``place`` and
    ``doc`` in the block, ``symbol`` and its ``number`` in the plan, whether it is ``learnt``, ``log`` probability in the longest suffix state so far,
    code of the ``context`` before it, how often training has ``seen`` that, and whether it is ``alive``: it, or a longer
    one that it ends, may be a state (``_answer``). Others are open if the context of an open token after them
    needs their counts. ``sums``: logs of the closed by document. On the first level also ``total`` of the symbol and
    number of the word ``near`` before it; on the second the one ``far`` before that, and the ``last`` level's count of
    the symbol if it has come to be listed."""

    OPEN = {"place": np.int32, "doc": np.int32, "symbol": np.uint64, "number": np.uint16, "learnt": np.bool_, "log": np.float64,
            "context": np.uint64, "seen": np.int64, "alive": np.bool_}

    EARLY = ("total", "near", "far", "last")

    def __init__(self, sums: np.ndarray, **opened: np.ndarray):
        self.sums = sums
        for name, values in opened.items():
            setattr(self, name, values)

    @classmethod
    def begun(cls, sizes: np.ndarray, held: np.ndarray, tokens: np.ndarray, hashes: np.ndarray, totals: np.ndarray,
              root: Root, plan: Plan) -> Walk:
        rare = totals < LEAST   # needs no counts: it cannot be listed
        hashes = hashes.view(np.uint64)
        symbols = np.where(rare, np.uint64(RARE), hashes)
        first = np.cumsum(sizes) - sizes
        context, seen = np.r_[hashes[:1], hashes[tokens[:-1]]], np.r_[0, totals[tokens[:-1]]]
        # entry 0 is the end symbol; as a context, the beginning stands for the end before it
        context[first], seen[first] = BEGIN, totals[0]
        numbers = plan.numbers(hashes)
        near = np.r_[numbers[:1], numbers[tokens[:-1]]]
        near[first] = plan.numbers(np.array([BEGIN], np.uint64))
        walk = cls(np.zeros(len(sizes)), place=np.arange(len(tokens), dtype=np.int32),
                   doc=np.repeat(np.arange(len(sizes), dtype=np.int32), sizes),
                   symbol=symbols[tokens], number=np.where(rare, plan.numbers(np.zeros(1, np.uint64)), numbers)[tokens],
                   learnt=np.repeat(~held, sizes) & ~rare[tokens], log=root.log(totals)[tokens], context=context, seen=seen,
                   alive=np.ones(len(tokens), np.bool_), total=totals[tokens], near=near)
        walk._close(seen >= FLOOR)
        return walk

    def _close(self, open_: np.ndarray) -> None:
        self.sums = self.sums + np.bincount(self.doc[~open_], self.log[~open_], len(self.sums))
        for name in (*self.OPEN, *self.EARLY):
            if hasattr(self, name):
                setattr(self, name, getattr(self, name)[open_])

    def logs(self) -> np.ndarray:
        """Log probability of each document."""
        return self.sums + np.bincount(self.doc, self.log, len(self.sums))

    def pairs(self, plan: Plan) -> None:
        """Number the different pairs of a context and the symbol after it by bucket, context and code."""
        codes = _coded(self.context, self.symbol)
        by_code = _order(codes)
        codes = codes[by_code]
        new = np.ones(len(codes), bool)
        new[1:] = codes[1:] != codes[:-1]
        at, codes = by_code[new], codes[new]
        own = _mixed(self.context[at])
        bucket = (np.where(self.seen[at] >= plan.head, codes, own) >> np.uint64(32)) * np.uint64(plan.buckets) >> np.uint64(32)
        # by bucket and context, equal ones in the order of codes
        order = _order(own)
        order = order[np.argsort(bucket[order].astype(np.min_scalar_type(plan.buckets)), kind="stable")]
        own = own[order]
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.back = np.empty(len(by_code), np.int32)
        self.back[by_code] = place[np.cumsum(new) - 1]
        self.codes, self.at = codes[order], at[order]
        self.bucket = bucket[order].astype(np.int32)
        run = np.ones(len(own), bool)
        run[1:] = (own[1:] != own[:-1]) | (self.bucket[1:] != self.bucket[:-1])
        self.runs = np.flatnonzero(run)          # where a bucket's pairs of a context begin
        self.run = np.cumsum(run) - 1

    def asked(self, block: int, plan: Plan, depth: int, share: int, shares: int) -> pa.RecordBatch:
        """A row per bucket of this share: its pairs' symbols with their counts here, and its contexts with their numbers of pairs.
        Probabilities are sent if they do not follow from numbers: on the first level the total does for symbols without
        a number, on the second the last level's count if the symbol and the word before it have numbers."""
        counts = np.bincount(self.back[self.learnt], minlength=len(self.codes))
        symbols, below, contexts = self.symbol[self.at], self.log[self.at], self.context[self.at[self.runs]]
        seen, sizes = self.seen[self.at[self.runs]], np.diff(np.r_[self.runs, len(self.codes)])
        alive = self.alive[self.at[self.runs]]
        # a share is a range of buckets, so that its pairs follow each other
        edges = np.searchsorted(self.bucket, [-(-plan.buckets * k // shares) for k in (share, share + 1)])
        buckets, starts = np.unique(self.bucket[edges[0]:edges[1]], return_index=True)
        starts += edges[0]
        stops = np.r_[starts[1:], edges[1:]][:len(starts)]
        pairs, runs = Cells(starts, stops), Cells(*np.searchsorted(self.runs, [starts, stops]))
        numbers = self.number[self.at]
        other = given = numbers == NUMBERED
        context_numbers, near, last = np.full(len(contexts), NUMBERED, np.uint16), np.zeros(0, np.uint16), np.zeros(0, np.int64)
        if depth == 1:
            context_numbers, last = plan.numbers(contexts), self.total[self.at]
            below, last = below[:0], last[other]
        elif depth == 2:
            near, far = self.near[self.at[self.runs]], self.far[self.at[self.runs]]
            context_numbers = np.where(near == NUMBERED, near, far)
            given = other | (near == NUMBERED)[self.run]
            below, last = below[given], self.last[self.at[~given]]
        other_context = context_numbers == NUMBERED
        none = pairs.of(np.zeros(len(other), bool))
        return record(_ASKED, buckets, np.full(len(buckets), block), pairs.packed(numbers),
                      pairs.of(other).packed(symbols[other]), pairs.packed(counts),
                      none.packed(below) if depth == 1 else pairs.of(given).packed(below) if depth == 2 else pairs.packed(below),
                      pairs.of(other).packed(last) if depth == 1 else pairs.of(~given).packed(last) if depth == 2 else none.packed(last),
                      runs.packed(context_numbers), (runs if depth == 2 else none).packed(near), runs.of(other_context).packed(contexts[other_context]),
                      *[runs.packed(column) for column in (seen, sizes, alive)])

    def answered(self, answers: pa.StructArray, heads: Heads, plan: Plan, ends: bool = False) -> None:
        """Take in the answers to ``asked``, in the order of buckets, and go on to contexts that are one longer.

        ``ends``: the next level is the last of the walk, so that only what is alive stays open."""
        totals, lasting = self._taken(answers, heads, plan)
        follows = np.zeros(len(self.place), bool)
        follows[1:] = (self.place[1:] == self.place[:-1] + 1) & (self.doc[1:] == self.doc[:-1])
        self.context = np.r_[self.context[:1], self.codes[self.back[:-1]]]
        self.seen = np.where(follows, np.r_[self.seen[:1], totals[:-1]], 0)
        self.alive = self.alive & lasting
        # no longer context has more of a symbol, so that these need no counts from here on
        few = totals < LEAST
        self.symbol, self.learnt = np.where(few, np.uint64(RARE), self.symbol), self.learnt & ~few
        self.number = np.where(few, plan.numbers(np.array([RARE], np.uint64)), self.number)
        for name in ("back", "codes", "at", "bucket", "runs", "run"):
            delattr(self, name)
        # open are those up to the last that is alive of neighbours that are all candidates
        open_ = self.seen >= FLOOR
        if ends:
            self._close(open_ & self.alive)
            return
        chain = np.cumsum(~(open_ & np.r_[False, open_[:-1]] & follows))
        last = np.full(len(open_) + 1, -1)
        alive = np.flatnonzero(open_ & self.alive)
        last[chain[alive]] = alive
        self._close(open_ & (np.arange(len(open_)) <= last[chain]))

    def _taken(self, answers: pa.StructArray, heads: Heads, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
        """Logs as the answers change them; each token's count of its pair, and whether its context stays alive."""
        totals, told, flags = (_whole(answers.field(name), kind)
                               for name, kind in (("totals", np.int64), ("rests", np.float64), ("alive", np.uint8)))
        rests = np.where(flags & 2, 0.0, np.nan)
        rests[flags & 4 > 0] = told
        contexts, seen = self.context[self.at[self.runs]], self.seen[self.at[self.runs]]
        spread = np.flatnonzero(seen >= plan.head)
        if len(spread) and len(heads.codes):
            found = _find(heads.codes, contexts[spread])
            rests[spread] = np.where(found >= 0, heads.rests[found], np.nan)
        # a listed symbol's new probability takes the place of the old one, for others a factor comes in
        change = rests[self.run]
        to = np.flatnonzero(~np.isnan(change) & (totals >= LEAST))
        below = self.log[self.at[to]]
        new = np.log((totals[to] + PRIOR * np.exp(below)) / (seen[self.run[to]] + PRIOR))
        listed = np.full(len(change), np.nan)
        listed[to] = new
        if hasattr(self, "total"):
            self.far = np.r_[self.near[:1], self.near[:-1]]
            self.last = np.where(np.isnan(listed), 0, totals)[self.back]
            del self.total
        elif hasattr(self, "far"):
            del self.near, self.far, self.last
        listed, change = listed[self.back], np.nan_to_num(change)[self.back]
        self.log = np.where(np.isnan(listed), self.log + change, listed)
        return totals[self.back], (flags & 1 > 0)[self.run][self.back]

    def left(self, answers: pa.StructArray, heads: Heads, plan: Plan) -> None:
        """Take in the last answers: alive is what has a longer context, of which it is not known that it is no candidate."""
        totals, lasting = self._taken(answers, heads, plan)
        known = np.zeros(len(self.place), bool)
        known[1:] = (self.place[1:] == self.place[:-1] + 1) & (self.doc[1:] == self.doc[:-1]) & (totals[:-1] < FLOOR)
        self.alive = lasting & ~known


_DOCS = {"doc_ids": pa.int64(), "held": pa.bool_(), "sizes": pa.int32(), "known": pa.int64(), "base": pa.float64(),
         "sums": pa.float64()}
#: Of open tokens: steps from one's place to the next one's, hashes of symbols without a number, and the rest of ``Walk.OPEN``.
_SENT = {"steps": np.int64, "number": np.uint16, "others": np.uint64, "learnt": np.bool_, "log": np.float64, "context": np.uint64,
         "seen": np.int64, "alive": np.bool_}
_OPEN = pa.schema([("block", pa.int64()), *[(n, pa.list_(t)) for n, t in _DOCS.items()], *[(n, pa.binary()) for n in _SENT]])
_OPEN_SQL = ("block long, doc_ids array<long>, held array<boolean>, sizes array<int>, known array<long>, base array<double>, "
             "sums array<double>, " + ", ".join(f"{n} binary" for n in _SENT))


def _walks(batches, root: Root, levels: Levels, plan: Plan):
    """(block, columns of its documents, the walk through ``levels`` after those that it has behind it) of each block."""
    for batch in batches:
        if "tokens" in batch.schema.names:
            rows = _begun(batch, root, plan)
        else:
            rows = _opened(batch, plan)
        for i, (docs, walk) in enumerate(rows):
            for k, (heads, dealt, more) in levels.items():
                answers = batch.column(f"level_{k}")[i]
                if answers.is_valid and len(answers):
                    walk.pairs(dealt)
                    if more == 0:
                        walk.left(_told(answers), heads, dealt)
                    else:
                        walk.answered(_told(answers), heads, dealt, more == 1)
            yield batch.column("block")[i].as_py(), docs, walk


def _begun(batch: pa.RecordBatch, root: Root, plan: Plan):
    for ids, held, sizes, tokens, hashes, totals in _rows(batch):
        first = np.cumsum(sizes) - sizes
        known = np.add.reduceat((totals > 0)[tokens].astype(np.int64), first)
        base = np.add.reduceat(root.base_log10(totals)[tokens], first)
        yield (ids, held, sizes, known, base), Walk.begun(sizes, held, tokens, hashes, totals, root, plan)


def _opened(batch: pa.RecordBatch, plan: Plan):
    for i in range(batch.num_rows):
        docs = [batch.column(n)[i].values for n in _DOCS]
        docs[1:] = [d.to_numpy(zero_copy_only=False) for d in docs[1:]]
        sent = {n: _unpacked(batch.column(n)[i].as_buffer(), t) for n, t in _SENT.items()}
        place = np.cumsum(sent.pop("steps"))
        yield tuple(docs[:-1]), Walk(docs[-1], place=place.astype(np.int32), symbol=plan.hashes(sent["number"], sent.pop("others")),
                                     doc=np.searchsorted(np.cumsum(docs[2]), place, "right").astype(np.int32), **sent)


def _open_kernel(root: Root, levels: Levels, plan: Plan):
    def kernel(batches):
        for block, (ids, *docs), walk in _walks(batches, root, levels, plan):
            sent = [np.diff(walk.place, prepend=0).astype(np.int64), walk.number, walk.symbol[walk.number == NUMBERED], walk.learnt,
                    walk.log, walk.context, walk.seen, walk.alive]
            yield record(_OPEN, [block], [ids], *[[d] for d in docs], [walk.sums],
                         *[Cells(np.zeros(1, np.int64), np.full(1, len(c))).packed(c) for c in sent])
    return kernel


# --- contexts of which a bucket holds all that a longer one needs ---------------------------

_ROWS_SQL = ("block long, doc_ids array<long>, held array<boolean>, sizes array<int>, known array<long>, base array<double>, "
             "sums array<double>, rows long, ends array<struct<bucket int, places binary, keys binary, logs binary>>")
_END = pa.struct([("bucket", pa.int32()), ("places", pa.binary()), ("keys", pa.binary()), ("logs", pa.binary())])
_ROWS = pa.schema([("block", pa.int64()), *[(n, pa.list_(t)) for n, t in _DOCS.items()], ("rows", pa.int64()), ("ends", pa.list_(_END))])
_WINDOWS = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), *[(n, pa.binary()) for n in (
    "places", "keys", "logs", "numbers", "others", "trained", "windows", "other_words")]])
_WINDOWS_SQL = "bucket int, block long, " + ", ".join(f"{n} binary" for n in _WINDOWS.names[2:])
_GROWN = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("changed", pa.binary()), ("depths", pa.binary()), ("changes", pa.binary()),
                    ("places", pa.binary()), ("keys", pa.binary()), ("logs", pa.binary()), ("rows", pa.int64()), ("states", pa.list_(pa.int64()))])
_GROWN_SQL = ("block long, bucket int, changed binary, depths binary, changes binary, places binary, keys binary, logs binary, "
              "rows long, states array<long>")


def _rows_kernel(root: Root, levels: Levels, plan: Plan):
    """Documents with the sums of all their logs, and the tokens that are alive."""
    def kernel(batches):
        for block, (ids, *docs), walk in _walks(batches, root, levels, plan):
            own = np.flatnonzero(walk.alive)
            cell = Cells(np.zeros(1, np.int64), np.full(1, len(own)))
            ends = pa.StructArray.from_arrays([pa.array([0], pa.int32()), cell.packed(walk.place[own]), cell.packed(walk.context[own]),
                                               cell.packed(walk.log[own])], fields=list(_END))
            yield record(_ROWS, [block], [ids], *[[d] for d in docs], [walk.logs()], [len(own)],
                         pa.ListArray.from_arrays(pa.array([0, 1], pa.int32()), ends))
    return kernel


def _window_kernel(plan: Plan, depth: int, window: int, buckets: int):
    """A row per bucket of a block's open tokens, dealt by the context before each that is shorter than ``depth`` by a symbol:
    with the ``window`` symbols before that context, the nearest first, as far as training holds them ``FLOOR`` times."""
    stop = plan.numbers(np.array([RARE], np.uint64))[0]
    begin = plan.numbers(np.array([BEGIN], np.uint64))[0]

    def kernel(batches):
        for batch in batches:
            for i, (_, held, sizes, tokens, hashes, totals) in enumerate(_rows(batch)):
                ends = _told(batch.column("ends")[i])
                place, keys, logs = (_whole(ends.field(n), t) for n, t in (("places", np.int32), ("keys", np.uint64), ("logs", np.float64)))
                bucket = ((_mixed(keys) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
                order = np.lexsort((place, bucket))
                bucket, place, keys, logs = bucket[order], place[order], keys[order], logs[order]
                hashes = hashes.view(np.uint64)
                numbers = plan.numbers(hashes)
                firsts = np.cumsum(sizes) - sizes
                doc = np.searchsorted(firsts, place, "right") - 1
                at = place[:, None] - depth - np.arange(window)
                entry = tokens[np.maximum(at, 0)]
                first = firsts[doc][:, None]
                words = np.where(at >= first, np.where(totals >= FLOOR, numbers, stop)[entry], np.where(at == first - 1, begin, stop))
                words[np.logical_or.accumulate(words == stop, axis=1)] = stop
                own, starts = np.unique(bucket, return_index=True)
                cells = Cells(starts, np.r_[starts[1:], len(bucket)])
                wide = Cells(*[np.asarray(e) * window for e in (starts, np.r_[starts[1:], len(bucket)])])
                words, other = words.ravel(), words.ravel() == NUMBERED
                symbols = np.where(totals < LEAST, np.uint64(RARE), hashes)[tokens[place]]
                named = np.where(totals < LEAST, stop, numbers)[tokens[place]]
                unnamed = named == NUMBERED
                yield record(_WINDOWS, own, np.full(len(own), batch.column("block")[i].as_py()), cells.packed(place.astype(np.int32)),
                             cells.packed(keys), cells.packed(logs), cells.packed(named), cells.of(unnamed).packed(symbols[unnamed]),
                             cells.packed(~held[doc]), wide.packed(words), wide.of(other).packed(hashes[entry.ravel()[other]]))
    return kernel


def _grown(sent: pa.Table, depth: int, window: int, candidates: int, plan: Plan) -> pa.Table:
    """The levels from ``depth`` on of the contexts that end with a bucket's, which are a symbol shorter: as many as ``window``.

    One row for each that came in: the changes of its tokens' logs by level, and what is open after the last level.
    The first has the numbers of states. Tests are those of ``_answer``.
    """
    def whole(name, kind):
        return _whole(sent[name], kind)

    place, code, log, trained = whole("places", np.int32), whole("keys", np.uint64), whole("logs", np.float64), whole("trained", np.bool_)
    lengths = _lengths(sent["places"], np.int32)
    cell = np.repeat(np.arange(len(lengths)), lengths)
    symbol = plan.hashes(whole("numbers", np.uint16), whole("others", np.uint64))
    words, other_words = whole("windows", np.uint16).reshape(len(place), window), whole("other_words", np.uint64)
    stop = plan.numbers(np.array([RARE], np.uint64))[0]
    # where the next of a token's words without a number is
    next_ = np.r_[0, np.cumsum((words == NUMBERED).sum(1))[:-1]] if len(place) else np.zeros(0, np.int64)
    # tokens with the same symbol and the same symbols before it go through the levels as one
    lasts = np.r_[next_[1:], len(other_words)] if len(place) else next_
    alike = _mixed(code) ^ symbol
    for k in range(0, window, 4):
        four = np.zeros((len(place), 4), np.uint16)
        four[:, :min(4, window - k)] = words[:, k:k + 4]
        alike = _mixed(alike ^ four.view(np.uint64)[:, 0])
    mixed = np.r_[np.uint64(0), np.cumsum(_mixed(other_words ^ (np.arange(len(other_words), dtype=np.uint64) - np.repeat(
        next_, lasts - next_).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64)]
    _, first, alike = _distinct(alike + mixed[lasts] - mixed[next_])
    trained, listable = (np.bincount(alike, v, len(first)) for v in (trained, trained & (symbol != RARE)))
    code, log, symbol, words, next_ = (c[first] for c in (code, log, symbol, words, next_))
    row, states, changes = np.arange(len(first)), np.zeros(window, np.int64), []

    def candidate():
        """Drop what follows contexts that training holds less than ``FLOOR`` times; of the others the counts and each token's."""
        nonlocal row, code, log
        own, _, of = _distinct(code)
        often = np.bincount(of, trained[row], len(own)).astype(np.int64)
        kept = often >= FLOOR
        use = kept[of]
        row, code, log = row[use], code[use], log[use]
        return often[kept], (np.cumsum(kept) - 1)[of[use]]

    for k in range(window):
        word = words[row, k]
        use = word != stop
        row, code, log, word = row[use], code[use], log[use], word[use]
        other, before = word == NUMBERED, plan.words[np.minimum(word, len(plan.words) - 1)]
        before[other] = other_words[next_[row[other]]]
        next_[row[other]] += 1
        code = _mixed(_mixed(code) ^ before)
        often, of = candidate()
        if not len(row):
            break
        pairs, at, back = _distinct(_coded(code, symbol[row]))
        totals = np.bincount(back, listable[row], len(pairs)).astype(np.int64)
        listed = np.flatnonzero(totals >= LEAST)
        n, below, context = totals[listed], np.exp(log[at[listed]]), of[at[listed]]
        smooth, sums = _gains(often, context, n, below)
        kept, rest = _judged(often, *sums, depth + k, candidates)
        lasting = (sums[0] > 0) & _lasting(often, context, n, below, smooth, sums, kept, depth + k, candidates)
        states[k] = kept.sum()
        new = np.full(len(pairs), np.nan)
        new[listed] = np.log(smooth)
        new = np.where(np.isnan(new[back]), log + rest[of], new[back])
        to = np.flatnonzero(kept[of])
        changes.append((row[to], np.full(len(to), depth + k), new[to] - log[to]))
        log = np.where(kept[of], new, log)
        use = lasting[of]
        row, code, log = row[use], code[use], log[use]
    changed, depths, change = (np.concatenate(c) for c in zip(*changes)) if changes else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
    # back from each to its tokens, which are in the order of cells
    members, edges = np.argsort(alike, kind="stable"), np.r_[0, np.cumsum(np.bincount(alike, minlength=len(first)))]

    def tokens(rows):
        n = edges[rows + 1] - edges[rows]
        at = np.repeat(np.arange(len(rows)), n)
        token = members[np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + edges[rows][at]]
        order = np.argsort(token, kind="stable")
        return token[order], at[order]

    changed, at = tokens(changed)
    depths, change = depths[at], change[at]
    row, at = tokens(row)
    code, log = code[at], log[at]

    def cells(rows):
        edges = np.searchsorted(cell[rows], np.arange(len(lengths) + 1))
        return Cells(edges[:-1], edges[1:]), np.diff(edges)

    told, (left, rows) = cells(changed)[0], cells(row)
    return pa.table([
        sent["block"], sent["bucket"], told.packed(place[changed]), told.packed(depths), told.packed(change),
        left.packed(place[row]), left.packed(code), left.packed(log), pa.array(rows, pa.int64()),
        pa.array([states.tolist(), *[None] * (len(rows) - 1)], pa.list_(pa.int64()))], schema=_GROWN)


def _grown_kernel(depth: int, window: int, candidates: int, plan: Plan):
    def kernel(sent: pa.Table) -> pa.Table:
        try:
            return _grown(sent, depth, window, candidates, plan)
        finally:
            give_back()
    return kernel


def _changed_kernel(root: Root, told: list[str], end: int | None):
    """Scores. ``told``: columns of changes, of which those of the level ``end`` and after it do not count."""
    def kernel(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, held, sizes, known, base, sums = (batch.column(n)[i].values for n in _DOCS)
                sizes, sums = (c.to_numpy(zero_copy_only=False) for c in (sizes, sums))
                for name in told:
                    if batch.column(name)[i].is_valid:
                        rows = _told(batch.column(name)[i])
                        place, depths, change = (_whole(rows.field(n), t) for n, t in (("changed", np.int32), ("depths", np.int64),
                                                                                      ("changes", np.float64)))
                        use = depths < end if end else np.ones(len(place), bool)
                        doc = np.searchsorted(np.cumsum(sizes), place[use], "right")
                        sums = sums + np.bincount(doc, change[use], len(sums))
                yield record(_SCORED, ids, held, sizes.astype(np.int64), known, np.full(len(sizes), root.tokens), base, sums / math.log(10))
    return kernel


def _deep(blocks: DataFrame, docs: DataFrame, root: Root, plan: Plan, depth: int, candidates: int, buckets: int) -> DataFrame:
    """The scores with the levels from ``depth`` on, in rounds of several levels.

    ``docs``: as by ``_rows_kernel``. Contexts that end with the same one of the level before meet in one bucket, so that
    it can go on alone for as many levels as it has been sent symbols; what is alive then starts the next round, with more.
    """
    spark = blocks.sparkSession
    scores, ends, window, told, end = docs.drop("rows", "ends"), docs.where("rows > 0").select("block", "rows", "ends"), WINDOW, [], None
    while end is None:
        rows = ends.agg(F.sum("rows")).first()[0]
        if not rows:
            break
        dealt = max(math.ceil(rows / ROUND_ROWS), min(buckets, math.ceil(rows / (ROUND_ROWS >> 1))))
        sent = map_arrow(blocks.join(ends, "block"), _window_kernel(plan, depth, window, dealt), _WINDOWS_SQL)
        got, _ = _bucketed([sent.groupBy("bucket").applyInArrow(_grown_kernel(depth, window, candidates, plan), _GROWN_SQL)], spark,
                           f"suffix_round_{depth}", buckets, placed=False)
        name = f"told_{depth}"
        changes = got.groupBy("block").agg(F.collect_list(F.struct("bucket", "changed", "depths", "changes")).alias(name))
        scores = scores.join(changes, "block", "left")
        told.append(name)
        states = got.where("states is not null").agg(*[F.sum(F.col("states")[k]) for k in range(window)]).first()
        end = next((depth + k for k, n in enumerate(states) if not n), None)
        ends = got.where("rows > 0").groupBy("block").agg(
            F.sum("rows").alias("rows"), F.collect_list(F.struct("bucket", "places", "keys", "logs")).alias("ends"))
        depth, window = depth + window, 4 * window
        release(spark)
    return map_arrow(scores, _changed_kernel(root, told, end), _SCORED_SQL)


def _gains(often: np.ndarray, of: np.ndarray, n: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Smoothed probabilities of listed symbols, and by context the sums that ``_judged`` takes.

    ``often``: how often each context occurs. Of listed symbols: ``of`` the number of its context, ``n`` the count,
    ``below`` the probability in the shorter state.
    """
    smooth = (n + PRIOR * below) / (often[of] + PRIOR)
    return smooth, [np.bincount(of, v, len(often)) for v in (np.ones(len(of)), n, smooth, below,
                                                             n * (np.log(smooth) - np.log(below)))]


def _lasting(often: np.ndarray, of: np.ndarray, n: np.ndarray, below: np.ndarray, smooth: np.ndarray, sums: list[np.ndarray],
             kept: np.ndarray, depth: int, candidates: int) -> np.ndarray:
    """Which contexts stay alive: one of the longer contexts that they end might still pass.

    Of these none has more of a symbol,
    and the least that a test costs is known. With n of a symbol of probability b a context gains
    n log((n + PRIOR b) / ((N + PRIOR) b)), so never more than with N = n, which grows with n; symbols that
    cannot be listed count as one. The sum of that is what a longer context can gain at most.
    """
    after, others = np.where(kept[of], smooth, below), np.maximum(0, often - sums[1])
    other = np.maximum(1e-12, 1 - np.where(kept, sums[2], sums[3]))
    most = np.bincount(of, n * np.log((n + PRIOR * after) / ((n + PRIOR) * after)), len(often))
    most += others * np.log((others + PRIOR * other) / ((others + PRIOR) * other))
    return most > 0.5 * math.log(FLOOR) + (math.log(candidates) if depth > 1 else 0)


def _answer(asked: pa.Table, depth: int, candidates: int, plan: Plan) -> pa.Table:
    """A bucket's totals and tests, as one row for each that came in; and sums of spread contexts, as rows of a number that no block has."""
    def whole(name, kind=np.int64):
        return _whole(asked[name], kind)

    numbers, counts, below, last_ = whole("symbols", np.uint16), whole("counts"), whole("below", np.float64), whole("last")
    named, near = whole("contexts", np.uint16), whole("near", np.uint16)
    seen, sizes, living = whole("seen"), whole("sizes"), whole("alive", np.bool_)
    ends, last = _lengths(asked["symbols"], np.uint16), _lengths(asked["contexts"], np.uint16)
    contexts = plan.hashes(named, whole("other_contexts", np.uint64))
    run = np.repeat(np.arange(len(sizes)), sizes)
    if depth == 1:
        other, below = plan.root.log(last_), plan.logs[np.minimum(numbers, len(plan.logs) - 1)]
        below[numbers == NUMBERED] = other
    elif depth == 2:
        both = named != NUMBERED
        contexts[both] = _coded(contexts[both], plan.words[near[both]])
        given = (numbers == NUMBERED) | (near == NUMBERED)[run]
        sent, below = below, np.empty(len(numbers))
        below[given] = sent
        to = np.flatnonzero(~given)
        logs, word = plan.logs[numbers[to]], near[run[to]]
        change = np.nan_to_num(plan.rests[word])
        below[to] = np.where(last_ >= LEAST, np.log((last_ + PRIOR * np.exp(logs)) / (plan.seen[word] + PRIOR)), logs + change)
    pairs = _coded(contexts[run], plan.hashes(numbers, whole("other_symbols", np.uint64)))
    pairs, at, back = _distinct(pairs)
    totals = np.bincount(back, counts, len(pairs)).astype(np.int64)
    # what is not listed has to know what is left to the shorter state
    lacks = np.bincount(run, totals[back] < LEAST, len(sizes)) > 0
    run = run[at]
    listed = np.flatnonzero(totals >= LEAST)
    own, run_at, of = _distinct(contexts[run[listed]])
    often = seen[run[listed][run_at]]
    n, below = totals[listed], np.exp(below[at[listed]])
    smooth, sums = _gains(often, of, n, below)
    kept, rest = _judged(often, *sums, depth, candidates)
    # counts of contexts that are not alive need not be whole
    spread = (often >= plan.head) & living[run[listed][run_at]]
    kept &= (often < plan.head) & living[run[listed][run_at]]
    lasting = _lasting(often, of, n, below, smooth, sums, kept, depth, candidates)
    found = _find(own, contexts)
    rests, alive = np.full(len(contexts), np.nan), seen >= plan.head
    if len(own):
        rests = np.where(found >= 0, np.where(kept, rest, np.nan)[found], np.nan)
        alive |= (found >= 0) & lasting[found]
    alive &= living
    state = ~np.isnan(rests)
    told = state & lacks
    flags, rests = alive + np.uint8(2) * state + np.uint8(4) * told, rests[told]
    by_name = plan.numbers(own) if depth == 1 else np.full(len(own), NUMBERED, np.uint16)
    given = np.flatnonzero(kept & (by_name != NUMBERED))
    one = Cells(np.zeros(1, np.int64), np.full(1, len(given)))
    longer = (totals >= FLOOR) & (pairs & np.uint64(1) == 0)
    hottest = int(totals[longer & alive[run]].max(initial=0))
    rows, heads = asked.num_rows, int(spread.sum())
    per_pair = totals[back]
    zeros = np.zeros(rows - 1 + heads, np.int64)
    ends, last = (Cells(np.r_[0, np.cumsum(k)[:-1]], np.cumsum(k)) for k in (ends, last))
    first = pa.nulls(len(zeros), pa.binary())
    none = pa.nulls(heads, pa.binary())
    return pa.table([
        pa.array([*asked["block"].to_pylist(), *[-1 - asked["bucket"][0].as_py()] * heads], pa.int64()),
        pa.array([*asked["bucket"].to_pylist(), *[None] * heads], pa.int32()),
        pa.concat_arrays([ends.packed(per_pair), none]), pa.concat_arrays([last.of(told).packed(rests), none]),
        pa.concat_arrays([last.packed(flags.astype(np.uint8)), none]),
        *[pa.array(np.r_[int(k), zeros]) for k in (kept.sum(), longer.sum(), len(back), hottest)],
        pa.array([*[None] * rows, *own[spread].view(np.int64).tolist()], pa.int64()),
        pa.array([*[None] * rows, *np.stack([often, *sums], 1)[spread].tolist()], pa.list_(pa.float64())),
        pa.concat_arrays([one.packed(by_name[given]), first]), pa.concat_arrays([one.packed(rest[given]), first])], schema=_ANSWERED)


def _ask_kernel(root: Root, levels: Levels, plan: Plan, depth: int):
    def kernel(batches):
        for block, _, walk in _walks(batches, root, levels, plan):
            walk.pairs(plan)
            if len(walk.codes):
                yield walk.asked(block, plan, depth, 0, 1)
    return kernel


def _answer_kernel(depth: int, candidates: int, plan: Plan):
    def kernel(asked: pa.Table) -> pa.Table:
        try:
            return _answer(asked, depth, candidates, plan)
        finally:
            give_back()
    return kernel


def _answers(blocks: DataFrame, root: Root, levels: Levels, plan: Plan, depth: int, candidates: int) -> DataFrame:
    """What the buckets say to the blocks."""
    asked = map_arrow(blocks, _ask_kernel(root, dict(levels), plan, depth), _ASKED_SQL)
    return asked.groupBy("bucket").applyInArrow(
        _answer_kernel(depth, candidates, plan), "block long, bucket int, totals binary, rests binary, alive binary, states long, "
                                                 "longer long, pairs long, hottest long, head long, sums array<double>, "
                                                 "named binary, named_rests binary")


def _named(got: DataFrame, heads: Heads, plan: Plan) -> np.ndarray:
    """By number of a word, what the states of the first level leave to the root, nan if there is none."""
    out = np.full(len(plan.words), np.nan)
    told = got.where("named is not null").select("named", "named_rests").toArrow()   # a row per bucket, each number once at most
    out[_whole(told["named"], np.uint16)] = _whole(told["named_rests"], np.float64)
    at = _find(plan.words, heads.codes)
    out[at[at >= 0]] = heads.rests[at >= 0]
    return out


def joined(blocks: DataFrame, root: Root, plan: Plan, buckets: int) -> DataFrame:
    """The scores by a model that is learnt by joins.

    Levels are as in ``learn``; contexts are coded by 64-bit hashes. The tasks of the second level go through the first
    again. After it few tokens are open, and each level leaves what it has come to for the next, which then frees it.
    From level ``DEEP`` on, buckets go on alone (``_deep``), but not before each context occurs ``CROWD`` times at most.
    """
    spark, tokens = blocks.sparkSession, blocks
    levels: Levels = {}
    depth, longer, candidates, done, more = 1, 1, 0, [], None
    while longer:
        got, folder = _bucketed([_answers(blocks, root, levels, plan, depth, candidates)], spark, f"suffix_level_{depth}", buckets,
                                placed=False)
        found = got.drop("block", "bucket", "totals", "rests", "alive").groupBy("head").agg(   # 1 / HEAD_SHARE rows at most, and one
            F.sum("states").alias("states"), F.sum("longer").alias("longer"), F.sum("pairs").alias("pairs"), F.max("hottest").alias("hottest"),
            *[(F.sum if k else F.max)(F.col("sums")[k]).alias(f"s{k}") for k in range(6)]).toArrow()
        states, longer, pairs = (sum(found[c].to_pylist()) for c in ("states", "longer", "pairs"))
        spread = found.filter(pc.field("head").is_valid())
        kept, rests = _judged(*[spread[f"s{k}"].to_numpy() for k in range(6)], depth, candidates)
        if depth > 1 and not states and not kept.any():
            break
        codes = spread["head"].to_numpy()[kept].view(np.uint64)
        order = np.argsort(codes)
        heads = Heads(codes[order], rests[kept][order])
        candidates = longer if depth == 1 else candidates
        crowded = max(found["hottest"].to_pylist()) > CROWD
        more = 0 if more == 1 else 1 if depth >= DEEP - 2 and not crowded else None
        levels[depth] = heads, plan, more
        answers = (got.where("block >= 0").groupBy("block")
                   .agg(F.collect_list(F.struct("bucket", "totals", "rests", "alive")).alias(f"level_{depth}")))
        blocks = blocks.join(answers, "block", "left")
        done.append(folder)
        if depth > 1:
            kernel, schema = (_rows_kernel, _ROWS_SQL) if more == 0 else (_open_kernel, _OPEN_SQL)
            blocks, folder = _bucketed([map_arrow(blocks, kernel(root, levels, plan), schema)], spark, f"suffix_open_{depth}", buckets,
                                       placed=True)
            levels = {}
            for old in done:
                delete_path(spark, old)
            done = [folder]
        # fewer tokens are open on each level
        if depth == 1:
            plan = replace(plan, rests=_named(got, heads, plan))
        plan = replace(plan, buckets=min(plan.buckets, max(buckets, math.ceil(pairs / BUCKET_PAIRS))))
        depth += 1
        del got, answers
        release(spark)
        if more == 0:
            return _deep(tokens, blocks, root, plan, depth, candidates, buckets)
    return map_arrow(blocks, _walk_kernel(root, levels, plan), _SCORED_SQL)


def _walk_kernel(root: Root, levels: Levels, plan: Plan):
    def kernel(batches):
        for _, (ids, held, sizes, known, base), walk in _walks(batches, root, levels, plan):
            yield record(_SCORED, ids, held, sizes, known, np.full(len(sizes), root.tokens), base, walk.logs() / math.log(10))
    return kernel


_HASHES = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])
_TOTALS = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("totals", pa.binary()), ("hashes", pa.binary())])
_WORDS = pa.schema([("hash", pa.int64()), ("total", pa.int64())])


def _hashes_kernel(buckets: int):
    """A row per bucket of a block's vocabulary."""
    def kernel(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                hashes = batch.column("hashes")[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                counts = batch.column("counts")[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
                bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
                own, starts = np.unique(bucket, return_index=True)
                cells = Cells(starts, np.r_[starts[1:], len(hashes)])
                yield record(_HASHES, own, np.full(len(own), batch.column("block")[i].as_py()), cells.packed(hashes), cells.packed(counts))
    return kernel


def _totals_kernel(sent: pa.Table) -> pa.Table:
    """Each row's totals; and all of the bucket's words, as a row that no block has the number of."""
    try:
        ends = _lengths(sent["hashes"], np.uint64)
        hashes, _, back = _distinct(_whole(sent["hashes"], np.uint64))
        totals = np.bincount(back, _whole(sent["counts"], np.int64), len(hashes)).astype(np.int64)
        cells, whole = Cells(np.r_[0, np.cumsum(ends)[:-1]], np.cumsum(ends)), Cells(np.zeros(1, np.int64), np.full(1, len(hashes)))
        bucket = sent["bucket"].to_pylist()
        return pa.table([pa.array([*sent["block"].to_pylist(), -1 - bucket[0]], pa.int64()), pa.array([*bucket, bucket[0]], pa.int32()),
                         pa.concat_arrays([cells.packed(totals[back]), whole.packed(totals)]),
                         pa.concat_arrays([pa.nulls(len(bucket), pa.binary()), whole.packed(hashes)])], schema=_TOTALS)
    finally:
        give_back()


def _words_kernel(batches):
    for batch in batches:
        if batch.num_rows:
            yield record(_WORDS, _whole(batch.column("hashes"), np.uint64).view(np.int64),
                         _whole(batch.column("totals"), np.int64))


def counted(blocks: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """(block, totals): the training counts of each block's vocabulary, as the word buckets tell them; and (hash, total) of all words."""
    spark = blocks.sparkSession
    entries = blocks.agg(F.sum("entries")).first()[0] or 0
    sent = map_arrow(blocks.select("block", "hashes", "counts"),
                     _hashes_kernel(max(buckets, math.ceil(entries / BUCKET_TOKENS))), "bucket int, block long, hashes binary, counts binary")
    got, _ = _bucketed([sent.groupBy("bucket").applyInArrow(_totals_kernel, "block long, bucket int, totals binary, hashes binary")],
                       spark, "block_totals", buckets, placed=False)
    words = map_arrow(got.where("block < 0").select("hashes", "totals"), _words_kernel, "hash long, total long")
    totals = got.where("block >= 0").groupBy("block").agg(F.collect_list(F.struct("bucket", "totals")).alias("totals"))
    return totals, words


def scored(docs: DataFrame) -> DataFrame:
    """Score ``docs(doc_id, text)`` with a tree learnt from those whose crc32(doc_id) mod 10 is not 0.

    One row per row of ``docs``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score (log10). Null text counts as empty: the
    end symbol alone. Rows without doc_id are training rows; repeated rows
    count as often as they occur. Words are hashed to 64 bits. Without training
    tokens every symbol is the unseen one, with probability 1. Other columns
    are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    blocks, _ = _bucketed([map_arrow(rows, _block_kernel, _BLOCK_SQL)], spark, "token_blocks", buckets, placed=True)
    totals, words = counted(blocks, buckets)
    release(spark)
    blocks = blocks.join(totals, "block").select("block", "doc_ids", "held", "sizes", "tokens", "hashes", "totals")
    root = root_of(words)
    if root.tokens > SMALL:
        return joined(blocks, root, plan_of(words, root, buckets), buckets)
    return map_arrow(blocks, _score_kernel(learn(blocks, words, root), root), _SCORED_SQL)


def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: see ``scored``."""
    return scored(table(spark, sf_dir, "documents"))
