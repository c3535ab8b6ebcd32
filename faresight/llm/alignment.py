"""Alignment of two tokenizers' ids over the same text.

Both tokenizers encode a space and the text; a token is the run of bytes that
it stands for. Every token points to the farthest-right token of the other
side that it overlaps, and a token of the second side that ends where its
partner ends points to itself. Doubling the pointers (each takes its
successor's successor) until none changes leaves every token at the last token
of its overlap component; these labels are the groups, which byte offsets
where both sides end tell apart.

Both encodings break between a character and a following space or line end, so
a text is cut there, each new segment is encoded and aligned once, and a
worker keeps up to ``CACHED_SEGMENTS`` of them. Texts with other white space
before such a place are one segment.

The count of an id pair is the number of documents that hold it linked. Tasks
write what they found about the documents of a slice to a file in the shared
folder, and hand on the slice's different pairs with their document counts.
Spark adds the counts, finds each first id's highest, joins both back to the
slices' pairs, and a task per slice finishes its documents. Nothing of it is
gathered on the driver or in one group: a slice's pairs are bounded by its
text, and a first id has at most as many pairs as the second vocabulary has
ids.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faresight.llm.blobs import Reader, Writer
from faresight.llm.common import bytes_of, map_arrow, record, saved, slices, table, text_of
from faresight.session import fresh_path

#: Contract of the registered query.
FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"

#: Segments, and bytes of them, that a Python worker keeps aligned.
CACHED_SEGMENTS, CACHED_BYTES = 300_000, 32 << 20
#: Bytes of text of a slice.
SLICE = 3 << 20

SEGMENT = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: White space of another kind before a space or line end: a run that must not be cut.
MIXED = re.compile(r"[^\S \n][ \n]")
SPACE_PIECE = "▁"


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable characters
    for themselves, the other bytes for the characters from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Group number of every token, first side's tokens before the second's, by pointer jumping.

    ``ends``: ascending end offsets of tokens that cover the same bytes.
    """
    n = len(ends_a)
    back = np.searchsorted(ends_a, ends_b)
    closes = ends_a[back] == ends_b
    to = np.r_[n + np.searchsorted(ends_b, ends_a), np.where(closes, n + np.arange(len(ends_b)), back)]
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return np.searchsorted(n + np.flatnonzero(closes), to)
        to = further


class Aligner(dict):
    """Number of each segment met; ``take`` encodes and aligns the new ones."""

    def __init__(self, first: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        super().__init__()
        self.a, self.b = Tokenizer.from_file(first), sentencepiece.SentencePieceProcessor(model_file=second)
        self.a.encode_special_tokens = True
        letters = byte_of_letter()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_PIECE, " ").encode()
                        for i, p in enumerate(pieces)]
        self.space = self.b.piece_to_id(SPACE_PIECE)
        # no piece may reach over a place where texts are cut
        self.cuts = not any(re.search(f"[^{SPACE_PIECE}]{SPACE_PIECE}|[ \\n]", p) for p in pieces)
        self.pending: list[str] = []
        self.kept_bytes = 0
        self.whole = np.zeros(0, bool)                       # both sides spell the segment
        self.sizes = np.zeros((4, 0), np.int64)              # ids of either side, groups, links
        self.texts: list[str] = []
        self.pair_ends, self.pairs, self.weights = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __missing__(self, segment: str) -> int:
        self[segment] = at = len(self)
        self.pending.append(segment)
        return at

    def segments(self, text: bytes) -> list[int] | None:
        """Segments of a space and the text; None for bytes that are no UTF-8."""
        try:
            spaced = " " + text.decode()
        except UnicodeDecodeError:
            return None
        cut = SEGMENT.findall(spaced) if self.cuts and not MIXED.search(spaced) else [spaced]
        return [*map(self.__getitem__, cut)]

    def second_ids(self, segments: list[str]) -> list[list[int]]:
        """Ids of the second side, whose encoder puts a space before what it is given."""
        found = self.b.encode([s[1:] if s[0] == " " else s for s in segments], num_threads=1)
        for i, s in enumerate(segments):
            if s == " ":
                found[i] = [self.space]
            elif s[0] != " ":
                # a cut before a line end: the space of the encoder's own is a token by itself
                found[i] = found[i][1:] if found[i][:1] == [self.space] else []
        return found

    def take(self) -> None:
        """Encode and align the segments met since the last call."""
        new = self.pending
        if not new:
            return
        a = [e.ids for e in self.a.encode_batch(new, add_special_tokens=False)]
        b = self.second_ids(new)
        raw = [s.encode() for s in new]
        whole = np.array([b"".join(map(self.a_bytes.__getitem__, x)) == r == b"".join(map(self.b_bytes.__getitem__, y))
                          for x, y, r in zip(a, b, raw)], bool)
        good = [i for i in range(len(new)) if whole[i]]
        sizes, texts, ends, pairs, weights = self.aligned([a[i] for i in good], [b[i] for i in good])
        every = np.zeros((4, len(new)), np.int64)
        every[:, good] = sizes
        lengths = np.zeros(len(new), np.int64)
        lengths[good] = np.diff(ends)
        spread = [""] * len(new)
        for i, t in zip(good, texts):
            spread[i] = t
        self.whole, self.sizes = np.r_[self.whole, whole], np.concatenate([self.sizes, every], axis=1)
        self.texts += spread
        self.pair_ends = np.r_[self.pair_ends, self.pair_ends[-1] + np.cumsum(lengths)]
        self.pairs, self.weights = np.r_[self.pairs, pairs], np.r_[self.weights, weights]
        self.kept_bytes += sum(map(len, raw))

    def aligned(self, a: list[list[int]], b: list[list[int]]):
        """For segments that both sides spell: (sizes, texts of their groups, ends, pairs, weights); a pair is
        first id * 2^32 + second id, its weight the number of its links in the segment."""
        count = len(a)
        if not count:
            return np.zeros((4, 0), np.int64), [], np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a, b))
        owner = np.repeat(np.arange(count), [len(x) for x in b])
        ends_a = np.cumsum([len(self.a_bytes[i]) for i in ids_a.tolist()])
        ends_b = np.cumsum([len(self.b_bytes[i]) for i in ids_b.tolist()])
        label = terminals(ends_a, ends_b)
        of_a, of_b = label[:len(ids_a)], label[len(ids_a):]
        groups = int(label.max()) + 1
        many_a, many_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
        segment = np.zeros(groups, np.int64)
        segment[of_b] = owner
        sizes = np.zeros((4, count), np.int64)
        for row, weight in zip(sizes, (many_a, many_b, np.ones(groups, np.int64), many_a * many_b)):
            np.add.at(row, segment, weight)

        spelled_a, spelled_b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
        stop_a, stop_b = np.cumsum(many_a).tolist(), np.cumsum(many_b).tolist()
        shown, i, j = [], 0, 0
        for u, v in zip(stop_a, stop_b):
            shown.append(f"{','.join(spelled_a[i:u])}|{','.join(spelled_b[j:v])}")
            i, j = u, v
        cuts = np.r_[0, np.cumsum(sizes[2])].tolist()
        texts = [";".join(shown[u:v]) for u, v in zip(cuts[:-1], cuts[1:])]

        # different ids of either side of a group with their numbers, then every pair of different ids
        key_a, times_a = np.unique(of_a << 32 | ids_a, return_counts=True)
        key_b, times_b = np.unique(of_b << 32 | ids_b, return_counts=True)
        kinds_a, kinds_b = np.bincount(key_a >> 32, minlength=groups), np.bincount(key_b >> 32, minlength=groups)
        number = kinds_a * kinds_b
        group = np.repeat(np.arange(groups), number)
        place = np.arange(len(group)) - np.repeat(np.cumsum(number) - number, number)
        at_a = (np.cumsum(kinds_a) - kinds_a)[group] + place // kinds_b[group]
        at_b = (np.cumsum(kinds_b) - kinds_b)[group] + place % kinds_b[group]
        pair = (key_a[at_a] & 0xFFFFFFFF) << 32 | (key_b[at_b] & 0xFFFFFFFF)
        owners, pairs, weights = summed(segment[group], pair, times_a[at_a] * times_b[at_b])
        return sizes, texts, np.searchsorted(owners, np.arange(count + 1)), pairs, weights

    def forget(self, known: int) -> None:
        """Keep only the first ``known`` segments if there are too many by now."""
        if len(self) > CACHED_SEGMENTS or self.kept_bytes > CACHED_BYTES:
            for segment in self.pending:
                self.kept_bytes -= len(segment.encode())
                del self[segment]
            held = self.pair_ends[known]
            self.whole, self.sizes, self.texts = self.whole[:known], self.sizes[:, :known], self.texts[:known]
            self.pair_ends, self.pairs, self.weights = self.pair_ends[:known + 1], self.pairs[:held], self.weights[:held]
        self.pending = []

    def documents(self, texts: list[bytes]) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(digest texts, sizes [4, documents], documents of pairs, slice's pair of each, weight of each, the slice's
        different pairs)."""
        known = len(self)
        found = [self.segments(t) if t else None for t in texts]
        self.take()
        found = [f if f is not None and self.whole[f].all() else [] for f in found]
        digests = [hashlib.sha256(";".join([self.texts[i] for i in f]).encode()).hexdigest() if f else "" for f in found]
        n = len(texts)
        document = np.repeat(np.arange(n), [len(f) for f in found])
        segment = np.fromiter(chain.from_iterable(found), np.int64, len(document))
        sizes = np.stack([np.bincount(document, self.sizes[r, segment], n).astype(np.int64) for r in range(4)])
        # different segments of a document with their numbers, then their pairs
        key, times = np.unique(document << 32 | segment, return_counts=True)
        document, segment = key >> 32, key & 0xFFFFFFFF
        used, local = np.unique(segment, return_inverse=True)
        length = np.diff(self.pair_ends)[used]
        at = spans(self.pair_ends[used], length)
        pairs, slot = np.unique(self.pairs[at], return_inverse=True)
        begins = np.cumsum(length) - length
        many = length[local]
        at = spans(begins[local], many)
        weight = self.weights[spans(self.pair_ends[segment], many)] * np.repeat(times, many)
        owners, slots, weights = summed(np.repeat(document, many), slot[at], weight)
        self.forget(known)
        return digests, sizes, owners, slots, weights, pairs


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of runs: starts[0], starts[0] + 1, ..., then those of the next."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def summed(owner: np.ndarray, key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (owner, key) in order, with the sums of their weights."""
    order = np.lexsort((key, owner))
    owner, key, weight = owner[order], key[order], weight[order]
    if not len(key):
        return owner, key, weight
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])])
    return owner[first], key[first], np.add.reduceat(weight, first)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(first: str, second: str) -> Aligner:
    """This worker's aligner; it lives as long as the worker."""
    if (first, second) not in _ALIGNERS:
        _ALIGNERS[first, second] = Aligner(first, second)
    return _ALIGNERS[first, second]


_HELD = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                   ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("steps", pa.list_(pa.int32())),
                   ("weights", pa.list_(pa.int64()))])


def packed(schema: pa.Schema, columns: list) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(record(schema, *columns))
    return sink.getvalue().to_pybytes()


#: A row with ``path`` says where a slice's documents lie; the others are its pairs with their document counts.
_SLICED = pa.schema([("slice", pa.int64()), ("pos", pa.int32()), ("pair", pa.int64()), ("docs", pa.int64()),
                     ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def write_slices(docs: DataFrame, folder: str, first: str, second: str) -> DataFrame:
    """Align ``docs(doc_id, text)`` by slices, written to files of ``folder``; rows as in ``_SLICED``."""
    def kernel(batches):
        task, number, out = TaskContext.get().partitionId(), 0, None
        for batch in slices(batches, limit=SLICE):
            data, ends = bytes_of(batch.column(1))
            raw = data.tobytes()
            digests, sizes, owners, slots, weights, pairs = aligner(first, second).documents(
                [raw[a:b] for a, b in zip(ends[:-1], ends[1:])])
            out = out or Writer(folder, f"aligned-{task:06d}", "arrow")
            # a document's pairs ascend, so their steps are small and pack well
            starts = np.searchsorted(owners, np.arange(batch.num_rows + 1)).astype(np.int32)
            fresh = np.r_[True, owners[1:] != owners[:-1]] if len(owners) else np.zeros(0, bool)
            steps = np.where(fresh, slots, slots - np.r_[0, slots[:-1]]) if len(slots) else slots
            lists = [pa.ListArray.from_arrays(pa.array(starts), pa.array(v, t))
                     for v, t in ((steps, pa.int32()), (weights, pa.int64()))]
            body = packed(_HELD, [batch.column(0), *sizes, digests, *lists])
            name, n = task << 32 | number, len(pairs)
            yield record(_SLICED, [name], [None], [None], [None], [out.location], [out.write(body)], [len(body)])
            if n:
                nothing = pa.nulls(n)
                yield record(_SLICED, np.full(n, name), np.arange(n), pairs, np.bincount(slots, minlength=n),
                             nothing.cast(pa.string()), nothing.cast(pa.int64()), nothing.cast(pa.int64()))
            number += 1
        if out is not None:
            out.close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return saved(map_arrow(rows, kernel, "slice long, pos int, pair long, docs long, path string, offset long, length long"),
                 "aligned")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, count, best) of ``pairs(pair, docs)``: documents that hold the pair linked, and whether no pair of its
    first id has more. A first id has at most one pair for each id of the second vocabulary."""
    counts = pairs.groupBy("pair").agg(F.sum("docs").alias("count"))
    most = F.max("count").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.withColumn("best", F.col("count") == most)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                  ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])
OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
       "groups_sha256 string")


def finish(place: pa.Table, found: pa.Table) -> pa.Table:
    """The documents of one slice from its file and its pairs' corpus-wide counts."""
    source = Reader(place["path"][0].as_py())
    held = pa.ipc.open_stream(source.read(place["offset"][0].as_py(), place["length"][0].as_py())).read_all().combine_chunks()
    source.close()
    pos = found["pos"].to_numpy()
    count, best = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
    count[pos] = found["count"].to_numpy()
    best[pos] = found["best"].to_numpy()
    steps, weights = held["steps"].combine_chunks(), held["weights"].combine_chunks().flatten().to_numpy()
    ends = np.r_[0, np.cumsum(steps.value_lengths().to_numpy())]
    jumps = np.r_[0, np.cumsum(steps.flatten().to_numpy().astype(np.int64))]
    slot = jumps[1:] - np.repeat(jumps[ends[:-1]], np.diff(ends))

    def per_document(value: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(weights * value[slot])]
        return total[ends[1:]] - total[ends[:-1]]

    return pa.table([held["doc_id"], held["n_a"], held["n_b"], held["n_groups"], held["n_links"], pa.array(per_document(best)),
                     pa.array(per_document(count)), held["groups_sha256"]], schema=_OUT)


def aligned(docs: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """``docs(doc_id, text)`` aligned between two vocabularies: one row per row.

    doc_id; n_a, n_b (ids of either side); n_groups; n_links (pairs of tokens
    of one group); n_best (links whose pair's count is the highest of its first
    id in the corpus, ties included); count_sum (counts of all links);
    groups_sha256 of the groups in order, ``a1,a2|b1;a3|b2,b3``. Null and empty
    texts, bytes that are no UTF-8 and texts whose tokens do not spell a space
    and the text have no tokens: zeros and an empty digest column. Rows with
    equal or null doc_id are documents like any other; other columns are not
    read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = write_slices(docs, fresh_path(spark, "alignment"), first or public_tokenizers.path(FIRST),
                        second or public_tokenizers.path(SECOND))
    pairs = rows.where("path IS NULL").select("slice", "pos", "pair", "docs")
    counts = saved(pair_counts(pairs), "pair-counts")
    stats = pairs.join(counts, "pair").select("slice", "pos", "count", "best")
    places = rows.where("path IS NOT NULL").select(F.col("slice").alias("own"), "path", "offset", "length")
    return places.groupBy("own").cogroup(stats.groupBy("slice")).applyInArrow(finish, OUT)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``, aligned between the two contract vocabularies: see ``aligned``."""
    return aligned(table(spark, sf_dir, "documents"))
