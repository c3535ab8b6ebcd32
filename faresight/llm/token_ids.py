"""Token-id shards with a minimal perfect hash index for keyed access.

Shard file: the 16-byte header ``FSTOK1`` + item size (2 bytes, little-endian)
+ 8 zero bytes, then raw little-endian ids, 2 bytes each if the vocabulary
allows, else 4. Shards hold documents in ascending doc_id order.

Index: keys (doc_id, occurrence; 0 unless a doc_id has several rows) are dealt
by hash to buckets of about ``BUCKET_KEYS``. A bucket's file is a minimal
perfect hash function (levels of bit arrays: a key that is alone at its
position in a level stays there, the others go to the next level; a key's slot
is the number of bits set before its own) and, by slot, a 32-bit fingerprint
of the key, its shard, its offset and its number of ids. A look-up computes
the slot in constant time and rejects a foreign key by its fingerprint.
"""

from __future__ import annotations

import re
import struct
import zlib
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faresight.llm.blobs import Reader, Writer
from faresight.llm.common import bytes_of, map_arrow, record, saved, ship, slices, table, text_of
from faresight.session import fresh_path

#: Contract of the registered query.
VOCABULARY = "word_bpe_49k.json"
END_ID = 2

#: Keys of an index bucket, on average.
BUCKET_KEYS = 100_000
#: Words a Python worker keeps encoded.
CACHED_WORDS = 500_000
#: Bits of a level per key still without a slot.
LOAD = 1.6
LEVELS = 48

MAGIC = b"FSTOK1"
_SHARDED = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("ordinal", pa.int64()), ("doc_id", pa.int64()),
                      ("offset", pa.int64()), ("n_tokens", pa.int64())])


# --- encoding -------------------------------------------------------------------------------

class WordEncoder(dict):
    """Ids of whole texts by way of their words, each encoded once and kept.

    The vocabulary drops white space and never joins what it separates, so a
    text's ids are the ids of its words in turn. A word of plain characters
    (printable ASCII and the Latin-1 letters, which normalisation only
    lower-cases) is cut into the pieces that the vocabulary's pattern would
    cut, and each new piece goes to the tokenizer's model; any other word goes
    through the whole tokenizer. Up to ``CACHED_WORDS`` words and pieces stay.
    """

    PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
    # The pieces of the vocabulary's pre-tokenizer, for plain characters.
    PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.as_bytes = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        specials = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(specials) or r"(?!)")
        self.dtype = np.dtype("<u2" if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        self.pieces: dict[str, list[int]] = {}
        # entry 0 is the end of a document; splitting never gives an empty word
        super().__init__({b"": 0})
        self.flat, self.lengths, self.pending = np.array([end_id], self.dtype), np.ones(1, np.int64), []

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        self.pending.append(word)
        return at

    def _piece(self, piece: str) -> list[int]:
        """Ids of a piece that is not kept."""
        mapped = piece if piece.isascii() else piece.translate(self.as_bytes)
        ids = [t.id for t in self.model.tokenize(mapped)]
        if len(self.pieces) < CACHED_WORDS:
            self.pieces[piece] = ids
        return ids

    def word(self, word: str) -> list[int]:
        if self.PLAIN.fullmatch(word) and not self.special.search(word):
            known, pieces = self.pieces, self.PIECES.findall(word.lower())
            if len(pieces) == 1:
                return known.get(pieces[0]) or self._piece(pieces[0])
            return [i for piece in pieces for i in known.get(piece) or self._piece(piece)]
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in turn, each with its end id; number of ids of each)."""
        look, known = self.__getitem__, len(self)
        words = [[*map(look, t.split()), 0] for t in texts]
        if self.pending:
            new = [self.word(w.decode()) for w in self.pending]
            self.flat = np.r_[self.flat, np.fromiter(chain.from_iterable(new), self.dtype)]
            self.lengths = np.r_[self.lengths, [len(ids) for ids in new]]
        ends = np.cumsum([len(w) for w in words])
        index = np.fromiter(chain.from_iterable(words), np.int64, ends[-1])
        sizes = self.lengths[index]
        stops = np.cumsum(sizes)
        starts = (np.cumsum(self.lengths) - self.lengths)[index] - (stops - sizes)
        ids = self.flat[np.arange(stops[-1]) + np.repeat(starts, sizes)]
        if len(self) > CACHED_WORDS:  # the words that came with these texts are not kept
            for w in self.pending:
                del self[w]
            self.lengths = self.lengths[:known]
            self.flat = self.flat[:int(self.lengths.sum())]
        self.pending = []
        return ids, np.diff(np.r_[0, stops[ends - 1]])


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, end_id: int) -> WordEncoder:
    """This worker's encoder; it lives as long as the worker."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = WordEncoder(path, end_id)
    return _ENCODERS[path, end_id]


def write_shards(docs: DataFrame, folder: str, vocabulary: str, end_id: int) -> DataFrame:
    """Write ``docs(doc_id, text)`` as shards in doc_id order; one row per document with its place.

    shard numbers ascend with doc_id; ``offset`` and ``n_tokens`` count ids.
    """
    def kernel(batches):
        shard = TaskContext.get().partitionId()
        out, at, ordinal = None, 0, 0
        for batch in slices(batches):
            codes = encoder(vocabulary, end_id)
            if out is None:
                out = Writer(folder, f"shard-{shard:06d}", "ids")
                out.write(MAGIC + struct.pack("<HQ", codes.dtype.itemsize, 0))
            data, ends = bytes_of(batch.column(1))
            raw = data.tobytes()
            ids, counts = codes.encode([raw[a:b] for a, b in zip(ends[:-1], ends[1:])])
            out.write(ids.tobytes())
            n = batch.num_rows
            yield record(_SHARDED, np.full(n, shard, np.int32), [out.location] * n, np.arange(ordinal, ordinal + n),
                         batch.column(0), at + np.cumsum(counts) - counts, counts)
            at, ordinal = at + int(counts.sum()), ordinal + n
        if out is not None:
            out.close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return saved(map_arrow(rows, kernel, "shard int, path string, ordinal long, doc_id long, offset long, n_tokens long"),
                 "sharded")


# --- minimal perfect hash ---------------------------------------------------------------------

def _mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit mix of each key with a salt."""
    x = keys ^ np.uint64((salt * 0x9E3779B97F4A7C15 + 0x1234567) & (2 ** 64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of different 64-bit keys onto 0 .. n-1.

    Keys that no level could separate (none, but for chance) follow the bit
    arrays' slots, in ascending order.
    """

    def __init__(self, sizes: np.ndarray, words: np.ndarray, rest: np.ndarray):
        self.sizes, self.words, self.rest = sizes, words, rest
        self.bases = np.cumsum(sizes) - sizes
        ones = np.bitwise_count(words).astype(np.int64)
        self.ranks = np.cumsum(ones) - ones
        self.set_bits = int(ones.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, chosen, base = [], [], 0
        while len(keys) and len(sizes) < LEVELS:
            size = max(64, -(-int(len(keys) * LOAD) // 64) * 64)
            at = (_mixed(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size)[at] == 1
            chosen.append(base + at[alone])
            keys, base = keys[~alone], base + size
            sizes.append(size)
        words = np.zeros(base // 64, np.uint64)
        bits = np.concatenate(chosen) if chosen else np.zeros(0, np.int64)
        np.bitwise_or.at(words, bits // 64, np.uint64(1) << (bits % 64).astype(np.uint64))
        return cls(np.array(sizes, np.int64), words, np.sort(keys))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; any slot, or -1, for a key that was not built in."""
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = self.bases[level] + (_mixed(keys[open_], level) % np.uint64(size)).astype(np.int64)
            word, bit = self.words[at // 64], (at % 64).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[open_[hit]] = (self.ranks[at // 64] + below)[hit]
            open_ = open_[~hit]
        if len(open_) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            hit = self.rest[at] == keys[open_]
            out[open_[hit]] = self.set_bits + at[hit]
        return out


def _key(doc_id: np.ndarray, absent: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    """64-bit key of (doc_id or null, occurrence)."""
    first = _mixed(doc_id.astype(np.int64).view(np.uint64), 101)
    first[absent] = np.uint64(0x5851F42D4C957F2D)
    return _mixed(first ^ _mixed(occurrence.astype(np.int64).view(np.uint64), 102), 103)


def _entry(frame: pd.DataFrame) -> np.ndarray:
    absent = frame["doc_id"].isna().to_numpy()
    return _key(frame["doc_id"].fillna(0).to_numpy(np.int64), absent, frame["occurrence"].to_numpy(np.int64))


_ENTRY = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("n", "<u8")])


def _packed(hashes: PerfectHash, entries: np.ndarray) -> bytes:
    head = struct.pack("<QQQQ", len(hashes.sizes), len(hashes.words), len(hashes.rest), len(entries))
    return b"".join([head, hashes.sizes.tobytes(), hashes.words.tobytes(), hashes.rest.tobytes(), entries.tobytes()])


def _unpacked(data: bytes) -> tuple[PerfectHash, np.ndarray]:
    levels, words, rest, n = struct.unpack_from("<QQQQ", data)
    parts, at = [], 32
    for dtype, count in (("<i8", levels), ("<u8", words), ("<u8", rest), (_ENTRY, n)):
        parts.append(np.frombuffer(data, dtype, count, at))
        at += parts[-1].nbytes
    return PerfectHash(*parts[:3]), parts[3]


# --- index and access ---------------------------------------------------------------------------

def _numbered(sharded: DataFrame) -> DataFrame:
    """``sharded`` with ``occurrence``, a row's number among those of its doc_id; counted by
    shard first, so that a doc_id with very many rows is not one task's."""
    counts = sharded.groupBy("doc_id", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("doc_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("doc_id", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy("doc_id", "shard").orderBy("ordinal")
    rows = sharded.withColumn("own", F.row_number().over(inside) - 1)
    same = F.col("r.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("r.shard") == F.col("c.shard"))
    return rows.alias("r").join(counts.alias("c"), same).select("r.*", (F.col("own") + F.col("earlier")).alias("occurrence"))


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    number = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), "occurrence"), F.lit(buckets))
    return rows.withColumn("bucket", number.cast("int"))


def build_index(sharded: DataFrame, folder: str) -> DataFrame:
    """(bucket, path, keys): the index files over ``sharded``."""
    ship(sharded.sparkSession)
    buckets = max(1, -(-sharded.count() // BUCKET_KEYS))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        keys = _entry(frame)
        hashes = PerfectHash.build(keys)
        entries = np.zeros(len(keys), _ENTRY)
        at = hashes.slots(keys)
        entries["fingerprint"][at] = _mixed(keys, 104) >> np.uint64(32)
        for name, column in (("shard", "shard"), ("offset", "offset"), ("n", "n_tokens")):
            entries[name][at] = frame[column].to_numpy()
        out = Writer(folder, f"index-{frame['bucket'].iloc[0]:06d}", "mph")
        out.write(_packed(hashes, entries))
        out.close()
        return pd.DataFrame({"bucket": [frame["bucket"].iloc[0]], "path": [out.location], "keys": [len(keys)],
                             "buckets": [buckets]})

    rows = _bucketed(_numbered(sharded), buckets).select("bucket", "doc_id", "occurrence", "shard", "offset", "n_tokens")
    return saved(rows.groupBy("bucket").applyInPandas(build, "bucket int, path string, keys long, buckets int"), "index")


def look_up(index: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc_id, occurrence, shard, offset, n_tokens) of the ``keys(doc_id, occurrence)`` that the index holds."""
    first = index.select("buckets").first()
    if first is None:
        return keys.select("doc_id", "occurrence", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("offset"),
                           F.lit(0).cast("long").alias("n_tokens")).where("false")

    def find(frame: pd.DataFrame) -> pd.DataFrame:
        source = Reader(frame["path"].iloc[0])
        hashes, entries = _unpacked(source.read(0, source.size))
        source.close()
        own = _entry(frame)
        at = hashes.slots(own)
        there = at >= 0
        there[there] = entries["fingerprint"][at[there]] == (_mixed(own[there], 104) >> np.uint64(32))
        got = entries[at[there]]
        return pd.DataFrame({"doc_id": frame["doc_id"][there], "occurrence": frame["occurrence"][there],
                             "shard": got["shard"].astype(np.int32), "offset": got["offset"].astype(np.int64),
                             "n_tokens": got["n"].astype(np.int64)})

    # a bucket's keys are dealt to several tasks, by hash, so that a rerun task deals them alike
    run = F.pmod(F.xxhash64(F.lit(1), "doc_id", "occurrence"), F.lit(4)).cast("int")
    rows = _bucketed(keys, first[0]).join(index.select("bucket", "path"), "bucket").withColumn("run", run)
    return rows.groupBy("bucket", "run").applyInPandas(
        find, "doc_id long, occurrence long, shard int, offset long, n_tokens long")


_READ = pa.schema([("doc_id", pa.int64()), ("occurrence", pa.int64()), ("shard", pa.int32()), ("offset", pa.int64()),
                   ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_digests(places: DataFrame, shards: DataFrame) -> DataFrame:
    """``places`` with ids_crc32, the checksum of the ids read from the shard files.

    ``shards``: (shard, path).
    """
    def kernel(batches):
        source, path = None, None
        for batch in batches:
            frame = batch.to_pandas()
            crcs = np.zeros(len(frame), np.int64)
            starts = np.flatnonzero(np.r_[True, frame["path"].to_numpy()[1:] != frame["path"].to_numpy()[:-1]]) \
                if len(frame) else []
            for a, b in zip(starts, [*starts[1:], len(frame)]):
                if frame["path"].iloc[a] != path:
                    if source is not None:
                        source.close()
                    path = frame["path"].iloc[a]
                    source = Reader(path)
                    head = source.read(0, 16)
                    if head[:6] != MAGIC:
                        raise ValueError(f"{path} is no shard of ids")
                    width = struct.unpack_from("<H", head, 6)[0]
                spans = [(16 + o * width, n * width) for o, n in zip(frame["offset"].iloc[a:b], frame["n_tokens"].iloc[a:b])]
                for i, data in enumerate(source.ranges(spans), a):
                    ids = np.frombuffer(data, "<u2" if width == 2 else "<u4")
                    crcs[i] = zlib.crc32(ids.astype("<u4").tobytes())
            yield record(_READ, *[batch.column(i) for i in range(5)], crcs)
        if source is not None:
            source.close()

    rows = (places.join(shards, "shard").select("doc_id", "occurrence", "shard", "offset", "n_tokens", "path")
            .repartitionByRange("shard", "offset").sortWithinPartitions("shard", "offset"))
    return map_arrow(rows, kernel, "doc_id long, occurrence long, shard int, offset long, n_tokens long, ids_crc32 long")


def encoded(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Encode ``docs`` to shards, index them, and read every document back by its key.

    One row per row of ``docs``: doc_id, start (ids of all documents before
    it), n_tokens (with the end id), ids_crc32, shard, offset. Documents are in
    ascending doc_id order, rows without doc_id last, rows of equal doc_id in
    the order of a hash of their texts. Null text counts as empty: the end id
    alone. Other columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    folder = fresh_path(spark, "token-ids")
    sharded = write_shards(docs, folder, vocabulary, end_id)
    index = build_index(sharded, folder)

    copies = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count("*").alias("n"))
    keys = copies.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("occurrence"))
    shards = sharded.groupBy("shard").agg(F.first("path").alias("path"), F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = saved(shards.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0))), "shards")
    read = read_digests(look_up(index, keys), shards.select("shard", "path"))
    return (read.join(shards.select("shard", "base"), "shard")
            .select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "shard", "offset"))


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: doc_id, start, n_tokens, ids_crc32."""
    return encoded(table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")
