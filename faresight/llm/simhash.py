"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are 64-bit majority votes over the XXH64 hashes of word
shingles. Every pair of different fingerprints within ``radius`` bits is found
exactly, without comparing all pairs:

* Copies of one fingerprint are one row before anything is compared.
* The 64 bits are cut into bands of which, by the pigeonhole principle, one
  differs in at most one bit for every pair within the radius. A band's tile
  is the vector of population counts of its 4-bit segments. One differing bit
  moves one count by one, so a fingerprint meets only its own tile and, as a
  visitor, the tiles with one count higher: all other tile pairs have
  population counts that differ beyond what the radius allows and are skipped.
* Inside a tile the rows are ordered by the population count of all 64 bits,
  cut into blocks, and block pairs whose counts differ beyond the radius are
  skipped; the rest is compared with numpy's exclusive-or and bit counts.
* A tile with more than ``TILE_ROWS`` fingerprints is dealt to several tasks
  as pairs of chunks, each pair compared once, so no task holds a whole tile.

A task passes on a spanning forest of the links it found, which has the same
components as the links and never more rows than the tile. Components are
found by star contraction over tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faresight.llm.common import bytes_of, map_arrow, record, row_key, saved, slices, table, text_of, whole_row

#: Contract of the registered query.
SHINGLE_WORDS = 3
RADIUS = 2

#: Fingerprints of one tile that one task compares; larger tiles are dealt out in chunk pairs.
TILE_ROWS = 50_000
#: Rows of a block inside a tile.
BLOCK = 1024
#: Groups up to this size are compared lag by lag, many groups at a time.
SMALL = 32
#: Bytes of a long text that are cut into words at a time.
PIECE = 1 << 20

_FP = pa.schema([("doc_id", pa.int64()), ("row_key", pa.string()), ("fp", pa.int64())])
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    """Words of a text, a bounded run at a time; no word is cut."""
    start = 0
    while start < len(data):
        stop = min(len(data), start + PIECE)
        while stop < len(data) and data[stop] not in b" \t\n\x0b\x0c\r":
            stop += 1
        yield data[start:stop].split()
        start = stop


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """SimHash of a UTF-8 text as an unsigned 64-bit number; no words give 0."""
    digest = xxhash.xxh64_intdigest
    votes, n, tail = np.zeros(64, np.int64), 0, []
    for words in _pieces(text.lower()):
        words = tail + words
        if len(words) < width:
            tail = words
            continue
        starts = list(accumulate((len(w) + 1 for w in words), initial=0))
        line = b" ".join(words)
        hashes = np.array([digest(line[a:b - 1], 42) for a, b in zip(starts, starts[width:])], np.uint64)
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(hashes)
        tail = words[len(words) - width + 1:] if width > 1 else []
    if not n:
        return digest(b" ".join(tail), 42) if tail else 0
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, row_key, fp) per row of ``docs``; fp is the fingerprint as a signed long."""
    def kernel(batches):
        for batch in slices(batches):
            data, ends = bytes_of(batch.column(2))
            raw = data.tobytes()
            fps = np.array([fingerprint(raw[a:b], width) for a, b in zip(ends[:-1], ends[1:])], np.uint64)
            yield record(_FP, batch.column(0), batch.column(1), fps.view(np.int64))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       row_key().alias("row_key"), text_of().alias("text"))
    return map_arrow(rows, kernel, "doc_id long, row_key string, fp long")


def _bands(radius: int) -> list[list[int]]:
    """Segment numbers (0 to 15) of each band; one band differs in one bit at most."""
    count = radius // 2 + 1
    return [list(map(int, part)) for part in np.array_split(np.arange(16), count)]


def _tiled(nodes: DataFrame, radius: int) -> DataFrame:
    """(band, tile, visitor, fp): a fingerprint's own tile and those it visits, for each band."""
    entries = []
    for band, segments in enumerate(_bands(radius)):
        counts = [F.bit_count(F.shiftrightunsigned("fp", 4 * s).bitwiseAND(F.lit(15))).cast("long") for s in segments]
        weights = [5 ** k for k in range(len(segments))]
        own = sum((c * F.lit(w) for c, w in zip(counts, weights)), F.lit(0)).cast("long")
        entries.append(F.struct(F.lit(band).alias("band"), own.alias("tile"), F.lit(0).alias("visitor")))
        for c, w in zip(counts, weights):
            entries.append(F.when(c < 4, F.struct(F.lit(band).alias("band"), (own + w).alias("tile"),
                                                  F.lit(1).alias("visitor"))))
    return (nodes.select("fp", F.explode(F.array_compact(F.array(*entries))).alias("e"))
            .select("e.band", "e.tile", "e.visitor", "fp"))


def _find(parent: dict, x):
    while parent.setdefault(x, x) != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def forest(a: np.ndarray, b: np.ndarray) -> tuple[list, list]:
    """A spanning forest of the given links as two lists of ends."""
    parent: dict = {}
    left, right = [], []
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = _find(parent, x), _find(parent, y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            left.append(x)
            right.append(y)
    return left, right


def _near(x: np.ndarray, y: np.ndarray, radius: int) -> np.ndarray:
    return np.bitwise_count(np.bitwise_xor(x, y)) <= radius


def tile_links(fp: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside one tile, or between two chunks of a large one."""
    order = np.argsort(np.bitwise_count(fp), kind="stable")
    fp, side = fp[order], side[order]
    ones = np.bitwise_count(fp).astype(np.int64)
    found: list[tuple[list, list]] = []
    for i in range(0, len(fp), BLOCK):
        x, sx = fp[i:i + BLOCK], side[i:i + BLOCK]
        for j in range(i, len(fp), BLOCK):
            if ones[j] - ones[min(i + BLOCK, len(fp)) - 1] > radius:
                break
            y, sy = fp[j:j + BLOCK], side[j:j + BLOCK]
            near = _near(x[:, None], y[None, :], radius) & _meets(sx[:, None], sy[None, :])
            if i == j:
                near &= np.triu(np.ones(near.shape, bool), 1)
            p, q = np.nonzero(near)
            if len(p):
                found.append(forest(x[p], y[q]))
    a = np.array([v for f in found for v in f[0]], np.uint64)
    b = np.array([v for f in found for v in f[1]], np.uint64)
    return a, b


def _meets(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Which sides are compared. 0 home and 1 visitor of an undivided tile; 2 and 3
    home rows of two different chunks, 4 and 5 the visitors of the same chunks."""
    low, high = np.minimum(s, t), np.maximum(s, t)
    return ((low == 0) & (high <= 1)) | ((low == 2) & ((high == 3) | (high == 5))) | ((low == 3) & (high == 4))


def _links_kernel(radius: int):
    def groups(batches):
        """Arrays (key, fp, side) of whole groups; a group cut by a batch end waits for its rest."""
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if rest is not None:
                now = [np.concatenate(p) for p in zip(rest, now)]
            cut = int(np.flatnonzero(now[0] != now[0][-1])[-1]) + 1 if now[0][0] != now[0][-1] else 0
            if cut:
                yield [c[:cut] for c in now]
            rest = [c[cut:] for c in now]
        if rest is not None:
            yield rest

    def kernel(batches):
        for key, fp, side in groups(batches):
            fp = fp.astype(np.int64).view(np.uint64)
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            a, b = [], []
            small = np.repeat(sizes <= SMALL, sizes)
            for lag in range(1, int(min(SMALL, sizes.max()))):
                same = (key[lag:] == key[:-lag]) & small[lag:]
                at = np.flatnonzero(same)
                if not len(at):
                    break
                near = _near(fp[at], fp[at + lag], radius) & _meets(side[at], side[at + lag])
                a.append(fp[at[near]])
                b.append(fp[at[near] + lag])
            for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
                x, y = tile_links(fp[s:s + n], side[s:s + n], radius)
                a.append(x)
                b.append(y)
            left, right = forest(np.concatenate(a), np.concatenate(b)) if a else ([], [])
            if left:
                yield record(_LINK, np.array(left, np.uint64).view(np.int64), np.array(right, np.uint64).view(np.int64))
    return kernel


def links(nodes: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(a, b): links whose components are those of all pairs of ``nodes.fp`` within the radius.

    ``nodes`` has one row per different fingerprint.
    """
    tiled = _tiled(nodes, radius)
    large = (tiled.groupBy("band", "tile").count().where(F.col("count") > tile_rows)
             .select("band", "tile", F.ceil(F.col("count") / tile_rows).cast("int").alias("chunks")))
    dealt = tiled.join(large, ["band", "tile"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    # Chunk pair (i, j), i <= j, of a large tile: inside a chunk the plain rule,
    # across two chunks side 2 against 3. A visitor of chunk i meets the home rows
    # of every chunk.
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.struct(
        F.least(c, mine).alias("i"), F.greatest(c, mine).alias("j"),
        F.when(c == mine, F.lit(0)).when(mine < c, F.lit(2)).otherwise(F.lit(3)).alias("chunk_side")))
    rows = (dealt.select("band", "tile", "visitor", "fp", F.explode(cells).alias("c"))
            .select(F.xxhash64("band", "tile", "c.i", "c.j").alias("cell"), "band", "tile", "fp", "visitor",
                    "c.chunk_side"))
    side = (F.when(F.col("chunk_side") == 0, F.col("visitor"))
            .when(F.col("visitor") == 0, F.col("chunk_side")).otherwise(F.col("chunk_side") + 2))
    rows = rows.select("cell", "fp", side.cast("int").alias("side"))
    rows = rows.repartition("cell").sortWithinPartitions("cell", "fp", "side")
    return map_arrow(rows, _links_kernel(radius), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; root is the smallest node reachable.

    Alternates large-star and small-star contraction until nothing changes;
    each round is written to the shared folder.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now, state = saved(ordered.distinct(), "stars"), None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = saved(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v")
        now = saved(small.distinct(), "small-star")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: doc_id, row_key, fp, fingerprint, component_id.

    Fingerprints link at ``radius`` or fewer differing bits; component_id is
    the smallest doc_id reachable over links, the row's own included. Null
    text counts as empty; texts without words have fingerprint 0, linked like
    any other. A row without doc_id takes part, and component_id is null only
    if no row of its component has a doc_id. Repeated rows and rows with equal
    doc_id are rows of their own. Other columns are not read, so clashing
    names do no harm. An empty table gives an empty result.
    """
    rows = saved(fingerprints(docs, width), "fingerprints")
    nodes = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("head")), "nodes")
    found = components(links(nodes.select("fp"), radius))
    rooted = (nodes.join(found.select(F.col("node").alias("fp"), "root"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    lowest = rooted.groupBy("root").agg(F.min("head").alias("component_id"))
    member = rooted.join(lowest, "root").select("fp", "root", "component_id")
    return (rows.join(member, "fp")
            .withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0")))
            .select("doc_id", "row_key", "fp", "root", "fingerprint", "component_id"))


def keep_one(docs: DataFrame, width: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each near-duplicate component, all columns as they were.

    The row with the smallest doc_id stays (rows without doc_id last), of
    repeated rows one; ties go to the smallest digest of (doc_id, text).
    """
    found = near_duplicates(docs, width, radius)
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row_key")
    stays = found.groupBy("root").agg(F.min(order).alias("k")).select(F.col("k.row_key").alias("row_key"))
    one = Window.partitionBy("row_key").orderBy("row_key")
    return (docs.select(whole_row(docs), row_key().alias("row_key")).join(stays, "row_key", "left_semi")
            .withColumn("number", F.row_number().over(one)).where("number = 1").select("row.*"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: doc_id, fingerprint, component_id."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
