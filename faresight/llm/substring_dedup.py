"""Removal of repeated byte strings with sparse suffix sorting.

A byte goes if a 100-byte window over it also begins earlier in the corpus.
Not all windows need to meet: every window holds 32-byte grams, and the one
with the smallest hash, its anchor, depends on the window's bytes alone. Equal
windows have equal anchors at equal places, so it is enough to compare windows
around equal anchors.

1. Anchors of all texts, with a hash of the up to 168 bytes that windows over
   the anchor can reach, its surroundings. Of anchors that agree in gram and
   surroundings all but the first lose all their windows. A task does this
   with its own rows first, so that a string that a third of all documents
   share sends one row per task slice and not one per document.
2. Where a gram has several surroundings, the first anchor of each is looked
   at byte by byte: the bytes after and before it are sorted by deep-shallow
   suffix sorting (``suffix_sort``). From the prefixes that neighbours in the
   order share, windows are put into classes; in each class all but the first
   go.
3. The removed ranges of a document are united and cut out of its text.

A gram with more than ``GROUP_ROWS`` different surroundings is not gathered:
its windows are spread out as rows and their classes found by grouping.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faresight.llm.common import bytes_of, map_arrow, record, release, saved, slices, table, text_of
from faresight.llm.suffix_sort import deep_shallow

#: Contract of the registered query: bytes of a string that may occur once only.
LENGTH = 100

GRAM = 32
#: Different surroundings of one gram that one task compares.
GROUP_ROWS = 200_000
#: Rows that a task sorts at a time, in whole groups.
CHUNK_ROWS = 60_000
#: Depths of the shallow sort of the bytes after (they begin with the same gram) and before.
SHALLOW_AFTER, SHALLOW_BEFORE = 40, 16
#: Order number of rows without doc_id: after all others.
LAST = (1 << 63) - 1

#: Places of a window relative to its anchor: it begins up to this many bytes before.
REACH = LENGTH - GRAM


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _word(data: np.ndarray, shift: int, n: int) -> np.ndarray:
    """The 8 bytes from each of ``n`` places on, as numbers."""
    return np.ndarray((n,), "<u8", data.data, shift, (1,))


def _spaced(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with LENGTH + REACH zero bytes around each, and where each begins."""
    gap = LENGTH + REACH
    starts = ends[:-1] + gap * np.arange(1, len(ends))
    out = np.zeros(int(ends[-1]) + gap * len(ends), np.uint8)
    out[np.arange(len(data)) + np.repeat(starts - ends[:-1], np.diff(ends))] = data
    return out, starts


def _slide(x: np.ndarray, op, width: int) -> np.ndarray:
    """``op`` over every run of ``width`` neighbours."""
    have = 1
    while 2 * have <= width:
        x, have = op(x[:-have], x[have:]), 2 * have
    return op(x[:len(x) - (width - have)], x[width - have:]) if have < width else x


def anchors(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, gram hashes) of the anchors in spaced texts; all that tie in a window."""
    n = len(data) - GRAM + 1
    gram = _mix(_word(data, 0, n) + np.uint64(0x632BE59BD9B4E019))
    for shift in range(8, GRAM, 8):
        gram = _mix(gram + _word(data, shift, n))
    # 0 stands for places outside every window below, so no gram has it
    value = np.maximum((gram >> np.uint64(32)).astype(np.uint32), np.uint32(1))
    low = _slide(value, np.minimum, REACH + 1)
    # windows are inside one text
    windows = np.zeros(len(low) + 1, np.int32)
    long_ = sizes >= LENGTH
    np.add.at(windows, starts[long_], 1)
    np.add.at(windows, starts[long_] + sizes[long_] - LENGTH + 1, -1)
    low[np.cumsum(windows[:-1]) == 0] = 0
    edge = np.zeros(REACH, np.uint32)
    high = _slide(np.concatenate([edge, low, edge]), np.maximum, REACH + 1)[:n]
    at = np.flatnonzero((high == value) & (high > 0))
    return at, gram[at]


def _surroundings(data: np.ndarray, at: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Hash of the bytes from REACH before to LENGTH after each anchor, and of how many are its text's."""
    out = _mix((before * 256 + after).astype(np.uint64))
    words = np.ndarray((len(data) - 7,), "<u8", data.data, 0, (1,))
    for shift in range(-REACH, LENGTH, 8):
        out = _mix(out + words[at + min(shift, LENGTH - 8)])
    return out


_ANCHOR = pa.schema([("g", pa.int64()), ("c", pa.int64()), ("d", pa.int64()), ("h", pa.int64()), ("at", pa.int64()),
                     ("gone", pa.bool_())])
_ANCHOR_SQL = "g long, c long, d long, h long, at long, gone boolean"
_MARK = pa.schema([("d", pa.int64()), ("h", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("g", pa.int64())])
_MARK_SQL = "d long, h long, start long, end long, g long"


def _anchor_kernel(batches):
    """Anchor rows. ``at`` packs place, bytes before and bytes after. gone: an earlier
    anchor of this slice agrees in gram and surroundings; such a row needs no meeting
    and is keyed by its own place."""
    for batch in slices(batches):
        raw, ends = bytes_of(batch.column(2))
        sizes = np.diff(ends)
        if not (sizes >= LENGTH).any():
            continue
        data, starts = _spaced(raw, ends)
        at, gram = anchors(data, starts, sizes)
        if not len(at):
            continue
        text = np.searchsorted(starts, at, side="right") - 1
        place = at - starts[text]
        before, after = np.minimum(place, REACH), np.minimum(sizes[text] - place, LENGTH)
        round_ = _surroundings(data, at, before, after)
        d, h = (batch.column(i).to_numpy(zero_copy_only=False)[text] for i in (0, 1))
        order = np.lexsort((place, h, d, round_, gram))
        g, c, d, h, place, before, after = (x[order] for x in (gram, round_, d, h, place, before, after))
        alike = (g[1:] == g[:-1]) & (c[1:] == c[:-1])
        twice = alike & (d[1:] == d[:-1]) & (h[1:] == h[:-1]) & (place[1:] == place[:-1])
        once, gone = ~np.r_[False, twice], np.r_[False, alike]
        key = np.where(gone, _mix(_mix(d.view(np.uint64)) + place.astype(np.uint64)), g).view(np.int64)
        packed = (place << 16) | (before << 8) | after
        yield record(_ANCHOR, *(x[once] for x in (key, c.view(np.int64), d, h, packed, gone)))


def _reach(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of all windows over an anchor."""
    place, before, after = packed >> 16, (packed >> 8) & 255, packed & 255
    return place - before, place + after


def _meeting_kernel(batches):
    """Marks of anchors in (g, c, d, h, at) order. A mark with g = 0 is a removed range; any
    other is the first anchor of its surroundings, of a gram that has several: it carries
    the place as start."""
    last, open_ = None, None  # the row before; the first anchor of the gram, while it has one surroundings
    for batch in batches:
        if not batch.num_rows:
            continue
        g, c, d, h, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        gone = batch.column(5).to_numpy(zero_copy_only=False)
        prior = last if last is not None else (None,) * 5
        same_g = np.r_[g[0] == prior[0] if last else False, g[1:] == g[:-1]]
        same_c = same_g & np.r_[c[0] == prior[1] if last else False, c[1:] == c[:-1]]
        twice = same_c & np.r_[(d[0], h[0], at[0]) == prior[2:] if last else False,
                               (d[1:] == d[:-1]) & (h[1:] == h[:-1]) & (at[1:] == at[:-1])]
        removed = (gone | same_c) & ~twice
        first = ~gone & ~same_c
        # a gram's first anchors count once it is known to have two
        new_g = np.cumsum(first & ~same_g)
        firsts = np.flatnonzero(first)
        several = np.zeros(len(g), bool)
        follows = firsts[same_g[firsts]]
        several[follows] = True
        leads = np.searchsorted(new_g, np.unique(new_g[follows][new_g[follows] > 0]))
        several[leads] = True
        rows = [(d[removed], h[removed], *_reach(at[removed]), np.zeros(int(removed.sum()), np.int64)),
                (d[several], h[several], at[several] >> 16, at[several] >> 16, _gram_key(g[several]))]
        if open_ is not None and len(follows) and (new_g[follows] == 0).any():
            rows.append(tuple(np.array([x]) for x in open_))
            open_ = None
        if new_g[-1]:
            lead = int(np.searchsorted(new_g, new_g[-1]))
            open_ = None if several[lead] else (d[lead], h[lead], at[lead] >> 16, at[lead] >> 16, _gram_key(g[lead:lead + 1])[0])
        elif not same_g[-1]:
            open_ = None
        last = (g[-1], c[-1], d[-1], h[-1], at[-1])
        yield record(_MARK, *(np.concatenate(x) for x in zip(*rows)))


def _gram_key(g: np.ndarray) -> np.ndarray:
    return np.where(g == 0, 1, g)


_CONTEXT = pa.schema([("g", pa.int64()), ("d", pa.int64()), ("h", pa.int64()), ("place", pa.int64()),
                      ("before", pa.binary()), ("after", pa.binary())])


def _context_kernel(batches):
    """The bytes before (nearest first) and after each wanted place."""
    for batch in batches:
        rows = []
        for d, h, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(4))):
            raw = text.encode()
            for w in wanted:
                p = w["start"]
                rows.append((w["g"], d, h, p, raw[max(0, p - REACH):p][::-1], raw[p:p + LENGTH]))
        for i in range(0, len(rows), 20_000):
            yield record(_CONTEXT, *map(list, zip(*rows[i:i + 20_000])))


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of bytes filled up with zeros, and how many are their own."""
    data, ends = bytes_of(column)
    sizes = np.diff(ends)
    out = np.zeros((len(sizes), width), np.uint8)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(data)) - ends[:-1][row]] = data
    return out, sizes


def repeated_windows(group: np.ndarray, before: np.ndarray, n_before: np.ndarray, after: np.ndarray,
                     n_after: np.ndarray) -> np.ndarray:
    """For anchors in corpus order inside ascending groups: whether the window that begins x
    bytes before an anchor (column x) equals that of an earlier anchor of its group."""
    n = len(group)
    order_a, common_a = deep_shallow(after, group, SHALLOW_AFTER)
    order_b, common_b = deep_shallow(before, group, SHALLOW_BEFORE)
    class_a, class_b = np.zeros(n, np.int64), np.zeros(n, np.int64)
    out = np.zeros((n, REACH + 1), bool)
    for x in range(REACH + 1):
        there = np.flatnonzero((n_before >= x) & (n_after >= LENGTH - x))
        class_a[order_a] = np.cumsum(common_a < LENGTH - x)
        class_b[order_b] = np.cumsum(common_b < x)
        key = class_a[there] * (n + 1) + class_b[there]
        _, first = np.unique(key, return_index=True)
        out[there, x] = True
        out[there[first], x] = False
    return out


def _sorting_kernel(batches):
    """Removed ranges of contexts in (g, d, h, place) order."""
    waiting: list[pa.RecordBatch] = []

    def ranges(rows: pa.Table):
        columns = [rows.column(i).combine_chunks() for i in range(6)]
        g, d, h, place = (c.to_numpy(zero_copy_only=False) for c in columns[:4])
        before, n_before = _matrix(columns[4], REACH)
        after, n_after = _matrix(columns[5], LENGTH)
        gone = repeated_windows(g, before, n_before, after, n_after)
        step = np.diff(np.pad(gone, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        (row, first), (_, past) = np.nonzero(step == 1), np.nonzero(step == -1)
        return record(_MARK, d[row], h[row], place[row] - past + 1, place[row] - first + LENGTH, np.zeros(len(row), np.int64))

    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) >= CHUNK_ROWS:
            rows = pa.Table.from_batches(waiting)
            g = rows.column(0).to_numpy()
            whole = int(np.searchsorted(g, g[-1]))
            if whole:
                yield ranges(rows.slice(0, whole))
                waiting = rows.slice(whole).to_batches()
    if waiting:
        yield ranges(pa.Table.from_batches(waiting))


_WINDOW = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("d", pa.int64()), ("h", pa.int64()), ("start", pa.int64())])


def _window_kernel(batches):
    """All windows over each wanted place, by a 128-bit digest of their bytes."""
    for batch in batches:
        for d, h, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(4))):
            raw = text.encode()
            rows = []
            for w in wanted:
                for start in range(max(0, w["start"] - REACH), min(w["start"], len(raw) - LENGTH) + 1):
                    k = np.frombuffer(hashlib.md5(raw[start:start + LENGTH]).digest(), np.int64)
                    rows.append((int(k[0]), int(k[1]), d, h, start))
                if len(rows) >= 10_000:
                    yield record(_WINDOW, *map(list, zip(*rows)))
                    rows = []
            if rows:
                yield record(_WINDOW, *map(list, zip(*rows)))


def _keyed(docs: DataFrame, repeats: bool) -> DataFrame:
    """(doc_id, d, h, text): order number of the doc_id, and of the text among its rows."""
    tie = F.xxhash64(text_of()) if repeats else F.lit(0).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("d"), tie.alias("h"),
                       text_of().alias("text"))


def removed_ranges(keyed: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(d, h, start, end): byte ranges to remove; they may overlap."""
    found = map_arrow(keyed.select("d", "h", "text"), _anchor_kernel, _ANCHOR_SQL)
    found = found.repartition("g").sortWithinPartitions("g", "c", "d", "h", "at")
    marks = saved(map_arrow(found, _meeting_kernel, _MARK_SQL), "marks")
    release(keyed.sparkSession)
    out = marks.where("g = 0").select("d", "h", "start", "end")

    wanted = marks.where("g <> 0")
    large = wanted.groupBy("g").count().where(F.col("count") > group_rows).select("g")
    any_large = not large.isEmpty()
    small = wanted.join(large, "g", "left_anti") if any_large else wanted

    def with_text(places: DataFrame) -> DataFrame:
        by_text = places.groupBy("d", "h").agg(F.collect_list(F.struct("g", "start")).alias("wanted"))
        texts = keyed.select("d", "h", "text").withColumn("n", F.row_number().over(Window.partitionBy("d", "h").orderBy("d")))
        return texts.where("n = 1").join(by_text, ["d", "h"]).select("d", "h", "text", "wanted")

    contexts = map_arrow(with_text(small), _context_kernel,
                         "g long, d long, h long, place long, before binary, after binary")
    contexts = contexts.repartition("g").sortWithinPartitions("g", "d", "h", "place")
    sorted_out = saved(map_arrow(contexts, _sorting_kernel, _MARK_SQL).select("d", "h", "start", "end"), "sorted")
    release(keyed.sparkSession)
    out = out.unionByName(sorted_out)
    if any_large:
        windows = saved(map_arrow(with_text(wanted.join(large, "g", "left_semi")), _window_kernel,
                                  "k1 long, k2 long, d long, h long, start long").distinct(), "windows")
        firsts = windows.groupBy("k1", "k2").agg(F.min(F.struct("d", "h", "start")).alias("first"))
        later = windows.join(firsts, ["k1", "k2"]).where(F.struct("d", "h", "start") != F.col("first"))
        out = out.unionByName(later.select("d", "h", "start", (F.col("start") + LENGTH).alias("end")))
    return out


_CUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                  ("kept_sha256", pa.string()), ("text", pa.binary())])


def _united(starts: list[int], ends: list[int]) -> list[list[int]]:
    """Ranges that overlap or touch made one."""
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, ends)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _cutting_kernel(with_text: bool):
    def kernel(batches):
        for batch in slices(batches):
            rows = []
            ids, copies, starts, ends = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            data, edges = bytes_of(batch.column(2))
            raw = data.tobytes()
            for i, (doc_id, copy) in enumerate(zip(ids, copies)):
                text = raw[edges[i]:edges[i + 1]]
                if copy > 1 and len(text) >= LENGTH:
                    gone = [[0, len(text)]]
                else:
                    gone = _united(starts[i] or [], ends[i] or [])
                kept = b"".join(text[a:b] for a, b in zip([0, *[g[1] for g in gone]], [*[g[0] for g in gone], len(text)]))
                rows.append((doc_id, len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(),
                             kept if with_text else None))
            yield record(_CUT, *map(list, zip(*rows)))
    return kernel


def deduplicated(docs: DataFrame, with_text: bool = True, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Cut from every text the bytes under strings of ``LENGTH`` bytes that begin earlier.

    One row per row of ``docs(doc_id, text)``: doc_id, n_bytes, n_removed,
    n_spans (runs removed), kept_sha256, and text, the bytes kept, as binary
    (null unless ``with_text``), since a cut may fall inside a character.
    Earlier is: smaller doc_id, or the same document and an earlier start;
    rows without doc_id come last; rows of equal doc_id are ordered by a hash
    of their texts, and of repeated rows all but one lose all their bytes if
    they have ``LENGTH``. Null text counts as empty; shorter texts lose
    nothing. Other columns are not read. An empty table gives an empty result.
    """
    ids = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).count()
    keyed = _keyed(docs, not ids.where("count > 1").isEmpty())
    ranges = (removed_ranges(keyed, group_rows).groupBy("d", "h")
              .agg(F.collect_list(F.struct("start", "end")).alias("gone")))
    copy: Column = F.row_number().over(Window.partitionBy("d", "h").orderBy("d"))
    rows = keyed.withColumn("copy", copy).join(ranges, ["d", "h"], "left")
    rows = rows.select("doc_id", "copy", "text", F.col("gone.start").alias("starts"), F.col("gone.end").alias("ends"))
    return map_arrow(rows, _cutting_kernel(with_text),
                     "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text binary")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return deduplicated(table(spark, sf_dir, "documents"), with_text=False).drop("text")
