"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts and benchmark items are lower-cased, and what is neither a letter nor a
digit becomes one space. An item of m bytes with an edit budget k that occurs
in a text shares at least  m - q + 1 - k q  of its q-grams with it, on
diagonals (text place less item place) that differ by k at most. So diagonals
are cut into bands of width w that overlap by k; the shared q-grams are counted
by document, item and band, only bands with enough of them are kept, and there
an alignment confined to the band's diagonals finds the fewest edits. The
filter loses nothing; the alignment accepts what meets the budget.

The items are a stated set: they go to the tasks in blocks of at most
``BLOCK_BYTES`` and about ``BLOCK_ITEMS``, and every block meets all documents whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.common import bytes_of, map_arrow, record, saved, slices, table, text_of

#: Bytes of a gram, and the edits allowed by byte of an item.
GRAM = 10
BUDGET = 0.08
#: Least width of a band of diagonals.
BAND = 32
#: Bytes of benchmark text that are looked for in one pass over the documents.
BLOCK_BYTES = 32 << 20
#: Items that are looked for in one pass, about.
BLOCK_ITEMS = 100_000
#: Text bytes that are searched at a time; a task takes some 65 bytes of memory for each.
SEARCH_BYTES = 1 << 20
#: Size of the table that tells most grams that are in no item, as a power of two.
TABLE_BITS = 22

_MATCH = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                    ("edits", pa.int32()), ("item_bytes", pa.int32())])
_MATCH_SQL = "doc_id long, item_id long, start long, end long, edits int, item_bytes int"


def _plain_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[:128] = 32
    for first, last in (b"az", b"09"):
        out[first:last + 1] = np.arange(first, last + 1)
    return out


_PLAIN = _plain_table()


def _lower(column: pa.Array) -> pa.Array:
    """Lower case that keeps every character's bytes in place."""
    low = pc.utf8_lower(column)
    moved = pc.not_equal(pc.binary_length(low), pc.binary_length(column))
    if pc.any(moved).as_py():
        def careful(text: str) -> str:
            return "".join(c.lower() if len(c.lower().encode()) == len(c.encode()) else c for c in text)
        low = pa.array([careful(t) if m else x for t, x, m in
                        zip(column.to_pylist(), low.to_pylist(), moved.to_pylist())], column.type)
    return low


def normalised(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, origins): the plain texts, each followed by a zero byte; where each
    begins, with the end of all last; each byte's place in its own text."""
    data, ends = bytes_of(_lower(column))
    plain = _PLAIN[data]
    blank = plain == 32
    first = np.zeros(len(data), bool)
    first[ends[:-1][np.diff(ends) > 0]] = True
    keep = ~(blank & (np.r_[True, blank[:-1]] | first)) if len(data) else blank
    counts = np.r_[0, np.cumsum(keep)][ends]
    starts = counts + np.arange(len(counts))
    out = np.zeros(starts[-1], np.uint8)
    origins = np.zeros(starts[-1], np.int64)
    kept = np.flatnonzero(keep)
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(counts))
    at = np.arange(len(kept)) + owner
    out[at] = plain[kept]
    origins[at] = kept - ends[:-1][owner]
    return out, starts, origins


def _codes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit code of the ``gram`` bytes from each place (8 at least)."""
    n = len(data) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    padded = np.ascontiguousarray(data)

    def word(shift: int) -> np.ndarray:
        return np.ndarray((n,), "<u8", padded.data, shift, (1,)).astype(np.uint64)

    code = word(0) * np.uint64(0x9E3779B97F4A7C15)
    code ^= code >> np.uint64(29)
    if gram > 8:
        code += word(gram - 8) * np.uint64(0xC2B2AE3D27D4EB4F)
        code ^= code >> np.uint64(32)
    code *= np.uint64(0xBF58476D1CE4E5B9)
    return code ^ (code >> np.uint64(31))


@dataclass
class Items:
    """A block of items and the postings of their grams."""

    ids: list
    texts: list[bytes]
    budgets: np.ndarray
    needed: np.ndarray
    widths: np.ndarray
    codes: np.ndarray      # different codes, ascending
    first: np.ndarray      # first posting of each, with the number of all last
    item: np.ndarray
    place: np.ndarray
    table: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple], gram: int = GRAM, budget: float = BUDGET) -> Items:
        """``rows``: (item_id, text). An item of fewer than ``gram`` plain bytes is not searched."""
        column = pa.array([t or "" for _, t in rows], pa.string())
        data, starts, _ = normalised(column)
        texts = [data[a:b - 1].tobytes().rstrip(b" ") for a, b in zip(starts[:-1], starts[1:])]
        ids, texts = zip(*[(i, t) for (i, _), t in zip(rows, texts) if len(t) >= gram]) if any(
            len(t) >= gram for t in texts) else ((), ())
        sizes = np.array([len(t) for t in texts], np.int64)
        # a budget under which the lemma still asks for one shared gram
        budgets = np.minimum((sizes * budget).astype(np.int64), (sizes - gram) // gram)
        codes = [_codes(np.frombuffer(t, np.uint8), gram) for t in texts]
        every = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(texts)), [len(c) for c in codes])
        place = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, np.int64)
        order = np.argsort(every, kind="stable")
        unique, first = np.unique(every[order], return_index=True)
        table = np.zeros(1 << TABLE_BITS, bool)
        table[(unique >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
        return cls(list(ids), list(texts), budgets, sizes - gram + 1 - budgets * gram, np.maximum(BAND, budgets + 1),
                   unique, np.r_[first, len(every)], item[order], place[order], table)


def aligned(pattern: bytes, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits, and the column after the last byte, of ``pattern`` in each window.

    A window's rows are text from the band's first diagonal on; the alignment
    may start on any of the  width = columns - len(pattern)  diagonals and stays
    on them.
    """
    m, width = len(pattern), windows.shape[1] - len(pattern)
    step = np.arange(width)
    cost = np.zeros((len(windows), width), np.int64)
    for i, byte in enumerate(pattern):
        now = cost + (windows[:, i:i + width] != byte)
        now[:, :-1] = np.minimum(now[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(now - step, axis=1) + step
    best = cost.argmin(axis=1)
    return cost[np.arange(len(windows)), best], best + m


def find(items: Items, data: np.ndarray, starts: np.ndarray, gram: int = GRAM) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) of what meets its budget; places in the plain texts."""
    codes = _codes(data, gram)
    at = np.flatnonzero(items.table[(codes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
    found = np.minimum(np.searchsorted(items.codes, codes[at]), max(0, len(items.codes) - 1))
    if not len(at) or not len(items.codes):
        return []
    true = items.codes[found] == codes[at]
    at, found = at[true], found[true]
    counts = items.first[found + 1] - items.first[found]
    j = np.repeat(at, counts)
    post = np.arange(len(j)) + np.repeat(items.first[found] - (np.cumsum(counts) - counts), counts)
    item = items.item[post]
    text = np.searchsorted(starts, j, side="right") - 1
    diagonal = j - starts[text] - items.place[post] + (1 << 20)  # never negative: items are shorter
    band, over = np.divmod(diagonal, items.widths[item])
    # pairs are numbered as they occur: a key of text, item and band would not fit into 64 bits
    pairs, pair = np.unique(text * len(items.ids) + item, return_inverse=True)
    pair = pair << 32
    again = over < items.budgets[item]
    key, shared = np.unique(np.r_[pair + band, (pair + band - 1)[again]], return_counts=True)
    text, item = np.divmod(pairs[key >> 32], len(items.ids))
    enough = shared >= items.needed[item]
    return _verified(items, data, starts, text[enough], item[enough], (key & 0xFFFFFFFF)[enough])


def _verified(items: Items, data: np.ndarray, starts: np.ndarray, text: np.ndarray, item: np.ndarray,
              band: np.ndarray) -> list:
    out = []
    for i in np.unique(item):
        pattern, k, w = items.texts[i], int(items.budgets[i]), int(items.widths[i])
        rows = np.flatnonzero(item == i)
        width = w + k + 1
        low = band[rows] * w - (1 << 20) + starts[text[rows]]
        # text before or after its own document is blanked out
        at = low[:, None] + np.arange(width + len(pattern))
        inside = (at >= starts[text[rows]][:, None]) & (at < starts[text[rows] + 1][:, None] - 1)
        windows = np.where(inside, data[np.clip(at, 0, len(data) - 1)], 0)
        best: dict[int, list] = {}
        rest = []
        for r, window in enumerate(windows):
            hit = window.tobytes().find(pattern)
            if hit >= 0:
                _note(best, int(text[rows[r]]), int(low[r] + hit), int(low[r] + hit + len(pattern)), 0)
            else:
                rest.append(r)
        if rest and k:
            edits, ends = aligned(pattern, windows[rest])
            for r, e, end in zip(rest, edits, ends):
                if e <= k:
                    back = windows[r][::-1][len(windows[r]) - end:]
                    back = np.r_[back, np.zeros(max(0, len(pattern) + width - len(back)), back.dtype)]
                    _, length = aligned(pattern[::-1], _from_end(back, len(pattern), k))
                    _note(best, int(text[rows[r]]), int(low[r] + end - length[0] + k), int(low[r] + end), int(e))
        for t, spans in best.items():
            out += [(t, int(i), a - int(starts[t]), b - int(starts[t]), e) for a, b, e in spans]
    return out


def _from_end(back: np.ndarray, m: int, k: int) -> np.ndarray:
    """A window whose first k diagonals lie before ``back``, so that an alignment from its start fits."""
    return np.r_[np.zeros(k, back.dtype), back[:m + k + 1]][None, :]


def _note(best: dict, text: int, start: int, end: int, edits: int) -> None:
    """Keep one span for each place: of overlapping ones that with the fewest edits."""
    spans = best.setdefault(text, [])
    clash = [s for s in spans if s[0] < end and start < s[1]]
    if all(edits < s[2] for s in clash):
        best[text] = [s for s in spans if s not in clash] + [(start, end, edits)]


def _kernel_matches(items: Items):
    def kernel(batches):
        for batch in slices(batches, limit=SEARCH_BYTES):
            data, starts, origins = normalised(batch.column(1))
            found = find(items, data, starts)
            if not found:
                continue
            ids = batch.column(0).to_pylist()
            rows = []
            for t, i, a, b, e in sorted(found):
                first, last = starts[t] + a, starts[t] + b - 1
                rows.append((ids[t], items.ids[i], int(origins[first]), int(origins[last]) + 1, e, len(items.texts[i])))
            yield record(_MATCH, *map(list, zip(*rows)))
    return kernel


def _blocks(benchmark: DataFrame, block_bytes: int):
    """Item blocks of at most about ``block_bytes`` and ``BLOCK_ITEMS``; one at a time reaches the driver."""
    rows = saved(benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text")).distinct(),
                 "benchmark")
    size, n = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    count = max(1, -(-size // block_bytes), -(-n // BLOCK_ITEMS))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for block in range(count):
        yield Items.of([tuple(r) for r in rows.where(number == block).orderBy("item_id", "text").collect()])


def matches(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Where ``docs(doc_id, text)`` hold items of ``benchmark(item_id, text)``.

    One row per place: doc_id, item_id, start and end (bytes of the text),
    edits, item_bytes (plain bytes of the item). Of overlapping places of one
    item the one with the fewest edits counts. Null text counts as empty; rows
    without doc_id or item_id give rows with null there; repeated documents
    give repeated rows, repeated items do not. Items of fewer than ``GRAM``
    plain bytes are not searched. Other columns are not read. An empty table
    on either side gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    found = [map_arrow(rows, _kernel_matches(items), _MATCH_SQL) for items in _blocks(benchmark, block_bytes)]
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that hold an item; columns as they were."""
    def kernel_of(items: Items):
        def kernel(batches):
            for batch in slices(batches, limit=SEARCH_BYTES):
                data, starts, _ = normalised(batch.column("text").fill_null(""))
                good = np.ones(batch.num_rows, bool)
                good[[t for t, *_ in find(items, data, starts)]] = False
                yield batch.filter(pa.array(good))
        return kernel

    for items in _blocks(benchmark, block_bytes):
        docs = map_arrow(docs, kernel_of(items), docs.schema)
    return docs


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where ``documents`` hold items of ``benchmark``: see ``matches``."""
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
