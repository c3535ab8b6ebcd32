import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa

from faresight.llm import decontaminate as dc
from faresight.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm import odd


def plain(text):
    return re.sub(rb"(?:[\x00-\x2f\x3a-\x60\x7b-\x7f])+", b" ", (text or "").lower().encode()).strip(b" ")


def fewest_edits(pattern, text):
    """Smallest edit distance of ``pattern`` to any part of ``text``."""
    row = np.zeros(len(text) + 1, int)
    data, step = np.frombuffer(text, np.uint8), np.arange(len(text) + 1)
    for byte in pattern:
        now = row + 1
        now[1:] = np.minimum(now[1:], row[:-1] + (data != byte))
        row = np.minimum.accumulate(now - step) + step
    return int(row.min())


def budget(m):
    return min(int(m * dc.BUDGET), (m - dc.GRAM) // dc.GRAM)


def brute(docs, items):
    out = set()
    for d, t in docs:
        for i, x in items:
            p = plain(x)
            if len(p) >= dc.GRAM and fewest_edits(p, plain(t)) <= budget(len(p)):
                out.add((d, i))
    return out


def damaged(text, edits, rng):
    text = list(text)
    for _ in range(edits):
        at = rng.randrange(len(text))
        kind = rng.randrange(3)
        if kind == 0:
            text[at] = rng.choice("abcxyz")
        elif kind == 1:
            del text[at]
        else:
            text.insert(at, rng.choice("abcxyz"))
    return "".join(text)


def test_edits_within_and_beyond_the_budget(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abdeiklmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))
    items = [(i, prose(rng.randint(8, 50))) for i in range(12)] + [(50, "short"), (51, None), (None, prose(20))]
    docs = []
    for n in range(150):
        i, x = items[n % 12] if n % 13 else items[-1]
        k = rng.randint(0, 2 * budget(len(x)))
        docs.append((n, prose(rng.randint(0, 80)) + " " + damaged(x, k, rng).upper().replace(" ", "!! ") + " " + prose(30)))
    frames = (spark.createDataFrame(docs, "doc_id long, text string"),
              spark.createDataFrame(items + items[:2], "item_id long, text string"))
    rows = dc.matches(*frames, block_bytes=700).collect()
    expected = brute(docs, items)
    assert 40 < len(expected) < 140
    assert {(r.doc_id, r.item_id) for r in rows} == expected
    texts, known = dict(docs), dict(items)
    for r in rows:
        part = texts[r.doc_id].encode()[r.start:r.end]
        p = plain(known[r.item_id])
        assert fewest_edits(p, plain(part.decode())) <= r.edits == fewest_edits(p, plain(texts[r.doc_id]))
        assert r.item_bytes == len(p)
    flagged = {d for d, _ in expected}
    assert {r.doc_id for r in dc.clean(*frames, block_bytes=700).collect()} == set(texts) - flagged


def test_against_brute_force_on_the_tables(spark):
    docs, items = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    rows = {(r.doc_id, r.item_id) for r in dc.matches(docs, items).collect()}
    some = [tuple(r) for r in items.limit(12).collect()]
    want = brute([(r.doc_id, r.text) for r in docs.collect() if len(r.text) < 5000], some)
    short = {r.doc_id for r in docs.collect() if len(r.text) < 5000}
    assert {(d, i) for d, i in rows if d in short and i in {x for x, _ in some}} == want


def test_odd_rows_and_empty_tables(spark):
    docs = odd.documents(spark)
    items = spark.createDataFrame([(1, odd.LINE), (2, odd.LONG[:400]), (3, ""), (4, "É" * 40)], "item_id long, text string")
    rows = sorted(((r.doc_id, r.item_id) for r in dc.matches(docs, items).collect()), key=str)
    want = [(6, 2)] * 1 + [(7, 1), (8, 1), (8, 1), (8, 1), (9, 1), (9, 1), (None, 1), (11, 4)]
    assert sorted(set(rows), key=str) == sorted(set(want), key=str)
    assert rows.count((9, 1)) == 2 and rows.count((8, 1)) == 3
    kept = dc.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.select("doc_id").collect()), key=str) == sorted(
        [1, 2, 3, 4, 5, 10, 12, 13, 100, None, None], key=str)
    assert dc.matches(odd.nothing(spark), items).count() == 0
    assert dc.matches(docs, items.where("false")).count() == 0


def test_many_items_against_many_texts():
    """Texts in a slice times items in a block beyond 2^31."""
    import pyarrow as pa

    words = [f"{i * 2654435761 % (1 << 32):08x} {i * 40503 % 65521:05d}" for i in range(250_000)]
    items = dc.Items.of(list(enumerate(words)))
    texts = ["nothing of note"] * 10_000
    planted = {(0, 249_999), (5_000, 3), (9_000, 240_000), (9_999, 0), (9_999, 249_999)}
    for t, i in planted:
        texts[t] += " and " + words[i]
    data, starts, _ = dc.normalised(pa.array(texts))
    found = dc.find(items, data, starts)
    assert {(t, i) for t, i, *_ in found} == planted
    assert all(data[starts[t] + a:starts[t] + b].tobytes().decode() == words[i] and e == 0 for t, i, a, b, e in found)


def test_blocks_are_bounded_by_their_number_of_items(spark, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 4)
    items = [(i, f"item number {i} of a few short ones") for i in range(10)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(dc._blocks(frame, dc.BLOCK_BYTES))) == 3
    docs = spark.createDataFrame([(i, f"here is {t} again") for i, t in items], "doc_id long, text string")
    rows = dc.matches(docs, frame).collect()
    assert {(r.doc_id, r.item_id) for r in rows if r.edits == 0} == {(i, i) for i in range(10)}


def test_a_search_takes_little_memory(spark, monkeypatch):
    """Both kernels work on a run of texts at a time, however large the batches are that they are given."""
    kernels = []
    monkeypatch.setattr(dc, "map_arrow", lambda df, kernel, schema: kernels.append(kernel) or df)
    items = spark.createDataFrame([(1, "a passage of the benchmark that some of the texts hold")], "item_id long, text string")
    docs = spark.createDataFrame([], "doc_id long, text string")
    dc.clean(docs, items)
    dc.matches(docs, items)
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["passage", "benchmark", "words", "that", "tell", "little"], k=300)) for _ in range(4_000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(4_000)), "text": texts})
    assert len(kernels) == 2 and batch.nbytes > 6 << 20
    for kernel in kernels:
        tracemalloc.start()
        for _ in kernel([batch]):
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 150 << 20
