import hashlib
import random

import numpy as np
import pytest

from faresight.llm import substring_dedup as sd
from faresight.llm.common import table
from faresight.llm.suffix_sort import blind_trie_order, deep_shallow
from tests.conftest import SF_SMALL
from tests.llm import odd


def brute(rows):
    """Removal by looking every window up, in corpus order; repeated rows after their first."""
    def order(row):
        return (row[0] is None, row[0] or 0)
    seen, out, done = set(), [], set()
    for d, t in sorted(rows, key=order):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - sd.LENGTH + 1):
            w = raw[i:i + sd.LENGTH]
            if w in seen:
                gone[i:i + sd.LENGTH] = b"\1" * sd.LENGTH
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
        done.add((d, t))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.drop("text").collect()), key=str)


def test_deep_shallow_order_and_shared_prefixes():
    rng = np.random.default_rng(0)
    for trial in range(60):
        n, width = int(rng.integers(1, 50)), int(rng.integers(1, 30))
        s = rng.integers(0, 2 if trial % 2 else 256, (n, width)).astype(np.uint8)
        s[:, :width // 2] = 7 if trial % 3 == 0 else s[:, :width // 2]
        g = np.sort(rng.integers(0, 4, n))
        order, common = deep_shallow(s, g, int(rng.choice([0, 8, 16])))
        rows = [(int(g[i]), s[i].tobytes()) for i in order]
        assert rows == sorted(rows)
        for i in range(1, n):
            a, b = s[order[i]], s[order[i - 1]]
            shared = int(np.argmax(a != b)) if (a != b).any() else width
            assert common[i] == (shared if g[order[i]] == g[order[i - 1]] else -1)


def test_blind_trie_keeps_equal_strings_in_their_order():
    assert blind_trie_order([b"bb", b"ab", b"bb", b"aa", b"ab"]) == [3, 1, 4, 0, 2]


def crafted(seed):
    """Texts pasted together from shared passages at odd places, with runs and periods."""
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcd ") for _ in range(rng.choice([99, 100, 101, 130, 400]))) for _ in range(12)]
    out = []
    for d in range(80):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            a = rng.randint(0, 30)
            parts += [p[a:a + rng.choice([60, 100, 140, 400])], "".join(rng.choice("wxyz") for _ in range(rng.randint(0, 40)))]
        out.append((d * 3 % 80, "".join(parts)))
    return out + [(200, "z" * 500), (201, "z" * 99), (202, "ab" * 300), (203, "ab" * 60 + "é" * 90)]


@pytest.mark.parametrize("group_rows", [200_000, 2])
def test_crafted_texts(spark, group_rows):
    rows = crafted(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(sd.deduplicated(docs, group_rows=group_rows)) == brute(rows)


def test_a_gram_whose_hash_begins_with_zero_bits(spark):
    gram = "the quick brown fox jump]Pjv8LaD"   # upper 32 bits of its hash are 0
    raw = np.frombuffer((gram + "\0" * 8).encode(), np.uint8)
    value = sd._mix(sd._word(raw, 0, 1) + np.uint64(0x632BE59BD9B4E019))
    for shift in range(8, sd.GRAM, 8):
        value = sd._mix(value + sd._word(raw, shift, 1))
    assert len(gram) == sd.GRAM and int(value[0]) >> 32 == 0
    rng = random.Random(2)
    side = ["".join(rng.choice("efgh") for _ in range(34)) for _ in range(2)]
    for rows in ([(i, side[0] + gram + side[1]) for i in range(3)],
                 [(i, f"{i}" * 150 + side[0] + gram + side[1] + f"{i}" * 70) for i in range(3)]):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert found(sd.deduplicated(docs)) == brute(rows)


def test_table_and_kept_bytes(spark):
    docs = table(spark, SF_SMALL, "documents").where("length(text) < 20000")
    got = sd.deduplicated(docs).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == brute(
        [(r.doc_id, r.text) for r in docs.collect()])
    assert all(hashlib.sha256(r.text).hexdigest() == r.kept_sha256 for r in got)


def test_odd_rows(spark):
    rows = [r[:2] for r in odd.ROWS]
    got, want = found(sd.deduplicated(odd.documents(spark))), brute(rows)
    # of rows with one doc_id either order is earlier, so compare what is left of them together
    tied = (8, None)

    def plain(x):
        return [r for r in x if r[0] not in tied]
    assert plain(got) == plain(want)
    for d in tied:
        assert sum(r[2] for r in got if r[0] == d) == sum(r[2] for r in want if r[0] == d)


def test_empty_table(spark):
    assert sd.deduplicated(odd.nothing(spark)).count() == 0
