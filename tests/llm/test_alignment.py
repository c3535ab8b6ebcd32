import hashlib
import os
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from faresight.llm import alignment
from faresight.llm.common import table
from tests.llm import odd

SF = "/root/testdata/sf0.001"
#: Texts with white space, specials, bytes and symbols in places where cutting could go wrong.
AWKWARD = ["a", " ", "  ", "\n", "\n\n", " \n ", "a ", "a  ", " a", "a\nb", "a \n b", "a\n\n  b", "a\t b", "a\t  b", "x   y", "x  y",
           "tab\tand\r\nline", "don't  stop'll", "<|endoftext|> in text<|endoftext|>", "<s> </s> <unk> <0x41>", "▁ mark", "é à  ü ß\n",
           "日本語のテキスト と 中文", "हिन्दी पाठ है", "👩‍👩‍👧 🙂🙂 x", "ab" * 300, "!" * 77 + " " * 31 + "?", "\x00 nul \x1c sep \x85 next line",
           "a\x1c b!\x1c  c", "3.14159  12,345.00\n  indent\n\tcode { }", "​zero﻿width", "Ｆｕｌｌ width", "é combining"]


@pytest.fixture(scope="module")
def pair():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    a = Tokenizer.from_file(public_tokenizers.path(alignment.FIRST))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=public_tokenizers.path(alignment.SECOND))
    return a, b, alignment.Aligner(public_tokenizers.path(alignment.FIRST), public_tokenizers.path(alignment.SECOND))


def whole(pair, text):
    """Groups of one text, both encoders applied to all of it: [(first ids, second ids)]."""
    if not text:
        return []
    a, b, known = pair
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    raw = (" " + text).encode()
    if b"".join(known.a_bytes[i] for i in ids_a) != raw or b"".join(known.b_bytes[i] for i in ids_b) != raw:
        return []
    groups, i, j, end_a, end_b, own_a, own_b = [], 0, 0, 0, 0, [], []
    while i < len(ids_a) or j < len(ids_b):
        if end_a <= end_b and i < len(ids_a):
            own_a.append(ids_a[i])
            end_a += len(known.a_bytes[ids_a[i]])
            i += 1
        else:
            own_b.append(ids_b[j])
            end_b += len(known.b_bytes[ids_b[j]])
            j += 1
        if end_a == end_b:
            groups.append((own_a, own_b))
            own_a, own_b = [], []
    return groups


def brute(pair, rows):
    """Expected rows of (doc_id, text) rows."""
    every = [(i, whole(pair, t)) for i, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in every]
    count = Counter(p for l in links for p in l)
    highest = {}
    for (x, _), n in count.items():
        highest[x] = max(n, highest.get(x, 0))
    out = []
    for (i, g), l in zip(every, links):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(l.values()),
                    sum(n for p, n in l.items() if count[p] == highest[p[0]]), sum(n * count[p] for p, n in l.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_whole_table_against_brute_force(spark, pair):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert order(alignment.op11_alignment(spark, SF).collect()) == order(brute(pair, rows))


def test_awkward_and_odd_texts(spark, pair):
    rows = [(r[0], r[1]) for r in odd.ROWS] + list(enumerate(AWKWARD, 1000)) + list(enumerate(AWKWARD[:9], 1000))
    extra = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, slice string").repartition(3)
    got = alignment.aligned(extra.selectExpr("*", "1 AS pair", "2 AS docs", "3 AS n_a", "'p' AS path"))
    assert got.columns == [f.name for f in alignment._OUT] and order(got.collect()) == order(brute(pair, rows))
    assert [r for r in brute(pair, rows) if r[0] == 1000 + AWKWARD.index("▁ mark")][0][1:] == (0, 0, 0, 0, 0, 0, "")
    assert alignment.aligned(odd.nothing(spark)).count() == 0


def test_segments_agree_with_whole_texts(pair):
    rng = random.Random(11)
    letters = ["a", "the", " ", " ", "  ", "\n", "\t", "\r\n", " ", "é", "'s", "12", "!", "　", "\x1c", "日本", "🙂", "▁", "-"]
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 14)))
        digests, sizes, *_ = pair[2].documents([text.encode()])
        g = whole(pair, text)
        assert (sizes[0, 0], sizes[2, 0]) == (sum(len(a) for a, _ in g), len(g)), repr(text)
        shown = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        assert digests[0] == (hashlib.sha256(shown.encode()).hexdigest() if g else ""), repr(text)


def test_pointer_jumping_labels_components():
    rng = random.Random(7)
    for _ in range(300):
        n = rng.randrange(1, 60)
        a, b = (np.array(sorted({*rng.sample(range(1, n), rng.randrange(0, n)), n}) if n > 1 else [1]) for _ in range(2))
        label = alignment.terminals(a, b)
        common = sorted(set(a.tolist()) & set(b.tolist()))
        assert label.tolist() == [*np.searchsorted(common, a).tolist(), *np.searchsorted(common, b).tolist()]


def test_a_chain_of_overlaps_is_one_group():
    n = 10_000
    label = alignment.terminals(np.r_[np.arange(2, 2 * n, 2), 2 * n], np.r_[np.arange(1, 2 * n, 2), 2 * n])
    assert set(label.tolist()) == {0}


def test_kept_segments_are_bounded(pair, monkeypatch):
    monkeypatch.setattr(alignment, "CACHED_SEGMENTS", 50)
    own = alignment.Aligner(public_tokenizers.path(alignment.FIRST), public_tokenizers.path(alignment.SECOND))
    texts = [f"word{i} and more{i % 7} text" for i in range(200)]
    for t in texts:
        digests, sizes, *_ = own.documents([t.encode()])
        assert sizes[2, 0] == len(whole(pair, t))
    assert len(own) <= 60 and len(own.texts) == len(own) == len(own.whole) and own.pair_ends[-1] == len(own.pairs)


def test_bytes_that_are_no_text_have_no_tokens(pair):
    digests, sizes, *_ = pair[2].documents([b"\xff\xfe broken", b"fine", b""])
    assert digests[0] == "" == digests[2] and sizes[:, 0].sum() == 0 and sizes[0, 1] > 0
