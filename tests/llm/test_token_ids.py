import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from faresight.llm import token_ids
from tests.llm import odd

PATH = public_tokenizers.path(token_ids.VOCABULARY)


def whole(texts):
    t = Tokenizer.from_file(PATH)
    return [e.ids + [2] for e in t.encode_batch(texts, add_special_tokens=False)]


def test_words_in_turn_are_the_whole_text(monkeypatch):
    texts = [r[1] or "" for r in odd.ROWS] + ["<|endoftext|> a|b x́ ́y İ ΑΣ \x1c z", "it's don't 'll _a_ ½²ª", "naïve ÀÉ ß×÷"]
    for cap in (500_000, 3):
        monkeypatch.setattr(token_ids, "CACHED_WORDS", cap)
        codes = token_ids.WordEncoder(PATH, 2)
        for part in (texts[:9], texts[9:], texts):
            ids, counts = codes.encode([t.encode() for t in part])
            want = whole(part)
            assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_perfect_hash():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 1000):
        keys = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        hashes = token_ids.PerfectHash.build(keys)
        assert sorted(hashes.slots(keys)) == list(range(len(keys)))
        entries = np.zeros(len(keys), token_ids._ENTRY)
        again, _ = token_ids._unpacked(token_ids._packed(hashes, entries))
        assert (again.slots(keys) == hashes.slots(keys)).all()


def test_round_trip_of_odd_rows(spark):
    got = token_ids.encoded(odd.documents(spark)).collect()
    texts = [r[1] or "" for r in odd.ROWS]
    ids = dict(zip(texts, whole(texts)))
    crc = {t: zlib.crc32(np.array(x, "<u4").tobytes()) for t, x in ids.items()}
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (r[0] or -1, len(ids[r[1] or ""]), crc[r[1] or ""]) for r in odd.ROWS)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is None, d or 0))


def test_foreign_keys_are_rejected(spark, workdir):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    sharded = token_ids.write_shards(docs, workdir, PATH, 2)
    index = token_ids.build_index(sharded, workdir)
    asked = spark.createDataFrame([(i, n) for i in range(60) for n in (0, 1)], "doc_id long, occurrence long")
    got = sorted((r.doc_id, r.occurrence) for r in token_ids.look_up(index, asked).collect())
    assert got == [(i, 0) for i in range(50)]


def test_empty_table(spark):
    assert token_ids.encoded(odd.nothing(spark)).count() == 0


def test_kept_pieces_are_not_asked_for_again(monkeypatch):
    """A piece that is kept costs one look-up, also as a part of new words."""
    asked, piece = [], token_ids.WordEncoder._piece
    monkeypatch.setattr(token_ids.WordEncoder, "_piece", lambda self, p: asked.append(p) or piece(self, p))
    encoder = token_ids.WordEncoder(token_ids.public_tokenizers.path(token_ids.VOCABULARY), token_ids.END_ID)
    texts = [f"one-{a} Two,{b} (three)" for a in range(10) for b in range(10)]
    ids, counts = encoder.encode([t.encode() for t in texts])
    whole = [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, token_ids.END_ID] for t in texts]
    assert ids.tolist() == [i for w in whole for i in w] and counts.tolist() == [*map(len, whole)]
    assert len(asked) == len(set(asked))
