import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from faresight.llm import suffix_tree as st
from faresight.llm.common import table
from tests.llm import odd

SF = "/root/testdata/sf0.01"


def words(text):
    return (text or "").encode().lower().split() + [b""]


def check(rows, got):
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows}
    train = Counter(w for d, t in rows if not held[d] for w in words(t))
    n, v = sum(train.values()), len(train)
    want = []
    for d, t in rows:
        base = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t))
        want.append((str(d), held[d], len(words(t)), sum(w in train for w in words(t)), n, round(base, 6)))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                  for r in got) == sorted(want)


def test_base_counts_and_a_better_score(spark):
    docs = table(spark, SF, "documents")
    got = st.scored(docs).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], got)
    for held in (False, True):
        rows = [r for r in got if r.held_out == held]
        assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)


def test_odd_rows(spark):
    got = st.scored(odd.documents(spark)).collect()
    check([r[:2] for r in odd.ROWS], got)


def test_empty_table_and_no_training_rows(spark):
    assert st.scored(odd.nothing(spark)).count() == 0
    held = next(d for d in range(1000) if zlib.crc32(str(d).encode()) % 10 == 0)
    row = st.scored(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (True, 3, 0, 0, 0.0, 0.0)


def test_states_are_distributions_of_planted_contexts(spark):
    """Words that follow a pair of words for certain: the pair becomes a state, and in every
    state the probabilities of all symbols, the unseen one too, add up to one."""
    rng = np.random.default_rng(2)
    texts = []
    for i in range(400):
        out = []
        for _ in range(40):
            a, b = rng.choice(["x", "y"], 2)
            out += [a, b, {"xx": "p", "xy": "q", "yx": "r", "yy": "s"}[a + b], f"w{rng.integers(30)}"]
        texts.append((i, " ".join(out)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    caught = {}
    kernel = st._score_kernel
    st._score_kernel = lambda tree, root: (caught.update(tree=tree, root=root), kernel(tree, root))[1]
    try:
        got = st.scored(docs).collect()
    finally:
        st._score_kernel = kernel
    tree, root = caught["tree"], caught["root"]
    assert len(tree.levels) == 2 and (tree.levels[1].states >= 0).sum() >= 4
    counts = Counter(st.END if w == b"" else st.xxhash.xxh64_intdigest(w, 42) for d, t in texts
                     if zlib.crc32(str(d).encode()) % 10 for w in words(t))
    hashes = np.array([h if h < 1 << 63 else h - (1 << 64) for h in counts], np.int64)
    logs = root.log(np.array(list(counts.values())))
    roots = dict(zip(hashes.tolist(), logs.tolist()))
    unseen = float(np.exp(root.log(np.array([0]))[0]))
    assert abs(np.exp(logs).sum() + unseen - 1) < 1e-9
    for state in range(len(tree.parent)):
        total = np.exp(st._prob(tree, roots, np.full(len(hashes), state), hashes)).sum()
        s, rest = state, 1.0
        while s >= 0:
            rest, s = rest * np.exp(tree.rest[s]), tree.parent[s]
        assert abs(total + rest * unseen - 1) < 1e-6
    per_token = sum(r.score for r in got) / sum(r.n_tokens for r in got)
    assert per_token > sum(r.base_score for r in got) / sum(r.n_tokens for r in got) + 0.1


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    docs = table(spark, SF, "documents").where("doc_id < 200")
    one = {r.doc_id: r for r in st.scored(docs).collect()}
    monkeypatch.setattr(st, "BLOCK_BYTES", 20_000)
    two = st.scored(docs.repartition(5, F.col("text"))).collect()
    assert all(abs(one[r.doc_id].score - r.score) < 1e-6 * abs(r.score) for r in two)


def learnt_and_scored(docs):
    caught = {}
    kernel = st._score_kernel
    st._score_kernel = lambda tree, root: (caught.update(tree=tree, root=root), kernel(tree, root))[1]
    try:
        return caught, st.scored(docs).collect()
    finally:
        st._score_kernel = kernel


def test_a_symbol_that_only_its_three_before_tell(spark):
    """The fourth word follows from the parity of three: no shorter context says anything of it."""
    rng = np.random.default_rng(7)
    texts = []
    for i in range(300):
        out = []
        for _ in range(40):
            bits = rng.integers(0, 2, 3)
            out += [f"{'abc'[k]}{b}" for k, b in enumerate(bits)] + [["even", "odd"][bits.sum() % 2 if rng.random() < .9 else 1]]
        texts.append((i, " ".join(out)))
    caught, got = learnt_and_scored(spark.createDataFrame(texts, "doc_id long, text string"))
    tree = caught["tree"]
    assert len(tree.levels) >= 3 and (tree.levels[2].states >= 0).sum() >= 8
    # three words of a bit each and a fourth that is nearly told
    held = [r for r in got if r.held_out]
    per_group = -sum(r.score for r in held) / sum(r.n_tokens for r in held) * 4 / math.log10(2)
    assert per_group < 3.7


def test_rare_contexts_of_a_large_training_are_states(spark):
    """A name that follows its five words every time, in 3e-5 of training: no share of training keeps it out."""
    rng = np.random.default_rng(11)
    texts = [(i, " ".join(f"w{k}" for k in rng.integers(0, 60, 1000))) for i in range(400)]
    texts += [(1000 + i, " ".join(["rare sign name"] * 2)) for i in range(9)]
    got = {r.doc_id: r for r in st.scored(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    rare = [got[1000 + i] for i in range(9)]
    # "name" after "rare sign" or "sign" costs little: the words alone are worth -25 each way
    assert all(r.score > r.base_score + 3 for r in rare)


def test_a_model_by_joins_is_the_model_sent_whole(spark, monkeypatch):
    """Equal scores whether the tree is sent whole or joined by context, with and without spread contexts."""
    docs = table(spark, SF, "documents").unionByName(odd.documents(spark), allowMissingColumns=True)
    docs = docs.select("doc_id", "text")
    # phrases that come often, so that there are levels of three symbols and more
    often = spark.range(5000, 5200).selectExpr(
        "id as doc_id", "concat('once upon a time in a land far ', id % 7, ' lived a ', id % 3, ' king of old times') as text")
    docs = docs.unionByName(often)
    whole, joined, key = st.scored(docs).collect(), {}, lambda r: (str(r.doc_id), r.n_tokens, round(r.base_score, 6), r.score)
    spread, heads = [], st.Heads
    monkeypatch.setattr(st, "Heads", lambda codes, rests: spread[-1].append(len(codes)) or heads(codes, rests))
    for share in (1.0, 1e-3):
        spread.append([])
        for name, value in (("SMALL", 0), ("BLOCK_BYTES", 300_000), ("HEAD_SHARE", share)):
            monkeypatch.setattr(st, name, value)
        got = st.scored(docs).collect()
        assert len(got) == len(whole)
        for a, b in zip(sorted(whole, key=key), sorted(got, key=key)):
            assert (a.doc_id, a.n_tokens, a.n_known, a.held_out) == (b.doc_id, b.n_tokens, b.n_known, b.held_out)
            assert abs(a.score - b.score) < 1e-6 * max(1, abs(a.score))
    assert len(spread[0]) >= 3 and not any(spread[0]) and any(spread[1])


def block_of(texts):
    """A block's columns, and a plan in which the ten most frequent words have numbers."""
    batch = st.pa.record_batch({"doc_id": st.pa.array(range(1, len(texts) + 1)), "text": st.pa.array(texts)})
    (row,) = st._block_kernel([batch])
    hashes, totals = (row.column(n)[0].values.to_numpy().astype(np.int64) for n in ("hashes", "counts"))
    root = st.Root(int(totals.sum()), int((totals > 0).sum()), 0.5)
    top = np.argsort(-totals)[:10]
    known = {int(h): int(n) for h, n in zip(hashes[top].view(np.uint64), totals[top])} | {st.RARE: 0, st.BEGIN: 0}
    names = np.array(sorted(known), np.uint64)
    plan = st.Plan(3, 1e9, names, root.log(np.array([known[h] for h in names.tolist()])))
    tokens = np.frombuffer(row.column("tokens")[0].as_buffer(), np.uint32).astype(np.int64)
    sizes = row.column("sizes")[0].values.to_numpy().astype(np.int64)
    held = row.column("held")[0].values.to_numpy(zero_copy_only=False)
    return sizes, st.Walk.begun(sizes, held, tokens, hashes, totals, root, plan), plan


def test_pairs_of_frequent_words_are_sent_in_few_bytes():
    rng = np.random.default_rng(3)
    _, walk, plan = block_of([" ".join(f"w{k}" for k in np.minimum(rng.geometric(.01, 100), 900)) for _ in range(600)])
    every = [f"w{k}" for k in range(1, 901)]
    known = np.array(sorted({st.RARE: 0, st.BEGIN: 0} | {st.xxhash.xxh64_intdigest(w, 42): 1 for w in every}), np.uint64)
    plan = st.replace(plan, words=known, logs=np.zeros(len(known)))
    walk.number = plan.numbers(walk.symbol)
    walk.pairs(plan)
    assert walk.asked(1, plan, 1, 0, 1).nbytes < 5 * len(walk.codes)   # 8 bytes of a hash alone before


def test_shares_of_the_buckets_are_all_that_is_asked_and_decode_to_it():
    rng = np.random.default_rng(4)
    _, walk, plan = block_of([" ".join(f"w{k}" for k in rng.integers(0, 40, 50)) for _ in range(40)])
    walk.pairs(plan)
    parts = [walk.asked(1, plan, 1, k, 2) for k in range(2)]
    whole = walk.asked(1, plan, 1, 0, 1)
    assert sorted(b for p in parts for b in p["bucket"].to_pylist()) == whole["bucket"].to_pylist() == [0, 1, 2]
    answer = st._answer(st.pa.Table.from_batches([whole]), 1, 0, plan)
    totals = np.concatenate([st._unpacked(x.as_buffer(), np.int64) for x in answer["totals"]])
    counts = Counter(zip(walk.context[walk.learnt].tolist(), walk.symbol[walk.learnt].tolist()))
    assert totals.tolist() == [counts[c, s] for c, s in zip(walk.context[walk.at].tolist(), walk.symbol[walk.at].tolist())]


def test_words_are_cut_at_ascii_space_only():
    texts = ["\t A\x0bb\x0c", "", " ", "caf\u00e9\u00a0X \u2003y\x1cz", "end\r\n"]
    sizes, walk, _ = block_of(texts)
    assert sizes.tolist() == [len(words(t)) for t in texts]


def test_deep_levels_are_grown_in_rounds_and_not_one_by_one(spark, monkeypatch):
    """Runs of a word that end with a word of their length: a state on each of many levels. Also if no round may begin, for
    crowded contexts. Equal scores; the levels take a few tables."""
    rng = np.random.default_rng(5)
    texts = [(i, " ".join(" ".join(["a"] * k + [f"z{k}", f"w{rng.integers(40)}"]) for k in rng.integers(1, 24, 8))) for i in range(500)]
    texts += [(1000 + i, "the same long passage of many words that all texts of a kind hold from its first to its last word " * 2)
              for i in range(20)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    caught, whole = learnt_and_scored(docs)
    assert len(caught["tree"].levels) > 12
    tables, bucketed = [], st._bucketed
    monkeypatch.setattr(st, "_bucketed", lambda parts, spark, label, *a, **b: tables.append(label) or bucketed(parts, spark, label, *a, **b))
    for name, value in (("SMALL", 0), ("BLOCK_BYTES", 30_000), ("WINDOW", 3)):
        monkeypatch.setattr(st, name, value)
    for crowd in (st.CROWD, 0):
        monkeypatch.setattr(st, "CROWD", crowd)
        tables.clear()
        got = {r.doc_id: r.score for r in st.scored(docs).collect()}
        assert len(got) == len(whole) and all(abs(got[r.doc_id] - r.score) < 1e-6 * abs(r.score) for r in whole)
        assert (len(tables) < 12) == (crowd > 0)   # one or two a level before
