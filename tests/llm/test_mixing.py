import math
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from faresight.llm import mixing
from faresight.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm import odd


def brute_targets(sizes, weights=(5, 2, 1), repeats=3):
    """Targets of sources (in order) by sharing the excess until none is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > repeats * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: repeats * sizes[s] for s in over}


def check(rows, mixed):
    sizes = defaultdict(int)
    for _, t, _, s, _ in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    targets = brute_targets(sizes)
    got = mixed.documents.collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id, r.size) for r in got if r.doc_id is not None) == sorted(
        (d, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, *_ in rows if d is not None)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, targets[r.source], abs_tol=1e-6)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 0.5 + 1e-9
    return got


def test_odd_rows(spark):
    check(odd.ROWS, mixing.mix(odd.documents(spark), block_words=10, shard_words=20_000))


def test_shards_are_exact_disjoint_and_reruns_agree(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = [tuple(r) for r in docs.collect()]
    one = mixing.mix(docs, block_words=50, shard_words=9000)
    check(rows, one)
    two = mixing.mix(docs.repartition(7, "text"), block_words=50, shard_words=9000)
    key = ["key", "copy", "pass", "words", "shard", "position"]
    a, b = (sorted(tuple(r) for r in m.draws.select(*key).collect()) for m in (one, two))
    assert a == b
    total = sum(r.size for r in one.documents.collect())
    words = Counter()
    for _, _, _, w, shard, _ in a:
        words[shard] += w
    # shards have equal numbers of blocks; a block is the documents that start in it, so words vary
    assert len(words) == -(-total // 9000) and sum(words.values()) in range(total - 20, total + 21)
    assert max(words.values()) < 3 * min(words.values())
    for shard in words:
        places = [r[5] for r in a if r[4] == shard]
        assert sorted(places) == list(range(1, len(places) + 1))


def test_splitting_tree_keeps_quotas(spark):
    quotas = spark.createDataFrame([(1, 100), (2, 7), (3, 0), (4, 1)], "sid int, drawn long")
    for shards in (1, 2, 5, 8):
        leaves = mixing._split(quotas, shards, 11).collect()
        by_source, by_shard = Counter(), Counter()
        for r in leaves:
            by_source[r.sid] += r.blocks
            by_shard[r.shard] += r.blocks
        assert by_source == {1: 100, 2: 7, 4: 1}
        assert max(by_shard.values()) - min(by_shard[s] for s in range(shards)) <= shards.bit_length()
        for sid, total in by_source.items():
            runs = sorted((r.first, r.first + r.blocks) for r in leaves if r.sid == sid)
            assert runs[0][0] == 0 and runs[-1][1] == total
            assert all(x[1] == y[0] for x, y in zip(runs, runs[1:]))


def test_hypergeometric_distribution(spark):
    """Inversion over an even grid of uniform numbers reproduces the probabilities."""
    n = 4000
    grid = spark.range(n).withColumn("u", (F.col("id") + 0.5) / n)
    for population, marked, drawn in ((20, 8, 10), (50, 3, 25), (9, 9, 4), (30, 1, 0), (200, 120, 150)):
        sql = mixing.hypergeometric(f"{population}L", f"{marked}L", f"{drawn}L", "u")
        got = {r.x: r["count"] / n for r in grid.select(F.expr(sql).alias("x")).groupBy("x").count().collect()}
        for k in range(0, marked + 1):
            p = (math.comb(marked, k) * math.comb(population - marked, drawn - k) / math.comb(population, drawn)
                 if 0 <= drawn - k <= population - marked else 0)
            assert abs(got.get(k, 0) - p) <= 1.5 / n


def test_mixed_documents_have_the_words_drawn(spark):
    docs = odd.documents(spark)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    drawn = mixing.mix(docs).draws
    want = sorted(r.words for r in drawn.collect())
    got = sorted(len(r.text.encode().split()) for r in out.select("text").collect())
    assert got == want
    for name in odd.CLASHING:   # what a user's column holds comes back
        assert {r[name] for r in out.select(name).collect()} == {f"extra {name}"}


def test_empty_table(spark):
    mixed = mixing.mix(odd.nothing(spark))
    assert mixed.documents.count() == 0 and mixed.draws.count() == 0
    assert mixing.mixed_documents(odd.nothing(spark)).count() == 0
