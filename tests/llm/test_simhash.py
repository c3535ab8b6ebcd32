import itertools
import random

import numpy as np
import xxhash

from faresight.llm import simhash
from faresight.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm import odd


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute(rows, radius=2, heads=False):
    """(doc_id, fingerprint, component_id) by comparing all pairs; or each component's id."""
    fps = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            parent[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    low = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    if heads:
        return sorted(low.values(), key=str)
    return sorted(((d, f"{fps[i]:016x}", low[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_against_all_pairs(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(simhash.near_duplicates(docs)) == brute(rows)


def test_odd_rows_and_clashing_columns(spark):
    assert found(simhash.near_duplicates(odd.documents(spark))) == brute([r[:2] for r in odd.ROWS])
    kept = simhash.keep_one(odd.documents(spark))
    assert kept.columns == odd.documents(spark).columns
    stays = sorted((r.doc_id for r in kept.select("doc_id").collect()), key=str)
    assert stays == brute([r[:2] for r in odd.ROWS], heads=True)


def test_empty_table(spark):
    assert simhash.near_duplicates(odd.nothing(spark)).count() == 0
    assert simhash.keep_one(odd.nothing(spark)).count() == 0


def clustered(n, seed):
    """Fingerprints around a few centres, many of them within a few bits."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(5)]
    out = set()
    while len(out) < n:
        x = rng.choice(centres)
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


def test_links_have_the_components_of_all_pairs(spark):
    fps = clustered(400, 3)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    for radius, tile_rows in ((2, 50_000), (2, 20), (3, 50_000), (1, 50)):
        parent = {}
        for a, b in itertools.combinations(fps, 2):
            if (a ^ b).bit_count() <= radius:
                x, y = simhash._find(parent, a), simhash._find(parent, b)
                parent[x] = y
        expected = {a: simhash._find(parent, a) for a in fps}
        got = {}
        links = [(r.a, r.b) for r in simhash.links(nodes, radius, tile_rows).collect()]
        for a, b in np.array(links, np.int64).reshape(-1, 2).view(np.uint64).tolist():
            assert (a ^ b).bit_count() <= radius
            got[simhash._find(got, a)] = simhash._find(got, b)
        same = {}
        for a in fps:
            assert same.setdefault(expected[a], simhash._find(got, a)) == simhash._find(got, a)
        assert len({simhash._find(got, a) for a in fps}) == len(set(expected.values()))


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (102, 100)]
    random.Random(1).shuffle(edges)
    found_ = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found_[i] == 0 for i in range(1, 61)) and found_[101] == found_[102] == 100


def test_a_long_text_is_cut_between_words(monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 50)
    text = odd.LONG[:3000]
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)
