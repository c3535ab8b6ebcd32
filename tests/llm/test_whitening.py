import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from faresight.llm import whitening
from faresight.llm.common import table

SF = "/root/testdata/sf0.001"


def plain(rows):
    """n, x, S and V of (id, vector) rows by Python integers alone."""
    kept = [(i, v) for i, v in rows if v is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in kept]
    n, dims = len(x), len(x[0])
    sums = [sum(r[d] for r in x) for d in range(dims)]
    scatter = [[n * sum(r[a] * r[b] for r in x) - sums[a] * sums[b] for b in range(dims)] for a in range(dims)]
    return kept, x, n, sums, np.array([[s / (n * n) for s in row] for row in scatter])


def compare(got, rows, k):
    kept, x, n, sums, cov = plain(rows)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == len(kept) * len(values) and {r.n for r in got} == {n}
    expected = (np.array([[v - s / n for v, s in zip(r, sums)] for r in x]) @ vectors) / np.sqrt(values)
    mine = np.array([[by_id[i][c + 1].whitened for c in range(len(values))] for i, _ in kept])
    signs = np.sign((mine * expected).sum(0))
    assert np.allclose(mine, expected * signs, atol=1e-6)
    for (i, _), r in zip(kept, x):
        assert by_id[i][1].deviation == sum((n * v - s) ** 2 for v, s in zip(r, sums))
    for c, e in enumerate(values, 1):
        assert np.isclose(by_id[kept[0][0]][c].explained, e / np.trace(cov), rtol=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-6
    white = mine - mine.mean(0)
    assert np.abs(white.T @ white / n - np.eye(len(values))).max() < 1e-6


def test_whole_table_against_integers(spark):
    got = whitening.op12_whitening(spark, SF).collect()
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    compare(got, rows, 32)


def test_scatter_is_exact_for_wide_and_narrow_ranges():
    rng = random.Random(3)
    rows = [[rng.randrange(0, 1 << b) for b in (0, 1, 7, 20, 54)] for _ in range(300)]
    rows[0] = [0, 1, 127, (1 << 20) - 1, (1 << 54) - 1]
    y = np.array(rows, np.int64)
    held = whitening.Scatter(np.array([0, 1, 7, 20, 54]))
    held.add(y[:130])
    held.add(y[130:])
    found, ones = np.zeros((5, 5), object), np.zeros(5, object)
    for a, b, s, total in held.rows():
        for p, q, e, t in zip(a.tolist(), b.tolist(), s.tolist(), total.tolist()):
            if q < 0:
                ones[p] += t << (whitening.STEP * e)
            else:
                found[p, q] += t << (whitening.STEP * e)
    for a in range(5):
        assert ones[a] == sum(r[a] for r in rows)
        for b in range(a, 5):
            assert found[a, b] == sum(r[a] * r[b] for r in rows)


def test_dropped_rows_ties_and_other_lengths(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-2, 2), rng.gauss(0, 300), -rng.random(), 0.25]) for i in range(90)]
    rows += [(90, rows[3][1]), (91, rows[3][1]), (90, rows[4][1])]           # ties, a repeated vec_id
    odd_rows = [(200, None), (201, [1.0, None, 2.0, 3.0]), (202, [1.0, float("nan"), 2.0, 3.0]),
                (203, [float("inf"), 1.0, 1.0, 1.0]), (204, [1.0]), (205, []), (None, None)]
    df = spark.createDataFrame(rows + odd_rows, "vec_id long, v array<double>")
    df = df.select("vec_id", F.col("v").alias("embedding"), *[F.lit(1).alias(c) for c in ("n", "component", "v", "a", "whitened")])
    got = whitening.whitened(df).collect()
    # the last dimension is constant: three components have variance
    assert {r.component for r in got} == {1, 2, 3} and {r.n for r in got} == {93}
    assert len(got) == 93 * 3 and len([r for r in got if r.vec_id == 90]) == 6
    assert not {r.vec_id for r in got} & {200, 201, 202, 203, 204, 205, None}
    white = np.array([r.whitened for r in got if r.component == 2])
    assert np.isclose(white.mean(), 0, atol=1e-9) and np.isclose(white.var(), 1)
    compare([r for r in whitening.whitened(df.where("vec_id < 90 or vec_id = 91")).collect()],
            [(i, v[:3] + [0.25]) for i, v in rows if i != 90], 3)


def test_without_variance_and_empty(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whitening.whitened(same).count() == 0
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whitened(empty).columns == whitening.whitened(same).columns and whitening.whitened(empty).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).count() == 0


def test_deviation_beyond_a_long_is_null():
    model = whitening.Whitening(4_000_000, np.zeros(1, np.int64), np.array([0], object), np.eye(1), np.ones(1), 1.0)
    x = np.array([[700], [800], [1 << 40]], np.int64)
    exact = [(4_000_000 * int(v)) ** 2 for v in x[:, 0]]
    assert model.deviations(x) == [v if v < 1 << 63 else None for v in exact]
    assert model.deviations(x)[0] is not None and model.deviations(x)[2] is None


@pytest.mark.parametrize("rows", [0, 1, 63, 64, 65])
def test_planes_of_any_number_of_rows(rows):
    y = np.arange(rows, dtype=np.int64) % 8
    planes = whitening.packed(y, 3)
    assert [int(np.bitwise_count(p).sum()) for p in planes] == [int(((y >> i) & 1).sum()) for i in range(3)]
