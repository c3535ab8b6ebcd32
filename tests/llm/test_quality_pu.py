import zlib

import numpy as np
from pyspark.sql import functions as F

from faresight.llm import quality_pu
from faresight.llm.common import table
from tests.llm import odd

SF = "/root/testdata/sf0.01"


def numbers(text):
    raw = text.encode()
    return quality_pu.features(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]


def test_features_do_not_depend_on_neighbours():
    texts = [r[1] or "" for r in odd.ROWS]
    raw = [t.encode() for t in texts]
    together = quality_pu.features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert np.allclose(together, np.stack([numbers(t) for t in texts]), atol=1e-6)
    assert np.isfinite(together).all()
    shape = dict(zip("length lines upper again short kinds repeated empty".split(), numbers("Aa a a b\nlong")[-9:-1]))
    assert np.isclose(shape["upper"], 1 / 9) and np.isclose(shape["again"], 1 / 5) and shape["empty"] == 0
    assert np.isclose(shape["lines"], 2 / 5) and np.isclose(shape["length"], np.log1p(9 / 5))


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(0)
    for share in (0.3, 0.8):
        positive = rng.normal(3, 1, 4000)
        unlabelled = np.where(rng.random(4000) < share, rng.normal(3, 1, 4000), rng.normal(-3, 1, 4000))
        assert abs(quality_pu.class_prior(positive, unlabelled) - share) < 0.06


def test_held_out_accuracy_and_columns(spark):
    got = quality_pu.op8_quality(spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    rows = got.collect()
    assert len(rows) == table(spark, SF, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for _, p, y in held) / len(held) > 0.95
    pairs = [(a, b) for a, _, y in held if y for b, _, z in held if not z]
    assert sum(a > b for a, b in pairs) / len(pairs) > 0.98


def test_only_training_labels_and_texts_count(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    held = quality_pu.held_out_fold(F.col("doc_id"))
    plain = quality_pu.learn(docs, labels, held)
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = quality_pu.learn(docs.withColumn("source", F.lit("x")).withColumn("lang", F.lit("y")), turned, held)
    assert np.array_equal(plain.weights, other.weights) and plain.shift == other.shift


def test_odd_rows_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (7, 1), (7, None), (None, 1), (10, 0)], "doc_id long, quality int")
    docs = odd.documents(spark)
    model = quality_pu.learn(docs, labels, F.lit(False))
    assert quality_pu.scored(docs, model).count() == len(odd.ROWS)
    kept = quality_pu.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= len(odd.ROWS)
    blank = quality_pu.learn(odd.nothing(spark), labels, F.lit(False))
    assert {round(r.score, 6) for r in quality_pu.scored(docs, blank).collect()} == {0.5}
    assert quality_pu.scored(odd.nothing(spark), model).count() == 0


def test_the_sample_is_bounded_when_one_doc_id_has_many_rows(spark, monkeypatch):
    sizes = []
    fit = quality_pu.fit
    monkeypatch.setattr(quality_pu, "fit", lambda p, u: (sizes.append((len(p), len(u))), fit(p, u))[1])
    monkeypatch.setattr(quality_pu, "SAMPLE", 20)
    docs = spark.range(600).select((F.col("id") % 40 * (F.col("id") % 3)).alias("doc_id"),
                                   F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = spark.range(0, 80, 2).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    quality_pu.learn(docs, labels, F.lit(False))
    assert sizes and all(0 < n <= 20 for n in sizes[0])
