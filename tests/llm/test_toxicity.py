import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from faresight.llm import toxicity
from faresight.llm.common import table
from tests.llm import odd

SF = "/root/testdata/sf0.01"


def words_of(*texts):
    raw = [t.encode() for t in texts]
    return toxicity.words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))


def test_words_of_many_texts_in_pieces(monkeypatch):
    texts = [(r[1] or "").encode() for r in odd.ROWS]
    whole = words_of(*[t.decode() for t in texts])
    monkeypatch.setattr(toxicity, "PIECE", 100)
    pieces = toxicity.words_of(texts)
    for name in ("at", "ends", "hashes", "features"):
        assert np.array_equal(getattr(whole, name), getattr(pieces, name))


def net_of(seed=1):
    rng = np.random.default_rng(seed)
    net = toxicity.Net(rng.normal(0, 1, toxicity.BUCKETS).astype(np.float32))
    net.bias[:] = rng.normal(0, 0.1, len(net.bias))
    net.unit[:] = rng.normal(0, 1, net.unit.shape)
    return net


def test_words_and_their_features():
    w = words_of("The IDIOT's Éclair, idiot the", "", "éclair 12")
    assert np.diff(w.ends).tolist() == [6, 0, 2]
    the, idiot, s, eclair = w.at[:4].tolist()
    assert w.at.tolist() == [the, idiot, s, eclair, idiot, the, eclair, w.at[-1]] and len(w.hashes) == 5
    assert (w.features[idiot] > 0).tolist() == [True, True, False, False, False, False, True, False]   # 5 bytes: idio-, -diot
    assert (w.features[eclair] > 0).tolist() == [True, True, True, True, False, False, True, True]               # 7 bytes
    assert (w.features[the][1:] == 0).all()
    shared = words_of("worthless", "worthlike")
    assert (shared.features[0] == shared.features[1])[1:4].all() and shared.features[0, 0] != shared.features[1, 0]


def test_scores_do_not_depend_on_neighbours():
    texts = [r[1] or "" for r in odd.ROWS] + ["", "x"]
    net = net_of()
    together = net.logits(words_of(*texts))
    assert np.allclose(together, [net.logits(words_of(t))[0] for t in texts], atol=1e-3) and np.isfinite(together).all()
    assert np.isclose(together[-2], float(net.constant) + (np.maximum(net.bias, 0) * net.unit).sum(), atol=1e-5)


def test_logits_against_a_plain_network():
    net, text = net_of(2), "You are a clown, and a worthless one: a clown"
    w = words_of(text)
    v = [sum(net.embedding[f] for f in w.features[i]) for i in w.at] + [np.zeros(toxicity.NUMBERS)] * toxicity._PAD
    total, column = float(net.constant), 0
    for own in net.filters:
        for f in range(toxicity.FILTERS):
            seen = sorted((max(0.0, float(sum(v[p + j] @ own[j][:, f] for j in range(len(own))) + net.bias[column]))
                           for p in range(len(w.at) + toxicity.TOPS)), reverse=True)
            total += sum(a * b for a, b in zip(seen, net.unit[:, column]))
            column += 1
    assert np.isclose(net.logits(w)[0], total, atol=1e-3)


def test_training_lowers_the_loss_and_is_repeatable():
    rng = np.random.default_rng(5)
    plain = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "clowns"[:rng.integers(3, 5)]], 30)) for _ in range(160)]
    toxic = np.arange(160) % 4 == 0
    texts = [f"{t} clownish {t[:9]} moronic" if y else t for t, y in zip(plain, toxic)]
    model = toxicity.fit([t.encode() for t in texts], toxic.astype(np.int64))
    again = toxicity.fit([t.encode() for t in texts], toxic.astype(np.int64))
    s = model.score(words_of(*texts))
    assert ((s >= toxicity.THRESHOLD) == toxic).mean() > 0.98 and np.array_equal(s, again.score(words_of(*texts)))


def test_language_of_texts():
    w = words_of("the cat of the house", "der Hund und die Katze", "le chat et les chiens", "el gato y los perros", "12 xyz", "")
    assert [toxicity.LANGUAGES[i] for i in toxicity.language(w)] == ["en", "de", "fr", "es", "other", "other"]


@pytest.mark.parametrize("seed", range(4))
def test_threshold_misjudges_the_least(seed):
    rng = np.random.default_rng(seed)
    z, y = rng.normal(0, 1, 60).round(1), rng.integers(0, 2, 60)
    y[0], y[1] = 0, 1

    def cost(t):
        return (z[y == 1] < t).mean() + (z[y == 0] >= t).mean()

    assert np.isclose(cost(toxicity.threshold(z, y)), min(cost(t) for t in np.r_[z - 0.05, z.max() + 1]))


def test_held_out_accuracy_and_columns(spark):
    got = toxicity.op13_toxicity(spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    rows = got.collect()
    assert len(rows) == table(spark, SF, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in held) / len(held) > 0.95
    assert sum(p for p, y in held if y) / sum(y for _, y in held) > 0.8


def test_only_training_labels_and_texts_count(spark):
    small = "/root/testdata/sf0.001"
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    held = toxicity.held_out_fold(F.col("doc_id"))
    plain = toxicity.learn(docs, labels, held)
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = toxicity.learn(docs.withColumn("source", F.lit("x")).withColumn("lang", F.lit("y")), turned, held)
    assert np.array_equal(plain.net.embedding, other.net.embedding) and np.array_equal(plain.thresholds, other.thresholds)


def test_odd_rows_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, 0), (7, 1), (7, None), (8, 0), (None, 1), (10, 0), (13, 1)],
                                   "doc_id long, toxic int")
    docs = odd.documents(spark).selectExpr("*", "1 AS toxic", "2 AS id", "3 AS y", "4 AS predicted")
    model = toxicity.learn(docs, labels, F.lit(False))
    got = toxicity.scored(docs, model).collect()
    assert len(got) == len(odd.ROWS) and all(0 <= r.score <= 1 for r in got)
    blank = toxicity.learn(odd.nothing(spark), labels, F.lit(False))
    assert {r.score for r in toxicity.scored(docs, blank).collect()} == {0.5}
    assert {r.score for r in toxicity.scored(docs, toxicity.learn(docs, labels.where("toxic = 1"), F.lit(False))).collect()} == {0.5}
    assert toxicity.scored(odd.nothing(spark), model).count() == 0


def test_the_sample_is_bounded(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, y: sizes.append((int(y.sum()), int((y == 0).sum()), sum(map(len, texts)))))
    monkeypatch.setattr(toxicity, "TOXIC", 5)
    monkeypatch.setattr(toxicity, "OTHERS", 30)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 400)
    docs = spark.range(600).select((F.col("id") % 200).alias("doc_id"), F.concat(F.lit("a text "), F.col("id").cast("string")).alias("text"))
    labels = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    toxicity.learn(docs, labels, F.lit(False))
    assert sizes[0][0] == 5 and 0 < sizes[0][1] <= 30 and sizes[0][2] <= 400


def test_all_labelled_rows_train_and_set_thresholds(spark, monkeypatch):
    """More rows than are fitted at once: markers that the first fit can't know are learnt from the others."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(800):
        toxic = i % 4 == 0
        plain = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "epsilon"], 20))
        marker = ["clownish", "moronic", "wretched", "pathetic", "loathsome", "vile", "stupid", "idiotic"][i // 4 % 8]
        rows.append((i, f"{plain} number{i} {marker if toxic else 'kind'}", int(toxic)))
    table_ = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    for name, most in (("TOXIC", 4), ("OTHERS", 12), ("SHARD_BYTES", 30_000)):
        monkeypatch.setattr(toxicity, name, most)
    model = toxicity.learn(table_.select("doc_id", "text"), table_.select("doc_id", "toxic"), F.col("doc_id") % 5 == 0)
    got = {r.doc_id: r.predicted for r in toxicity.scored(table_, model).collect()}
    held = [(got[i], y) for i, _, y in rows if i % 5 == 0]
    assert sum(p == y for p, y in held) / len(held) > 0.97


def test_threshold_of_scores_that_stand_for_many():
    rng = np.random.default_rng(1)
    z, y = rng.normal(0, 1, 200).round(1), rng.integers(0, 2, 200)
    cells, times = np.unique(np.c_[z, y], axis=0, return_counts=True)
    assert np.isclose(toxicity.threshold(z, y), toxicity.threshold(cells[:, 0], cells[:, 1].astype(int), times))


def test_training_reads_no_text_of_held_out_rows_and_frees_each_round(spark, monkeypatch):
    """Texts of rows that are never used are not shuffled; they fail here if read."""
    freed, release = [], toxicity.release
    monkeypatch.setattr(toxicity, "release", lambda s: freed.append(1) or release(s))
    for name, most in (("TOXIC", 4), ("OTHERS", 12), ("SHARD_BYTES", 3_000)):
        monkeypatch.setattr(toxicity, name, most)
    held = F.col("doc_id") % 5 == 0
    text = F.when(held, F.raise_error(F.lit("read")).cast("string")).otherwise(F.concat(F.lit("some text "), F.col("doc_id").cast("string")))
    rows = spark.range(200).select(F.col("id").alias("doc_id"))
    toxicity.learn(rows.select("doc_id", text.alias("text")), rows.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic")), held)
    assert len(freed) > toxicity.ROUNDS


def test_the_largest_responses_are_those_that_training_pools():
    rng = np.random.default_rng(3)
    sizes = np.r_[toxicity.TOPS, toxicity._PAD, rng.integers(toxicity.TOPS, 90, 40)]
    z = np.maximum(rng.normal(0, 1, (sizes.sum(), 24)).round(1), 0).astype(np.float32)   # with ties
    starts = np.cumsum(sizes) - sizes
    assert np.array_equal(toxicity.largest(z, starts), toxicity.pooled(z.copy(), starts)[0])


def test_only_texts_that_train_are_written(spark, monkeypatch):
    """Copies of a text, and texts without label, are left out by digests before any text is written."""
    written, saved = [], toxicity.saved
    monkeypatch.setattr(toxicity, "saved", lambda df, label: written.append(saved(df, label)) or written[-1])
    for name, most in (("TOXIC", 4), ("OTHERS", 12), ("SHARD_BYTES", 3_000)):
        monkeypatch.setattr(toxicity, name, most)
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("some text "), (F.col("id") % 90).cast("string")).alias("text"))
    docs = rows.unionByName(rows.where("doc_id < 20")).unionByName(rows.where("doc_id < 9").withColumn("text", F.lit("another")))
    labels = rows.where("doc_id < 300").select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    toxicity.learn(docs, labels, F.lit(False))
    texts = [r.text for df in written if "text" in df.columns for r in df.select("text").collect()]
    assert len(texts) == len(set(texts)) and {f"some text {i}" for i in range(20, 90)} <= set(texts)


def test_pooling_takes_the_first_of_equal_values():
    rng = np.random.default_rng(3)
    z = rng.integers(0, 3, (40, 5)).astype(np.float32)
    starts = np.array([0, 7, 20])
    tops, at = toxicity.pooled(z.copy(), starts)
    for i, (a, b) in enumerate(zip(starts, [7, 20, 40])):
        for column in range(5):
            order = sorted(range(a, b), key=lambda row: (-z[row, column], row))[:toxicity.TOPS]
            assert at[:, i, column].tolist() == order
            assert tops[:, i, column].tolist() == [z[row, column] for row in order]


def test_training_sums_the_vector_of_a_word_once_for_each_batch(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"word{k}" for k in rng.integers(0, 30, 200)).encode() for _ in range(80)] + [b""]
    w = toxicity.words_of(texts)
    toxic = (np.arange(len(texts)) % 3 == 0).astype(np.int64)
    net = toxicity.Net(toxicity.log_odds(w, toxic))
    rows, vectors = [], toxicity.Net.vectors
    monkeypatch.setattr(toxicity.Net, "vectors", lambda self, f: (rows.append(len(f)), vectors(self, f))[1])
    toxicity.descend(net, w, toxic, 1, 1.0)
    assert rows and max(rows) <= len(w.hashes) + 1   # the padding too


def test_a_bucket_counts_a_text_once():
    texts = [b"alpha alpha beta", b"alpha", b"gamma beta", b""]
    w = toxicity.words_of(texts)
    toxic = np.array([1, 0, 1, 0])
    others, toxics = toxicity.held_by(w, toxic)
    feature = {name: w.features[np.flatnonzero(w.hashes == toxicity._hash_of(name))[0], 0] for name in ("alpha", "beta", "gamma")}
    assert [(others[feature[n]], toxics[feature[n]]) for n in feature] == [(1, 1), (0, 2), (0, 1)]


def test_a_text_longer_than_the_kept_powers(monkeypatch):
    text = b"some words of a text " * 9
    ends = np.array([0, len(text)])
    whole = toxicity.words(np.frombuffer(text, np.uint8), ends)
    monkeypatch.setattr(toxicity, "_kept_powers", lambda: toxicity._powers_to(20))
    cut = toxicity.words(np.frombuffer(text, np.uint8), ends)
    assert np.array_equal(whole.hashes, cut.hashes) and np.array_equal(whole.features, cut.features)
