import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from closewright.llm import langid


def text_of(syllables, random_, n):
    return " ".join("".join(random_.choice(syllables) for _ in range(random_.randint(1, 3))) for _ in range(n))


TONGUES = {"aa": ["the", "ing", "and", "tion"], "bb": ["être", "eau", "oué", "les"], "cc": ["ung", "sch", "über", "der"]}


def rows(n=150, seed=1):
    random_ = random.Random(seed)
    return [(k, text_of(TONGUES[t], random_, random_.randint(5, 80)), t) for k in range(n) for t in [random_.choice(sorted(TONGUES))]]


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, lang string")
    return langid.train(docs)


def test_held_out_accuracy(spark, trained):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, lang string")
    got = langid.predict(docs, trained).withColumn("out", langid.held_out(F.col("doc_id"))).collect()
    for r in got:
        assert r.out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    out = [r for r in got if r.out]
    assert len(out) > 20 and np.mean([r.lang == r.lang_pred for r in out]) > 0.95


def test_held_out_labels_are_not_learned(spark):
    docs = [(k, t, "zz" if zlib.crc32(str(k).encode()) % 4 == 2 else lang) for k, t, lang in rows()]
    assert langid.train(spark.createDataFrame(docs, "doc_id long, text string, lang string")).labels == ["aa", "bb", "cc"]


def test_odd_texts(spark, trained):
    docs = spark.createDataFrame([(1, None, None, 1), (2, "", "x", 1), (3, "123 !?", "x", 1), (None, "les être eau " * 40000, None, 1), (5, "é", None, 1), (5, "é", None, 1)], "doc_id long, text string, score string, row int")
    got = langid.predict(docs, trained).collect()
    assert [r.lang_pred for r in got][:4] == ["und", "und", "und", "bb"] and [r.score for r in got][:3] == [0, 0, 0]
    assert got[4].lang_pred in TONGUES and got[4] == got[5] and len(got) == 6
    nothing = langid.train(docs.select("doc_id", "text").withColumn("lang", docs.text).limit(0))
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(docs.limit(0), trained).count() == 0


def test_every_position_of_whole_texts_counts(trained):
    """Pooled windows equal the mean over all positions, computed window by window."""
    texts = [text_of(TONGUES["aa"], random.Random(4), 60).encode(), b"", b"x" * 200]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts]))
    got = langid.document_probabilities(trained, data, offsets)
    for t, row in zip(texts, got):
        parts = [t[k : k + langid.STEPS] for k in range(0, len(t), langid.STEPS)]
        total = np.zeros(3)
        for p in parts:
            x, valid = langid.grid([p])
            total += langid.positions(trained, x)[0][valid[:, 0], 0].sum(axis=0)
        assert np.allclose(row, total / max(1, len(t)), atol=1e-5)


def test_gradients_are_those_of_the_loss():
    net = langid.new_network(["a", "b", "c"], seed=3)
    for k, w in enumerate(net.weights()):
        w *= 0.5
    random_ = np.random.default_rng(1)
    x, valid = random_.integers(0, 5, (langid.STEPS, 4)).astype(np.uint8), np.ones((langid.STEPS, 4), bool)
    valid[40:, 1] = False
    y = np.array([0, 1, 2, 0])

    def loss():
        p, _ = langid.positions(net, x)
        return -np.log(p[:, np.arange(4), y][valid].astype(np.float64)).mean()

    found = langid.gradients(net, x, y, valid)
    for w, g in zip(net.weights(), found):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = w[at], np.float32(1e-2)
        w[at] = old + step
        up = loss()
        w[at] = old - step
        down = loss()
        w[at] = old
        assert g[at] == pytest.approx((up - down) / (2 * step), rel=0.1, abs=1e-4)


def test_every_label_is_learned(spark):
    docs = [(k, f"word{k} of tongue {k % 70}", f"l{k % 70:02d}") for k in range(700)]
    assert langid.train(spark.createDataFrame(docs, "doc_id long, text string, lang string")).labels == [f"l{k:02d}" for k in range(70)]


def test_rejection_follows_the_number_of_labels():
    import corpus_pipeline as c

    assert c.least_score(1) == c.least_score(2) == c.least_score(4) == c.LEAST_SCORE
    assert c.least_score(100) == c.LEAST_LIFT / 100


def test_rows_without_ids_are_drawn_one_by_one(spark):
    docs = spark.createDataFrame([(None, f"word{k} of tongue {k % 2}", f"l{k % 2}") for k in range(12000)], "doc_id long, text string, lang string")
    assert {r.label for r in langid.training_windows(docs, "doc_id", "text", "lang").select("label").distinct().collect()} == {"l0", "l1"}
