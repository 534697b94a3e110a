import random

import numpy as np

from closewright.llm import cotrain


def corpus(n=240):
    random_ = random.Random(2)
    rows, labels = [], []
    for k in range(n):
        good = random_.random() < 0.6
        vocabulary = ["clear", "plain", "sound", "even"] if good else ["spam", "buy!!", "click", "win$$"]
        text = " ".join(random_.choice([*vocabulary, "the", "of", "and"]) for _ in range(random_.randint(5, 60)))
        rows.append((k, text, ("a" if good else "b") if random_.random() < 0.8 else "c", "en", len(text)))
        if k % 4 == 0:
            labels.append((k, int(good), 0))
    truth = {k: int(r[1].split()[0] in ("clear", "plain", "sound", "even") or any(w in r[1] for w in ("clear", "plain", "sound", "even"))) for k, r in enumerate(rows)}
    return rows, labels, truth


def frames(spark, rows, labels):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_unlabelled_documents_are_judged(spark):
    rows, labels, truth = corpus()
    got = cotrain.quality_scores(*frames(spark, rows, labels)).collect()
    told = {k for k, _, _ in labels}
    new = [r for r in got if r.doc_id not in told]
    assert len(got) == len(rows) and np.mean([r.keep == bool(truth[r.doc_id]) for r in new]) > 0.95
    assert all(0 <= x <= 1 for r in got for x in (r.p_text, r.p_meta, r.score))


def test_views_exchange_labels(spark):
    rows, labels, _ = corpus()
    docs, told = frames(spark, rows, labels)
    model = cotrain.co_train(cotrain.prepared(docs, told, "doc_id", "text", "source", "lang", "n_chars", "quality"))
    first, *later = model.rounds
    held = cotrain.prepared(docs, told, "doc_id", "text", "source", "lang", "n_chars", "quality").filter("held").count()
    assert 0 < held < len(labels) and sum(first["text"]) == sum(first["meta"]) == len(labels) - held
    assert all(sum(r["meta"]) > len(labels) for r in later)


def prepare(docs, told):
    return cotrain.prepared(docs, told, "doc_id", "text", "source", "lang", "n_chars", "quality")


def test_counts_are_those_of_all_documents(spark):
    rows, labels, _ = corpus(40)
    ready = prepare(*frames(spark, rows, labels))
    whole = cotrain.counts(ready.repartition(5), None)
    used = [r.doc_id for r in ready.filter("label is not null and not held").collect()]
    n_words = sum(2 * len(rows[k][1].split()) + len(rows[k][1].split()) - 1 for k in used)
    assert whole[:, : 1 << cotrain.TEXT_BITS].sum() == n_words
    assert whole[:, 1 << cotrain.TEXT_BITS : -2].sum() == 5 * len(used)


def test_every_row_is_prepared_once_with_its_label(spark, monkeypatch):
    rows, labels, _ = corpus(300)
    rows = rows + rows[:9] + [(None, "no id", "a", "en", 5)]
    for bits in (1 << 23, 1 << 15):  # with few bits, unlabelled documents pass the filter too
        monkeypatch.setattr(cotrain, "FILTER_BITS", bits)
        got = sorted((r.doc_id if r.doc_id is not None else -1, r.text, -1 if r.label is None else r.label) for r in prepare(*frames(spark, rows, labels)).collect())
        told = {k: q for k, q, _ in labels}
        assert got == sorted((k if k is not None else -1, t, told.get(k, -1)) for k, t, *_ in rows)


def test_scores_against_plain_sums(spark):
    """The whole co-training once more in plain Python over dictionaries."""
    rows, labels, _ = corpus(120)
    docs, told = frames(spark, rows, labels)
    ready = prepare(docs, told)
    features = {}
    for r in ready.collect():
        data = r.text.encode()
        words, _ = cotrain.text_features(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        features[r.doc_id] = (words.tolist(), list(r.meta), r.label, r.held)

    def weights(labelled, view, size):
        count = [[0.5] * size, [0.5] * size]
        for doc, label in labelled.items():
            for f in features[doc][view]:
                count[label][f] += 1
        total = [sum(c) for c in count]
        return [np.log(count[1][f] / total[1]) - np.log(count[0][f] / total[0]) if count[0][f] + count[1][f] > 1 else 0.0 for f in range(size)]

    raw = lambda w, doc, view: sum(w[f] for f in features[doc][view]) / max(1, len(features[doc][view]))
    views, known = (1 << cotrain.TEXT_BITS, 1 << cotrain.META_BITS), {d: f[2] for d, f in features.items() if f[2] is not None and not f[3]}
    held = {d: f[2] for d, f in features.items() if f[3]}
    labelled = [dict(known), dict(known)]
    for turn in range(cotrain.ROUNDS + 1):
        w = [weights(labelled[v], v, views[v]) for v in (0, 1)]
        fits = [cotrain.logistic(np.array([[raw(w[v], d, v)] for d in held]), np.array(list(held.values()), float)) if len(set(held.values())) == 2 else (1.0, 0.0) for v in (0, 1)]
        p = [{d: cotrain.probability(np.clip(fits[v][0] * raw(w[v], d, v) + fits[v][1], -30, 30)) for d in features} for v in (0, 1)]
        labelled = [known | {d: int(q >= cotrain.SURE) for d, q in p[1 - v].items() if features[d][2] is None and (q >= cotrain.SURE or q <= 1 - cotrain.SURE)} for v in (0, 1)]
    got = {r.doc_id: r for r in cotrain.quality_scores(docs, told).collect()}
    for d in features:
        assert abs(got[d].p_text - p[0][d]) < 1e-6 and abs(got[d].p_meta - p[1][d]) < 1e-6


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "text", "a", "en", 4), (2, "", "a", "en", 0), (3, "x " * 100000, "a", "en", None)]
    for labels in ([], [(2, 1, 0)], [(2, 1, 0), (2, 0, 0), (3, None, None), (99, 1, 0), (None, 1, 0)]):
        got = cotrain.quality_scores(*frames(spark, rows, labels)).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        if not labels:
            assert {r.score for r in got} == {0.5}
    assert cotrain.quality_scores(*frames(spark, [], [(1, 1, 0)])).count() == 0
