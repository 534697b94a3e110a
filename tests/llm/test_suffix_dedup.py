import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from closewright.llm import suffix_dedup as s
from closewright.llm import suffixsort as ss


def brute(texts):
    held = [(t or "").encode() for t in texts]
    seen = Counter(b[k : k + 200] for b in held for k in range(len(b) - 199))
    out = []
    for b in held:
        cover = np.zeros(len(b) + 1, int)
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                cover[k] += 1
                cover[k + 200] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def run(spark, rows):
    df = spark.createDataFrame([(n, t, 1, "x") for n, t in rows], "doc_id long, text string, start int, key string").repartition(3)
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in s.without_repeats(df).collect())


def corpus():
    random_ = random.Random(9)
    draw = lambda n: "".join(random_.choice("abcdé \n") for _ in range(n))
    passage, short = draw(320), draw(180)
    base = draw(900)
    texts = [draw(random_.randint(0, 700)) for _ in range(12)]
    texts += [draw(150) + passage[a:b] + draw(90) for a, b in ((0, 320), (60, 320), (0, 250), (100, 300), (0, 199))]
    texts += [draw(100) + short + draw(100) for _ in range(6)]
    texts += [base, base, base[:450] + "X" + base[451:], "y" + base[200:], base[:410] + base[:410]]
    texts += ["z" * 1000, "z" * 210, "ab" * 300, "ab" * 120 + "c", "abc" * 90, "", None, "short", passage + passage]
    return list(enumerate(texts))


def test_against_brute_force(spark):
    rows = corpus()
    assert run(spark, rows) == sorted((n, *b) for (n, _), b in zip(rows, brute([t for _, t in rows])))


def test_hot_buckets_and_cut_texts(spark, monkeypatch):
    monkeypatch.setattr(s, "HOT_BUCKET", 1)
    rows = corpus()
    assert run(spark, rows) == sorted((n, *b) for (n, _), b in zip(rows, brute([t for _, t in rows])))


def test_repeated_and_null_ids_and_no_rows(spark):
    text = "".join(random.Random(1).choice("abcdefgh") for _ in range(300))
    rows = [(1, text), (1, text), (None, "q" + text), (2, "w" * 150), (None, "other")]
    assert run(spark, rows) == sorted((n if n is not None else -1, *b) for (n, _), b in zip(rows, brute([t for _, t in rows])))
    assert run(spark, []) == []


def test_parts_of_long_texts(monkeypatch):
    """Cutting a text into parts changes pieces, but every string stands in exactly one."""
    data = np.frombuffer(bytes(random.Random(7).choices(range(97, 103), k=5000)), np.uint8)
    for part in (1 << 20, 700):
        monkeypatch.setattr(s, "PART", part)
        key, content, text, start, n, repeats = s.pieces_of(data, np.array([0, 1900, 1900, 5000]))
        covered = sorted((int(t), int(a) + k) for t, a, m, r in zip(text, start, n, repeats) for k in range(m * r))
        assert covered == [(0, k) for k in range(1701)] + [(2, k) for k in range(2901)]


def test_cover_and_network():
    shifts = np.arange(ss.PERIOD)
    inside = ss._IN_COVER
    assert {(a - b) % ss.PERIOD for a in ss.COVER for b in ss.COVER} == set(range(ss.PERIOD))
    for a in shifts:
        for b in shifts:
            step = ss.SHIFT[a, b]
            assert inside[(a + step) % ss.PERIOD] and inside[(b + step) % ss.PERIOD]
    random_ = np.random.default_rng(1)
    for size in (2, 4, 8, 32, 128):
        row = random_.permutation(size)
        for low, high in ss.merge_network(size):
            a, b = row[low], row[high]
            row[low], row[high] = np.minimum(a, b), np.maximum(a, b)
        assert row.tolist() == sorted(row.tolist())


@pytest.mark.parametrize("letters", [1, 2, 4])
def test_suffix_order(letters):
    random_ = np.random.default_rng(letters)
    text = random_.integers(97, 97 + letters, 3000).astype(np.uint8)
    text[1000:1500] = text[200:700]
    words = ss.words_at(np.append(text, np.zeros(2 * 200 + 64, np.uint8)))
    starts = random_.permutation(2700)[:1500]
    bucket = starts % 3
    order = ss.sorted_suffixes(words, ss.sample_ranks(words, len(text), 200), starts, bucket)
    held = text.tobytes()
    keys = [(int(bucket[k]), held[starts[k] : starts[k] + 200]) for k in order]
    assert keys == sorted(keys)
    seen = Counter((int(b), held[p : p + 200]) for p, b in zip(starts, bucket))
    assert ss.equal_to_neighbour(words, starts, bucket, order, 200).tolist() == [seen[int(b), held[p : p + 200]] > 1 for p, b in zip(starts, bucket)]
