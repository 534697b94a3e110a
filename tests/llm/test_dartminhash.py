import random
from collections import Counter

import numpy as np
import pytest

from closewright.llm import dartminhash as d
from closewright.llm.components import components
from closewright.llm.textbytes import utf8


def bag(text):
    words = (text or "").split()
    if not words:
        return Counter()
    return Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)])


def similarity(a, b):
    both = sum(min(n, b[k]) for k, n in a.items())
    return both / (sum(a.values()) + sum(b.values()) - both)


def brute(rows):
    """Least id of each row's component, for distinct ids."""
    bags, root = {i: bag(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        return x if root[x] == x else find(root[x])

    ids = sorted(bags)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if bags[a] and bags[b] and similarity(bags[a], bags[b]) >= 0.8:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def words(random_, n):
    return ["".join(random_.choice("abcdefgh") for _ in range(random_.randint(1, 6))) for _ in range(n)]


def corpus():
    random_, rows = random.Random(4), []
    for group in range(12):
        text = words(random_, random_.randint(8, 300))
        for copy in range(8):  # a chain of edits: neighbours are near, ends are not
            rows.append((len(rows), " ".join(text)))
            text = list(text)
            for _ in range(max(1, len(text) // 60)):
                text[random_.randrange(len(text))] = f"edit{group}{copy}{random_.random()}"
        rows.append((len(rows), " ".join(text)))
        rows.append((len(rows), "  \n".join(text)))
    rows += [(len(rows) + n, t) for n, t in enumerate(["one two", "one  two", "one two three", "x " * 900, "x " * 1000, "x " * 700, "word", "word"])]
    return rows


def test_classes_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, class int, sid int").repartition(3)
    got = {r.doc_id: r for r in d.near_classes(df).collect()}
    expected = brute(rows)
    assert {i: r.class_id for i, r in got.items()} == expected
    sizes = Counter(expected.values())
    assert all(r.class_size == sizes[r.class_id] for r in got.values())


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "  "), (None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (5, "a b c d e f g " * 4), (5, "other words than those before it")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or -1, r.class_id, r.class_size) for r in d.near_classes(df).collect()))
    assert got == [(-1, 4, 3), (1, 1, 1), (2, 2, 1), (3, 3, 1), (4, 4, 3), (4, 4, 3), (5, 5, 1), (5, 5, 1)]
    kept = d.one_of_each(df.selectExpr("*", "text as lang")).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == [(1, ""), (2, ""), (3, "  "), (4, "a b c d e f"), (5, "a b c d e f g " * 4), (5, "other words than those before it")]
    assert d.near_classes(df.limit(0)).count() == 0


def test_signatures_estimate_weighted_similarity():
    random_ = np.random.default_rng(8)
    for _ in range(4):
        elements = random_.integers(0, 1 << 63, 300, dtype=np.uint64)
        a, b = random_.integers(1, 9, 300), random_.integers(1, 9, 300)
        expected = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        agree = []
        for salt in range(8):
            h = elements * np.uint64(2 * salt + 1)
            ranks = d.signatures(np.append(h, h), np.repeat([0, 1], 300), np.append(a, b), 2)
            assert np.isfinite(ranks).all()
            agree.append((ranks[0] == ranks[1]).mean())
        assert np.mean(agree) == pytest.approx(expected, abs=0.06)


def test_scarce_elements_and_empty_sets():
    ranks = d.signatures(np.array([5], np.uint64), np.array([1]), np.array([1]), 3)
    assert np.isinf(ranks[0]).all() and np.isfinite(ranks[1]).all() and np.isinf(ranks[2]).all()


def test_components(spark):
    random_ = random.Random(2)
    links = [(n, n + 1) for n in range(0, 120)] + [(500, 500)] + [(1000, 1000 + n) for n in range(1, 60)] + [(2000 + random_.randrange(80), 2000 + random_.randrange(80)) for _ in range(70)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "u long, v long")).collect()))
    near = {}
    for u, v in links:
        near.setdefault(u, set()).add(v)
        near.setdefault(v, set()).add(u)
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            todo += [w for w in near[todo.pop()] if w not in seen and not seen.add(w)]
        assert got[start] == min(seen)
    assert len(got) == len(near)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_utf8_of_slices_and_nulls():
    import pyarrow as pa

    data, offsets = utf8(pa.array(["zero", "é", None, "", "last"]).slice(1, 3))
    assert data.tobytes() == "é".encode() and offsets.tolist() == [0, 2, 2, 2]


@pytest.mark.parametrize("n", [120, 360])
def test_compared_rows_grow_with_members(spark, monkeypatch, n):
    """Near copies of one text, each with its own edits: links are at most linear in the sets, whatever their pairs."""
    random_ = random.Random(n)
    text, rows = words(random_, 120), []
    for k in range(n):
        copy = list(text)
        for edit in range(random_.randint(1, 2)):
            copy[random_.randrange(len(copy))] = f"own{k}x{edit}"
        rows.append((k, " ".join(copy)))
    told = []
    keep = d.written

    def counted(df, name):
        out = keep(df, name)
        if name == "links":
            told.append(out.count())
        return out

    monkeypatch.setattr(d, "written", counted)
    got = {r.doc_id: r.class_id for r in d.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows) and any(similarity(bag(rows[0][1]), bag(t)) < 0.8 for _, t in rows)
    # The first comparison is to the least set of each of 32 buckets, each later one to one set of a bucket.
    assert max(told) <= n * d.BANDS / 4 and sum(told) <= n * d.BANDS


def test_joining_pairs_join_what_all_pairs_join(monkeypatch):
    import pyarrow as pa

    random_ = np.random.default_rng(3)
    rows = []
    for sid in range(60):
        base = (sid % 6) * 1000
        held = np.unique(np.append(base + np.arange(40), base + 40 + random_.integers(0, 400, random_.integers(0, 14))))
        rows.append((0, 0, 0, 0, sid, sid // 2, [7] * d.BANDS, held.tolist()))
    names = ["band", "one", "two", "part", "sid", "component", "bands", "elements"]
    kinds = [pa.int64()] * 6 + [pa.list_(pa.int64())] * 2
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
    pairs = d.joining_pairs(d.Sets([batch.slice(0, 25), batch.slice(25)]), 7, 0, 0)

    def classes(links):
        root = {r[4]: r[5] for r in rows}
        for a, b in links:
            low, high = sorted((root[a], root[b]))
            root = {k: low if v == high else v for k, v in root.items()}
        return root

    sets = {r[4]: set(r[7]) for r in rows}
    all_pairs = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert classes(pairs) == classes(all_pairs) and len(pairs) < len(rows) and all((min(p), max(p)) in all_pairs for p in pairs)
    assert d.joining_pairs(d.Sets([batch]), 8, 0, 0) == []
