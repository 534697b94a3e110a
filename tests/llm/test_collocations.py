import random
import re
from collections import Counter, defaultdict

import numpy as np

from closewright.llm import collocations as c

FOLD = {k: k + 32 for k in range(65, 91)}


def brute(docs, least, longest=5, best=2000):
    n, f = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    able = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    rows = defaultdict(list)
    for (lang, words), a in able.items():
        inside = any(x == lang and b >= a and len(w) > len(words) and any(w[i : i + len(words)] == words for i in range(len(w))) for (x, w), b in able.items())
        if not inside:
            score, k = min((1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words)))
            rows[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return sorted((lang, r + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in rows.items() for r, (s, a, p, left, right) in enumerate(sorted(found)[:best]))


def run(spark, docs, least, **more):
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "lang string, text string, n int, word string").repartition(3)
    return sorted(tuple(r) for r in c.ranked_phrases(df, least, **more).collect())


def corpus(seed, n=120):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(40)] + ["Élan", "élan", "日本", "a\x00b", "x y", "The", "the"]
    texts = []
    for _ in range(n):
        some = []
        for _ in range(r.randint(0, 60)):
            some.append(r.choice(words[: r.randint(1, len(words))]))
            if r.random() < 0.15:
                some += ["in", "a", "fixed", "order", "always"][: r.randint(2, 5)]
            some.append(r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "?!", " : "]))
        texts.append((r.choice(["de", "en", "en", None, "und"]), " ".join(some[:1]) + "".join(x if x.strip() else x for x in some[1:])))
    return texts + [("en", "la la la la la la la. " * 6), ("xx", "one two " * 30)]


def test_against_brute_force(spark, monkeypatch):
    docs = corpus(1)
    assert run(spark, docs, 8) == brute(docs, 8)
    monkeypatch.setattr(c, "BLOCK_WORDS", 150)
    monkeypatch.setattr(c, "TAKEN_BYTES", 40)
    monkeypatch.setattr(c, "TILE", 4)
    monkeypatch.setattr(c, "DENSE", 6)
    monkeypatch.setattr(c, "RANK_ROWS", 20)
    assert run(spark, docs, 5, best=7) == brute(docs, 5, best=7)


def test_dense_and_sparse_tiles_count_alike(monkeypatch):
    random_ = np.random.default_rng(2)
    ids = (random_.pareto(0.6, (2, 5000)) * 3).astype(np.int64) % (1 << 40)
    expected = Counter(zip(*ids.tolist(), strict=True))
    for tile, dense in ((512, 1 << 14), (16, 50), (1 << 10, 1)):
        monkeypatch.setattr(c, "TILE", tile)
        monkeypatch.setattr(c, "DENSE", dense if tile < 1 << 10 else 400)
        a, b, n, number = c.tiled_counts(ids[0], ids[1])
        assert Counter(dict(zip(zip(a.tolist(), b.tolist(), strict=True), n.tolist(), strict=True))) == expected
        assert (a[number] == ids[0]).all() and (b[number] == ids[1]).all() and len(a) == len(expected)


def test_ids_fall_with_frequency(spark):
    counted = spark.createDataFrame([(f"w{k}", k % 37) for k in range(500)], "word string, n long").repartition(7)
    got = sorted((r.id, r.word, r.n) for r in c.by_frequency(counted, ["word"], "test").collect())
    assert [g[0] for g in got] == list(range(500))
    assert [g[1:] for g in got] == sorted(((f"w{k}", k % 37) for k in range(500)), key=lambda x: (-x[1], x[0]))


def test_products_beyond_64_bits(spark):
    big = 10**13
    rows = [(["a", "b"], big - 1, [big + 7], [big + 9])]
    df = spark.createDataFrame(rows, "words array<string>, n long, first array<long>, last array<long>").selectExpr("*", "cast(90000000000000 as long) as total")
    cut = df.select(c.lowest_cut(df["total"]).alias("cut")).first().cut
    assert (cut.score, cut.k, cut.l, cut.r) == (1000 * (big - 1) * 90000000000000 // ((big + 7) * (big + 9)), 1, big + 7, big + 9)


def test_odd_rows(spark):
    docs = [(None, "a b"), ("und", "a b"), ("en", None), ("en", ""), ("en", " . ,"), ("en", "a b")] + [("de", "x y. " * 20000)] * 2
    assert run(spark, docs, 2) == brute(docs, 2)
    assert run(spark, [("en", "a b")], 2) == [] and run(spark, [], 2) == []


def test_numbers_learn_their_ids_with_one_move(spark):
    rows = [(block, spot, lang, f"w{spot}", n) for block in (0, 7) for spot, (lang, n) in enumerate([("x", 9), ("x", 1), ("y", 5), ("y", 2)])] + [(9, 0, "x", "w1", 8), (9, 1, "y", "w1", 9)]
    numbers = spark.createDataFrame(rows, "block long, spot int, lang string, word string, n long")
    found = c.frequent(numbers, ["lang", "word"], 10)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    got = sorted((r.block, r.spot, r.n) for r in found.collect())
    assert got == [(0, 0, 18), (0, 1, 10), (0, 2, 10), (7, 0, 18), (7, 1, 10), (7, 2, 10), (9, 0, 10)]
    ids = {(r.block, r.spot): r.id for r in found.collect()}
    assert ids[0, 1] == ids[7, 1] == ids[9, 0] and len(set(ids.values())) == 3
    assert sorted((r.lang, r.word) for r in found.filter("word is not null").collect()) == [("x", "w0"), ("x", "w1"), ("y", "w2")]


def test_ids_fall_with_frequency_in_each_bucket(spark):
    numbers = spark.range(20_000).selectExpr("0L as block", "cast(id as int) as spot", "id as a", "id % 7 as b", "id + 1 as n")
    found = c.frequent(numbers, ["a", "b"], 101).collect()
    assert len(found) == 19_900 and len({r.id for r in found}) == 19_900
    for bucket in range(0, c.BUCKETS, 100):
        mine = sorted((r.id, -r.n) for r in found if r.id % c.BUCKETS == bucket)
        assert mine and [n for _, n in mine] == sorted(n for _, n in mine) and [i // c.BUCKETS for i, _ in mine] == list(range(len(mine)))


def test_counts_of_pairs_move_packed(spark):
    """Every pair of 300,000 occurs in both blocks: they take less than 5 bytes each where they are moved, and come back with their ids."""
    random_ = np.random.default_rng(5)
    key = np.sort(random_.choice(1 << 26, 300_000, replace=False))
    a, b, n = key >> 13, key & 8191, random_.integers(1, 4, len(key))
    batches = [x for block in (3, 8) for x in c.pair_rows(block, np.arange(-1, len(key)), a, b, n)]
    assert sum(len(p) for x in batches for p in x.column("pairs").to_pylist() if p) < 5 * 2 * len(key)
    blocks = spark.createDataFrame(c.pa.Table.from_batches(batches))
    found = c.frequent_pairs(blocks, 4).toArrow()
    told = {(r["a"], r["b"]): (r["id"], r["n"]) for r in found.filter(c.pa.compute.is_valid(found["a"])).select(["id", "a", "b", "n"]).to_pylist()}
    assert len({i for i, _ in told.values()}) == len(told)
    assert {k: m for k, (_, m) in told.items()} == {(x, y): 2 * m for x, y, m in zip(a.tolist(), b.tolist(), n.tolist(), strict=True) if m > 1}
    number = c.unpacked(batches[0].column("places")[0].as_py(), 1, len(key) + 1)[0]
    assert number[0] == -1
    pair_of = dict(zip(number[1:].tolist(), zip(a.tolist(), b.tolist(), strict=True), strict=True))
    back = [x for x in found.filter(c.pa.compute.is_valid(found["ids"])).select(["block", "size", "ids"]).to_pylist()]
    for block in (3, 8):
        spots, ids = np.concatenate([c.unpacked(x["ids"], 2, x["size"]) for x in back if x["block"] == block], axis=1).tolist()
        assert {pair_of[s]: i for s, i in zip(spots, ids, strict=True)} == {k: i for k, (i, _) in told.items()}
