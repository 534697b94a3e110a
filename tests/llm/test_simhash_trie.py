import random

import numpy as np
import xxhash

from closewright.llm import simhash_trie as s


def plain_print(text):
    words = (text or "").encode().translate(s.LOWERED).split()
    runs = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(prints):
    """Least key each key reaches over links of 3 or fewer differing bits."""
    root = {k: k for k in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(prints)
    for n, a in enumerate(keys):
        for b in keys[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def flipped(r, value, n):
    for b in r.sample(range(64), n):
        value ^= 1 << b
    return value


def clustered(r, n):
    values = set()
    while len(values) < n:
        seed = r.getrandbits(64)
        values.add(seed)
        for _ in range(r.randint(0, 12)):
            seed = flipped(r, seed, r.randint(1, 4))
            values.add(seed)
    return np.array(sorted(values), np.uint64)


def test_walk_meets_every_close_pair_once(monkeypatch):
    monkeypatch.setattr(s, "FRONTIER", 37)
    values = clustered(random.Random(1), 400)
    met = [(min(a, b), max(a, b)) for x, y in s.close_pairs(values, values, True, 0) for a, b in zip(x.tolist(), y.tolist())]
    expected = {(a, b) for a in range(len(values)) for b in range(a + 1, len(values)) if (int(values[a]) ^ int(values[b])).bit_count() <= 3}
    assert sorted(met) == sorted(expected)
    top = [values[values >> np.uint64(62) == p] for p in range(4)]
    for u, v in ((0, 1), (0, 3), (1, 2)):
        met = [(a, b) for x, y in s.close_pairs(top[u], top[v], False, 2) for a, b in zip(x.tolist(), y.tolist())]
        assert sorted(met) == [(a, b) for a in range(len(top[u])) for b in range(len(top[v])) if (int(top[u][a]) ^ int(top[v][b])).bit_count() <= 3]


def test_links_are_fewer_than_prints():
    r = random.Random(2)
    ball = np.array(sorted({flipped(r, 77, k) for k in (0, 1, 2, 3) for _ in range(400)}), np.uint64)
    a, _ = s.links_of(ball, ball, True, 0)
    assert len(a) == len(ball) - 1


def test_divided_trie_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(s, "NODE_SIZE", 8)
    r = random.Random(3)
    values = {int(v) for v in clustered(r, 500)} | {flipped(r, 5, k) for k in (1, 2) for _ in range(30)}  # a hot prefix
    rows = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    prints = spark.createDataFrame(rows, "print long").repartition(5)
    units = s.divided(prints)
    assert units.select("depth").distinct().count() > 1 and units.count() == units.distinct().count()
    links = s.components(s.trie_links(prints))
    got = {x.u: x.component for x in links.collect()}
    expected = brute({v: int(np.int64(v).astype(np.uint64)) for (v,) in rows})
    assert {v: got.get(v, v) for (v,) in rows} == expected


def test_documents_against_brute_force(spark):
    r, rows = random.Random(4), []
    for _ in range(25):
        words = ["".join(r.choice("abcdeÉ") for _ in range(r.randint(1, 6))) for _ in range(r.randint(1, 200))]
        for _ in range(6):
            rows.append((len(rows), r.choice([" ", "\n", "\t\x0b "]).join(words)))
            if r.random() < 0.7:
                words[r.randrange(len(words))] = f"Edit{r.random()}"
    rows += [(900, None), (901, ""), (902, " \n"), (903, "word"), (904, "WORD"), (905, "two words"), (906, "a b c d")]
    df = spark.createDataFrame([(*x, 1, "z") for x in rows], "doc_id long, text string, print int, component string").repartition(3)
    got = {x.doc_id: x for x in s.near_classes(df).collect()}
    prints = {i: plain_print(t) for i, t in rows}
    assert {i: x.fingerprint for i, x in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: x.component_id for i, x in got.items()} == brute(prints)


def test_long_text_in_parts(monkeypatch):
    text = " ".join(f"w{n % 97}" for n in range(3000)) + "\n"
    whole = s.fingerprint(text.encode())
    monkeypatch.setattr(s, "TAKEN_BYTES", 50)
    monkeypatch.setattr(s, "TAKEN_HASHES", 7)
    assert s.fingerprint(text.encode()) == whole == plain_print(text)
    assert s.fingerprint(b"x" * 500) == plain_print("x" * 500)


def test_odd_rows(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (3, "e f g h i"), (3, "e f g h i"), (3, "other words are these"), (None, None), (7, "")]
    got = sorted((x.doc_id or -1, x.component_id or -1) for x in s.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(-1, -1), (-1, -1), (-1, 7), (3, 3), (3, 3), (3, 3), (7, 7)]
    assert s.near_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0
