import math
import random
import re
from collections import Counter

from closewright.llm import termscan as t

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, item_id string, score int"


def brute(docs, items, k=20):
    terms = [(i, Counter(TERM.findall((x or "").translate(FOLD)))) for i, x in docs]
    n_docs, n_terms = sum(1 for _, c in terms if c), sum(sum(c.values()) for _, c in terms)
    df = Counter(w for _, c in terms for w in c)
    weight = lambda w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
    asked = {}
    for i, x in set(items):
        asked.setdefault(i, Counter()).update(TERM.findall((x or "").translate(FOLD)))
    out = []
    for item, q in asked.items():
        found = []
        for doc, c in terms:
            m = 75 + (25 * sum(c.values()) * n_docs) // max(1, n_terms)
            score = sum(r * weight(w) * ((10**9 * c[w]) // (1000 * c[w] + 12 * m)) for w, r in q.items() if c[w])
            if score > 0:
                found.append((-score, doc is None, doc))
        out += [(item, n + 1, doc, -s) for n, (s, _, doc) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k])]
    return sorted(out, key=str)


def run(spark, docs, items, k=20, parts=3):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], SCHEMA).repartition(parts)
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    return sorted((tuple(r) for r in t.ranked(d, i, k).collect()), key=str)


def corpus(seed, n=160):
    r = random.Random(seed)
    words = ["a", "an", "ant", "Ant", "zèbre", "ZÈBRE", "日本", "x1", "1", "tea", "team", "The", "the"] + [f"w{k}" for k in range(60)]
    text = lambda m: "".join(r.choice(words) + r.choice([" ", ", ", "-", "\n", "_", "\x7f", "  "]) for _ in range(m))
    return [(k, text(r.randint(0, 60))) for k in range(n)], [(k, text(r.randint(0, 15))) for k in range(12)]


def test_against_brute_force(spark, monkeypatch):
    docs, items = corpus(1)
    docs += [(500 + k, docs[3][1]) for k in range(30)]  # ties
    assert run(spark, docs, items) == brute(docs, items)
    monkeypatch.setattr(t, "CELLS", 40)
    monkeypatch.setattr(t, "MERGE_ROWS", 6)
    assert run(spark, docs, items, k=3) == brute(docs, items, 3)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items = corpus(2)
    monkeypatch.setattr(t, "BLOCK_ITEMS", 3)
    assert len(list(t.item_blocks(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text"))) > 2
    assert run(spark, docs, items) == brute(docs, items)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "?!"), (None, "tea for two"), (4, "tea for two"), (4, "tea for two"), (5, "Tea, " * 40000 + "end"), (6, "teapot")]
    items = [(1, "tea two"), (1, "tea two"), (1, "end"), (None, "teapot"), (3, None), (4, "..."), (5, "absent")]
    got = run(spark, docs, items)
    assert got == brute(docs, items)
    assert [r[2] for r in got if r[0] is None] == [6]
    assert run(spark, [], items, parts=1) == [] and run(spark, docs, []) == []


def test_guards_part_terms_that_overlap():
    block = t.block_of([(1, "tea team a")])
    found = Counter(block.terms[n] for _, n in block.automaton().iter(" tea team tea steam a "))
    assert found == {"tea": 2, "team": 1, "a": 1}
