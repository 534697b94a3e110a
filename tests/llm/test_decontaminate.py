import random
import tracemalloc

import numpy as np
import pyarrow as pa

from closewright.llm import decontaminate as d

ITEMS = [
    (1, "A train leaves Boston at 40 miles per hour and meets another train that left Denver at 60 miles per hour. How long until they meet again near Boston?"),
    (2, "If Alice has 12 apples and gives Bob 5 apples, how many apples does Alice still keep in her own basket at home?"),
    (3, "short item"), (4, None), (5, ""),
    (6, "seven plain words make this one item"),
]


def found(spark, docs, items=ITEMS):
    got = d.leaks(spark.createDataFrame([(*x, 1, 2) for x in docs], "doc_id long, text string, item_id int, place int"), spark.createDataFrame([(*i, 5) for i in items], "item_id long, text string, doc_id int"))
    return {(r.doc_id, r.item_id): r for r in got.collect()}


def filler(n, seed):
    random_ = random.Random(seed)
    return " ".join("".join(random_.choice("abcdefghij") for _ in range(random_.randint(3, 9))) for _ in range(n))


def test_exact_and_changed_questions(spark):
    train, apples = ITEMS[0][1], ITEMS[1][1]
    changed = train.replace("40", "1,250.5").replace("60", "75").replace("Boston", "Lyon").replace("Denver", "Oslo").replace("miles", "km")
    muddled = train.replace("Boston", "Lyon", 1).replace("40 miles", "40 km")  # one name and one unit in two ways
    docs = [(1, filler(300, 1) + ". " + train + " " + filler(50, 2)), (2, filler(20, 3) + ". " + changed), (3, filler(40, 4) + ". " + apples.replace("12", "99").replace("Bob", "Carol")),
            (4, filler(400, 5)), (5, None), (6, ""), (7, muddled), (8, apples[:40]), (9, "Seven plain words, make THIS one item!"), (10, ITEMS[0][1].upper()), (1, filler(300, 1) + ". " + train + " " + filler(50, 2))]
    got = found(spark, docs)
    assert set(got) >= {(1, 1), (2, 1), (3, 2), (9, 6)}
    assert not {k[0] for k in got} & {4, 5, 6, 8}
    assert (7, 1) not in got
    assert got[1, 1].n_reparameterised == 0 and got[2, 1].n_reparameterised >= 4 and got[3, 2].n_reparameterised == 2
    assert all(r.share >= d.LEAST_SHARE for r in got.values())


def test_filter_of_documents(spark):
    docs = spark.createDataFrame([(1, ITEMS[0][1], "en"), (None, ITEMS[1][1], "en"), (None, "clean text of no item", "de"), (2, None, None), (1, "another text", "x")], "doc_id long, text string, lang string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = d.without_leaks(docs, d.leaks(docs, items))
    assert kept.columns == docs.columns
    assert {(r.doc_id, r.text) for r in kept.collect()} == {(None, "clean text of no item"), (2, None), (1, "another text")}


def test_empty_tables(spark):
    assert found(spark, [], ITEMS) == {} and found(spark, [(1, ITEMS[0][1])], []) == {}
    assert found(spark, [(1, ITEMS[0][1])], [(1, None)]) == {}


def slow_windows(text):
    """Windows of an ASCII text by the plain reading of the rules."""
    import re

    words, ends = [], True
    at = 0
    for m in re.finditer(r"[0-9A-Za-z]+(?:(?<=[0-9])[.,][0-9][0-9A-Za-z]*)*", text):
        ends = ends or bool(set(text[at : m.start()]) & set(".!?\n:;|"))
        raw, at = m.group(), m.end()
        low = raw.lower()
        slot = "#" if raw[0].isdigit() else "u" if low in d.UNITS else "N" if raw[0].isupper() and not ends and not raw.isupper() else ""
        words.append(slot or low)
        ends = False
    return [tuple(words[k : k + 8]) for k in range(len(words) - 7) if sum(w not in ("#", "u", "N") for w in words[k : k + 8]) >= 4]


def test_windows_agree_with_plain_rules():
    random_ = random.Random(6)
    parts = ["apples", "Bob", "12", "3.5", "1,000", "km", "The", "is", "NASA", "x9", ". ", "! ", "\n", " and", "minutes", "red", "blue", "seven", "Oslo", "we"]
    texts = [" ".join(random_.choice(parts) for _ in range(random_.randint(0, 60))) for _ in range(60)]
    joined = "".join(texts).encode()
    offsets = np.append(0, np.cumsum([len(t.encode()) for t in texts]))
    owner, shown, _, slot = d.templates(np.frombuffer(joined, np.uint8), offsets)
    at, h = d.windows(shown, slot, owner, 8)
    by_hash = {}
    expected = [(n, w) for n, t in enumerate(texts) for w in slow_windows(t)]
    assert [n for n, _ in expected] == owner[at].tolist()
    for (_, w), x in zip(expected, h.tolist(), strict=True):
        assert by_hash.setdefault(w, x) == x
    assert len(set(by_hash.values())) == len(by_hash)


NAMED = "yesterday morning the old baker Alice carried twelve warm loaves over to the market and sold nearly all of them before noon without resting once"
OPENED = "Alice sells fresh eggs beside the old bridge every morning before school. Bob buys seven of them for his hungry cousins at home."


def test_stretches_with_words_put_in_or_left_out(spark):
    items = [(1, NAMED), (2, OPENED)]
    words = NAMED.split()
    docs = [(1, filler(30, 1) + " " + NAMED.replace("Alice", "Mary Ann") + " " + filler(30, 2)), (2, " ".join([*words[:12], "really", *words[12:]])), (3, " ".join(words[:12] + words[13:])),
            (4, OPENED.replace("Alice", "Carol").replace("Bob", "Dora Lee")), (5, "Once " + OPENED.replace("Alice", "Eve")), (6, " ".join(words[:10]) + " " + filler(400, 3) + " " + " ".join(words[14:])),
            (7, NAMED + " " + NAMED.replace("Alice", "Zoe"))]
    got = found(spark, docs, items)
    assert set(got) == {(1, 1), (2, 1), (3, 1), (4, 2), (5, 2), (7, 1)}
    assert got[1, 1].n_reparameterised == 1 and got[1, 1].share == 1 and got[4, 2].n_reparameterised == 2


SHARED = "if Alice has 12 apples and gives Bob 5 apples then how many of the apples does she still keep in her basket at home for Bob"


def test_fillers_that_coincide_and_single_slips(spark):
    long = "the town of Springfield keeps 40 horses and its people feed them at dawn before they walk down to the wide river near Springfield where the boats wait for grain and salt and wool from the far hills"
    docs = [(1, SHARED.replace("12", "7").replace("5", "7")), (2, SHARED.replace("Alice", "Eve").replace("Bob", "Eve")), (3, long.replace("near Springfield", "near Shelbyville")), (4, SHARED.replace("gives Bob", "gives Tom", 1))]
    got = found(spark, docs, [(1, SHARED), (2, long)])
    assert set(got) >= {(1, 1), (2, 1), (3, 2)}
    assert got[1, 1].n_reparameterised == 2 and got[1, 1].share == 1 and got[3, 2].share < 1


def test_items_without_literal_windows_and_unspaced_scripts(spark):
    chinese, thai = "小明有十二个苹果，他给了小红五个，请问小明还剩下几个苹果？", "แดงมีส้มสิบสองผลและให้ดำห้าผล"
    items = [(1, "short item"), (2, "What is 12 + 15?"), (3, "Marie Curie, Pierre Curie, 1903"), (4, chinese), (5, thai), (6, "?!"), (7, "été – hiver")]
    docs = [(1, filler(30, 1) + " Short  ITEM. " + filler(9, 2)), (2, "Tell me, what is 12 + 15? Thanks."), (3, "They were Marie Curie, Pierre Curie, 1903."), (4, "问题：" + chinese.replace("苹果", "梨子", 1) + "谢谢"), (5, "คำถาม" + thai),
            (6, "what is 12 and then 15, a shorter item?"), (7, "Été hiver"), (8, "?!")]
    assert set(found(spark, docs, items)) == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (7, 7)}


def test_words_of_unicode():
    text = "a–b “日本c” ดี5 x y café"
    data = np.frombuffer(text.encode(), np.uint8)
    first, last, *_ = d.words_of(data, np.array([0, len(data)]))
    assert [data[a:b].tobytes().decode() for a, b in zip(first, last, strict=True)] == ["a", "b", "日", "本", "c", "ดี", "5", "x", "y", "café"]


def test_short_exact_items_can_be_told_apart(spark):
    docs = spark.createDataFrame([(1, "the bird sings"), (2, "What is 12 + 15?")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "the"), (2, "What is 12 + 15?"), (None, "bird sings")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.exact_words for r in d.leaks(docs, items).collect()}
    assert got == {(1, 1): 1, (1, None): 2, (2, 2): 4}


def test_a_batch_of_texts_takes_bounded_memory(spark):
    class Rows:
        """Stands for a frame and gives the function that its tasks would run."""

        schema = spark.range(1).schema

        def select(self, *_):
            return self

        def mapInArrow(self, find, _):
            return find

    find = d.window_rows(Rows(), ["id"], "text", [d.WINDOW], bytes(1 << (d.FILTER_BITS - 3)))
    texts = [f"Some words of text number {k} stand here in a row. " * 20 for k in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array(texts)], names=["id", "__text"])
    tracemalloc.start()
    assert list(find(iter([batch]))) == []
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(map(len, texts)) > 4e6 and peak < 50e6
