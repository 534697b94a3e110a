import hashlib
import random
import re

import numpy as np

from closewright.llm import pii

# The patterns as the contract gives them.
PLAIN = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain(text):
    out = []
    for k, p in enumerate(PLAIN):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            if k == 1 and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if k == 2 and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((k, *m.span()))
    return out


def test_patterns_against_plain_search():
    random_ = random.Random(3)
    parts = ["a.b", "@", "x-1.com", ".", "1.2.3.4", "256.1.1.1", "001.02.3.4", "+1 (743) 555-3824", "4485275742308327", "4485 2757 4230 8327", "-", " ", "é", "\n", "+", "12", "@@", "j@b.c", "..", "9" * 25, "1.2.3.4.5.6.7.8"]
    for _ in range(3000):
        text = "".join(random_.choice(parts) for _ in range(random_.randint(0, 9)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1" * 100_000):
        pii.base_spans(text)


def test_similar_tokens_get_the_same_label(spark):
    """A number that is a phone number in one place is one elsewhere, where the pattern does not see it; without that place it is not."""
    field = pii.Field(np.zeros((len(pii.FEATURES), 5)), np.zeros((5, 5)), np.eye(5) * 6)
    field.unary[0, 0] = 2.0
    with_base = "call +1 555 743-5553824 now. Later: 743-5553824 again, and 12 apples"
    without = "call nobody now. Later: 743-5553824 again, and 12 apples"
    docs = spark.createDataFrame([(1, with_base), (2, without), (None, None), (3, ""), (1, with_base)], "doc_id long, text string")
    got = [(r.doc_id, r.n_phone, r.spans, r.base_sha256) for r in pii.find_spans(docs, field).collect()]
    base = "phone:5:23"
    extra = f"phone:{with_base.rindex('743-')}:{with_base.rindex('743-') + 11}"
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert with_base[5:23] == "+1 555 743-5553824"
    assert sorted(got, key=str) == sorted([(1, 1, f"{base},{extra}", sha(base))] * 2 + [(2, 0, "", sha("")), (None, 0, "", sha("")), (3, 0, "", sha(""))], key=str)


def test_message_passing_is_exact_on_trees():
    random_ = np.random.default_rng(2)
    field = pii.Field(random_.standard_normal((len(pii.FEATURES), 5)), random_.standard_normal((5, 5)), random_.standard_normal((5, 5)))
    masks, labels, chain, skip = [1, 3, 9, 1 << 4 | 1], [0, 0, 0, 0], [-1, 0, 1, -1], [-1, -1, -1, 0]
    unary = pii.bits(masks) @ field.unary
    total = np.zeros((4, 5))
    for y in np.ndindex(5, 5, 5, 5):
        w = np.exp(sum(unary[n, y[n]] for n in range(4)) + field.chain[y[0], y[1]] + field.chain[y[1], y[2]] + field.skip[y[0], y[3]])
        for n in range(4):
            total[n, y[n]] += w
    found = pii.marginals(field, masks, labels, chain, skip)
    assert np.allclose(found, total / total.sum(axis=1, keepdims=True), atol=0.01)


def test_trained_field_keeps_patterns_and_clean_texts(spark):
    random_ = random.Random(5)
    word = lambda: "".join(random_.choice("abcdefgh") for _ in range(5))
    rows = []
    for n in range(120):
        held = random_.choice([f"{word()}.{n}@mail.example.com", f"{n}.1.2.3", f"+1 (555) 555-{1000 + n}", f"page {n}", f"{n} of {n + 3}", ""])
        rows.append((n, " ".join([word(), word(), held, word(), word()])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    field = pii.train(docs)
    for row in pii.find_spans(docs, field).collect():
        text = rows[row.doc_id][1]
        assert row.spans == pii.written_spans(plain(text)), text
    assert pii.train(docs.limit(0)).unary.any() == False  # noqa: E712


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "mail a.b@c.de or 10.0.0.1", "x", 24, 9), (None, None, None, None, 9), (2, "clean 12 text", "y", 13, 9)], "doc_id long, text string, row string, n_chars long, t int")
    got = pii.redact(docs, pii.train(docs.limit(0)))
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "mail [EMAIL] or [IP]", "x", 20, 9), (None, None, None, None, 9), (2, "clean 12 text", "y", 13, 9)], key=str)
    assert pii.redacted_text("abcdef", [(0, 1, 3), (2, 2, 5)]) == "a[EMAIL]f"


def test_links_of_spaced_numbers_and_short_addresses():
    parts = ["+44 20 7946 0958", "44 20 7946 0958", "4111 1111 1111 1111", "4111 1111 1111 1111", "10.0.0.1", "10.0.0.1", "a@b.org", "a@c.org", "555 123 4567", "5551234567"]
    text = " and then ".join(parts)
    nodes = pii.nodes_of(text, [])
    tokens = [text[a:b] for a, b in nodes.spans]
    assert tokens == " ".join(parts).split()
    assert nodes.skip[4:8] == [0, 1, 2, 3] and nodes.skip[12:16] == [8, 9, 10, 11]
    assert nodes.skip[17] == 16 and nodes.skip[19] == 18 and nodes.skip[23] == 22
    assert nodes.chain == [-1 if k in (0, 4, 8, 12, 16, 17, 18, 19, 20, 23) else k - 1 for k in range(24)]


def phone(r):
    return f"+{r.randint(1, 99)} {r.randint(200, 999)} {r.randint(200, 999)} {r.randint(1000, 9999)}"


def trained(spark, r):
    """A field trained on texts with phones, cards, prices and counts, none of them repeated without its format."""
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    number = lambda: r.choice([f"page {r.randint(1, 900)}", f"{r.randint(1, 99)} of {r.randint(100, 999)}", f"order {r.randint(10**6, 10**9)}", f"{r.randint(2, 99)} {r.randint(100, 999)} {r.randint(1000, 9999)} units", phone(r), "4111 1111 1111 1111", f"a{r.randint(1, 99)}@mail.org"])
    rows = [(n, " ".join(word() if r.random() < 0.7 else number() for _ in range(r.randint(8, 30)))) for n in range(400)]
    return pii.train(spark.createDataFrame(rows, "doc_id long, text string"))


def spans_of(field, text):
    base = pii.base_spans(text)
    nodes = pii.nodes_of(text, base)
    return sorted(base + pii.added_spans(nodes, pii.marginals(field, *pii.graph([nodes])), base), key=lambda s: s[1])


def test_a_trained_field_carries_the_label_to_later_mentions(spark):
    r = random.Random(11)
    field = trained(spark, r)
    text = "call +1 555 123 4567 now, later 555 123 4567 again"
    assert [(pii.KINDS[k], text[a:b]) for k, a, b in spans_of(field, text)] == [("phone", "+1 555 123 4567"), ("phone", "555 123 4567")]
    found = clean = 0
    for _ in range(200):
        told = phone(r)
        later = r.choice([told[1:], told.split(" ", 1)[1], told.split(" ", 1)[1].replace(" ", "-"), told.split(" ", 1)[1].replace(" ", "")])
        text = f"reach me at {told} today. There are {r.randint(2, 99)} pages. I said {later} before."
        found += (text.rindex(later), text.rindex(later) + len(later)) in {(a, b) for _, a, b in spans_of(field, text)}
        other = f"{r.randint(200, 999)} {r.randint(200, 999)} {r.randint(1000, 9999)}"
        text = f"in stock {other} units of {r.randint(2, 99)}, and {other} units again, see page {r.randint(2, 99)}"
        clean += not spans_of(field, text)
    assert found >= 180 and clean == 200


def test_a_number_twice_in_a_row_is_two_spans(spark):
    field = trained(spark, random.Random(12))
    text = "card 4111 1111 1111 1111 4111 1111 1111 1111 twice"
    assert [(pii.KINDS[k], a, b) for k, a, b in spans_of(field, text)] == [("card", 5, 24), ("card", 25, 44)]
