"""What changed, distinct counts in one pass, and sums kept up to date."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from closewright.checks.queries import QUERIES
from closewright.operators import changes as ch, distinct as di, fx, pivots, thresholds as th, upkeep as up
from tests.conftest import rows


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def table(frame, held):
    return frame([(k, v, t) for (k, v), t in held], "k int, v int, t string")


@pytest.mark.parametrize("width", [None, 50])
def test_changed_added_and_lost_rows_are_named(spark, frame, tmp_path, width):
    old = [((k, k % 7), "x") for k in range(3000)] + [((5, 1), "again"), ((5, 1), "again")]
    new = [r for r in old if r[0][0] != 17]  # lost
    new = [((k, 99), t) if k == 1234 else ((k, v), t) for (k, v), t in new]  # changed
    new += [((70000, 1), "new"), ((5, 1), "again")]  # added, and an equal row more
    paths = []
    for name, held in (("old", old), ("new", new)):
        paths.append(str(tmp_path / name))
        ch.write_by_range(table(frame, held), paths[-1], ["k"], width)
    a, b = (ch.read_by_range(spark, p) for p in paths)
    trees = [ch.digest_tree(df, ["k"], width).cache() for df in (a, b)]
    found = ch.changed_rows(a, b, *trees, ["k"], width)
    assert rows(found, "k", "change") == [(1234, "changed"), (17, "lost"), (5, "changed"), (70000, "added")]
    at = {r.k: r.range for r in table(frame, old + new).select("k", ch.range_of(table(frame, old), ["k"], width).alias("range")).collect()}
    assert {(r.k, r.range) for r in found.collect()} == {(k, at[k]) for k in (1234, 17, 5, 70000)}
    assert set(ch.differing_ranges(*trees)) == {at[k] for k in (1234, 17, 5, 70000)}
    assert "digest_range" in plan_of(found).split("PartitionFilters: [")[1].split("]")[0]
    # Order and partitioning do not count, and a tree made before writing is that of the table.
    assert rows(ch.digest_tree(table(frame, old[::-1]).repartition(5), ["k"], width)) == rows(trees[0])
    assert ch.differing_ranges(trees[0], trees[0]) == [] and ch.changed_rows(a, a, trees[0], trees[0], ["k"], width).count() == 0


def test_empty_and_null_keys(spark, frame):
    empty, some = table(frame, []), table(frame, [((None, 1), "x"), ((1, 1), None)])
    trees = [ch.digest_tree(df, ["k"]) for df in (empty, some)]
    assert rows(ch.changed_rows(empty, some, *trees, ["k"]), "k", "change") == [(None, "added"), (1, "added")]
    assert rows(ch.changed_rows(some, empty, *trees[::-1], ["k"]), "k", "change") == [(None, "lost"), (1, "lost")]


def test_trees_are_made_once(frame, monkeypatch):
    trees = [ch.digest_tree(table(frame, [((k, v), "x") for k in range(40)]), ["k"]) for v in (1, 2)]
    kind, asked = type(trees[0]), []
    monkeypatch.setattr(kind, "collect", lambda self, collect=kind.collect: asked.append(self) or collect(self))
    found = ch.differing_ranges(*trees)
    assert len(asked) == 1 and len(found) == len(set(found)) > 1


@pytest.mark.parametrize("stored", [(), ("old",), ("old", "new")])
def test_rows_of_a_key_are_compared_by_number(spark, frame, tmp_path, stored):
    old = [((1, 1), "a"), ((1, 1), "a"), ((1, 2), "a"), ((2, 1), "b"), ((2, 2), "b"), ((3, 1), None), ((4, 1), "x"), ((None, 1), "n"), ((None, 2), "n"), ((5, 5), "f"), ((5, 5), "f")]
    # 1: as many, but others; 2: in another order; 3: a row more, 5: one less; 4 goes, 6 comes; null: a value changed.
    new = [((1, 1), "a"), ((1, 2), "a"), ((1, 2), "a"), ((2, 2), "b"), ((2, 1), "b"), ((3, 1), None), ((3, 2), None), ((6, 1), "x"), ((None, 1), "n"), ((None, 3), "n"), ((5, 5), "f")]
    frames = []
    for name, held in (("old", old), ("new", new)):
        frames.append(table(frame, held))
        if name in stored:
            ch.write_by_range(frames[-1], str(tmp_path / name), ["k"])
            frames[-1] = ch.read_by_range(spark, str(tmp_path / name))
    trees = [ch.digest_tree(df, ["k"]) for df in frames]
    found = ch.changed_rows(*frames, *trees, ["k"])
    assert rows(found, "k", "change") == [(None, "changed"), (1, "changed"), (3, "changed"), (4, "lost"), (5, "changed"), (6, "added")]
    assert rows(found, "k", "range") == rows(found, "k", ch.range_of(found, ["k"]))
    pairs = ch.changed_rows(*frames, *(ch.digest_tree(df, ["t", "k"]) for df in frames), ["t", "k"]) if not stored else None
    assert not pairs or (pairs.columns, rows(pairs, "k", "t")) == (["t", "k", "range", "change"], [(None, "n"), (1, "a"), (3, None), (4, "x"), (5, "f"), (6, "x")])


def test_a_changed_row_is_not_moved_by_a_join(spark, frame):
    entries = frame(
        [(1000, "a", 1), (1000, "a", 1), (996, "b", 2), (996, "b", None), (990, "c", 3), (9, "d", None), (9, "d", None), (None, "e", 4), (8, None, 5)], "entry_no long, document_no string, n int"
    ).selectExpr("entry_no", "document_no", "cast(n as decimal(18,2)) as amount", "'more' as more")
    moved = entries.join(frame([("more", 1)], "more string, one int").hint("merge"), "more")
    found = QUERIES["changed_ledger_rows"]({"gl_entries": moved})
    assert rows(found) == [(None, "added"), (-990, "lost"), (1000, "added"), (996, "changed")]
    plan = plan_of(found)
    assert "Join" not in plan and plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 2


def test_distinct_counts_in_one_pass(spark, frame):
    r = random.Random(1)
    held = [(r.choice("ab"), r.choice(["x", "y", None, f"v{r.randint(0, 300)}"]), r.randint(0, 70000), None if r.random() < 0.2 else Decimal(r.randint(0, 9))) for _ in range(4000)]
    df = frame(held, "g string, s string, n int, d decimal(18,2)").repartition(4)
    made = {c: di.numbers_of(df, c) for c in ("s", "d")}
    for c in made:
        assert sorted(x.number for x in made[c].collect()) == list(range(df.select(c).distinct().filter(f"{c} is not null").count()))
    got = di.distinct_counts(df, ["s", "n", "d"], made)
    assert tuple(got.first()) == tuple(df.agg(F.count_distinct("s"), F.count_distinct("n"), F.count_distinct("d")).first())
    assert "Expand" not in plan_of(got)
    assert rows(di.distinct_counts(df, ["s", "n", "d"], made, ["g"])) == rows(df.groupBy("g").agg(F.count_distinct("s"), F.count_distinct("n"), F.count_distinct("d")))
    from closewright.operators.audit import table_probe

    made["n"] = di.numbers_of(df, "n")
    probe = table_probe(df, "t", "d", None, ["s", "n", "d"], made)
    assert "Expand" not in plan_of(probe)
    plain = table_probe(df, "t", "d", None, ["s", "n", "d"])
    assert rows(probe, *sorted(plain.columns)) == rows(plain, *sorted(plain.columns))
    del made["n"]
    # Bitmaps of parts merge to those of the whole.
    told = di.numbered(df, made)
    parts = di.bitmaps(told.filter("n % 2 = 0"), ["s_number", "n"]).union(di.bitmaps(told.filter("n % 2 = 1"), ["s_number", "n"]))
    assert tuple(di.counts_of(di.merged(parts), ["s", "n"]).first()) == tuple(got.first())[:2]
    assert tuple(di.distinct_counts(df.limit(0), ["s"]).first()) == (0,)


def lines(frame, held):
    return frame(held, "country_code string, category string, voucher_type string, amount_local decimal(18,2)")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_changes_equal_the_full_run(spark, frame, seed):
    r = random.Random(seed)
    line = lambda: (r.choice(["EG", "NG", "GH", None]), r.choice(["Usage", "VTC", None]), r.choice(["refund", "apology", None]), r.choice([None, Decimal(r.randint(-10**6, 10**6)) / 100]))
    nav, tv = [line() for _ in range(60)], [line() for _ in range(40)]
    gone = {"nav": r.sample(range(len(nav)), 12), "tv": r.sample(range(len(tv)), 5)}
    late = {"nav": [line() for _ in range(10)] + [("KE", "Usage", "refund", Decimal("5000.00"))], "tv": [line() for _ in range(4)]}
    rates = fx.rate_table(frame([("JM_EG", 30.0), ("EC_NG", 1500.0), ("JD_GH", None)], "company_code string, fx_rate double"))
    judged = lambda a, b: up.judged(up.sums_of(lines(frame, a)), up.sums_of(lines(frame, b)), rates, "18412", th.CONTRACTS)
    before = judged(nav, tv)
    changes = {k: up.changes_of(lines(frame, late[k]), lines(frame, [held[n] for n in gone[k]])) for k, held in (("nav", nav), ("tv", tv))}
    after, new_nav, new_tv, touched = up.updated(before, up.sums_of(lines(frame, nav)), up.sums_of(lines(frame, tv)), changes["nav"], changes["tv"], rates, "18412", th.CONTRACTS)
    now = {k: [x for n, x in enumerate(held) if n not in gone[k]] + late[k] for k, held in (("nav", nav), ("tv", tv))}
    assert rows(new_nav) == rows(up.sums_of(lines(frame, now["nav"]))) and rows(new_tv) == rows(up.sums_of(lines(frame, now["tv"])))
    assert rows(after) == rows(judged(now["nav"], now["tv"]))
    assert 0 < touched.count() <= 30
    # The stored sums are the pivots.
    assert rows(new_nav, *pivots.GRAIN, "amount") == rows(pivots.nav_pivot(lines(frame, now["nav"])))


def test_review_rows_of_touched_buckets_are_replaced(frame):
    review = frame([("EG", None, "r", 1), ("EG", None, "r", 2), ("NG", "U", "r", 3)], "country_code string, category string, voucher_type string, n int")
    touched = review.filter("country_code = 'EG'").select(*pivots.GRAIN).distinct()
    again = frame([("EG", None, "r", 9)], "country_code string, category string, voucher_type string, n int")
    assert rows(up.review_again(review, touched, again), "n") == [(3,), (9,)]
