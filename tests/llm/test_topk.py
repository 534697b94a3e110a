import math

import numpy as np

from closewright.llm import topk


def brute(rows, k, every):
    held = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in held:
        if i % every == 0:
            queries[i] = min(queries.get(i, v), v)
    out = set()
    for q, v in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in held if i != q)[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)}
    return out


def run(spark, rows, k=10, every=100):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, ids int, block int, cell int")
    return {tuple(r) for r in topk.exact_top_k(df, k, every).collect()}


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    random = np.random.default_rng(5)
    rows = [(n, [float(np.float32(x)) for x in random.standard_normal(8) * (random.random(8) < 0.5)]) for n in range(150)]
    rows += [(1000 + n, [0.5] * 8) for n in range(40)]  # ties
    assert run(spark, [(*r, 1, 2, 3) for r in rows], every=10) == brute(rows, 10, 10)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (100, [0.0, 0.0]), (1, [1.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, []), (7, [1.0, 2.0, 3.0])]
    assert run(spark, [(*r, 1, 2, 3) for r in rows]) == brute(rows, 10, 100)


def test_repeated_rows_and_empty_tables(spark):
    rows = [(0, [1.0]), (1, [2.0]), (1, [2.0]), (2, [3.0])]
    got = sorted(run(spark, [(*r, 1, 2, 3) for r in rows]))
    assert [(r[1], r[2]) for r in got] == [(1, 2), (2, 1), (3, 1)]
    assert run(spark, []) == set()


def plain_rows(n):
    random = np.random.default_rng(6)
    return [(i, [float(np.float32(x)) for x in random.standard_normal(4).round(1)]) for i in range(n)]


def test_copies_of_queries_do_not_pass_the_driver(spark):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in plain_rows(300)], "vec_id long, embedding array<float>, ids int, block int, cell int")
    found = topk.exact_top_k(df)
    assert len(found.collect()) == 30
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_cells_are_few_and_bounded():
    assert [topk.cells_of(n) for n in (0, 1, 10, 400, 10_000, 1_000_000)] == [1, 1, 5, 200, 256, 15625]


def test_blocks_of_a_cell_are_merged(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 8)
    monkeypatch.setattr(topk, "QUERY_ROWS", 5)
    monkeypatch.setattr(topk, "CELLS", 2)
    rows = plain_rows(250)
    assert run(spark, [(*r, 1, 2, 3) for r in rows], k=4, every=10) == brute(rows, 4, 10)
    parts = [(7, np.array([5, 3]), np.array([2, 9])), (8, np.array([1]), np.array([-(2**63)])), (7, np.array([4, 2]), np.array([9, 1])), (9, np.array([], np.int64), np.array([], np.int64))]
    got = topk.best_of_run(parts, 3)
    assert list(zip(*(c.to_pylist() for c in got.columns))) == [(7, 3, 9), (7, 4, 9), (7, 5, 2), (8, 1, -(2**63))]
