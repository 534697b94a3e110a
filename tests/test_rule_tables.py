"""Thresholds and bridge rules as tables against their compiled forms."""

import random

import pytest
from pyspark.sql import functions as F

from closewright.operators import bridge_rules as br, threshold_table as tt, thresholds as th
from tests.conftest import rows

SCOPES = (["18412", "13003", "15010"], ["Usage", "Issuance", "VTC"], ["refund", "apology", "jforce"])


def random_contracts(r, n_rules, n_countries):
    contracts = []
    for country in [th.DEFAULT, *[f"C{k}" for k in range(n_countries)]]:
        made = []
        for k in range(max(1, n_rules // (n_countries + 1))):
            scope = [tuple(r.sample(s, r.randint(1, 2))) if r.random() < 0.4 else () for s in SCOPES]
            made.append(th.ThresholdRule(r.choice([th.BUCKET, th.LINE_ITEM]), float(r.randint(1, 10**6)), f"{country} rule {k}", *scope))
        contracts.append(th.ThresholdContract(country, 1, "2025-01-01", "random", tuple(made)))
    return contracts


def random_buckets(r, frame, n, n_countries):
    pick = lambda s: r.choice([*s, None, "", "other"])
    held = [(k, r.choice([*[f"C{c}" for c in range(n_countries)], None, "XX", th.DEFAULT]), pick(SCOPES[0]), pick(SCOPES[1]), pick(SCOPES[2])) for k in range(n)]
    return held, frame(held, "k int, country_code string, gl_account string, category string, voucher_type string")


@pytest.mark.parametrize("seed", [1, 2])
def test_thresholds_equal_the_compiled_case(spark, frame, seed):
    r = random.Random(seed)
    contracts = random_contracts(r, 250, 4)
    _, df = random_buckets(r, frame, 400, 4)
    for kind in (th.BUCKET, th.COUNTRY):
        case = df.withColumn("threshold", th.resolve_threshold(kind, F.col("country_code"), F.col("gl_account"), F.col("category"), F.col("voucher_type"), contracts))
        assert rows(tt.resolved(df, tt.rule_table(spark, contracts), kind)) == rows(case)


def test_ten_thousand_rules(spark, frame):
    r = random.Random(3)
    contracts = random_contracts(r, 10_000, 30)
    held, df = random_buckets(r, frame, 500, 30)
    got = {x.k: (x.threshold.value_usd, x.threshold.specificity) for x in tt.resolved(df, tt.rule_table(spark, contracts)).collect()}
    # A bucket of the country DEFAULT has the default tier only, as the compiled form has.
    for k, country, *values in held:
        value, _, specificity, _ = tt.first_match(contracts, th.BUCKET, country, values)
        assert got[k] == (value, specificity)


def test_plan_does_not_depend_on_the_rules(spark, frame):
    import re

    r = random.Random(4)
    _, df = random_buckets(r, frame, 20, 4)
    plans = []
    for n in (10, 2000):
        plan = tt.resolved(df, tt.rule_table(spark, random_contracts(r, n, 4)))._jdf.queryExecution().optimizedPlan().toString()
        plans.append([re.sub(r"[^A-Za-z]", "", line.split("(")[0].split("[")[0])[:12] for line in plan.splitlines()])
    assert plans[0] == plans[1] and not any("Cartesian" in p for p in plans[1])


def test_versions_by_date(spark, frame):
    rule = lambda v: (th.ThresholdRule(th.BUCKET, v, f"at {v}"),)
    contracts = [th.ThresholdContract("C1", 1, "2024-01-01", "", rule(1.0)), th.ThresholdContract("C1", 2, "2025-01-01", "", rule(2.0)), th.ThresholdContract("C1", 3, "2026-01-01", "", rule(3.0))]
    table = tt.rule_table(spark, contracts)
    df = frame([("C1", "a", "b")], "country_code string, category string, voucher_type string")
    value = lambda **k: tt.resolved(df, tt.rules_in_force(table, **k), gl_account="1").first().threshold.value_usd
    assert [value(), value(as_of="2025-06-30"), value(as_of="2024-12-31"), value(version=1), value(as_of="2020-01-01")] == [3.0, 2.0, 1.0, 1.0, 1000.0]
    empty = spark.createDataFrame([], tt.SCHEMA)
    assert tt.resolved(df, empty, gl_account="1").first().threshold.source == "fallback"


def random_rules(r, n):
    made = []
    for k in range(n):
        columns = r.sample(["Kind", "source", "IS_X", "absent"], r.randint(0, 3) if r.random() < 0.9 else 1)
        made.append(br.BridgeRule(f"R{k}", f"Rule {k}", {c: tuple(r.sample(["a", "A", "b", "c", "1", "yes"], r.randint(1, 3))) for c in columns} if k % 17 or not k else {"absent": ("a",)}, ("1",), ("2",), rank=r.randint(1, 3)))
    return [x for x in made if x.triggers or r.random() < 0.05]


@pytest.mark.parametrize("seed,n", [(1, 11), (2, 60), (3, 3)])
def test_bridge_rules_equal_the_compiled_case(spark, frame, seed, n):
    r = random.Random(seed)
    rules = random_rules(r, n)
    held = [(k, r.choice(["a", "B", "c", None, "", "z"]), r.choice(["A", "b", None]), r.choice([1.0, 0.0, None])) for k in range(200)]
    df = frame(held, "k int, kind string, Source string, is_x double")
    got = br.classify_by_table(df, br.rule_table(spark, rules), ["kind", "source", "is_x", "absent"])
    assert rows(got) == rows(br.classify_bridges(df, rules))


def test_shipped_rules_as_a_table(spark, frame):
    df = frame([("Payment", None, None, None), ("refund", 0.0, None, None), (None, 1.0, "sc", "account statement"), (None, None, "MPL", "ACCOUNT STATEMENT"), ("x", None, None, None)], "transaction_type string, IS_PREPAYMENT double, source string, entity string")
    got = br.classify_by_table(df, br.rule_table(spark), ["transaction_type", "is_prepayment", "source", "entity"])
    assert rows(got) == rows(br.classify_bridges(df))
    assert rows(br.classify_by_table(df.select("source"), br.rule_table(spark), ["source"])) == rows(br.classify_bridges(df.select("source")))
