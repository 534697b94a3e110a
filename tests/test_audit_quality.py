import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from closewright.operators import audit, evidence, quality as q
from tests.conftest import rows


def test_merge_audits(frame):
    left = frame([(1,), (1,), (2,), (None,), (None,)], "k int")
    right = frame([(1,), (2,), (2,), (3,), (None,)], "k int")
    got = audit.merge_audit(left, right, ["k"]).first()
    assert (got["left_total_rows"], got["left_duplicates"], got["left_unique_dup_keys"], got["right_duplicates"], got["right_unique_dup_keys"], got["explosion_risk"]) == (5, 4, 2, 2, 1, True)
    assert rows(audit.duplicated_rows(left, ["k"])) == [(None,), (None,), (1,), (1,)]
    over = audit.merge_key_overlap(left, right, ["k"]).first()
    assert (over["left_unique_keys"], over["right_unique_keys"], over["matching_keys"], over["left_only_keys"], over["right_only_keys"]) == (3, 4, 3, 0, 1)
    assert (over["left_null_keys"], over["right_null_keys"], over["left_duplicate_keys"], over["joined_rows"]) == (2, 1, 2, 2 + 2)
    assert (over["left_match_rate"], over["right_match_rate"]) == (100.0, 75.0)
    assert over["joined_rows"] == left.join(right, "k").count()
    assert rows(audit.key_sets(left, right, ["k"])) == [(None, "both"), (1, "both"), (2, "both"), (3, "right_only")]
    with pytest.raises(ValueError):
        audit.merge_audit(left, right, ["x"])


def test_overlap_of_empty_side(frame):
    got = audit.merge_key_overlap(frame([], "k int"), frame([(1,)], "k int"), ["k"]).first()
    assert (got["left_rows"], got["left_match_rate"], got["right_match_rate"]) == (0, None, 0.0)


def test_probes(frame):
    df = frame([(1, "a", 2.0, datetime(2025, 1, 2)), (1, "a", 2.0, datetime(2025, 1, 2)), (2, None, None, None)], "k int, s string, x double, d timestamp_ntz")
    got = audit.table_probe(df, "t", "x", "d", ["k", "s", "absent"]).first()
    assert (got["rows"], got["cols"], got["nulls_total"], got["duplicated_rows"], got["amount_sum"]) == (3, 4, 3, 1, 4.0)
    assert (got["min_date"], got["max_date"], got["unique_k"], got["unique_s"]) == ("2025-01-02", "2025-01-02", 2, 1)
    metrics = {r["metric"]: r["value"] for r in audit.probe_metrics(df, "c", ["x", "s", "absent"]).collect()}
    assert metrics == {"row_count": 3.0, "column_count": 4.0, "x_non_null_count": 2.0, "x_sum": 4.0, "x_mean": 2.0, "s_non_null_count": 2.0, "s_unique_count": 1.0}


@pytest.mark.parametrize("kind", ["uniform", "hot", "few", "single"])
def test_exact_quantiles(spark, kind):
    rng = random.Random(5)
    values = {
        "uniform": [rng.random() for _ in range(4001)], "hot": [1.0] * 3000 + [rng.gauss(1, 3) for _ in range(1500)], "few": [3.0, 1.0, 2.0, 10.0], "single": [4.0],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    df = df.withColumns({"y": -df.x, "none": F.lit(None).cast("double")})
    got = {r["column"]: r for r in audit.exact_quantiles(df, ["x", "y", "none"]).collect()}
    for c, sign in (("x", 1), ("y", -1)):
        assert [got[c][k] for k in ("p25", "p50", "p75")] == pytest.approx(list(np.percentile([sign * v for v in values], [25, 50, 75])))
    assert got["none"]["p50"] is None


def test_describe_of_no_values(spark):
    got = audit.describe_numeric(spark.createDataFrame([(None,)], "x double"), ["x"]).first()
    assert got["count"] == 0 and got["p50"] is None


def test_quality_rules(frame):
    df = frame([(1, 5.0, "2025-01-01", "1"), (2, -5.0, "2025-02-01", "x"), (None, 0.0, None, "3")], "k int, x double, d string, s string")
    rules = [
        q.RowCountCheck(3), q.RowCountCheck(0, 2), q.NumericSumCheck("x", True), q.NumericSumCheck("x", False), q.NumericSumCheck("s", True), q.NoNullsCheck("k"),
        q.DTypeCheck("k", "int64"), q.DTypeCheck("d", "datetime64[ns]"), q.DateRangeCheck("d", "2025-01-01", "2025-02-01"), q.DateRangeCheck("d", "2025-01-02"),
        q.SemanticValidityCheck("s", "amount"), q.SemanticValidityCheck("k", "id"), q.SemanticValidityCheck("d", "other"), q.ColumnExistsCheck("x"), q.NoNullsCheck("absent"),
    ]
    report = q.run_quality(df, rules, "t")
    passed = [r["passed"] for r in sorted(report.collect(), key=lambda r: r["rule_no"])]
    assert passed == [True, False, True, False, False, False, True, False, True, False, False, False, True, True, False]
    assert rows(q.quality_status(report)) == [("t", "FAIL", 15, 9)]


def test_nan_counts_as_missing(frame):
    df = frame([(1.0,), (float("nan"),), (None,)], "x double")
    report = q.run_quality(df, [q.NumericSumCheck("x", False), q.NoNullsCheck("x")])
    assert rows(report, "detail") == [("2 nulls of 3 rows",), ("sum 1.0",)]
    assert audit.table_probe(df, "t", "x").first()["nulls_total"] == 2 and audit.table_probe(df, "t", "x").first()["amount_sum"] == 1.0
    assert audit.describe_numeric(df, ["x"]).first()["count"] == 1


def test_quality_is_one_pass(frame):
    df = frame([(1, 5.0)], "k int, x double")
    plan = q.run_quality(df, [q.RowCountCheck(1), q.NoNullsCheck("k"), q.NumericSumCheck("x", False)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_custom_rule_joins_the_pass(frame):
    class NoNegative(q.QualityRule):
        column = "x"

        def plan(self, df):
            return q.Outcome({"neg": F.count_if(F.col("x") < 0)}, lambda get: get("neg") == 0, lambda get: get("neg").cast("string"))

    assert rows(q.run_quality(frame([(-1.0,)], "x double"), [NoNegative()]), "rule", "passed", "detail") == [("NoNegative", False, "1")]


def test_keys_and_controls(frame):
    df = frame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "k int, v string")
    assert rows(q.primary_key_violations(df, ["k"])) == [(None, 1), (1, 2)]
    got = q.control_totals(df, df, df.filter("k = 2"), df.filter("k = 99"), ["k"])
    assert rows(got) == [("completeness", 4, 4, "PASS"), ("exclusion", 0, 0, "PASS"), ("witness", 1, 1, "PASS")]
    failed = q.control_totals(df, df.limit(1), df.filter("k = 99"), df.filter("k = 1"), ["k"])
    assert {r["status"] for r in failed.collect()} == {"FAIL"}


def test_usage_validation(frame):
    df = frame([("V1", "1,0"), ("V1", "-5"), (None, None), ("V2", "n/a")], "`Voucher Id` string, `Amount Used` string")
    got = q.usage_validation(df).first()
    assert (got["row_count"], got["unique_vouchers"], got["null_voucher_ids"], got["null_amounts"], got["unreadable_amounts"], got["duplicate_vouchers"], got["negative_amounts"]) == (4, 2, 1, 1, 1, 2, 1)
    assert not q.usage_validation(df.drop("Amount Used")).first()["valid"]


def test_fingerprint(spark):
    df = spark.range(500).select("id", (F.col("id") % 7).cast("string").alias("s"), F.when(F.col("id") % 3 == 0, F.col("id") * 1.5).alias("x"))
    first = evidence.fingerprint(df, "d").first()
    assert evidence.fingerprint(df.repartition(13, "s").select("x", "id", "s"), "d").first() == first
    assert evidence.fingerprint(df.union(df.limit(1)), "d").first()["fingerprint"] != first["fingerprint"]
    assert evidence.fingerprint(df.withColumn("x", F.coalesce("x", F.lit(0.0))), "d").first()["fingerprint"] != first["fingerprint"]
    recorded = evidence.run_record(df, "d", "select 1", {"b": 2, "a": 1}, "PASS", datetime(2025, 10, 1))
    assert recorded.first()["params"] == "a=1,b=2"
    assert evidence.verify_fingerprint(df, recorded, "d").first()["verified"]
    assert not evidence.verify_fingerprint(df.limit(3), recorded, "d").first()["verified"]
    assert not evidence.verify_fingerprint(df, recorded, "unknown").first()["verified"]
