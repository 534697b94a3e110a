from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from closewright.operators import cascade, lookup, scope
from tests.conftest import rows

BATCH = "CORP/SVC.BATCH"
GL = "n long, gl_account string, amount double, user_id string, description string, comment string, bal_account_type string, document_type string, document_no string, voucher_no string"


@pytest.fixture(scope="module")
def sources(frame):
    issuance = frame([("V1", "refund", None), ("V2", None, None), (" V4 ", "jforce", "D9")], "id string, business_use string, transaction_no string")
    usage = frame([("V3", "store_credit", "D1"), ("V1", "apology", "D2"), (None, "cxp", " D3 "), ("V2", "x", None)], "id string, business_use string, transaction_no string")
    return issuance, usage


def ledger(frame, cases):
    base = {"gl": "18412", "amount": 10.0, "user": "USER/01", "desc": None, "note": None, "bal": None, "kind": None, "doc": None, "voucher": None}
    data = []
    for n, case in enumerate(cases):
        c = {**base, **case}
        data.append((n, c["gl"], c["amount"], c["user"], c["desc"], c["note"], c["bal"], c["kind"], c["doc"], c["voucher"]))
    return frame(data, GL)


CASES = [
    ({"user": "corp\\svc.batch ", "amount": -1.0, "desc": "Refund voucher"}, ("Integration", "Issuance", "Refund")),
    ({"user": BATCH, "amount": -1.0, "desc": "x rf_1"}, ("Integration", "Issuance", "Refund")),
    ({"user": BATCH, "amount": -1.0, "desc": "Commercial Gesture"}, ("Integration", "Issuance", "Apology")),
    ({"user": BATCH, "amount": -1.0, "desc": "commercial only"}, ("Integration", "Issuance", None)),
    ({"user": BATCH, "amount": -1.0, "desc": "PYT_PF"}, ("Integration", "Issuance", "JForce")),
    ({"amount": -1.0, "doc": " ng-1", "desc": "refund"}, ("Manual", "Issuance", "Store Credit")),
    ({"amount": -1.0, "doc": "XX-1", "desc": "rfn 5"}, ("Manual", "Issuance", "Refund")),
    ({"amount": -1.0, "desc": "ends with rf "}, ("Manual", "Issuance", None)),
    ({"amount": -1.0, "desc": "rf x"}, ("Manual", "Issuance", "Refund")),
    ({"amount": -1.0, "desc": " rf \n\tx "}, ("Manual", "Issuance", "Refund")),
    ({"amount": -1.0, "desc": "rf \n\t "}, ("Manual", "Issuance", None)),
    ({"amount": -1.0, "desc": "cxp"}, ("Manual", "Issuance", "Apology")),
    ({"amount": -1.0}, ("Manual", "Issuance", None)),
    ({"bal": " bank account"}, ("Manual", "VTC", "Refund")),
    ({"bal": "Bank Account", "amount": -1.0}, ("Manual", "Issuance", None)),
    ({"user": BATCH, "desc": "Voucher Accrual x"}, ("Integration", "Cancellation", "Apology")),
    ({"user": BATCH, "voucher": " V1"}, ("Integration", "Usage", "refund")),
    ({"desc": "EXPR_APLGY"}, ("Manual", "Expired", "Apology")),
    ({"desc": "expr_jforce"}, ("Manual", "Expired", "JForce")),
    ({"desc": "EXPR_STR CRDT"}, ("Manual", "Expired", "Store Credit")),
    ({"desc": "EXPRxSTR"}, ("Manual", "Expired", None)),
    ({"desc": "Manual RND 1"}, ("Manual", "VTC", "Refund")),
    ({"desc": "pyt_1", "note": "gtb payout"}, ("Manual", "VTC", "Refund")),
    ({"desc": "pyt_1"}, ("Manual", None, None)),
    ({"kind": "credit memo"}, ("Manual", "Cancellation", "Store Credit")),
    ({"desc": "ITEMPRICECREDIT", "doc": "D3"}, ("Manual", "Usage", "cxp")),
    ({"desc": "EXPR ITEMPRICECREDIT", "voucher": "V1"}, ("Manual", "Expired", None)),
    ({"gl": "15010", "bal": "Bank Account"}, ("Manual", None, None)),
    ({"gl": " 18412 ", "amount": 0.0, "user": BATCH}, ("Integration", None, None)),
    ({"amount": None, "user": None}, ("Manual", None, None)),
]


def test_cascade(frame, sources):
    out = cascade.classify_ledger(ledger(frame, [c for c, _ in CASES]), *sources, BATCH)
    got = {r["n"]: (r["integration_type"], r["bridge_category"], r["voucher_type"]) for r in out.collect()}
    assert got == {n: want for n, (_, want) in enumerate(CASES)}


def test_cascade_reads_source_headings(frame, sources):
    df = ledger(frame, [c for c, _ in CASES]).withColumnsRenamed({
        "gl_account": "Chart of Accounts No_", "amount": "Amount", "user_id": "User ID", "description": "Document Description", "voucher_no": "[Voucher No_]",
        "document_no": "Document No", "document_type": "Document Type", "bal_account_type": "Bal_ Account Type", "comment": "Comment",
    })
    out = cascade.classify_ledger(df, *sources, BATCH)
    assert {r["n"]: r["bridge_category"] for r in out.collect()} == {n: want[1] for n, (_, want) in enumerate(CASES)}


def test_no_user_column_is_manual(frame, sources):
    out = cascade.classify_ledger(ledger(frame, [{"user": BATCH}]).drop("user_id"), *sources, BATCH)
    assert out.first()["integration_type"] == "Manual"


def test_lookup_priority(frame, sources):
    asked = [("V1", "D1"), ("V2", "D1"), ("V3", None), ("V4", None), (None, "D1"), ("none", "D3"), (None, "D9"), (None, None), ("", " "), ("none", "none")]
    df = frame([(n, v, d) for n, (v, d) in enumerate(asked)], "n int, voucher_no string, document_no string")
    out = lookup.lookup_voucher_type(df, *sources, F.col("voucher_no"), F.col("document_no"), ["n"])
    got = {r["n"]: (r["lookup_stage"], r["lookup_type"]) for r in out.collect()}
    assert got == {
        0: (1, "refund"), 1: (1, None), 2: (2, "store_credit"), 3: (1, "jforce"), 4: (3, "store_credit"), 5: (3, "cxp"), 6: (4, "jforce"),
        7: (None, None), 8: (None, None), 9: (None, None),
    }


def test_lookup_keeps_rows_on_skewed_and_null_keys(frame, sources, spark):
    df = spark.range(20_000).select(
        F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, "V1").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("U"), F.col("id"))).alias("voucher_no"),
        F.lit(None).cast("string").alias("document_no"),
    )
    out = lookup.lookup_voucher_type(df, *sources, F.col("voucher_no"), F.col("document_no"), ["n"])
    assert out.count() == 20_000
    assert out.filter("lookup_stage = 1").count() == df.filter("n % 3 = 0").count()


def test_counts_and_invalid_pairs(frame, sources):
    out = cascade.classify_ledger(ledger(frame, [c for c, _ in CASES]), *sources, BATCH)
    totals = cascade.classification_totals(out).first()
    assert totals["total_rows"] == len(CASES) == totals["categorized_rows"] + totals["uncategorized_rows"]
    counts = cascade.classification_counts(out)
    assert counts.groupBy("dimension").agg(F.sum("rows").alias("n")).select("n").distinct().collect()[0]["n"] == len(CASES)
    # Raw lookup types are not in the validity table; the rule-made ones are.
    assert rows(cascade.invalid_pairs(out), "bridge_category", "voucher_type") == [("Usage", "cxp"), ("Usage", "refund")]


def test_scope_filters(frame):
    df = frame([("refund",), ("marketing",), (None,), ("Jpay store_credit",), ("REFUND",)], "business_use string")
    assert rows(scope.non_marketing(df)) == [("Jpay store_credit",), ("refund",)]
    assert scope.non_marketing(df.withColumnRenamed("business_use", "other")).count() == 5
    assert rows(scope.use_totals(df)) == [(5, 2, 3)]
    assert rows(scope.use_frequencies(df.limit(3)), "business_use", "vouchers", "non_marketing") == [("marketing", 1, False), ("refund", 1, True)]


def test_voucher_scope_parses_dates(frame):
    df = frame([("refund", "2025-01-02"), ("refund", "bad")], "business_use string, Order_Delivery_Date string")
    assert [r[0] is None for r in sorted(scope.voucher_scope(df).select("Order_Delivery_Date").collect(), key=str)] in ([True, False], [False, True])


def test_drilldown_view(frame):
    df = frame([("V1", "Usage", Decimal("5.00"), "NG"), ("V2", "VTC", Decimal("6.00"), "NG")], "voucher_no string, bridge_category string, amount decimal(18,2), country_code string")
    out = scope.drilldown_view(df, "Usage", "NG")
    assert out.columns == ["voucher_id", "category", "amount", "date", "country_code", "business_line", "details"]
    assert rows(out, "voucher_id", "date") == [("V1", None)]
    assert rows(scope.voucher_details(df, frame([("V2",), (None,)], "id string")), "voucher_no") == [("V2",)]
    assert scope.first_voucher_line(df, "V1", ["amount"]).count() == 1


def test_hot_keys_are_split(spark, frame, tmp_path):
    """Half of all rows on one key: adaptive execution splits the join of the voucher lookup, though its other side is an aggregate."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for k, v in zip(kept, ("64k", "128k", "-1", "16")):
        spark.conf.set(k, v)
    try:
        rows_ = spark.range(200_000).select(F.col("id").alias("n"), F.when(F.col("id") % 2 == 0, "V1").otherwise(F.concat(F.lit("V"), F.col("id"))).alias("voucher_no"), F.lit(None).cast("string").alias("document_no"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        issuance = spark.range(20_000).select(F.concat(F.lit("V"), F.col("id")).alias("id"), F.lit("refund").alias("business_use"), F.lit(None).cast("string").alias("transaction_no"))
        found = lookup.lookup_voucher_type(rows_, issuance, issuance, F.col("voucher_no"), F.col("document_no"), ["n"])
        found.write.format("noop").mode("overwrite").save()
        done = found.select("n", "lookup_type", "pad")
        done.collect()
        assert "skew=true" in done._jdf.queryExecution().executedPlan().toString()
        assert done.filter("lookup_type = 'refund'").count() == 100_000 + 10_000 - 0
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
