from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from closewright.operators import fx, pivots, thresholds as th, totals, variance as var
from tests.conftest import rows

KEYS = "country_code string, category string, voucher_type string"
D = Decimal


@pytest.fixture(scope="module")
def rates(frame):
    return fx.rate_table(frame([("EC_NG", 1650.0), ("JM_EG", 48.9), ("JD_GH", 0.0), ("EC_KE", None), ("EC_ZZ", float("nan"))], "Company_Code string, FX_rate double"))


def test_rate_table_ignores_unusable_and_duplicates(frame, rates):
    assert rows(rates) == [("EC_NG", 1650.0), ("JM_EG", 48.9)]
    twice = frame([("A", 2.0, 1), ("A", 3.0, 2), ("A", None, 3), ("B", 1.0, 1)], "company_code string, fx_rate double, month int")
    assert rows(fx.rate_table(twice, "month")) == [("A", 3.0), ("B", 1.0)]
    assert rows(fx.duplicate_rates(twice)) == [("A", 2)]
    with pytest.raises(ValueError):
        fx.rate_table(frame([("A",)], "company_code string"))


def test_usd_conversion(frame, rates):
    df = frame([("EC_NG", D("165000")), ("JD_GH", D("50")), ("EC_NG", None), (None, D("7"))], "c string, a decimal(18,2)")
    out = fx.with_usd(df, {"a": "u"}, F.col("c"), rates, keep_rate=True)
    assert rows(out, "c", "u", "fx_missing") == [(None, 7.0, True), ("EC_NG", 0.0, False), ("EC_NG", 100.0, False), ("JD_GH", 50.0, True)]


def test_rate_from_currency(frame):
    spot = frame([("NGN", 1600.0, "2025-08-31"), ("ngn", 1650.0, "2025-09-30"), ("NGN", 0.0, "2025-10-01"), ("GHS", 12.0, "2025-09-30")], "currency_code string, rate_amount double, starting_date string")
    assert rows(fx.company_rate_from_currency(spot, "EC_NG", "NGN")) == [("EC_NG", 1650.0)]
    assert fx.company_rate_from_currency(spot, "EC_XX", "XXX").count() == 0


def test_target_pivot(frame):
    a = frame([("NG", "Refund", "1,000"), ("NG", "refund", "500"), (None, None, "7"), ("NG", "x", "bad")], "country_code string, voucher_type string, amount_local string")
    b = frame([("NG", "Other", "store credit", "2")], "country_code string, category string, voucher_type string, amount_local string")
    assert rows(pivots.target_pivot(a)) == [(None, "Voucher", "Unknown", D("7.00")), ("NG", "Voucher", "other", D("0.00")), ("NG", "Voucher", "refund", D("1500.00"))]
    mixed = rows(pivots.target_pivot([a, b]), "country_code", "category", "voucher_type")
    assert ("NG", "Other", "store_credit") in mixed and ("NG", None, "refund") in mixed
    with pytest.raises(ValueError):
        pivots.target_pivot(a.drop("voucher_type"))


def test_nav_pivot_with_total(frame):
    df = frame([("Issuance", "Refund", -5.0), ("Issuance", "Refund", None), (None, None, 2.0), ("Usage", "JForce", 3.0)], "bridge_category string, voucher_type string, amount double")
    assert rows(pivots.nav_pivot_with_total(pivots.nav_lines(df))) == [
        ("Issuance", "refund", D("-5.00"), 1), ("Uncategorized", "Unknown", D("2.00"), 1), ("Usage", "jforce", D("3.00"), 1), ("__TOTAL__", "", D("0.00"), 3),
    ]


@pytest.fixture(scope="module")
def compared(frame, rates):
    nav = frame([("NG", "Voucher", "refund", D("165000")), ("EG", "Voucher", "refund", D("500")), ("KE", "V", "a", D("10")), (None, "V", "a", D("1"))], KEYS + ", nav_amount_local decimal(18,2)")
    tv = frame([("NG", "Voucher", "refund", D("0")), ("NG", "Voucher", "apology", D("500")), (None, "V", "a", D("3"))], KEYS + ", tv_amount_local decimal(18,2)")
    return var.variance_pivot(nav, tv, rates)


def test_variance(compared):
    got = {(r["country_code"], r["voucher_type"]): r for r in compared.collect()}
    assert len(got) == 5
    assert got["NG", "refund"]["variance_amount_usd"] == 100.0
    assert got["NG", "apology"]["nav_amount_local"] == 0 and got["NG", "apology"]["variance_amount_local"] == -500
    # Without a rate the local amount passes and the flag is set; null keys meet each other.
    assert got["KE", "a"]["variance_amount_usd"] == 10.0 and got["KE", "a"]["fx_missing"]
    assert got[None, "a"]["variance_amount_local"] == -2
    missing = {r["country_code"]: r["buckets_without_rate"] for r in var.missing_fx_by_country(compared).collect()}
    assert missing == {"NG": 0, "EG": 0, "KE": 1, None: 1}


def resolve(spark, kind, country, gl=None, category=None, voucher=None, contracts=th.CONTRACTS, version=None):
    text = lambda v: F.lit(v).cast("string")
    return spark.range(1).select(th.resolve_threshold(kind, text(country), text(gl), text(category), text(voucher), contracts, version).alias("t")).first()["t"]


def test_threshold_precedence(spark):
    assert resolve(spark, th.LINE_ITEM, "EG", "18412")["value_usd"] == 5000.0
    assert resolve(spark, th.LINE_ITEM, "EG", "99999")["value_usd"] == 500.0
    assert resolve(spark, th.COUNTRY, "EG", "99999")["value_usd"] == 22000.0
    default = resolve(spark, th.BUCKET, "NG", "18412")
    assert (default["value_usd"], default["source"], default["rule_description"].startswith("DEFAULT: ")) == (1000.0, "catalog", True)
    # A missing account matches the scoped rule.
    assert resolve(spark, th.LINE_ITEM, "EG")["value_usd"] == 5000.0
    none = resolve(spark, th.BUCKET, "NG", contracts=())
    assert (none["source"], none["contract_version"], none["value_usd"]) == ("fallback", 0, 1000.0)


def test_threshold_specificity_ties_and_versions(spark):
    rules = (
        th.ThresholdRule(th.BUCKET, 1.0, "wide"), th.ThresholdRule(th.BUCKET, 2.0, "account", gl_accounts=("1",)),
        th.ThresholdRule(th.BUCKET, 3.0, "category", categories=("A",)), th.ThresholdRule(th.BUCKET, 4.0, "both", gl_accounts=("1",), categories=("A",)),
    )
    book = (th.ThresholdContract("NG", 1, "2025-01-01", "one", rules), th.ThresholdContract("NG", 2, "2025-06-01", "two", (th.ThresholdRule(th.BUCKET, 9.0, "new"),)))
    assert resolve(spark, th.BUCKET, "NG", "1", "A", contracts=book, version=1)["value_usd"] == 4.0
    assert resolve(spark, th.BUCKET, "NG", "1", "B", contracts=book, version=1)["value_usd"] == 2.0
    assert resolve(spark, th.BUCKET, "NG", "2", "A", contracts=book, version=1)["value_usd"] == 3.0
    assert resolve(spark, th.BUCKET, "NG", "1", "A", contracts=book)["value_usd"] == 9.0
    with pytest.raises(ValueError):
        th.ThresholdRule("X", 1.0, "bad")
    with pytest.raises(ValueError):
        th.ThresholdRule(th.BUCKET, -1.0, "bad")
    assert len(book[0].content_hash) == 64 and book[0].content_hash != book[1].content_hash


def test_status_and_review(frame, rates):
    nav = frame([("NG", "Usage", "refund", D("3300000"), "V1", "D1"), ("NG", "Usage", "refund", D("-1650"), "V2", "D2"), ("EG", "Usage", "refund", D("10"), "V3", "D3")], KEYS + ", amount_local decimal(18,2), voucher_no string, document_no string")
    tv = frame([("NG", "Usage", "refund", D("165000"), "T1")], KEYS + ", amount_local decimal(18,2), id string")
    buckets = var.with_status(var.variance_pivot(pivots.nav_pivot(nav), pivots.target_pivot(tv), rates), "18412")
    assert rows(buckets, "country_code", "status") == [("EG", "OK"), ("NG", "INVESTIGATE")]
    review = var.review_table(buckets, "18412", rates, nav, tv)
    assert len(review.columns) == 20
    got = rows(review, "row_type", "voucher_id", "variance_amount_usd", "line_item_material")
    assert got == [("bucket_summary", None, 1899.0, None), ("line_item", "T1", 100.0, False), ("line_item", "V1", 2000.0, True), ("line_item", "V2", -1.0, False)]
    assert var.review_table(buckets, "18412", rates, nav, tv, only_material=True).count() == 2
    assert var.review_table(buckets, "18412").count() == 1
    with pytest.raises(ValueError):
        var.review_table(buckets, "18412", nav=nav)
    by_use = tv.withColumn("voucher_type", F.lit("REFUND")).withColumnRenamed("voucher_type", "business_use")
    assert rows(var.line_items(buckets, by_use, "tv", "18412", rates), "voucher_id", "voucher_type") == [("T1", "refund")]
    assert rows(var.line_items(buckets, tv.drop("category"), "tv", "18412", rates), "voucher_id", "category") == [("T1", "Usage")]


def test_threshold_is_exclusive(frame, rates):
    nav = frame([("KE", "U", "a", D("1000")), ("KE", "U", "b", D("999.99"))], KEYS + ", nav_amount_local decimal(18,2)")
    tv = frame([], KEYS + ", tv_amount_local decimal(18,2)")
    assert rows(var.with_status(var.variance_pivot(nav, tv, rates), "18412"), "voucher_type", "status") == [("a", "INVESTIGATE"), ("b", "OK")]


def test_reconciliation_totals(frame):
    books = {"CR_04": frame([("1,000.50",), ("x",)], "BALANCE_AT_DATE string"), "IPE_07": frame([("n/a",)], "Amount string"), "IPE_08": frame([(D("400.25"),)], "remaining_amount decimal(18,2)")}
    assert rows(totals.component_totals(books)) == [("IPE_08", D("400.25"))]
    got = totals.reconciliation_totals(books).first()
    assert (got["actuals"], got["target_values"], got["variance"], got["status"]) == (D("1000.50"), D("400.25"), D("600.25"), "RECONCILED")
    lacking = totals.reconciliation_totals({"IPE_08": books["IPE_08"]}).first()
    assert lacking["actuals"] is None and lacking["status"] is None
    judged = totals.catalog_status(totals.reconciliation_totals(books).select("actuals", "target_values"), "EG", "18412").first()
    assert judged["threshold"] == 1000.0 and judged["is_reconciled"]
