from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from closewright.operators import bridge_rules, bridges, fx
from tests.conftest import rows

D = Decimal
VOUCHER = "id string, business_use string, is_active int, `Total Amount Used` string, created_at timestamp_ntz"
DAY = datetime(2025, 5, 1)


def test_timing_offsets_to_zero(frame):
    vouchers = frame([("V1", "refund", 0, "120", DAY), ("V2", "store_credit", 0, "180", DAY)], VOUCHER)
    ops = frame([("V1", "50"), ("V1", "50"), ("V2", "200"), ("V9", "1"), (None, "3")], "`Voucher Id` string, `Amount Used` string")
    proof = bridges.timing_difference(ops, vouchers, "2025-09-30")
    assert rows(proof, "id", "variance") == [("V1", D("-20.00")), ("V2", D("20.00"))]
    assert bridges.timing_total(proof).first()["variance"] == 0


def test_timing_scope(frame):
    cases = [
        ("in", "refund", 0, "1,000.5", datetime(2024, 10, 1)), ("active", "refund", 1, "1", DAY), ("marketing", "promo", 0, "1", DAY),
        ("old", "refund", 0, "1", datetime(2024, 9, 30)), ("late", "refund", 0, "1", datetime(2025, 10, 1)), ("cut", "jforce", 0, None, datetime(2025, 9, 30)),
    ]
    vouchers = frame(cases, VOUCHER)
    assert rows(bridges.timing_difference(None, vouchers, "2025-09-30"), "id", "variance") == [("cut", D("0.00")), ("in", D("-1000.50"))]
    with pytest.raises(ValueError):
        bridges.timing_difference(None, vouchers.drop("is_active"), "2025-09-30")
    with pytest.warns(UserWarning):
        assert bridges.timing_difference(None, vouchers.drop("created_at"), "2025-09-30").count() == 4


ISSUED = "id string, business_use string, is_valid string, is_active int, remaining_amount double, inactive_at timestamp_ntz, ID_COMPANY string"


@pytest.fixture(scope="module")
def issued(frame):
    day = datetime(2025, 9, 10)
    return frame([
        ("V001", "refund", "valid", 0, 100.0, day, "EC_NG"), ("V002", "refund", "valid", 0, 200.0, day, "EC_NG"), ("3.0", "refund", "valid", 0, 50.0, day, "EC_KE"),
        ("V004", "refund", "expired", 0, 1.0, day, "EC_NG"), ("V005", "refund", "valid", 1, 1.0, day, "EC_NG"), ("V006", "jforce", "valid", 0, 1.0, day, "EC_NG"),
        ("V007", "refund", "valid", 0, 1.0, datetime(2025, 8, 31), "EC_NG"), (None, "refund", "valid", 0, 7.0, day, "EC_NG"),
    ], ISSUED)


@pytest.fixture(scope="module")
def ledger(frame):
    return frame([(" v001 ", "Cancellation"), ("3", "VTC"), ("V002", "Usage"), (None, "VTC Manual"), ("V006", None), ("v001", "cancellation - x")], "`[Voucher No_]` string, bridge_category string")


def test_unmatched_refunds(issued, ledger, frame):
    left = bridges.unmatched_refunds(issued, ledger, "2025-09-30")
    assert rows(left, "id", "remaining_amount") == [(None, D("7.00")), ("V002", D("200.00"))]
    assert bridges.unmatched_refunds(issued, ledger, None).count() == 3
    assert bridges.unmatched_refunds(issued, None, "2025-09-30").count() == 4
    rates = fx.rate_table(frame([("EC_NG", 2.0)], "company_code string, fx_rate double"))
    total = bridges.vtc_total(left, rates).first()
    assert (total["vouchers"], total["amount_local"], total["amount_usd"]) == (2, D("207.00"), 103.5)


def test_vtc_metrics(issued, ledger):
    got = bridges.vtc_metrics(issued, ledger, "2025-09-30").first()
    assert got.asDict() == {
        "refund_vouchers": 4, "source_unique_voucher_keys": 3, "matched_source_vouchers": 2, "unmatched_vouchers": 2, "target_unique_voucher_keys": 2,
    }


def test_posting_group_conflicts(frame):
    df = frame([("C1", "A", "UE"), ("C1", "A", "NAT"), ("C1", "A", "UE"), ("C2", "B", "NAT"), ("C2", "B", None), (None, "Z", "X"), (None, "Z", "Y")], "`Customer No_` string, `Customer Name` string, `Customer Posting Group` string")
    assert rows(bridges.posting_group_conflicts(df)) == [("C1", "A", 2, "NAT, UE")]


def test_business_line_reclass(frame):
    df = frame([
        ("C1", "BL01", "1,000"), ("C1", "BL02", "200"), ("C1", "BL03", "-50"), ("C2", "BL01", "5"), ("C3", "B", "10"), ("C3", "A", "-10"),
        ("C4", "A", "10"), ("C4", "B", "0.001"), ("C5", None, "3"), ("C5", "A", "1"),
    ], "customer_id string, business_line_code string, amount_lcy string")
    out = bridges.business_line_reclass(df)
    assert rows(out, "customer_id", "business_line_code", "proposed_primary_business_line", "proposed_reclass_amount_lcy", "num_business_lines_for_customer") == [
        ("C1", "BL01", "BL01", D("0.00"), 3), ("C1", "BL02", "BL01", D("200.00"), 3), ("C1", "BL03", "BL01", D("-50.00"), 3),
        ("C3", "A", "A", D("0.00"), 2), ("C3", "B", "A", D("10.00"), 2),
    ]
    text = {(r["customer_id"], r["business_line_code"]): r["reasoning"] for r in out.collect()}
    assert text["C1", "BL02"] == "Customer C1 has 3 business lines. Proposed primary: BL01 (largest absolute balance). Reclass 200.00 from BL02 to BL01."
    assert text["C3", "A"].endswith("Current BL is proposed primary. No reclass needed.")


def test_rule_bridges(frame):
    df = frame([("payment", None), ("Refund", 1.0), (None, 1.0), ("reallocation from", 0.0), ("nothing", None)], "Transaction_Type string, IS_PREPAYMENT double")
    got = {r["Transaction_Type"]: r for r in bridge_rules.classify_bridges(df).collect()}
    assert got["payment"]["bridge_key"] == "CASH_DEPOSITS" and got["payment"]["cr_gl_accounts"] == "13011,13012,10590"
    # Equal rank keeps list order; a float flag reads as 1.
    assert got["Refund"]["bridge_key"] == "PREPAYMENTS" and got[None]["bridge_key"] == "PREPAYMENTS"
    assert got["reallocation from"]["bridge_key"] == "CASH_DEPOSITS_CANCEL" and got["nothing"]["bridge_key"] is None
    assert bridge_rules.classify_bridges(df.select(F.lit(1).alias("x"))).first()["bridge_key"] is None
    two = frame([("SC", "Account Statement"), ("SC", None), ("mpl", "account statement")], "Source string, Entity string")
    assert rows(bridge_rules.classify_bridges(two), "bridge_key") == [(None,), ("SC_ACCOUNT_STATEMENT",), ("SELLER_ACCOUNT_STATEMENTS",)]
