from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from closewright.functions import (
    concat_nulls_as_blank, country_to_company, due_month_label, flag_text, gl_description, harmonize_voucher_type, in_cutoff_month, in_rolling_year, is_iso_date,
    midnight, next_month_first, rolling_year_start, scrub_line_breaks, to_number, to_timestamp, voucher_key, year_month_text, yyyymm,
)
from closewright.functions.dates import as_date, last_second_before
from tests.conftest import rows


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text,want", [
    ("1,234.56", "1234.56"), ("1 234.56", "1234.56"), (" 2,000 ", "2000.00"), ("-7", "-7.00"), ("1e3", "1000.00"), (".5", "0.50"),
    ("", None), ("  ", None), ("n/a", None), ("1d", None), ("nan", None), ("1.2.3", None), (None, None),
])
def test_to_number(spark, text, want):
    got = one(spark, to_number(F.lit(text).cast("string")))
    assert got == (Decimal(want) if want is not None else None)


def test_to_number_fill_and_numeric_sources(spark, frame):
    df = frame([(1.5,), (float("nan"),), (None,)], "x double")
    got = df.select(to_number("x", df.schema["x"].dataType, fill=0).alias("v"))
    assert rows(got) == [(Decimal("0.00"),), (Decimal("0.00"),), (Decimal("1.50"),)]


@pytest.mark.parametrize("text,want", [
    ("2025-09-30", datetime(2025, 9, 30)), ("2025-09-30 14:05:06", datetime(2025, 9, 30, 14, 5, 6)), ("30/09/2025", datetime(2025, 9, 30)),
    ("05/06/2025", datetime(2025, 6, 5)), ("12/31/2025", datetime(2025, 12, 31)), ("20250930", datetime(2025, 9, 30)), ("not a date", None),
    ("2025-02-30", None), (None, None),
])
def test_to_timestamp(spark, text, want):
    assert one(spark, to_timestamp(F.lit(text).cast("string"))) == want


def test_midnight_and_iso(spark):
    assert one(spark, midnight(to_timestamp(F.lit("2025-09-30 14:05:06")))) == datetime(2025, 9, 30)
    assert one(spark, is_iso_date(F.lit("2025-09-30")))
    assert not one(spark, is_iso_date(F.lit("2025-9-30")))
    assert not one(spark, is_iso_date(F.lit("2025-02-30")))
    assert not one(spark, is_iso_date(F.lit(None).cast("string")))


def test_period_arithmetic():
    assert rolling_year_start("2025-09-30") == date(2024, 10, 1)
    assert rolling_year_start("2024-12-15") == date(2024, 1, 1)
    assert next_month_first("2024-12-31") == date(2025, 1, 1)
    assert last_second_before("2025-10-01") == datetime(2025, 9, 30, 23, 59, 59)
    with pytest.raises(ValueError):
        as_date("30-09-2025")


def test_windows_are_inclusive_and_end_at_midnight(spark, frame):
    days = [datetime(2024, 9, 30), datetime(2024, 10, 1), datetime(2025, 9, 30), datetime(2025, 9, 30, 0, 0, 1)]
    df = frame([(d,) for d in days], "d timestamp_ntz")
    assert rows(df.filter(in_rolling_year("d", "2025-09-30"))) == [(days[1],), (days[2],)]
    month = [datetime(2025, 8, 31), datetime(2025, 9, 1), datetime(2025, 9, 30), datetime(2025, 9, 30, 12)]
    df = frame([(d,) for d in month], "d timestamp_ntz")
    assert rows(df.filter(in_cutoff_month("d", "2025-09-15"))) == [(month[1],), (month[2],)]


def test_date_labels(spark):
    day = to_timestamp(F.lit("2024-01-05"))
    assert one(spark, year_month_text(day)) == "2024-1"
    assert one(spark, year_month_text(F.lit(None).cast("date"))) == "-"
    assert one(spark, yyyymm(day)) == 202401
    assert one(spark, due_month_label(day, "2024-02-10")) == "Credit"
    assert one(spark, due_month_label(day, "2023-12-31")) == "Debit"
    assert one(spark, due_month_label(day, "2024-01-31")) == "Due Month"
    assert one(spark, due_month_label(F.lit(None).cast("date"), "2024-01-31")) == "Due Month"


def test_text_helpers(spark):
    assert one(spark, voucher_key(F.lit(" \t123.0 "))) == "123"
    assert one(spark, voucher_key(F.lit("ab1.05"))) == "AB1.05"
    assert one(spark, voucher_key(F.lit("  "))) is None
    assert one(spark, flag_text(F.lit(1.0))) == "1"
    assert one(spark, scrub_line_breaks(F.lit("a\r\nb"))) == "ab"
    assert one(spark, concat_nulls_as_blank(F.lit("a"), F.lit(None), F.lit(3))) == "a3"


@pytest.mark.parametrize("label,want", [
    ("Refund", "refund"), ("STORE CREDIT", "store_credit"), (" Apology ", "apology"), ("CXP", "apology"), ("PYT_PF", "jforce"), ("exp", "expired"),
    ("Voucher to Cash", "vtc"), ("apology_v2", "other"), ("something", "other"), ("", "Unknown"), (None, "Unknown"),
])
def test_harmonize(spark, label, want):
    assert one(spark, harmonize_voucher_type(F.lit(label).cast("string"))) == want


def test_gl_description(spark):
    assert one(spark, gl_description(F.lit("18412"))) == "Voucher Liabilities"
    assert one(spark, gl_description(F.lit("99"))) == "Unknown GL: 99"


def test_country_to_company(spark):
    for code, want in (("NG", "EC_NG"), ("eg", "JM_EG"), ("GH", "JD_GH"), ("XX", "EC_XX")):
        assert one(spark, country_to_company(F.lit(code))) == want
    assert one(spark, country_to_company(F.lit(None).cast("string"))) is None
