"""Row scoping: voucher use, ledger account, country, period and key filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closewright.functions.dates import in_cutoff_month, in_rolling_year, to_timestamp
from closewright.functions.text import strip
from closewright.operators.naming import DRILLDOWN_HEADINGS, LEDGER_ALIASES, USE_HEADINGS, column_or_null, first_existing

# Voucher uses that are not marketing.
NON_MARKETING_USES = ("apology_v2", "jforce", "refund", "store_credit", "Jpay store_credit")

VOUCHER_ACCOUNT = "18412"
ORDER_DATES = ("Order_Creation_Date", "Order_Delivery_Date", "Order_Cancellation_Date")


def _use_column(df: DataFrame) -> str | None:
    return first_existing(df, USE_HEADINGS)


def non_marketing(df: DataFrame, column: str | None = None) -> DataFrame:
    """Keep non-marketing vouchers; without a use column the frame passes unchanged."""
    name = column or _use_column(df)
    if name is None or name not in df.columns:
        return df
    return df.filter(F.col(name).isin(*NON_MARKETING_USES))


def voucher_scope(df: DataFrame) -> DataFrame:
    """Non-marketing vouchers with the order dates read as timestamps."""
    dates = {c: to_timestamp(c) for c in ORDER_DATES if c in df.columns}
    return non_marketing(df.withColumns(dates) if dates else df)


def on_account(df: DataFrame, account: str = VOUCHER_ACCOUNT) -> DataFrame:
    """Ledger rows of one account; a frame without an account column passes unchanged."""
    name = first_existing(df, ["gl_account", *LEDGER_ALIASES["gl_account"]])
    return df if name is None else df.filter(strip(F.col(f"`{name}`")) == account)


def of_company(df: DataFrame, company: str | None, column: str = "company_code") -> DataFrame:
    if company is None or column not in df.columns:
        return df
    return df.filter(F.col(column) == company)


def created_in_rolling_year(df: DataFrame, cutoff: str, column: str = "created_at") -> DataFrame:
    return df.filter(in_rolling_year(column, cutoff))


def inactive_in_month(df: DataFrame, cutoff: str, column: str = "inactive_at") -> DataFrame:
    return df.filter(in_cutoff_month(column, cutoff))


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows with any null key."""
    return df.dropna(subset=list(keys))


def drilldown_view(lines: DataFrame, category: str | None = None, country: str | None = None) -> DataFrame:
    """Voucher-level view with seven fixed columns; absent source columns become null."""
    category_col = first_existing(lines, DRILLDOWN_HEADINGS["category"])
    country_col = first_existing(lines, DRILLDOWN_HEADINGS["country_code"])
    if category is not None and category_col:
        lines = lines.filter(F.col(category_col) == category)
    if country is not None and country_col:
        lines = lines.filter(F.col(country_col) == country)
    kinds = {"amount": "decimal(18,2)", "date": "timestamp_ntz"}
    shown = ("voucher_id", "category", "amount", "date", "country_code", "business_line", "details")
    return lines.select(*[column_or_null(lines, list(DRILLDOWN_HEADINGS[c]), kinds.get(c, "string")).alias(c) for c in shown])


def voucher_details(lines: DataFrame, voucher_ids: DataFrame, key: str = "voucher_no") -> DataFrame:
    """All ledger lines of the wanted vouchers (`voucher_ids` has one column `id`)."""
    wanted = voucher_ids.select(F.col("id").cast("string").alias("_id")).filter("_id is not null")
    return lines.join(wanted, F.col(key).cast("string") == F.col("_id"), "left_semi")


def first_voucher_line(lines: DataFrame, voucher_id: str, order_by: Sequence[str], key: str = "voucher_no") -> DataFrame:
    """The first ledger line of one voucher, by an explicit order."""
    hit = lines.filter(F.col(key).cast("string") == str(voucher_id))
    return hit.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(1)


def use_frequencies(df: DataFrame) -> DataFrame:
    """Vouchers per use, null uses left out, with the non-marketing mark."""
    name = _use_column(df)
    return (
        df.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("business_use"))
        .agg(F.count("*").alias("vouchers"))
        .withColumn("non_marketing", F.col("business_use").isin(*NON_MARKETING_USES))
    )


def use_totals(df: DataFrame) -> DataFrame:
    """One row: all vouchers, non-marketing and the rest (null use counts as the rest)."""
    name = _use_column(df)
    inside = F.count_if(F.col(name).isin(*NON_MARKETING_USES))
    return df.agg(
        F.count("*").alias("total_vouchers"), inside.alias("non_marketing_count"),
        (F.count("*") - inside).alias("marketing_count"),
    )
