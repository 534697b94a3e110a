"""Bridges: what explains the difference between ledger and operations."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closewright.functions.text import MONEY, voucher_key
from closewright.operators.fx import usd
from closewright.operators.joins import beside, spread_key
from closewright.operators.naming import (
    CUSTOMER_LEDGER_ALIASES, LEDGER_ALIASES, OPS_USAGE_ALIASES, VOUCHER_ALIASES, amount_column, rename_first_existing,
    require_columns,
)
from closewright.operators.scope import created_in_rolling_year, inactive_in_month, non_marketing


# Sentences of a reclass proposal.
REASONING = {
    "proposal": "Customer %s has %d business lines. Proposed primary: %s (largest absolute balance). ",
    "move": "Reclass %s from %s to %s.",
    "stay": "Current BL is proposed primary. No reclass needed.",
}


def _zero() -> Column:
    return F.lit(0).cast(MONEY)


def usage_by_voucher(ops: DataFrame) -> DataFrame:
    """Σ used amount by voucher, text amounts parsed, null vouchers dropped."""
    known = rename_first_existing(ops, OPS_USAGE_ALIASES)
    require_columns(known, ["voucher_id", "amount_used"], "operational usage")
    return (
        known.select(F.col("voucher_id").cast("string").alias("voucher_id"), amount_column(known, "amount_used").alias("amount_used"))
        .filter("voucher_id is not null").groupBy("voucher_id").agg(F.sum("amount_used").alias("amount_used"))
    )


def timing_difference(ops: DataFrame | None, issuance: DataFrame, cutoff: str) -> DataFrame:
    """Inactive non-marketing vouchers of the rolling year: operations − accounting per voucher.

    Usage is summed per voucher before the join, so a voucher with very many uses reaches the
    join as one row. Vouchers known only to operations are not part of this bridge.
    """
    vouchers = rename_first_existing(issuance, VOUCHER_ALIASES)
    require_columns(vouchers, ["id", "is_active", "total_amount_used"], "voucher issuance")
    if "created_at" in vouchers.columns:
        vouchers = created_in_rolling_year(vouchers, cutoff)
    else:
        warnings.warn("no created_at column: vouchers of all dates are included", UserWarning, stacklevel=2)
    kept = non_marketing(vouchers.filter("is_active = 0"))
    keep = ["id", *(["business_use"] if "business_use" in kept.columns else [])]
    accounting = kept.select(
        F.col("id").cast("string").alias("id"), *keep[1:], amount_column(kept, "total_amount_used").alias("total_amount_used")
    )
    if ops is None:
        compared = accounting.withColumn("ops_amount_used", _zero())
    else:
        used = usage_by_voucher(ops).withColumnsRenamed({"voucher_id": "_id", "amount_used": "ops_amount_used"})
        compared = accounting.join(used, F.col("id") == F.col("_id"), "left").drop("_id").withColumn(
            "ops_amount_used", F.coalesce("ops_amount_used", _zero())
        )
    return compared.withColumn("variance", F.col("ops_amount_used") - F.col("total_amount_used"))


def timing_total(proof: DataFrame) -> DataFrame:
    return proof.agg(
        F.count("*").alias("vouchers"), F.count_if(F.col("ops_amount_used") != 0).alias("vouchers_with_usage"),
        F.coalesce(F.sum("variance"), F.lit(0)).alias("variance"),
    )


def refund_vouchers(issuance: DataFrame, cutoff: str | None) -> DataFrame:
    """Valid inactive refund vouchers, inactive in the cutoff month when a cutoff is given."""
    vouchers = non_marketing(rename_first_existing(issuance, VOUCHER_ALIASES))
    for column, wanted in (("business_use", "refund"), ("is_valid", "valid"), ("is_active", 0)):
        if column in vouchers.columns:
            vouchers = vouchers.filter(F.col(column) == wanted)
    if cutoff is not None and "inactive_at" in vouchers.columns:
        vouchers = inactive_in_month(vouchers, cutoff)
    require_columns(vouchers, ["id", "remaining_amount"], "voucher issuance")
    return vouchers.withColumns({"remaining_amount": amount_column(vouchers, "remaining_amount"), "voucher_key": voucher_key("id")})


def _cancelling_entries(classified: DataFrame) -> DataFrame:
    # One reference to the category: a filter on a derived column repeats its expression per reference.
    ledger = rename_first_existing(classified, LEDGER_ALIASES)
    return ledger.filter(F.col("bridge_category").rlike(r"(?i)^\s*(cancellation.*|vtc( manual)?)\s*$"))


def cancelled_keys(classified: DataFrame) -> DataFrame:
    """Distinct voucher keys with a cancellation or payout in the ledger."""
    return _cancelling_entries(classified).select(voucher_key("voucher_no").alias("ledger_key")).filter(
        "ledger_key is not null"
    ).distinct()


def unmatched_refunds(issuance: DataFrame, classified: DataFrame | None, cutoff: str | None) -> DataFrame:
    """Refund vouchers without a ledger cancellation (voucher-to-cash). A null key never matches."""
    source = refund_vouchers(issuance, cutoff)
    if classified is not None:
        keys = cancelled_keys(classified)
        spread = spread_key(F.col("voucher_key"), ["id", "remaining_amount"])
        source = source.withColumn("_key", spread).join(keys, F.col("_key") == F.col("ledger_key"), "left_anti").drop("_key")
    return source


def vtc_total(unmatched: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    """Σ remaining amount of the unmatched vouchers, in local currency and in USD when rates are given.

    Amounts are summed exactly per company before the division by its rate.
    """
    if rates is None or "company_code" not in unmatched.columns:
        return unmatched.agg(F.count("*").alias("vouchers"), F.coalesce(F.sum("remaining_amount"), _zero()).alias("amount_local"))
    per_company = unmatched.groupBy("company_code").agg(
        F.sum("remaining_amount").alias("amount_local"), F.count("*").alias("vouchers")
    )
    priced = per_company.join(rates, F.col("company_code") == F.col("rate_company"), "left").withColumn("amount_usd", usd(F.col("amount_local")))
    return priced.agg(
        F.coalesce(F.sum("vouchers"), F.lit(0)).alias("vouchers"), F.coalesce(F.sum("amount_local"), F.lit(0)).alias("amount_local"),
        F.coalesce(F.sum("amount_usd"), F.lit(0.0)).alias("amount_usd"),
    )


def vtc_metrics(issuance: DataFrame, classified: DataFrame, cutoff: str | None) -> DataFrame:
    """One row of counters on how refund vouchers meet ledger cancellations.

    Both sides become per-key counts first; one full join of these answers everything.
    """
    source = refund_vouchers(issuance, cutoff).groupBy("voucher_key").agg(F.count("*").alias("n"))
    both = source.join(cancelled_keys(classified), F.col("voucher_key") == F.col("ledger_key"), "full")
    matched = F.col("ledger_key").isNotNull()
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return both.agg(
        zero(F.sum("n")).alias("refund_vouchers"), F.count("voucher_key").alias("source_unique_voucher_keys"),
        zero(F.sum(F.when(matched, F.col("n")))).alias("matched_source_vouchers"),
        zero(F.sum(F.when(~matched, F.col("n")))).alias("unmatched_vouchers"), F.count("ledger_key").alias("target_unique_voucher_keys"),
    )


def posting_group_conflicts(customer_ledger: DataFrame) -> DataFrame:
    """Customers with more than one posting group: name and the sorted list of groups.

    Both aggregates combine on the map side, so a customer with very many ledger rows reaches the
    shuffle as its few groups.
    """
    known = rename_first_existing(customer_ledger, CUSTOMER_LEDGER_ALIASES)
    require_columns(known, ["customer_id", "customer_name", "posting_group"], "customer ledger")
    groups = F.array_sort(F.collect_set("posting_group"))
    per_customer = known.filter("customer_id is not null").groupBy("customer_id").agg(
        F.min("customer_name").alias("customer_name"), groups.alias("_groups")
    )
    return per_customer.filter(F.size("_groups") > 1).select(
        "customer_id", "customer_name", F.size("_groups").cast("long").alias("group_count"), F.array_join("_groups", ", ").alias("posting_groups")
    )


def business_line_reclass(customer_ledger: DataFrame, min_abs_amount: float = 0.01, reasoning: bool = True) -> DataFrame:
    """Customers holding balances on several lines; the largest absolute balance is the proposed primary.

    Balances are summed by customer and line first, so the window by customer only sees one row
    per business line, however many ledger rows a customer has. Ties go to the first line in
    alphabetical order.
    """
    known = rename_first_existing(customer_ledger, CUSTOMER_LEDGER_ALIASES)
    require_columns(known, ["customer_id", "business_line_code", "amount_lcy"], "customer ledger")
    rows = known.withColumn("_amount", amount_column(known, "amount_lcy")).dropna(subset=["customer_id", "business_line_code"])
    balances = rows.groupBy("customer_id", "business_line_code").agg(F.sum("_amount").alias("balance_lcy")).filter(
        F.abs("balance_lcy") >= F.lit(str(min_abs_amount)).cast("decimal(18,6)")
    )
    largest_first = Window.partitionBy("customer_id").orderBy(F.abs("balance_lcy").desc(), "business_line_code").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    away = F.col("business_line_code") != F.col("proposed_primary_business_line")
    out = balances.withColumns({
        "num_business_lines_for_customer": F.count("*").over(largest_first),
        "proposed_primary_business_line": F.first_value("business_line_code").over(largest_first),
    }).filter("num_business_lines_for_customer > 1").withColumns({
        "proposed_reclass_amount_lcy": F.when(away, F.col("balance_lcy")).otherwise(F.lit(0)),
        "review_required": F.lit(True),
    })
    if not reasoning:
        return out
    line, primary = F.col("business_line_code"), F.col("proposed_primary_business_line")
    count, balance = F.col("num_business_lines_for_customer"), F.col("balance_lcy").cast("decimal(28,2)").cast("string")
    told = F.format_string(REASONING["proposal"], F.col("customer_id"), count, primary)
    move = F.format_string(REASONING["move"], balance, line, primary)
    return out.withColumn("reasoning", F.concat(told, F.when(away, move).otherwise(REASONING["stay"])))


def adjustment_by_target(rows: DataFrame, target: str, amount: str) -> DataFrame:
    """Σ amount by target account, the shape of an integration-error adjustment."""
    return rows.groupBy(target).agg(F.sum(amount).alias("amount"), F.count("*").alias("rows"))


def bridge_summary(parts: Sequence[tuple[str, DataFrame, Column, Column]]) -> DataFrame:
    """One row per bridge: name, amount and item count, then a total row.

    Each part is (name, one-row frame, amount column, item-count column).
    """
    rows = [
        frame.select(F.lit(name).alias("bridge"), amount.cast("decimal(38,2)").alias("amount"), items.cast("long").alias("items"))
        for name, frame, amount, items in parts
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.union(row)
    return out.groupingSets([["bridge"], []], "bridge").agg(
        F.grouping_id().alias("level"), F.sum("amount").alias("amount"), F.sum("items").alias("items")
    ).select(
        F.when(F.col("level") == 1, "TOTAL").otherwise(F.col("bridge")).alias("bridge"), "amount", "items",
        F.when(F.col("items") > 0, "EXPLAINED").otherwise("NONE").alias("status"),
    )
