"""Ledger classification: one ordered rule list compiled to a single CASE."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closewright.functions.text import slashes, strip, upper_text
from closewright.operators.lookup import lookup_voucher_type
from closewright.operators.naming import LEDGER_ALIASES, amount_column, column_or_null, rename_first_existing, require_columns
from closewright.operators.scope import VOUCHER_ACCOUNT

# Country prefixes of store-credit document numbers.
STORE_CREDIT_COUNTRIES = ("NG", "EG", "KE", "GH", "CI", "MA", "TN", "ZA", "UG", "SN")

# Allowed voucher types of each category.
VALID_TYPES = {
    "Issuance": ("Refund", "Apology", "JForce", "Store Credit"),
    "Cancellation": ("Apology", "Store Credit"),
    "Usage": ("Refund", "Apology", "JForce", "Store Credit"),
    "Expired": ("Apology", "JForce", "Refund", "Store Credit"),
    "VTC": ("Refund",),
}

LOOKUP = "<lookup>"


@dataclass(frozen=True)
class LedgerRule:
    """A claim on ledger rows: the first rule whose condition holds decides category and type.

    The condition is SQL text over the working columns `_sign`, `_batch`, `_desc`, `_note`,
    `_doc`, `_bal` and `_kind`.
    """

    name: str
    condition: str
    category: str
    voucher_type: str | None = None


def _text(value: str | None) -> str:
    """A SQL string literal."""
    if value is None:
        return "cast(null as string)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _has(column: str, *parts: str) -> str:
    """True when the text column holds any of the parts literally (no wildcards)."""
    return "(" + " or ".join(f"contains({column}, {_text(part)})" for part in parts) + ")"


def _starts_with_any(column: str, codes: Sequence[str]) -> str:
    """One IN per code length; a chain of prefixes would make the generated method too long for the JIT."""
    by_length: dict[int, list[str]] = {}
    for code in codes:
        by_length.setdefault(len(code), []).append(_text(code.upper()))
    return "(" + " or ".join(f"left({column}, {n}) in ({', '.join(group)})" for n, group in by_length.items()) + ")" if codes else "false"


def ledger_rules(countries: Sequence[str] = STORE_CREDIT_COUNTRIES) -> list[LedgerRule]:
    """The cascade in order of priority."""
    # The sign is the cheapest test, so it comes first.
    batch_out, batch_back = "_sign < 0 and _batch", "_sign > 0 and _batch"
    manual_out, manual_back = "_sign < 0 and not _batch", "_sign > 0 and not _batch"
    # "RF " needs a following character: the text counts without its outer whitespace.
    loose_rf = "(contains(_desc, 'RF ') and _desc rlike r'(?s)RF (?=.*\\S)')"
    refund = f"({_has('_desc', 'REFUND', 'RF_')} or {loose_rf})"
    return [
        LedgerRule("bank payout", f"{manual_back} and _bal = 'BANK ACCOUNT'", "VTC", "Refund"),
        LedgerRule("batch refund", f"{batch_out} and {refund}", "Issuance", "Refund"),
        LedgerRule("batch gesture", f"{batch_out} and {_has('_desc', 'COMMERCIAL GESTURE')}", "Issuance", "Apology"),
        LedgerRule("batch jforce", f"{batch_out} and {_has('_desc', 'PYT_')}", "Issuance", "JForce"),
        LedgerRule("batch issuance", batch_out, "Issuance"),
        LedgerRule("manual store credit", f"{manual_out} and {_starts_with_any('_doc', countries)}", "Issuance", "Store Credit"),
        LedgerRule("manual refund", f"{manual_out} and ({_has('_desc', 'RFN')} or {refund})", "Issuance", "Refund"),
        LedgerRule("manual apology", f"{manual_out} and {_has('_desc', 'COMMERCIAL', 'CXP', 'APOLOGY')}", "Issuance", "Apology"),
        LedgerRule("manual jforce", f"{manual_out} and {_has('_desc', 'PYT_')}", "Issuance", "JForce"),
        LedgerRule("manual issuance", manual_out, "Issuance"),
        LedgerRule("accrual release", f"{batch_back} and {_has('_desc', 'VOUCHER ACCRUAL')}", "Cancellation", "Apology"),
        LedgerRule("batch usage", batch_back, "Usage", LOOKUP),
        LedgerRule("expired apology", f"{manual_back} and {_has('_desc', 'EXPR_APLGY')}", "Expired", "Apology"),
        LedgerRule("expired jforce", f"{manual_back} and {_has('_desc', 'EXPR_JFORCE')}", "Expired", "JForce"),
        LedgerRule("expired store credit", f"{manual_back} and {_has('_desc', 'EXPR_STR CRDT', 'EXPR_STR_CRDT')}", "Expired", "Store Credit"),
        LedgerRule("expired", f"{manual_back} and {_has('_desc', 'EXPR')}", "Expired"),
        LedgerRule("manual payout", f"{manual_back} and ({_has('_desc', 'MANUAL RND')} or ({_has('_desc', 'PYT_')} and {_has('_note', 'GTB')}))", "VTC", "Refund"),
        LedgerRule("credit memo", f"{manual_back} and _kind = 'CREDIT MEMO'", "Cancellation", "Store Credit"),
        LedgerRule("item price credit", f"{manual_back} and {_has('_desc', 'ITEMPRICECREDIT')}", "Usage", LOOKUP),
    ]


def integration_type(user: Column, batch_user: str) -> Column:
    """"Integration" for the batch user, either slash accepted; everyone else is "Manual"."""
    same = slashes(F.upper(strip(user))) == batch_user.upper().replace("\\", "/")
    return F.when(F.coalesce(same, F.lit(False)), "Integration").otherwise("Manual")


_WORK = ("_sign", "_batch", "_desc", "_note", "_doc", "_bal", "_kind")


def _prepared(ledger: DataFrame, batch_user: str, account: str) -> DataFrame:
    """Ledger with canonical names, `integration_type` and the working columns of the rules."""
    gl = rename_first_existing(ledger, LEDGER_ALIASES)
    require_columns(gl, ["amount"], "ledger")
    on_account = F.lit(True)
    if "gl_account" in gl.columns:
        on_account = F.coalesce(strip("gl_account") == account, F.lit(False))
    return gl.withColumn("integration_type", integration_type(column_or_null(gl, ["user_id"]), batch_user)).withColumns({
        # Rows of other accounts get sign 0, which no rule accepts.
        "_sign": F.when(on_account, F.signum(amount_column(gl, "amount"))).otherwise(F.lit(0.0)),
        "_batch": F.col("integration_type") == "Integration",
        # Searched for parts only, so the outer whitespace may stay.
        "_desc": F.coalesce(F.upper(column_or_null(gl, ["description"])), F.lit("")),
        "_note": F.coalesce(F.upper(column_or_null(gl, ["comment"])), F.lit("")),
        "_doc": upper_text(column_or_null(gl, ["document_no"])),
        "_bal": upper_text(column_or_null(gl, ["bal_account_type"])),
        "_kind": upper_text(column_or_null(gl, ["document_type"])),
    })


def _claimed(prepared: DataFrame, rules: Sequence[LedgerRule]) -> DataFrame:
    branches = " ".join(
        f"when {r.condition} then named_struct('category', {_text(r.category)}, 'type', {_text(r.voucher_type)})" for r in rules
    )
    return prepared.withColumn("_claim", F.expr(f"case {branches} end")).withColumns({
        "bridge_category": F.col("_claim.category"),
        "voucher_type": F.nullif(F.col("_claim.type"), F.lit(LOOKUP)),
        "needs_lookup": F.coalesce(F.col("_claim.type") == LOOKUP, F.lit(False)),
    }).drop(*_WORK, "_claim")


def apply_rules(
    ledger: DataFrame, batch_user: str, account: str = VOUCHER_ACCOUNT, countries: Sequence[str] = STORE_CREDIT_COUNTRIES
) -> DataFrame:
    """Add `integration_type`, `bridge_category`, `voucher_type` and `needs_lookup`. No shuffle."""
    return _claimed(_prepared(ledger, batch_user, account), ledger_rules(countries))


def classify_ledger(
    ledger: DataFrame,
    issuance: DataFrame,
    usage: DataFrame,
    batch_user: str,
    account: str = VOUCHER_ACCOUNT,
    countries: Sequence[str] = STORE_CREDIT_COUNTRIES,
) -> DataFrame:
    """Ledger rows with `integration_type`, `bridge_category` and `voucher_type`.

    Only rows that meet the condition of a lookup rule go through the two shuffles of the voucher
    lookup. The split uses those conditions alone: they are short and reach the scan, while a
    filter on the outcome would repeat the whole CASE. A row claimed by an earlier rule carries
    no key into the lookup.
    """
    rules = ledger_rules(countries)
    prepared = _prepared(ledger, batch_user, account)
    may_look_up = F.expr(" or ".join(f"({rule.condition})" for rule in rules if rule.voucher_type == LOOKUP))
    waiting = _claimed(prepared.filter(may_look_up), rules)
    settled = _claimed(prepared.filter(~may_look_up), rules)
    wanted = lambda name: F.when(F.col("needs_lookup"), column_or_null(waiting, [name]))
    spread = [c for c in ("entry_no", "document_no", "voucher_no", "amount", "posting_date") if c in waiting.columns]
    found = lookup_voucher_type(waiting, issuance, usage, wanted("voucher_no"), wanted("document_no"), spread or waiting.columns).withColumn(
        "voucher_type", F.when(F.col("needs_lookup"), F.nullif(F.col("lookup_type"), F.lit(""))).otherwise(F.col("voucher_type"))
    )
    return settled.drop("needs_lookup").unionByName(found.drop("needs_lookup", "lookup_stage", "lookup_type"))


def classification_counts(classified: DataFrame) -> DataFrame:
    """Rows by category, by type and by integration type, nulls kept, from one scan."""
    columns = ["bridge_category", "voucher_type", "integration_type"]
    return (
        classified.groupingSets([[F.col(c)] for c in columns], *[F.col(c) for c in columns])
        .agg(F.grouping_id().alias("level"), F.count("*").alias("rows"))
        .select(
            F.when(F.col("level") == 3, columns[0]).when(F.col("level") == 5, columns[1]).otherwise(columns[2]).alias("dimension"),
            F.coalesce(*columns).alias("value"), "rows",
        )
    )


def classification_totals(classified: DataFrame) -> DataFrame:
    """One row: all rows, categorised rows and the rest."""
    return classified.agg(
        F.count("*").alias("total_rows"), F.count("bridge_category").alias("categorized_rows"),
        F.count_if(F.col("bridge_category").isNull()).alias("uncategorized_rows"),
    )


def invalid_pairs(classified: DataFrame) -> DataFrame:
    """(category, type) pairs outside the validity table with their row counts; null parts are not judged."""
    allowed = F.lit(False)
    for category, types in VALID_TYPES.items():
        allowed = allowed | ((F.col("bridge_category") == category) & F.col("voucher_type").isin(*types))
    # Judged inside the aggregate: as a filter it would be pushed down and repeat the whole cascade per term.
    judged = F.col("bridge_category").isNull() | F.col("voucher_type").isNull() | allowed
    return (
        classified.groupBy("bridge_category", "voucher_type").agg(F.count("*").alias("rows"), F.bool_and(judged).alias("_valid"))
        .filter("not _valid").drop("_valid")
    )
