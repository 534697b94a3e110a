"""The catalog extracts: what each ledger or operational dataset selects at a cutoff.

Every extract takes a lookup of source tables by name and its parameters, and returns a lazy
DataFrame. Filters and column lists are written so that they reach the file scans.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closewright.functions.dates import as_date, cutoff_lit, due_month_label, last_second_before, next_month_first, year_month_text, yyyymm
from closewright.operators.joins import keys_as_one, left_lookup
from closewright.operators.quality import ColumnExistsCheck, QualityRule, RowCountCheck

Tables = Mapping[str, DataFrame]

# Customer posting groups in scope of the customer balances.
CUSTOMER_POSTING_GROUPS = (
    "LOAN-REC-NAT", "B2B-NG-NAT", "B2C-NG-NAT", "B2C-NG-INT", "NTR-NG-NAT", "B2B-NG-INT", "NTR-NG-INT", "UE", "INL",
    "EXPORT", "EU", "NATIONAL", "OM", "NAT", "AUS", "EXCB2B-NAT", "EMP-NAT",
)
# Transaction types that never are open collection items.
CLOSED_TRANSACTION_TYPES = (
    "Payment", "Collection Adjustment (over)", "Collection Adjustment (under)", "Payment Charges", "Reallocation From",
    "Transfer From", "Payment Charges Rev",
)
IN_PROGRESS = ("inProgress", "closed", "waitingConfirmation")


def _c(name: str) -> Column:
    return F.col(name)


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("decimal(18,2)"))


def _open_after(name: str, cutoff: Column) -> Column:
    """Not happened, or happened after the cutoff."""
    return F.col(name).isNull() | (F.col(name) > cutoff)


def _non_zero(detail: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Σ of the details by key where it is not exactly zero (decimal sums)."""
    return detail.groupBy(*keys).agg(F.sum("amount").alias(name)).filter(F.col(name) != 0)


def ledger_open_items(t: Tables, year_start: str, year_end: str, accounts: Sequence[str]) -> DataFrame:
    """Ledger entries of in-scope companies whose detail entries of the period do not net to zero."""
    company = t["company"].filter("in_scope = 1").select("company_code", _c("country_code").alias("company_country"), "opco_central", "in_scope")
    detail = t["gl_detail"].filter(
        _c("posting_date").between(cutoff_lit(year_start), cutoff_lit(year_end)) & _c("gl_account").isin(*accounts)
    ).join(company.select("company_code"), "company_code", "left_semi")
    remaining = _non_zero(detail, ["company_code", "entry_no"], "remaining_amount")
    accounts_dim = t["chart_of_accounts"].withColumnRenamed("account_no", "gl_account")
    description = _c("description")
    return (
        t["gl_entries"].drop("country_code").join(remaining, ["company_code", "entry_no"])
        .join(company, "company_code")
        .join(accounts_dim, ["company_code", "gl_account"], "left")
        .join(t["ifrs_map"].withColumnRenamed("level_4_code", "group_account_no"), "group_account_no", "left")
        .withColumn("entry_type", F.when(description.contains("BM") | description.contains("BACKMARGIN"), "BackMargin").otherwise("Other"))
    )


def balances_at_date(t: Tables, cutoff: str, accounts: Sequence[str]) -> DataFrame:
    return t["gl_balances"].filter((_c("closing_date") == F.lit(as_date(cutoff))) & _c("group_account_no").isin(*accounts))


def fx_closing(t: Tables, year: int, month: int, excluded: Sequence[str] = ("United arab emirates (the)",)) -> DataFrame:
    """Closing rate of each company; dollar companies are 1."""
    rates = t["fx_monthly"].filter(
        (_c("rate_year") == year) & (_c("rate_month") == month) & (_c("rate_type") == "Closing") & (_c("base_currency") == "USD")
        & ~_c("country").isin(*excluded)
    ).select("country_code", "rate_type", "rate_year", "rate_month", "rate")
    name = _c("country_name")
    dollar = (name == "United States of America") | ((name == "Germany") & (F.right("company_code", F.lit(4)) == "_USD"))
    return (
        t["fx_company"].join(rates, "country_code", "left").join(t["country"], "country_code", "left")
        .withColumn("fx_rate", F.when(dollar, F.lit(1.0)).otherwise(_c("rate"))).drop("rate")
    )


def fx_spot(t: Tables, on_date: str, currencies: Sequence[str]) -> DataFrame:
    return t["fx_spot"].filter(_c("currency_code").isin(*currencies) & (_c("starting_date") == cutoff_lit(on_date))).select(
        "currency_code", F.year("starting_date").cast("long").alias("year"), F.month("starting_date").cast("long").alias("month"), "rate_amount"
    )


def customer_open_items(t: Tables, cutoff: str, posting_groups: Sequence[str] = CUSTOMER_POSTING_GROUPS) -> DataFrame:
    """Customer ledger entries with an open entry balance, of customers with an open balance, at the cutoff."""
    at = cutoff_lit(cutoff)
    detail = t["cle_detail"].filter(_c("posting_date") <= at)
    by_customer = _non_zero(detail, ["company_code", "customer_id"], "customer_balance")
    by_entry = _non_zero(detail, ["company_code", "entry_no"], "remaining_amount_lcy")
    company = t["company"].filter("in_scope = 1").select("company_code", _c("country_code").alias("company_country"), "opco_central")
    customers = t["customers"].select(
        "company_code", _c("customer_no").alias("customer_id"), "name", _c("busline_code").alias("customer_busline"),
        "auto_integrated", _c("posting_group").alias("current_posting_group"), "stream",
    )
    lines = t["buslines"].withColumnsRenamed({"busline_code": "lookup_key"})
    open_entries = t["cle"].drop("country_code").filter((_c("posting_date") <= at) & _c("posting_group").isin(*posting_groups)).join(company, "company_code")
    # Entries are moved by entry, then by customer: what is known of a customer stands beside the open balance before that.
    keys = ["company_code", "customer_id"]
    known = by_customer.select(*keys).join(customers, keys, "left")
    told = known.select(keys_as_one(keys).alias("_customer"), *[c for c in known.columns if c not in keys])
    matched = open_entries.join(by_entry, ["company_code", "entry_no"])
    order = [*keys, *[c for c in matched.columns if c not in keys], *told.columns[1:]]
    entries = matched.withColumn("_customer", keys_as_one(keys)).join(told, "_customer").select(*order)
    with_line = left_lookup(entries, lines, _c("business_line_code"), ["entry_no", "customer_id", "amount_lcy"], ["company_code"])
    return with_line.withColumn("debit_credit_due_month", due_month_label("due_date", cutoff))


def _used_by_code(t: Tables, cutoff: str, delivered_after_year: int) -> DataFrame:
    """Voucher use on delivered order items before the cutoff, by company, code and voucher type."""
    items = t["order_items"].filter(
        (_c("package_delivery_date") < cutoff_lit(cutoff)) & (F.year("delivered_date") > delivered_after_year) & _c("voucher_code").isNotNull()
    )
    market = _c("is_marketplace")
    return items.groupBy("company_code", "voucher_code", "voucher_type").agg(
        F.sum(_or_zero("shipping_discount")).alias("shipping_discount"),
        F.sum(_or_zero("shipping_voucher_discount")).alias("shipping_storecredit"),
        F.sum(F.when(market == 1, _or_zero("coupon_value")).otherwise(0)).alias("mpl_storecredit"),
        F.sum(F.when(market == 0, _or_zero("coupon_value")).otherwise(0)).alias("rtl_storecredit"),
    )


def voucher_issuance(
    t: Tables, cutoff: str, companies: Sequence[str], issued_after: str = "2016-12-31", delivered_after_year: int = 2014
) -> DataFrame:
    """Issued vouchers with their use before the cutoff and the earliest date they became inactive."""
    at = cutoff_lit(cutoff)
    issued = t["voucher_closing"].filter(
        _c("company_code").isin(*companies) & (_c("created_at") > cutoff_lit(issued_after)) & (_c("created_at") < at)
    )
    templates = t["voucher_templates"].select("company_code", "id", "template_id", "template_name")
    used = _used_by_code(t, cutoff, delivered_after_year).withColumnRenamed("voucher_code", "code")
    prefix = F.left("code", F.lit(2))
    gift = F.when(prefix == "GC", "jpay_store_credit_gift").when(prefix == "JP", "jpay_store_credit_DS").otherwise("jpay_store_credit_other")
    # Comparisons with a null date fall to the other branch, so these are not least().
    earlier = F.when(_c("voucher_inactive_date") > _c("template_inactive_date"), _c("template_inactive_date")).otherwise(_c("voucher_inactive_date"))
    spent = ["shipping_storecredit", "mpl_storecredit", "rtl_storecredit"]
    joined = issued.join(templates, ["company_code", "id"], "left").join(used, ["company_code", "code"], "left")
    filled = joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ["shipping_discount", *spent]})
    total = reduce(lambda a, b: a + b, [_c(c) for c in spent])
    return filled.withColumns({
        "business_use_formatted": F.when(_c("business_use") == "jpay_store_credit", gift).otherwise(_c("business_use")),
        "is_valid": F.when(_c("to_date") < at, "expired").otherwise("valid"),
        "expiration_ym": year_month_text("to_date"), "creation_ym": year_month_text("created_at"),
        "last_update_ym": year_month_text("updated_at"), "codeinactive_ym": year_month_text("voucher_inactive_date"),
        "templateinactive_ym": year_month_text("template_inactive_date"),
        "total_amount_used": total, "total_remaining_amount": _or_zero("discount_amount") - total,
        "min_inactive_date": F.when(_c("to_date") > earlier, earlier).otherwise(_c("to_date")),
    })


def voucher_timing(t: Tables, cutoff: str) -> DataFrame:
    """Inactive vouchers still valid at the cutoff, with their unsettled order items, or without any item.

    The left join is written as its two halves: an inner join, whose sides can both be split when
    one code holds very many items, and the vouchers whose code no item carries. The item
    conditions then reach the scan.
    """
    at = cutoff_lit(cutoff)
    vouchers = t["voucher_closing"].filter(
        (_c("created_at") < at) & (F.coalesce(_c("is_active"), F.lit(0)) == 0) & (_c("to_date") >= at)
    ).select(
        "company_code", _c("id").alias("voucher_id"), "code", _c("discount_amount").alias("amount"), "business_use", _c("type").alias("origin"),
        F.lit("inactive").alias("status"), _c("created_at").alias("creation_date"), _c("from_date").alias("start_date"),
        _c("to_date").alias("end_date"), "fk_customer", _c("description").alias("comment"),
    )
    coded = t["order_items"].filter("voucher_code is not null").withColumnRenamed("voucher_code", "code")
    later = lambda c: _c(c).isNull() | (_c(c) >= at)
    status = _c("current_status")
    unsettled = (status.isNull() | ~status.isin("delivered", "cancelled", "closed")) & later("delivered_date") & later("cancellation_date")
    items = coded.filter(unsettled).select(
        "company_code", "code", "order_item_id", "order_nr", "order_creation_date", _c("delivered_date").alias("order_delivery_date"),
        _c("cancellation_date").alias("order_cancellation_date"), _c("current_status").alias("order_item_status"), "payment_method",
    )
    never_used = vouchers.join(coded.select("company_code", "code").distinct(), ["company_code", "code"], "left_anti")
    return vouchers.join(items, ["company_code", "code"]).unionByName(never_used, allowMissingColumns=True)


def voucher_usage_monthly(t: Tables, cutoff: str, companies: Sequence[str], delivered_after_year: int = 2014) -> DataFrame:
    """Store-credit use by voucher and delivery month.

    Items are summed by code and month before the voucher is joined, so a code with very many
    items reaches the join as a few rows.
    """
    items = t["order_items"].filter(
        (_c("voucher_type") == "reusablecredit") & (_c("package_delivery_date") < cutoff_lit(cutoff))
        & (F.year("delivered_date") > delivered_after_year)
        & _c("company_code").isin(*companies)
    )
    market, coupon = _c("is_marketplace"), _or_zero("coupon_value")
    sums = ["shipping_storecredit", "mpl_storecredit", "rtl_storecredit", "total_amount_used"]
    by_code = items.groupBy("company_code", "voucher_code", "voucher_type", yyyymm("package_delivery_date").alias("delivery_mth")).agg(
        F.sum(_or_zero("shipping_voucher_discount")).alias(sums[0]),
        F.sum(F.when(market == 1, coupon).otherwise(0)).alias(sums[1]), F.sum(F.when(market == 0, coupon).otherwise(0)).alias(sums[2]),
        F.sum(coupon + _or_zero("shipping_voucher_discount")).alias(sums[3]),
    )
    vouchers = t["voucher_closing"].select(
        "company_code", _c("code").alias("lookup_key"), "id", "business_use", F.year("created_at").cast("long").alias("creation_year")
    )
    joined = left_lookup(by_code, vouchers, _c("voucher_code"), ["delivery_mth", "total_amount_used"], ["company_code"])
    return joined.groupBy("company_code", "id", "voucher_type", "business_use", "creation_year", "delivery_mth").agg(
        *[F.sum(c).alias(c) for c in sums]
    )


def _paid_shipping() -> Column:
    return (
        _or_zero("base_shipping") - _or_zero("shipping_rule_discount") - _or_zero("shipping_voucher_discount")
        + _or_zero("customs_fee") - _or_zero("customs_rule_discount") + _or_zero("freight_fee")
    )


def prepayments(t: Tables, cutoff: str, since: str = "2018-01-01") -> DataFrame:
    """Prepaid order items neither delivered nor refunded at the cutoff."""
    at, start = cutoff_lit(cutoff), cutoff_lit(since)
    digital = _c("delivery_type").isin("Digital Content", "Gift Card")
    retail_open = (digital & _open_after("delivered_date", at)) | (~digital & _open_after("package_delivery_date", at))
    not_delivered = ((_c("is_marketplace") == 1) & _open_after("delivered_date", at)) | ((_c("is_marketplace") == 0) & retail_open)
    return t["order_items"].filter(
        (_c("order_creation_date") > start) & (_c("is_prepayment") == 1) & _c("finance_verified_date").between(start, at)
        & not_delivered & _open_after("refund_date", at)
    ).select(
        "company_code", "is_prepayment", "order_item_id", "order_nr", "customer_id", "current_status",
        F.when(_c("current_status") == "closed", 1).otherwise(0).alias("is_closed"), "is_marketplace", "payment_method",
        "order_creation_date", "finance_verified_date", "delivered_date", "package_delivery_date", "refund_date",
        (_or_zero("unit_price") - _or_zero("coupon_value") - _or_zero("cart_rule_discount")).alias("paid_for_items"),
        _or_zero("paid_price").alias("paid_price"), _paid_shipping().alias("paid_for_shipping"),
    )


def accrued_revenue(t: Tables, cutoff: str, since: str = "2020-01-01", level_1: str = "Revenues") -> DataFrame:
    """Seller revenue transactions created in the cutoff month whose statement is not closed in it."""
    first, following = cutoff_lit(as_date(cutoff).replace(day=1)), cutoff_lit(next_month_first(cutoff))
    transactions = t["seller_transactions"].filter(
        (_c("created_date") > cutoff_lit(since)) & (_c("created_date") >= first) & (_c("created_date") < following)
    )
    levels = t["asg_levels"].filter(_c("level_1") == level_1)
    statements = t["seller_statements"].select(
        "company_code", _c("statement_id").cast("string").alias("lookup_key"), "statement_no", "start_date", "end_date", "paid"
    )
    revenue = transactions.join(levels, ["company_code", "asg_name"])
    stated = left_lookup(revenue, statements, _c("statement_id").cast("string"), ["transaction_id"], ["company_code"])
    return (
        stated.filter(_c("statement_id").isNull() | (_c("end_date") >= following))
        .join(t["vendors"], ["company_code", "vendor_id"], "left")
        .join(t["seller_transaction_types"], ["company_code", "transaction_id"], "left")
    )


def packages_unreconciled(t: Tables, cutoff: str, since: str = "2019-01-01") -> DataFrame:
    """Delivered items paid on delivery whose package is not settled at the cutoff."""
    at = cutoff_lit(cutoff)
    items = t["order_items"].filter(
        (_c("is_prepayment") == 0) & (_c("payment_method") != "NoPayment") & _c("delivered_date").between(cutoff_lit(since), at)
    )
    packages = t["package_cash"].withColumnRenamed("package_nr", "package_number")
    return (
        items.join(packages, ["company_code", "package_number"], "left").filter(_open_after("troubleshoot_date", at))
        .join(t["customer_types"], "customer_type_code", "left")
        .select(
            "company_code", "package_number", "payment_method", "is_marketplace", "order_nr", "order_item_id", "voucher_type", "customer_id",
            "order_creation_date", "shipped_date", "delivered_date", "package_delivery_date", "is_prepayment", "customer_type_l1",
            "amount_expected", "amount_received", "delivery_date", "package_status", "troubleshoot_date",
            _or_zero("amount_paid").alias("amount_paid"), _or_zero("paid_price").alias("paid_price"),
            (_paid_shipping() - _or_zero("delivery_rule_discount")).alias("paid_shipping"),
        )
    )


def refund_liability(t: Tables, cutoff: str, since: str = "2019-01-01", excluded: Sequence[str] = ()) -> DataFrame:
    """Refunded but not yet returned (positive) and returned but not yet refunded (negative)."""
    following = cutoff_lit(next_month_first(cutoff))
    end = F.lit(last_second_before(next_month_first(cutoff)).isoformat(sep=" ")).cast("timestamp_ntz")
    start = cutoff_lit(since)
    amount = (
        _or_zero("price_after_discount") + _or_zero("base_shipping") + _or_zero("customs_fee") - _or_zero("customs_rule_discount")
        - _or_zero("shipping_rule_discount") - F.when(_c("voucher_type") == "coupon", _or_zero("shipping_voucher_discount")).otherwise(0)
    )
    items = t["order_items"].filter(~_c("company_code").isin(*excluded)) if excluded else t["order_items"]
    pending = lambda c: _c(c).isNull() | (_c(c) >= following)
    refunded = _c("delivered_date").isNotNull() & _c("refund_date").between(start, end) & pending("return_date")
    returned = _c("return_date").between(start, end) & pending("refund_date")
    # The two cases exclude each other: in the first the refund lies in the period, in the second it does not.
    case = F.when(refunded, "Refunded not yet returned").when(returned, "Returned not yet refunded")
    return (
        items.withColumn("case_type", case).filter("case_type is not null")
        .withColumn("amount_to_refund", F.when(_c("case_type") == "Refunded not yet returned", amount).otherwise(-amount))
        .join(t["refund_no_return"], ["company_code", "order_item_id"], "left")
        .join(t["customer_types"], "customer_type_code", "left")
        .select(
            "company_code", "current_status", "case_type", "is_marketplace", "order_nr", "order_item_id", "customer_id", "return_date", "is_global",
            "finance_verified_date", "refund_date", "oms_type", "customer_type_l1", "amount_to_refund",
        )
    )


def _open_transactions(t: Tables, following: Column) -> DataFrame:
    packages, payments = t["packlist_packages"], t["packlist_payments"]
    paid = payments.filter("payment_reconciled_amount is not null").select("company_code", "packlist_no", F.lit(1).alias("paid")).distinct()
    waiting = packages.join(paid, ["company_code", "packlist_no"], "left").filter(
        (_c("packlist_status") == "waitingApproval") | ((_c("packlist_status") == "waitingConfirmation") & _c("paid").isNull())
    ).select("company_code", _c("packlist_no").alias("lookup_key"), F.lit(1).alias("waiting")).distinct()
    # Which deposit type a transaction type refers to; other types never match a deposit.
    kind = _c("transaction_type")
    deposit_kind = F.when(kind == "Transfer to", "Transfer").when(kind.isin("Third Party Collection", "Payment - Rev"), "Payment")
    deposits = t["cash_deposits"].select(
        "company_code", F.concat_ws("|", "deposit_type", "payment_no").alias("lookup_key"), "payment_date", "payment_reversal_date"
    )
    transactions = t["cash_transactions"].filter(~kind.isin(*CLOSED_TRANSACTION_TYPES) & (_c("amount") != 0))
    spread = ["related_entity", "amount", "created_date"]
    deposit_key = F.when(deposit_kind.isNotNull(), F.concat(deposit_kind, F.lit("|"), _c("related_entity")))
    marked = left_lookup(transactions, deposits, deposit_key, spread, ["company_code"])
    event = (
        F.when(kind.isin("Transfer to", "Third Party Collection"), F.coalesce("payment_date", "created_date"))
        .when(kind == "Payment - Rev", F.coalesce("payment_reversal_date", "created_date")).otherwise(_c("created_date"))
    )
    due = marked.withColumn("event_date", event).filter(_c("event_date") < following)
    listed = left_lookup(due, waiting, _c("transaction_list_nr"), spread, ["company_code"])
    return listed.filter(
        _c("transaction_list_nr").isNull() | (_c("transaction_list_date") >= following) | _c("waiting").isNotNull()
    ).select("company_code", "event_date", _c("collection_partner").alias("cp"), "transaction_type", "related_entity", "amount")


def _reallocations(t: Tables, following: Column) -> DataFrame:
    return t["reallocations"].filter(
        (_c("original_transaction_date") < following) & (_c("reallocated_transaction_date") >= following)
    ).select(
        "company_code", _c("original_transaction_date").alias("event_date"), _c("collection_partner_from").alias("cp"),
        "transaction_type", "related_entity", "amount",
    )


def _lists_in_progress(t: Tables, following: Column) -> DataFrame:
    payments = t["packlist_payments"]
    lists = payments.filter(
        (_c("packlist_created_date") < following) & _c("packlist_status").isin(*IN_PROGRESS) & _c("payment_reconciled_amount").isNotNull()
    ).select("company_code", "collection_partner", "packlist_no", "amount_received", "packlist_created_date").distinct()
    applied = payments.filter(_c("payment_date") < following).groupBy("company_code", "packlist_no").agg(
        F.sum(_or_zero("payment_reconciled_amount") + _or_zero("charges_reconciled_amount")).alias("applied")
    )
    force_closed = t["collection_adjustments"].filter(
        (_c("entity_type") == "packlist") & (_c("force_closed") == 1) & (_c("close_date").isNull() | (_c("close_date") < following))
    ).select("company_code", _c("entity_no").alias("packlist_no"))
    residual = _c("amount_received") - F.coalesce("applied", F.lit(0))
    return (
        lists.join(force_closed, ["company_code", "packlist_no"], "left_anti")
        .join(applied, ["company_code", "packlist_no"], "left").withColumn("amount", residual).filter("amount > 0")
        .select(
            "company_code", _c("packlist_created_date").alias("event_date"), _c("collection_partner").alias("cp"),
            F.lit("Translist in progress").alias("transaction_type"), _c("packlist_no").alias("related_entity"), "amount",
        )
    )


def _deposits_in_progress(t: Tables, following: Column) -> DataFrame:
    applied = t["packlist_payments"].filter(
        (_c("packlist_created_date") < following) & (_c("payment_date") < following) & _c("payment_status").isin(*IN_PROGRESS)
        & _c("payment_reconciled_amount").isNotNull()
    ).groupBy("company_code", "payment_no").agg(
        F.sum(_or_zero("payment_reconciled_amount") + _or_zero("charges_reconciled_amount")).alias("applied")
    )
    early = _c("close_date") < following
    # A deposit stays when no adjustment matches, or one matches without a force-closed flag.
    closed = t["collection_adjustments"].filter(
        (_c("entity_type") != "packlist") & (((_c("force_closed") == 1) & (early | _c("close_date").isNull())) | early)
    ).groupBy("company_code", _c("entity_no").alias("payment_no")).agg(F.bool_and(_c("force_closed").isNotNull()).alias("flagged")).filter("flagged")
    residual = _or_zero("payment_amount") + _or_zero("charges_amount") - F.coalesce("applied", F.lit(0))
    return (
        t["cash_deposits"].filter((_c("payment_date") < following) & _c("payment_status").isin(*IN_PROGRESS))
        .join(closed, ["company_code", "payment_no"], "left_anti")
        .join(applied, ["company_code", "payment_no"], "left").withColumn("residual", residual).filter("residual > 0")
        .select(
            "company_code", _c("payment_date").alias("event_date"), _c("collection_partner").alias("cp"),
            _c("deposit_type").alias("transaction_type"), _c("payment_no").alias("related_entity"), (-_c("residual")).alias("amount"),
        ).distinct()
    )


def collection_open_items(t: Tables, cutoff: str, excluded_countries: Sequence[str] = (), skipped_bank_account: str = "10058") -> DataFrame:
    """Open collection items: transactions, reallocations, lists and deposits in progress at the cutoff."""
    following_day = next_month_first(cutoff)
    following = cutoff_lit(following_day)
    parts = (_open_transactions, _reallocations, _lists_in_progress, _deposits_in_progress)
    items = reduce(DataFrame.unionByName, [part(t, following) for part in parts])
    company = t["company"].filter("in_scope = 1").select("company_code", _c("country_code").alias("company_country"))
    if excluded_countries:
        company = company.filter(~_c("company_country").isin(*excluded_countries))
    groups = t["bank_posting_groups"].select("company_code", _c("code").alias("posting_group_code"), "gl_bank_account_no")
    banks = t["bank_accounts"].filter("provider_no is not null and provider_no <> ''").join(
        groups.filter(_c("gl_bank_account_no") != skipped_bank_account), ["company_code", "posting_group_code"]
    ).select("company_code", _c("provider_no").alias("erp_name"), "gl_bank_account_no").distinct()
    return (
        items.join(company, "company_code")
        .join(t["hubs"].withColumnRenamed("node", "cp"), ["company_code", "cp"], "left")
        .join(t["collection_partners"].withColumnRenamed("name", "cp"), ["company_code", "cp"], "left")
        .join(banks, ["company_code", "erp_name"], "left")
        .withColumn("closing_date", F.lit((last_second_before(following_day)).isoformat(sep=" ")).cast("timestamp_ntz"))
    )


def posting_group_of_provider(t: Tables) -> DataFrame:
    """One posting group per company and provider: the first in alphabetical order."""
    return t["bank_accounts"].filter("provider_no <> ''").groupBy("company_code", "provider_no").agg(
        F.min("posting_group_code").alias("posting_group_code")
    )


def channel_of_order(t: Tables) -> DataFrame:
    """Sales channel of each order: marketplace when its first item is, else retail."""
    first = F.min_by("is_marketplace", F.struct("item_no", "order_item_id", "is_marketplace"))
    return t["order_items"].groupBy("company_code", "order_nr").agg(
        F.when(first == 1, "MPL").otherwise("Retail").alias("channel")
    )


# Ledger accounts behind the extracts.
GL_ACCOUNTS = {
    "voucher_liability": ("18412",), "gl_accounts_cr_03": ("15010",), "customer_balances": ("13001", "13002", "13003"),
    "prepayments": ("18650", "18397"), "all_receivables": ("13001", "13002", "13003", "18412", "18650", "18397"),
}

# Dataset ids of the close and the extract behind each.
CATALOG = {
    "CR_03": ledger_open_items, "CR_04": balances_at_date, "CR_05": fx_closing, "CR_05a": fx_spot, "IPE_07": customer_open_items,
    "IPE_08": voucher_issuance, "IPE_08_TIMING": voucher_timing, "DOC_VOUCHER_USAGE": voucher_usage_monthly, "IPE_10": prepayments,
    "IPE_11": accrued_revenue, "IPE_12": packages_unreconciled, "IPE_31": collection_open_items, "IPE_34": refund_liability,
}

# Column that every extract must deliver besides at least one row.
_EXPECTED = {
    "CR_03": ("amount",), "CR_04": ("balance_at_date", "group_account_no"), "CR_05": ("company_code", "fx_rate"), "CR_05a": ("rate_amount",),
    "IPE_07": ("customer_id", "posting_group"), "IPE_08": ("remaining_amount", "id"), "IPE_08_TIMING": ("voucher_id", "status"),
    "DOC_VOUCHER_USAGE": ("total_amount_used",), "IPE_10": ("company_code",), "IPE_11": ("company_code",), "IPE_12": ("company_code",),
    "IPE_31": ("company_code",), "IPE_34": ("company_code",),
}


def catalog_rules(dataset: str) -> list[QualityRule]:
    """Quality rules of an extract: at least one row, and its expected columns."""
    return [RowCountCheck(1), *[ColumnExistsCheck(c) for c in _EXPECTED[dataset]]]


# Contract column of each extract column whose names differ; company_code is id_company everywhere but in CR_05.
CONTRACT_NAMES = {
    "CR_03": {
        "group_account_no": "group_coa_account_no", "group_account_name": "group_coa_account_name", "gl_account": "chart_of_accounts_no",
        "description": "document_description", "in_scope": "flg_in_conso_scope", "entry_type": "entrytype",
    },
    "CR_04": {"group_account_no": "group_coa_account_no"},
    "CR_05": {"country_code": "company_country", "rate_year": "year", "rate_month": "cod_month"},
    "CR_05a": {"rate_amount": "relational_exch_rate_amount"},
    "IPE_07": {
        "customer_id": "customer_no", "posting_group": "customer_posting_group", "remaining_amount_lcy": "rem_amt_lcy", "amount_lcy": "original_amount_lcy",
        "business_line_code": "busline_code", "auto_integrated": "automatically_integrated", "current_posting_group": "currentpostinggroup",
        "vertical_1": "busline_vertical_name_1", "vertical_2": "busline_vertical_name_2", "vertical_3": "busline_vertical_name_3",
        "debit_credit_due_month": "debit_credit_duemonth",
    },
    "IPE_08": {"total_amount_used": "totalamountused", "total_remaining_amount": "totalremainingamount"},
    "DOC_VOUCHER_USAGE": {"total_amount_used": "totalamountused"},
    "IPE_10": {"order_item_id": "cod_oms_sales_order_item", "customer_id": "bob_id_customer"},
    "IPE_11": {
        "transaction_id": "sc_id_transaction", "created_date": "sc_created_date", "transaction_amount": "sc_transaction_amount", "transaction_no": "sc_transaction_no",
        "transaction_type_name": "sc_transaction_type", "asg_name": "sc_asg_name", "nav_type": "sc_nav_type", "created_manually": "sc_created_manually",
        "vendor_id": "bob_id_vendor", "vendor_name": "sc_vendor_name", "statement_id": "sc_id_account_statement", "statement_no": "sc_transaction_statement_no",
        "start_date": "sc_start_date", "end_date": "sc_end_date", "paid": "sc_paid", "level_1": "asg_level_1", "level_2": "asg_level_2", "level_3": "asg_level_3",
    },
    "IPE_12": {
        "package_number": "cod_oms_id_package", "customer_id": "bob_id_customer", "customer_type_l1": "customer_type", "package_status": "package_status_cashrec",
        "troubleshoot_date": "troubleshoot_resolution_date",
    },
    "IPE_31": {"partner_type": "type", "gl_bank_account_no": "g_l_bank_account_no"},
    "IPE_34": {"customer_id": "bob_id_customer", "amount_to_refund": "amounttorefund"},
}


def in_contract_names(dataset: str, extract: DataFrame) -> DataFrame:
    """The extract with the column names of its contract; columns without a contract column keep theirs."""
    names = dict(CONTRACT_NAMES[dataset])
    if dataset != "CR_05":
        names["company_code"] = "id_company"
    return extract.withColumnsRenamed(names)
