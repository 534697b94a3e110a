"""One query per operator, over the sample tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StructField, StructType

from closewright.functions import (
    country_to_company, due_month_label, gl_description, harmonize_voucher_type, is_iso_date, month_first, month_last, number_is_invalid, to_number, to_timestamp,
    voucher_key, year_month_text, yyyymm,
)
from closewright.operators import audit, bridge_rules, bridges, cascade, changes, conform, distinct, evidence, fx, joins, lookup, naming, pivots, quality, scope, threshold_table, totals, upkeep
from closewright.operators import thresholds as th
from closewright.operators import variance as var
from closewright.plans import extracts as ex
from closewright.sources import io, layout, staging
from closewright.sources.contract_tables import CONTRACTS as DECLARED
from closewright.sources.contracts import FAIL_ON_NULL, FILL_ZERO, Contract, Field
from closewright.sources.sample_views import SampleTables

CUTOFF = "1998-09-30"
BATCH_USER = "CORP/SVC.BATCH"
ACCOUNT = "18412"
STORE_COUNTRIES = ("C07", "C11", "C20")
OVERRIDES = {"C01": "JM_C01", "C02": "JD_C02"}
COMPANIES = ("JM_C01", "JD_C02", "EC_C04", "EC_C07", "EC_C10", "EC_C15", "EC_C20")
EXCLUDED = ("EC_C05", "EC_C09")
GROUPS = ("BUILDING", "MACHINERY", "1-URGENT", "5-LOW")

# A country contract with rules of every specificity.
CONTRACTS = (
    th.DEFAULT_CONTRACT,
    th.ThresholdContract("C01", 1, "1998-01-01", "Sample country contract", (
        th.ThresholdRule(th.BUCKET, 50000.0, "account rule", gl_accounts=("18412",)),
        th.ThresholdRule(th.BUCKET, 2500000.0, "usage rule", gl_accounts=("18412",), categories=("Usage",)),
        th.ThresholdRule(th.BUCKET, 10.0, "usage refund rule", gl_accounts=("18412",), categories=("Usage",), voucher_types=("refund",)),
        th.ThresholdRule(th.LINE_ITEM, 5000.0, "line rule", gl_accounts=("18412",)),
    )),
    th.ThresholdContract("C02", 1, "1998-01-01", "Contract of another account", (
        th.ThresholdRule(th.BUCKET, 7.0, "other account", gl_accounts=("13003",)),
    )),
)

OPS_CONTRACT = Contract("OPS_USAGE", 1, (
    Field("voucher_id", "id", True, ("Voucher Id",)), Field("amount_used", "amount", True, ("Amount Used",), fill=FILL_ZERO), Field("usage_date", "date", False, ("Usage Date",), fill=FAIL_ON_NULL),
    Field("order_id", "id"), Field("status", "code", True, ("Status",)),
), ("voucher_id",))


def plain(df: DataFrame) -> DataFrame:
    """Result types every engine shares: decimals as double, dates as timestamps."""
    wanted = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, DateType):
            c = c.cast("timestamp_ntz")
        wanted.append(c.alias(f.name))
    return df.select(*wanted)


QUERIES: dict[str, Callable[[SampleTables], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def classified(t) -> DataFrame:
    return cascade.classify_ledger(t["gl_entries"], t["vouchers"], t["voucher_usage"], BATCH_USER, ACCOUNT, STORE_COUNTRIES)


def voucher_ledger(t) -> DataFrame:
    """Classified rows of the voucher account."""
    return scope.on_account(classified(t), ACCOUNT)


def target_sources(t) -> list[DataFrame]:
    issued = t["vouchers"].select("country_code", F.lit("Issuance").alias("category"), F.col("business_use").alias("voucher_type"), F.col("remaining_amount").alias("amount_local"), "id")
    used = t["vouchers"].filter("is_active = 0").select("country_code", F.lit("Usage").alias("category"), F.col("business_use").alias("voucher_type"), F.col("total_amount_used").alias("amount_local"), "id")
    return [issued, used]


def rates(t) -> DataFrame:
    return fx.rate_table(t["fx_rates"])


def variance(t) -> DataFrame:
    nav = pivots.nav_pivot(pivots.nav_lines(voucher_ledger(t)))
    return var.variance_pivot(nav, pivots.target_pivot(target_sources(t)), rates(t), OVERRIDES)


def buckets(t) -> DataFrame:
    return var.with_status(variance(t), ACCOUNT, CONTRACTS)


def staged_review(t) -> tuple[DataFrame, DataFrame]:
    """Ledger lines and buckets, each computed once: lines feed the pivot and the drilldown."""
    lines = pivots.nav_lines(voucher_ledger(t)).select(*pivots.GRAIN, "amount_local", "voucher_no", "document_no")
    lines = staging.staged(lines, "nav_lines")
    pivot = var.variance_pivot(pivots.nav_pivot(lines), pivots.target_pivot(target_sources(t)), rates(t), OVERRIDES)
    return lines, staging.staged(var.with_status(pivot, ACCOUNT, CONTRACTS), "buckets")


# --- classification -------------------------------------------------------------------------

@query
def gl_classified(t):
    return classified(t).select("entry_no", "gl_account", "amount", "integration_type", "bridge_category", "voucher_type")


@query
def gl_cascade_types(t):
    return classified(t).groupBy("gl_account", "integration_type", "bridge_category", "voucher_type").agg(
        F.count("*").alias("rows"), F.sum("amount").alias("amount")
    )


@query
def gl_category_counts(t):
    return cascade.classification_counts(classified(t))


@query
def gl_category_totals(t):
    return cascade.classification_totals(classified(t))


@query
def gl_invalid_pairs(t):
    return cascade.invalid_pairs(classified(t))


@query
def lookup_voucher_type(t):
    found = lookup.lookup_voucher_type(
        t["gl_entries"], t["vouchers"], t["voucher_usage"], F.col("voucher_no"), F.col("document_no"), ["entry_no", "amount", "posting_date"]
    )
    return found.groupBy("lookup_stage", "lookup_type").agg(F.count("*").alias("rows"), F.sum("amount").alias("amount"))


# --- scope ----------------------------------------------------------------------------------

@query
def scope_non_marketing(t):
    return scope.voucher_scope(t["vouchers"]).select("id", "business_use", "remaining_amount")


@query
def scope_account(t):
    return scope.on_account(t["gl_entries"], ACCOUNT).groupBy("gl_account").agg(F.count("*").alias("rows"), F.sum("amount").alias("amount"))


@query
def scope_company(t):
    return scope.of_company(t["gl_entries"], "JM_C01").select("entry_no", "company_code", "amount")


@query
def scope_rolling_year(t):
    return scope.created_in_rolling_year(t["vouchers"], CUTOFF).agg(
        F.count("*").alias("vouchers"), F.min("created_at").alias("first_day"), F.max("created_at").alias("last_day"), F.sum("total_amount_used").alias("amount")
    )


@query
def scope_inactive_month(t):
    return scope.inactive_in_month(t["vouchers"], CUTOFF).select("id", "inactive_at")


@query
def scope_null_keys_dropped(t):
    return scope.with_keys(t["cle"], ["customer_id", "business_line_code"]).groupBy("business_line_code").agg(F.count("*").alias("rows"))


@query
def drilldown_view(t):
    return scope.drilldown_view(classified(t), "Usage", "C01")


@query
def voucher_details(t):
    wanted = t["vouchers"].filter("business_use = 'refund' and is_active = 0").select("id")
    return scope.voucher_details(t["gl_entries"], wanted).select("entry_no", "voucher_no", "amount")


@query
def first_voucher_line(t):
    return scope.first_voucher_line(t["gl_entries"], "300", ["posting_date", "entry_no", "amount"]).select("entry_no", "voucher_no", "posting_date", "amount")


@query
def non_marketing_frequencies(t):
    return scope.use_frequencies(t["vouchers"])


@query
def non_marketing_summary(t):
    return scope.use_totals(t["vouchers"])


# --- scalar functions -----------------------------------------------------------------------

@query
def numeric_coercion(t):
    read = t["ops_usage"].select("voucher_id", to_number("amount_used").alias("amount"), number_is_invalid("amount_used").alias("invalid"), to_number("amount_used", fill=0).alias("filled"))
    return read.groupBy("voucher_id").agg(
        F.count("*").alias("rows"), F.count("amount").alias("readable"), F.count_if("invalid").alias("invalid"), F.sum("filled").alias("amount")
    )


@query
def amount_columns_cast(t):
    return naming.cast_matching_amounts(t["ops_usage"], "amount", fill=0).groupBy("usage_date").agg(F.sum("amount_used").alias("amount"))


@query
def date_functions(t):
    return t["order_items"].select(
        "order_item_id", "order_nr", month_first("shipped_date").alias("month_start"), month_last("shipped_date").alias("month_end"), yyyymm("shipped_date").alias("yyyymm"),
        year_month_text("delivered_date").alias("delivered_ym"), due_month_label("delivered_date", CUTOFF).alias("due_label"),
        (F.col("shipped_date") - F.expr("interval 1 second")).alias("second_before"),
    )


@query
def date_parsing(t):
    day = F.date_format("posting_date", "yyyy-MM-dd")
    other = F.date_format("posting_date", "d/M/yyyy")
    compact = F.date_format("posting_date", "yyyyMMdd")
    kind = F.col("entry_no") % 4
    text = F.when(kind == 0, day).when(kind == 1, other).when(kind == 2, compact).otherwise(F.concat(F.lit("x"), day))
    return t["gl_entries"].select(kind.alias("kind"), text.alias("text"), "posting_date").select(
        "kind", to_timestamp("text").alias("parsed"), is_iso_date("text").alias("iso"), (to_timestamp("text") == F.col("posting_date")).alias("same")
    ).groupBy("kind", "iso", "same").agg(F.count("*").alias("rows"), F.min("parsed").alias("first_day"))


@query
def key_normalise(t):
    key = F.concat(F.lit(" a"), F.col("order_nr"), F.lit(" "))
    floaty = F.concat(F.col("order_nr"), F.lit(".0"))
    return t["order_items"].select("order_nr", "item_no", voucher_key(F.when(F.col("item_no") % 2 == 0, key).otherwise(floaty)).alias("voucher_key"), voucher_key(F.lit("  ")).isNull().alias("blank_is_null"))


@query
def harmonise_type(t):
    return t["voucher_usage"].select("business_use", harmonize_voucher_type("business_use").alias("voucher_type")).groupBy("business_use", "voucher_type").agg(F.count("*").alias("rows"))


@query
def gl_account_names(t):
    return t["gl_entries"].select("gl_account", gl_description("gl_account").alias("account_name")).groupBy("gl_account", "account_name").agg(F.count("*").alias("rows"))


@query
def country_company_map(t):
    return t["company"].select("country_code", country_to_company("country_code", OVERRIDES).alias("fx_company"))


# --- currency -------------------------------------------------------------------------------

@query
def fx_conversion(t):
    return fx.with_usd(t["gl_entries"], {"amount": "amount_usd"}, F.col("company_code"), rates(t), keep_rate=True).select(
        "entry_no", "company_code", "amount", "amount_usd", "fx_rate_used", "fx_missing"
    )


@query
def fx_duplicate_rates(t):
    return fx.duplicate_rates(t["fx_rates"].unionByName(t["fx_rates"].filter("company_code like '%1'")))


@query
def fx_from_currency(t):
    return fx.company_rate_from_currency(t["fx_spot"], "JM_C01", "Q01")


# --- pivots, variance, review ---------------------------------------------------------------

@query
def nav_pivot(t):
    return pivots.nav_pivot(pivots.nav_lines(voucher_ledger(t)))


@query
def nav_pivot_total(t):
    return pivots.nav_pivot_with_total(pivots.nav_lines(voucher_ledger(t)))


@query
def tv_pivot(t):
    return pivots.target_pivot(target_sources(t))


@query
def union_mixed(t):
    plain_rows = t["vouchers"].filter("is_active = 0").select("country_code", F.col("business_use").alias("voucher_type"), F.col("remaining_amount").alias("amount_local"))
    return pivots.target_pivot([target_sources(t)[0], plain_rows])


@query
def variance_usd(t):
    return variance(t)


@query
def variance_status(t):
    return buckets(t)


@query
def variance_status_by_table(t):
    """The same status with the contracts as a table of rules."""
    rules = threshold_table.rules_in_force(threshold_table.rule_table(t["company"].sparkSession, CONTRACTS))
    return var.judge(threshold_table.resolved(variance(t), rules, th.BUCKET, ACCOUNT))


@query
def variance_missing_fx(t):
    return var.missing_fx_by_country(variance(t))


@query
def line_items_nav(t):
    lines, flagged = staged_review(t)
    return var.line_items(flagged, lines, "nav", ACCOUNT, rates(t), CONTRACTS, OVERRIDES, only_material=True)


@query
def review_table(t):
    lines, flagged = staged_review(t)
    return var.review_table(flagged, ACCOUNT, rates(t), lines, pivots.target_lines(target_sources(t)), CONTRACTS, OVERRIDES)


@query
def variance_ordered(t):
    return joins.order_rows(variance(t).select("country_code", "category", "voucher_type", "variance_amount_local"), pivots.GRAIN)


# --- bridges --------------------------------------------------------------------------------

@query
def timing_bridge(t):
    return bridges.timing_difference(t["ops_usage"], t["vouchers"], CUTOFF)


@query
def timing_total(t):
    return bridges.timing_total(bridges.timing_difference(t["ops_usage"], t["vouchers"], CUTOFF))


@query
def usage_by_voucher(t):
    return bridges.usage_by_voucher(t["ops_usage"])


@query
def vtc_unmatched(t):
    return bridges.unmatched_refunds(t["vouchers"], voucher_ledger(t), CUTOFF).select("id", "company_code", "remaining_amount")


@query
def vtc_amount(t):
    total = bridges.vtc_total(bridges.unmatched_refunds(t["vouchers"], voucher_ledger(t), CUTOFF), rates(t))
    return total.withColumn("amount_usd", F.round("amount_usd", 2))


@query
def vtc_metrics(t):
    return bridges.vtc_metrics(t["vouchers"], voucher_ledger(t), CUTOFF)


@query
def vtc_breakdown(t):
    return pivots.frequencies(bridges.unmatched_refunds(t["vouchers"], voucher_ledger(t), CUTOFF), "business_use", keep_null=False)


@query
def posting_group_conflicts(t):
    return bridges.posting_group_conflicts(t["cle"])


@query
def business_line_reclass(t):
    return bridges.business_line_reclass(t["cle"]).drop("reasoning")


@query
def business_line_reasoning(t):
    return bridges.business_line_reclass(t["cle"]).select("customer_id", "business_line_code", "reasoning")


@query
def adjustment_by_target(t):
    return bridges.adjustment_by_target(t["gl_entries"].filter("user_id like 'USER%'"), "gl_account", "amount")


@query
def bridge_summary(t):
    timing = bridges.timing_total(bridges.timing_difference(t["ops_usage"], t["vouchers"], CUTOFF))
    vtc = bridges.vtc_total(bridges.unmatched_refunds(t["vouchers"], voucher_ledger(t), CUTOFF))
    return bridges.bridge_summary([
        ("TIMING_DIFFERENCE", timing, F.col("variance"), F.col("vouchers")), ("VTC", vtc, F.col("amount_local"), F.col("vouchers"))
    ])


def bridge_rows(t) -> DataFrame:
    tx = t["cash_transactions"].select("company_code", "transaction_type", F.lit(None).cast("double").alias("IS_PREPAYMENT"), "amount")
    items = t["order_items"].select("company_code", F.when(F.col("refund_date").isNotNull(), "REFUND").alias("transaction_type"), F.col("is_prepayment").cast("double").alias("IS_PREPAYMENT"), F.col("unit_price").alias("amount"))
    return tx.unionByName(items)


@query
def rule_bridges(t):
    return bridge_rules.classify_bridges(bridge_rows(t)).groupBy("bridge_key", "bridge_title", "dr_gl_accounts", "cr_gl_accounts", "required_enrichments").agg(
        F.count("*").alias("rows"), F.sum("amount").alias("amount")
    )


@query
def rule_bridges_by_table(t):
    """The same bridges with the rules as a table. Rows are summed by what the rules ask for, so that only a few sums are looked up."""
    rules = bridge_rules.rule_table(t["company"].sparkSession)
    summed = bridge_rows(t).groupBy("transaction_type", "IS_PREPAYMENT").agg(F.count("*").alias("rows"), F.sum("amount").alias("amount"))
    summed = staging.staged(summed, "bridge-sums")
    return bridge_rules.classify_by_table(summed, rules, ("transaction_type", "is_prepayment", "source", "entity")).groupBy(
        "bridge_key", "bridge_title", "dr_gl_accounts", "cr_gl_accounts", "required_enrichments"
    ).agg(F.sum("rows").alias("rows"), F.sum("amount").alias("amount"))


@query
def rule_bridge_counts(t):
    return bridge_rules.bridge_counts(bridge_rules.classify_bridges(bridge_rows(t)))


# --- catalog extracts -----------------------------------------------------------------------

@query
def ledger_open_items(t):
    return ex.ledger_open_items(t, "1998-01-01", "1998-12-31", ["15010", "18412"])


@query
def balances_at_date(t):
    return ex.balances_at_date(t, CUTOFF, ["18412"])


@query
def fx_closing(t):
    return ex.fx_closing(t, 1998, 9)


@query
def fx_spot(t):
    return ex.fx_spot(t, CUTOFF, ["Q01", "Q02", "Q04", "Q07", "Q10", "Q15"])


@query
def customer_open_items(t):
    return ex.customer_open_items(t, CUTOFF, GROUPS)


@query
def voucher_issuance(t):
    return ex.voucher_issuance(t, CUTOFF, COMPANIES, issued_after="1995-06-30", delivered_after_year=1995)


@query
def voucher_timing(t):
    return ex.voucher_timing(t, CUTOFF)


@query
def voucher_usage_monthly(t):
    return ex.voucher_usage_monthly(t, CUTOFF, COMPANIES, delivered_after_year=1995)


@query
def prepayments(t):
    return ex.prepayments(t, CUTOFF, since="1995-06-01")


@query
def accrued_revenue(t):
    return ex.accrued_revenue(t, CUTOFF, since="1995-01-01")


@query
def packages_unreconciled(t):
    return ex.packages_unreconciled(t, CUTOFF, since="1995-06-01")


@query
def collection_open_items(t):
    return ex.collection_open_items(t, CUTOFF, excluded_countries=("C05", "C09"))


@query
def refund_liability(t):
    return ex.refund_liability(t, CUTOFF, since="1996-01-01", excluded=EXCLUDED)


@query
def posting_group_of_provider(t):
    return ex.posting_group_of_provider(t)


@query
def channel_of_order(t):
    return ex.channel_of_order(t)


# --- audits and quality ---------------------------------------------------------------------

@query
def dup_rows_left(t):
    return audit.duplicated_rows(t["lineitem"], ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query
def merge_audit(t):
    right = t["lineitem"].withColumnRenamed("l_orderkey", "o_orderkey")
    return audit.merge_audit(t["orders"], right, ["o_orderkey"], "orders_lines")


@query
def merge_key_overlap(t):
    left = t["ops_usage"].select(F.col("voucher_id").alias("id"))
    return audit.merge_key_overlap(left, t["vouchers"].filter("is_active = 0").select("id"), ["id"], "ops_vouchers")


@query
def merge_key_sets(t):
    left = t["ops_usage"].select(F.col("voucher_id").alias("id"))
    return audit.key_sets(left, t["vouchers"].filter("is_active = 0").select("id"), ["id"])


@query
def table_probe(t):
    return audit.table_probe(t["gl_entries"], "gl_entries", "amount", "posting_date", ["document_no", "voucher_no"])


@query
def probe_metrics(t):
    return audit.probe_metrics(t["gl_entries"], "ledger", ["amount", "voucher_no"]).withColumn("value", F.round("value", 4))


@query
def describe_amounts(t):
    described = audit.describe_numeric(t["lineitem"], ["l_quantity", "l_discount"])
    return described.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")})


@query
def table_summary(t):
    return audit.table_summary(t["orders"], "orders").select("table", "rows", "column")


GL_RULES = (
    quality.RowCountCheck(1), quality.RowCountCheck(1, 10), quality.ColumnExistsCheck("amount"), quality.ColumnExistsCheck("fx_rate"),
    quality.NumericSumCheck("amount", should_be_zero=False), quality.NumericSumCheck("amount", should_be_zero=True),
    quality.NumericSumCheck("user_id", should_be_zero=True), quality.NoNullsCheck("entry_no"), quality.NoNullsCheck("voucher_no"),
    quality.DTypeCheck("amount", "float64"), quality.DTypeCheck("posting_date", "float64"), quality.DateRangeCheck("posting_date", "1990-01-01", "2005-01-01"),
    quality.DateRangeCheck("posting_date", "1998-01-01", None), quality.SemanticValidityCheck("amount", "amount"),
    quality.SemanticValidityCheck("description", "amount"), quality.SemanticValidityCheck("voucher_no", "id"), quality.SemanticValidityCheck("entry_no", "key"),
    quality.SemanticValidityCheck("posting_date", "date"), quality.SemanticValidityCheck("comment", "name"),
)


@query
def quality_report(t):
    return quality.run_quality(t["gl_entries"], GL_RULES, "gl_entries").drop("detail")


@query
def quality_details(t):
    rules = (quality.RowCountCheck(1), quality.NoNullsCheck("voucher_no"), quality.DateRangeCheck("posting_date", "1998-01-01", None))
    return quality.run_quality(t["gl_entries"], rules, "gl_entries").select("rule_no", "rule", "detail")


@query
def quality_status(t):
    return quality.quality_status(quality.run_quality(t["gl_entries"], GL_RULES, "gl_entries"))


@query
def catalog_quality(t):
    made = {
        "IPE_10": prepayments(t), "IPE_34": refund_liability(t), "IPE_12": packages_unreconciled(t), "CR_04": balances_at_date(t),
    }
    return joins.stack_frames([quality.run_quality(df, ex.catalog_rules(name), name) for name, df in made.items()]).select("table", "rule", "column", "passed")


@query
def pk_violations(t):
    return quality.primary_key_violations(t["gl_entries"], ["company_code", "entry_no"])


@query
def control_totals(t):
    extract = t["vouchers"].filter("is_active = 0")
    expected = t["orders"].filter("o_orderstatus <> 'O'")
    return quality.control_totals(extract, expected, t["vouchers"].filter("business_use = 'refund'"), t["vouchers"].filter("is_active = 1"), ["id"])


@query
def usage_validation(t):
    return quality.usage_validation(t["ops_usage"])


# --- contracts and evidence -----------------------------------------------------------------

@query
def conform_rows(t):
    raw = t["ops_usage"].withColumnsRenamed({"voucher_id": "Voucher Id", "amount_used": "Amount Used", "usage_date": "Usage Date"})
    return conform.conform(raw.withColumn("Status", F.lit(" none ")), OPS_CONTRACT)


@query
def conform_report(t):
    raw = t["ops_usage"].withColumnsRenamed({"voucher_id": "Voucher Id", "amount_used": "Amount Used", "usage_date": "Usage Date"})
    return conform.conform_report(raw, OPS_CONTRACT)


@query
def ingest_projection(t):
    target = StructType([StructField("document_no", t["gl_entries"].schema["document_no"].dataType), StructField("amount", DecimalType(20, 4)), StructField("description", t["gl_entries"].schema["description"].dataType)])
    dirty = t["gl_entries"].withColumn("description", F.concat("description", F.lit("\r\n")))
    return io.ingest(dirty, target)


@query
def lineage_columns(t):
    from datetime import datetime

    return evidence.with_lineage(t["company"].select("company_code"), "CR_05", datetime(1998, 10, 2, 3, 4, 5), CUTOFF)


@query
def dataset_fingerprint(t):
    return evidence.fingerprint(t["gl_entries"], "gl_entries")


@query
def fingerprint_verified(t):
    recorded = evidence.fingerprint(t["vouchers"], "vouchers")
    shuffled, changed = t["vouchers"].repartition(7, "business_use"), t["vouchers"].withColumn("remaining_amount", F.when(F.col("is_active") == 1, F.col("remaining_amount")).otherwise(0).cast("decimal(18,2)"))
    checked = [evidence.verify_fingerprint(df, recorded, "vouchers").withColumn("copy", F.lit(copy)) for copy, df in (("shuffled", shuffled), ("changed", changed))]
    return joins.stack_frames(checked).select("copy", "dataset", "data_rows", "recorded_rows", "verified")


EXTRACTS = {
    "CR_03": "ledger_open_items", "CR_04": "balances_at_date", "CR_05": "fx_closing", "CR_05a": "fx_spot", "IPE_07": "customer_open_items", "IPE_08": "voucher_issuance",
    "DOC_VOUCHER_USAGE": "voucher_usage_monthly", "IPE_10": "prepayments", "IPE_11": "accrued_revenue", "IPE_12": "packages_unreconciled", "IPE_31": "collection_open_items",
    "IPE_34": "refund_liability",
}


def conformed_extract(t, dataset: str) -> DataFrame:
    """An extract under its contract: names, required columns, types."""
    return conform.conform(ex.in_contract_names(dataset, QUERIES[EXTRACTS[dataset]](t)), DECLARED[dataset], drop_unknown=True)


def register_conformed(dataset: str) -> None:
    def run(t) -> DataFrame:
        return conformed_extract(t, dataset)

    run.__name__ = f"conformed_{dataset.lower()}"
    run.__doc__ = f"{dataset} under its contract, all columns."
    query(run)


for _dataset in EXTRACTS:
    register_conformed(_dataset)


@query
def conform_preset_report(t):
    """The tracked preset: conformed rows and the report of what changed."""
    raw = t["ops_usage"].withColumnsRenamed({"voucher_id": "Voucher Id", "amount_used": "Amount Used", "usage_date": "Usage Date"})
    rows, report = conform.conform_as(raw, OPS_CONTRACT, "audit_mode")
    counted = rows.groupBy(F.lit("rows").alias("name")).agg(F.count("*").alias("n"))
    return joins.stack_frames([report.select(F.col("column").alias("name"), F.col("nulls_after").alias("n")), counted])


@query
def conformed_extracts(t):
    """Rows of each extract that conforms to its contract; a missing required column would raise."""
    t = t.with_lines_staged()
    counted = [conformed_extract(t, name).agg(F.count("*").alias("rows"), *[F.count(k).alias(f"k{n}") for n, k in enumerate(DECLARED[name].primary_keys[:1])]) for name in EXTRACTS]
    return joins.stack_frames([df.select(F.lit(name).alias("dataset_id"), "rows", F.col("k0").alias("keyed_rows")) for name, df in zip(EXTRACTS, counted)])


def awkward_text(t) -> DataFrame:
    """Ledger lines with line breaks, quotes, separators, padding, empty texts and nulls in their description."""
    kind = F.pmod(F.col("entry_no"), F.lit(8))
    text = F.col("description")
    return t["gl_entries"].select(
        F.col("entry_no").cast("string").alias("entry_no"),
        F.when(kind == 0, F.concat(text, F.lit("\nsecond line"))).when(kind == 1, F.concat(F.lit('say "'), text, F.lit('"\r\n,end\n'))).when(kind == 2, F.lit(""))
        .when(kind == 3, F.lit(None)).when(kind == 4, F.concat(F.lit("  "), text, F.lit(", ;\\ "))).otherwise(text).alias("note"),
        F.col("document_no"),
    )


def written_and_resolved(t, df: DataFrame, dataset: str) -> DataFrame:
    """A frame written as CSV into a folder of source files and found there."""
    spark = t["gl_entries"].sparkSession
    folder = f"{staging.shared_folder(spark)}/sources-{uuid.uuid4().hex}"
    io.write_csv(df, f"{folder}/{dataset}.csv")
    found, place = io.resolve_dataset(spark, dataset, folder=folder, company="C01")
    return found.withColumn("place", F.lit(place))


@query
def csv_round_trip(t):
    """Texts with line breaks, quotes, empty and null, written as CSV into the shared folder, resolved there and read back."""
    return written_and_resolved(t, awkward_text(t), "CR_03")


@query
def csv_short_rows(t):
    """CSV lines with too few fields are filled with nulls; lines with too many are kept apart."""
    spark = t["gl_entries"].sparkSession
    path = f"{staging.shared_folder(spark)}/short-rows-{uuid.uuid4().hex}"
    entry, document = F.col("entry_no").cast("string"), F.col("document_no")
    line = F.when(F.col("entry_no") % 3 == 0, entry).when(F.col("entry_no") % 3 == 1, F.concat_ws(",", entry, document)).otherwise(F.concat_ws(",", entry, document, F.lit("a"), F.lit("b")))
    # Each file of lines begins with the header, as in a folder of exports. Tasks write lines as they come: files of a fixed
    # number, in order, would each be one task that sorts its share of all lines.
    t["gl_entries"].select(line.alias("entry_no,document_no,note")).write.option("header", True).option("quote", "").csv(path, sep="\u0001")
    read = io.read_csv(spark, path, ["entry_no", "document_no", "note"])
    return io.good_rows(read).withColumn("bad", F.lit(False)).union(io.bad_rows(read).select("entry_no", "document_no", F.lit(None).cast("string"), F.lit(True)))


@query
def csv_conformed(t):
    """Operational usage as CSV under other headings, read back under its contract."""
    spark = t["ops_usage"].sparkSession
    path = f"{staging.shared_folder(spark)}/ops-usage-{uuid.uuid4().hex}"
    io.write_csv(t["ops_usage"].select(F.col("voucher_id").alias("Voucher Id"), F.col("amount_used").alias("Amount Used"), F.lit("kept\nas it is").alias("note")), path)
    return io.read_conformed_csv(spark, path, "OPS_USAGE").select("voucher_id", "amount_used", "note")


@query
def ledger_of_periods(t):
    """Ledger lines written by company and month, read for selected companies and months only."""
    spark = t["gl_entries"].sparkSession
    path = f"{staging.shared_folder(spark)}/ledger-by-period-{uuid.uuid4().hex}"
    layout.write_by_period(t["gl_entries"].select("company_code", "posting_date", "entry_no", "amount"), path)
    chosen = t["company"].filter(F.col("company_code").isin(*COMPANIES)).select("company_code")
    return layout.read_by_period(spark, path, chosen, 199501, 199612)


@query
def timing_bucketed(t):
    """Issued vouchers against their summed use, from tables bucketed by voucher key."""
    spark = t["vouchers"].sparkSession
    names = [f"bucketed_{uuid.uuid4().hex}" for _ in range(2)]
    paths = [f"{staging.shared_folder(spark)}/{name}" for name in names]
    vouchers = layout.bucketed_vouchers(t["vouchers"].select("id", "total_amount_used"), names[0], 16, paths[0])
    usage = layout.bucketed_usage(t["ops_usage"], names[1], 16, paths[1])
    return layout.used_against_issued(vouchers, usage).select("id", "total_amount_used", "ops_amount_used")


@query
def changed_ledger_rows(t):
    """Lines that were lost, changed or added between two states of the ledger, by a tree of digests over key ranges."""
    # Written once: both states are read twice, each time by a join of all lines to their orders otherwise.
    now = staging.staged(t["gl_entries"].select("entry_no", "document_no", "amount"), "ledger-lines")
    before = now.filter("entry_no % 997 <> 3").withColumn("amount", F.when(F.col("entry_no") % 991 == 5, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(18,2)"))
    before = before.union(now.filter("entry_no % 983 = 7").withColumn("entry_no", -F.col("entry_no")))
    return changes.changed_rows(before, now, changes.digest_tree(before, ["entry_no"]), changes.digest_tree(now, ["entry_no"]), ["entry_no"]).select("entry_no", "change")


@query
def distinct_by_bitmap(t):
    """Exact distinct counts of several ledger columns by company, in one pass."""
    return distinct.distinct_counts(t["gl_entries"], ["document_no", "voucher_no", "user_id", "gl_account"], by=["company_code"])


@query
def targets_kept_up(t):
    """Stored target sums after late vouchers and deleted ones."""
    lines = t["vouchers"].select("country_code", F.col("business_use").alias("voucher_type"), F.lit("Issuance").alias("category"), F.col("remaining_amount").alias("amount_local"), F.col("id").cast("long").alias("k"))
    moved = upkeep.changes_of(lines.filter("k % 7 = 0"), lines.filter("k % 13 = 0"))
    return upkeep.merged(upkeep.sums_of(lines.filter("k % 7 <> 0")), moved)


@query
def run_audit_row(t):
    return evidence.run_record(t["company"], "company", "select * from company", {"cutoff": CUTOFF, "account": ACCOUNT}, "SUCCESS", datetime(1998, 10, 2)).select(
        "dataset", "data_rows", "query_text", "params", "validation_status"
    )


# --- totals, sorts and limits ---------------------------------------------------------------

def close_datasets(t) -> dict[str, DataFrame]:
    return {
        "CR_04": ex.balances_at_date(t, CUTOFF, ["18412"]), "IPE_08": t["vouchers"].select("id", "remaining_amount"),
        "IPE_10": ex.prepayments(t, CUTOFF, since="1995-06-01").withColumnRenamed("paid_price", "Amount"),
        "IPE_31": ex.collection_open_items(t, CUTOFF, excluded_countries=("C05", "C09")), "IPE_07": customer_open_items(t), "IPE_12": packages_unreconciled(t), "IPE_34": refund_liability(t),
    }


@query
def reconciliation_totals(t):
    return totals.reconciliation_totals(close_datasets(t))


@query
def component_totals(t):
    return totals.component_totals(close_datasets(t))


@query
def catalog_status(t):
    sums = totals.reconciliation_totals(close_datasets(t)).select("actuals", "target_values")
    return totals.catalog_status(sums, "C01", ACCOUNT, CONTRACTS)


@query
def top_lines(t):
    return joins.head_rows(t["gl_entries"].select("amount", "entry_no", "document_no", "posting_date"), ["amount", "entry_no", "posting_date"], 100)


@query
def last_lines(t):
    return joins.tail_rows(t["gl_entries"].select("amount", "entry_no", "document_no", "posting_date"), ["amount", "entry_no", "posting_date"], 100)


@query
def report_size(t):
    return io.report_rows(t["gl_entries"], ["entry_no"], 1000)[1]


@query
def named_parameters(t):
    return io.run_query(
        t["company"].sparkSession, "select company_code, sum(amount) as amount from {gl} where posting_date <= cast(:cutoff as timestamp_ntz) group by company_code",
        {"cutoff": CUTOFF}, {"gl": t["gl_entries"]},
    )


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(QUERIES[name](SampleTables(spark, folder)))

    run.__name__ = name
    return run
