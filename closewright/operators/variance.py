"""Ledger against targets: variance, USD, status, drilldown and the review table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closewright.functions.labels import COMPANY_OVERRIDES, country_to_company
from closewright.operators.fx import with_usd
from closewright.operators.naming import column_or_null, first_existing, require_columns
from closewright.operators.pivots import GRAIN
from closewright.operators.thresholds import BUCKET, CONTRACTS, LINE_ITEM, ThresholdContract, with_threshold

INVESTIGATE, OK = "INVESTIGATE", "OK"


def variance_pivot(nav: DataFrame, targets: DataFrame, rates: DataFrame, overrides: Mapping[str, str] = COMPANY_OVERRIDES) -> DataFrame:
    """Full outer join of both pivots on null-safe keys, variance = ledger − target, in local and USD."""
    n, t = nav.alias("n"), targets.alias("t")
    same = F.lit(True)
    for key in GRAIN:
        same = same & F.col(f"n.{key}").eqNullSafe(F.col(f"t.{key}"))
    money = lambda c: F.coalesce(F.col(c), F.lit(0))
    joined = n.join(t, same, "full").select(
        *[F.coalesce(F.col(f"n.{k}"), F.col(f"t.{k}")).alias(k) for k in GRAIN],
        money("n.nav_amount_local").alias("nav_amount_local"), money("t.tv_amount_local").alias("tv_amount_local"),
    ).withColumn("variance_amount_local", F.col("nav_amount_local") - F.col("tv_amount_local"))
    amounts = {f"{x}_amount_local": f"{x}_amount_usd" for x in ("nav", "tv", "variance")}
    return with_usd(joined, amounts, country_to_company(F.col("country_code"), overrides), rates, keep_rate=True)


def with_status(variance: DataFrame, gl_account: str, contracts: Sequence[ThresholdContract] = CONTRACTS) -> DataFrame:
    """Bucket threshold and status; below the threshold is OK, a null variance is investigated."""
    return judge(with_threshold(variance, BUCKET, gl_account, contracts))


def judge(resolved: DataFrame) -> DataFrame:
    """Status of buckets whose `threshold` is resolved, by compiled contracts or by a table of rules."""
    below = F.abs(F.col("variance_amount_usd")) < F.col("threshold.value_usd")
    return resolved.withColumns({
        "threshold_usd": F.col("threshold.value_usd"),
        "status": F.when(below, OK).otherwise(INVESTIGATE),
        "threshold_contract_version": F.col("threshold.contract_version"),
        "threshold_contract_hash": F.col("threshold.contract_hash"),
        "threshold_rule_description": F.col("threshold.rule_description"),
        "threshold_source": F.col("threshold.source"),
        "threshold_specificity": F.col("threshold.specificity"),
    }).drop("threshold")


def missing_fx_by_country(variance: DataFrame) -> DataFrame:
    """Buckets without a rate, counted per country in one pass."""
    return variance.groupBy("country_code").agg(
        F.count_if("fx_missing").alias("buckets_without_rate"), F.count("*").alias("buckets")
    )


def _signed(value: Column, side: str, wanted: str) -> Column:
    return value if side == wanted else F.lit(None).cast("double")


def line_items(
    buckets: DataFrame, lines: DataFrame, side: str, gl_account: str, rates: DataFrame,
    contracts: Sequence[ThresholdContract] = CONTRACTS, overrides: Mapping[str, str] = COMPANY_OVERRIDES,
    only_material: bool = False,
) -> DataFrame:
    """Source rows of the flagged buckets with USD amount and materiality.

    `side` is "nav" or "tv". One equi-join replaces a loop over buckets. Bucket keys are few and
    each holds many rows, so the lines should not be shuffled on them: pass staged buckets, whose
    file size lets the optimizer broadcast them. Otherwise adaptive execution decides from the
    measured size and splits hot buckets.
    """
    flagged = buckets.filter(F.col("status") == INVESTIGATE).select(
        *[F.col(k).alias(f"_{k}") for k in GRAIN], F.col("threshold_usd").alias("bucket_threshold_usd"),
        "threshold_contract_version", "threshold_contract_hash",
    )
    use = first_existing(lines, ["business_use", "business_use_formatted"])
    if side == "tv" and "voucher_type" not in lines.columns and use:
        lines = lines.withColumn("voucher_type", F.lower(use))
    # A source without one of the keys matches every bucket on the others.
    present = [k for k in GRAIN if k in lines.columns]
    require_columns(lines, ["amount_local", "country_code"], f"{side} lines")
    match = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in present])
    source = lines.select(
        *present, column_or_null(lines, ["voucher_no"] if side == "nav" else ["id", "voucher_id", "voucher_no"]).cast("string").alias("voucher_id"),
        (column_or_null(lines, ["document_no"]) if side == "nav" else F.lit(None)).cast("string").alias("document_no"),
        F.coalesce("amount_local", F.lit(0)).alias("amount_local"),
    )
    hit = source.join(flagged, match, "inner").withColumns({k: F.col(f"_{k}") for k in GRAIN})
    priced = with_usd(hit, {"amount_local": "amount_usd"}, country_to_company(F.col("country_code"), overrides), rates)
    resolved = with_threshold(priced, LINE_ITEM, gl_account, contracts)
    local, in_usd = F.col("amount_local").cast("double"), F.col("amount_usd")
    material = F.abs(in_usd) >= F.col("threshold.value_usd")
    out = resolved.select(
        "country_code", F.lit(gl_account).alias("gl_account"), "category", "voucher_type",
        F.lit("line_item").alias("row_type"), "voucher_id", "document_no",
        _signed(local, side, "nav").alias("nav_amount_local"), _signed(local, side, "tv").alias("tv_amount_local"),
        local.alias("variance_amount_local"),
        _signed(in_usd, side, "nav").alias("nav_amount_usd"), _signed(in_usd, side, "tv").alias("tv_amount_usd"),
        in_usd.alias("variance_amount_usd"), "bucket_threshold_usd", F.lit(INVESTIGATE).alias("bucket_status"),
        F.col("threshold.value_usd").alias("line_item_threshold_usd"), material.alias("line_item_material"),
        "threshold_contract_version", "threshold_contract_hash",
        F.col("threshold.rule_description").alias("threshold_rule_description"),
    )
    return out.filter("line_item_material") if only_material else out


def bucket_summaries(buckets: DataFrame, gl_account: str) -> DataFrame:
    """Flagged buckets in the shape of the review table."""
    money = lambda c: F.col(c).cast("double").alias(c)
    null = lambda dtype, name: F.lit(None).cast(dtype).alias(name)
    return buckets.filter(F.col("status") == INVESTIGATE).select(
        "country_code", F.lit(gl_account).alias("gl_account"), "category", "voucher_type",
        F.lit("bucket_summary").alias("row_type"), null("string", "voucher_id"), null("string", "document_no"),
        *[money(f"{x}_amount_{unit}") for unit in ("local", "usd") for x in ("nav", "tv", "variance")],
        F.col("threshold_usd").alias("bucket_threshold_usd"), F.lit(INVESTIGATE).alias("bucket_status"),
        null("double", "line_item_threshold_usd"), null("boolean", "line_item_material"),
        "threshold_contract_version", "threshold_contract_hash", "threshold_rule_description",
    )


def review_table(
    buckets: DataFrame, gl_account: str, rates: DataFrame | None = None, nav: DataFrame | None = None,
    targets: DataFrame | None = None, contracts: Sequence[ThresholdContract] = CONTRACTS,
    overrides: Mapping[str, str] = COMPANY_OVERRIDES, only_material: bool = False,
) -> DataFrame:
    """Flagged buckets and, where line sources are given, their line items.

    Sort the result with `joins.order_rows` where an order is wanted.
    """
    if (nav is not None or targets is not None) and rates is None:
        raise ValueError("rates are needed for the line items")
    out = bucket_summaries(buckets, gl_account)
    for side, lines in (("nav", nav), ("tv", targets)):
        if lines is not None:
            items = line_items(buckets, lines, side, gl_account, rates, contracts, overrides, only_material)
            out = out.unionByName(items)
    return out


REVIEW_ORDER = ("country_code", "category", "voucher_type", "row_type", "voucher_id")
