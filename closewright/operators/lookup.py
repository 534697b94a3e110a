"""Voucher-type lookup of ledger rows against issued and used vouchers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closewright.functions.text import blank_to_null
from closewright.operators.joins import left_lookup
from closewright.operators.naming import column_or_null


def _candidates(source: DataFrame, key: str, rank: int) -> DataFrame:
    return source.select(
        blank_to_null(column_or_null(source, [key])).alias("lookup_key"),
        column_or_null(source, ["business_use"]).alias("type"), F.lit(rank).alias("rank"),
    ).filter("lookup_key is not null")


def _best_per_key(candidates: DataFrame, prefix: str) -> DataFrame:
    """One row per key: lowest source rank, then the first type in alphabetical order, null last."""
    order = F.struct("rank", F.col("type").isNull().alias("no_type"), "type")
    # Repeated rows go by a hash aggregate; the least of the few left needs a sort, as text does.
    return candidates.distinct().groupBy("lookup_key").agg(F.min(order).alias("best")).select(
        "lookup_key", F.col("best.rank").alias(f"{prefix}_rank"), F.col("best.type").alias(f"{prefix}_found")
    )


def lookup_voucher_type(
    rows: DataFrame, issuance: DataFrame, usage: DataFrame, voucher_no: Column, document_no: Column, spread_by: list[str]
) -> DataFrame:
    """Add `lookup_stage` (1-4, null when nothing matched) and `lookup_type`.

    Stages: issued voucher id, used voucher id, used transaction, issued transaction. The first
    match decides even when its type is null. The two id stages share one join and the two
    transaction stages another; rows already matched, or without a key, carry a null key into
    the second join and are spread over all partitions.
    """
    by_voucher = _best_per_key(_candidates(issuance, "id", 1).union(_candidates(usage, "id", 2)), "voucher")
    by_document = _best_per_key(
        _candidates(usage, "transaction_no", 3).union(_candidates(issuance, "transaction_no", 4)), "document"
    )
    keyed = rows.withColumns({"_voucher": blank_to_null(voucher_no), "_document": blank_to_null(document_no)})
    first = left_lookup(keyed, by_voucher, F.col("_voucher"), spread_by)
    open_document = F.when(F.col("voucher_rank").isNull(), F.col("_document"))
    second = left_lookup(first, by_document, open_document, spread_by)
    return second.withColumns({
        "lookup_stage": F.coalesce("voucher_rank", "document_rank"),
        "lookup_type": F.when(F.col("voucher_rank").isNotNull(), F.col("voucher_found")).otherwise(F.col("document_found")),
    }).drop("_voucher", "_document", "voucher_rank", "voucher_found", "document_rank", "document_found")
