"""Ledger and target pivots at the common grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closewright.functions.labels import harmonize_voucher_type
from closewright.operators.joins import stack_frames
from closewright.operators.naming import amount_column, require_columns

GRAIN = ("country_code", "category", "voucher_type")
TOTAL = "__TOTAL__"


def target_lines(tables: DataFrame | Sequence[DataFrame], amount: str = "amount_local", default_category: str = "Voucher") -> DataFrame:
    """Target rows of all sources with harmonised type and a numeric amount, ready to sum or drill into."""
    lines = tables if isinstance(tables, DataFrame) else stack_frames(list(tables))
    require_columns(lines, ["country_code", "voucher_type", amount], "target values")
    if "category" not in lines.columns:
        lines = lines.withColumn("category", F.lit(default_category))
    return lines.withColumns({
        "voucher_type": harmonize_voucher_type("voucher_type"), "amount_local": amount_column(lines, amount)
    })


def target_pivot(
    tables: DataFrame | Sequence[DataFrame], amount: str = "amount_local", keys: Sequence[str] = GRAIN,
    default_category: str = "Voucher",
) -> DataFrame:
    """Σ target amount by bucket; null keys form their own bucket."""
    return target_lines(tables, amount, default_category).groupBy(*keys).agg(F.sum("amount_local").alias("tv_amount_local"))


def nav_lines(classified: DataFrame) -> DataFrame:
    """Classified ledger rows with the bucket labels of the pivot and their local amount."""
    require_columns(classified, ["bridge_category", "voucher_type", "amount"], "classified ledger")
    return classified.withColumns({
        "category": F.coalesce("bridge_category", F.lit("Uncategorized")),
        "voucher_type": harmonize_voucher_type("voucher_type"),
        "amount_local": amount_column(classified, "amount", fill=None),
    })


def nav_pivot(lines: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    """Σ ledger amount by bucket, at country grain so that it can meet the targets."""
    return lines.groupBy(*keys).agg(F.coalesce(F.sum("amount_local"), F.lit(0)).alias("nav_amount_local"))


def nav_pivot_with_total(lines: DataFrame) -> DataFrame:
    """Category × type with amount, non-null count and a grand-total row, from one pass."""
    keys = [F.col("category"), F.col("voucher_type")]
    grouped = lines.groupingSets([keys, []], *keys).agg(
        F.grouping_id().alias("level"), F.coalesce(F.sum("amount_local"), F.lit(0)).alias("amount_local"),
        F.count("amount_local").alias("row_count"),
    )
    total = F.col("level") != 0
    return grouped.select(
        F.when(total, TOTAL).otherwise(F.col("category")).alias("category"),
        F.when(total, "").otherwise(F.col("voucher_type")).alias("voucher_type"), "amount_local", "row_count",
    )


def frequencies(df: DataFrame, column: str, keep_null: bool = True) -> DataFrame:
    rows = df if keep_null else df.filter(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count("*").alias("rows"))
