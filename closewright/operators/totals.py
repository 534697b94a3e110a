"""Reconciliation totals: actuals against the sum of the target components."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closewright.functions.text import to_number
from closewright.operators.joins import beside
from closewright.operators.naming import first_existing
from closewright.operators.thresholds import BUCKET, CONTRACTS, ThresholdContract, resolve_threshold

# Components of the target values and the legacy tolerance.
COMPONENTS = ("IPE_07", "IPE_10", "IPE_08", "IPE_31", "IPE_34", "IPE_12")
ACTUALS = "CR_04"
LEGACY_TOLERANCE = 1000
ACTUAL_COLUMNS = ("BALANCE_AT_DATE", "balance_at_date", "Balance_At_Date", "balance", "Amount")
COMPONENT_COLUMNS = ("Amount", "amount", "Remaining Amount", "remaining_amount", "BALANCE_AT_DATE", "Balance", "Sum of Grand Total")


def component_total(df: DataFrame, dataset: str, columns: Sequence[str]) -> DataFrame | None:
    """(component, total): Σ of the first present amount column, null when nothing reads as a number."""
    name = first_existing(df, columns)
    if name is None:
        return None
    value = to_number(F.col(f"`{name}`"), df.schema[name].dataType)
    return df.agg(F.sum(value).cast("decimal(38,2)").alias("total")).select(F.lit(dataset).alias("component"), "total")


def component_totals(datasets: Mapping[str, DataFrame], components: Sequence[str] = COMPONENTS) -> DataFrame | None:
    """One row per component with a readable amount."""
    parts = [component_total(datasets[c], c, COMPONENT_COLUMNS) for c in components if c in datasets]
    parts = [p for p in parts if p is not None]
    return reduce(DataFrame.union, parts).filter("total is not null") if parts else None


def status_of(df: DataFrame, tolerance) -> DataFrame:
    """Add variance, abs_variance, threshold, status and is_reconciled to (actuals, target_values)."""
    inside = F.col("abs_variance") < F.col("threshold")
    return df.withColumn("variance", F.col("actuals") - F.col("target_values")).withColumns({
        "abs_variance": F.abs("variance"), "threshold": tolerance,
    }).withColumns({
        "status": F.when(inside, "RECONCILED").when(~inside, "VARIANCE_DETECTED"), "is_reconciled": inside,
    })


def reconciliation_totals(datasets: Mapping[str, DataFrame], tolerance: float = LEGACY_TOLERANCE) -> DataFrame:
    """One row: actuals, target values, variance and status against the fixed tolerance.

    Without actuals the variance and status stay null.
    """
    spark_frames = [datasets[k] for k in (ACTUALS, *COMPONENTS) if k in datasets]
    if not spark_frames:
        raise ValueError("no dataset to total")
    actuals = component_total(datasets[ACTUALS], ACTUALS, ACTUAL_COLUMNS) if ACTUALS in datasets else None
    targets = component_totals(datasets)
    none = spark_frames[0].agg(F.lit(None).cast("decimal(38,2)").alias("total"))
    left = (actuals if actuals is not None else none).select(F.col("total").alias("actuals"))
    right = (targets if targets is not None else none).agg(F.coalesce(F.sum("total"), F.lit(0)).cast("decimal(38,2)").alias("target_values"))
    return status_of(beside(left, right), F.lit(float(tolerance)))


def catalog_status(totals: DataFrame, country: str, gl_account: str | None = None, contracts: Sequence[ThresholdContract] = CONTRACTS) -> DataFrame:
    """Status of (actuals, target_values) against the country's bucket threshold."""
    found = totals.withColumn("_t", resolve_threshold(BUCKET, F.lit(country), F.lit(gl_account).cast("string"), contracts=contracts))
    return status_of(found, F.col("_t.value_usd")).withColumns({
        "threshold_contract_version": F.col("_t.contract_version"), "threshold_rule_description": F.col("_t.rule_description")
    }).drop("_t")
