"""Pivots and variance kept up to date: late and corrected lines as signed changes of stored sums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closewright.functions.labels import COMPANY_OVERRIDES
from closewright.operators import variance
from closewright.operators.pivots import GRAIN
from closewright.operators.thresholds import CONTRACTS, ThresholdContract

SIDES = ("nav", "tv")


def sums_of(lines: DataFrame, keys: Sequence[str] = GRAIN, amount: str = "amount_local") -> DataFrame:
    """Buckets with their exact sum, non-null count and rows: what is stored, and merges by adding."""
    return lines.groupBy(*keys).agg(F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(38,2)").alias("amount"), F.count(amount).alias("valued"), F.count("*").alias("lines"))


def changes_of(inserted: DataFrame | None, deleted: DataFrame | None, keys: Sequence[str] = GRAIN, amount: str = "amount_local") -> DataFrame:
    """Signed changes of buckets. A corrected line is deleted as it was and inserted as it is."""
    parts = []
    for lines, sign in ((inserted, 1), (deleted, -1)):
        if lines is not None:
            held = sums_of(lines, keys, amount)
            parts.append(held.select(*keys, *[(F.col(c) * sign).cast(held.schema[c].dataType).alias(c) for c in ("amount", "valued", "lines")]))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return _added(both, keys)


def _added(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("amount").cast("decimal(38,2)").alias("amount"), F.sum("valued").alias("valued"), F.sum("lines").alias("lines"))


def merged(stored: DataFrame, changes: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    """The stored sums with the changes added; a bucket without lines goes. Null keys are keys."""
    return _added(stored.unionByName(changes), keys).filter("lines <> 0")


def _same(keys: Sequence[str], left: str, right: str):
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return out


def only_touched(rows: DataFrame, touched: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    """The rows of the touched buckets."""
    return rows.alias("r").join(touched.select(*keys).distinct().alias("t"), _same(keys, "r", "t"), "left_semi")


def untouched(rows: DataFrame, touched: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    return rows.alias("r").join(touched.select(*keys).distinct().alias("t"), _same(keys, "r", "t"), "left_anti")


def judged(nav: DataFrame, tv: DataFrame, rates: DataFrame, gl_account: str, contracts: Sequence[ThresholdContract] = CONTRACTS, overrides: Mapping[str, str] = COMPANY_OVERRIDES) -> DataFrame:
    """Variance and status of stored sums of both sides."""
    ledger = nav.select(*GRAIN, F.col("amount").alias("nav_amount_local"))
    targets = tv.select(*GRAIN, F.col("amount").alias("tv_amount_local"))
    return variance.with_status(variance.variance_pivot(ledger, targets, rates, overrides), gl_account, contracts)


def updated(
    before: DataFrame, nav: DataFrame, tv: DataFrame, nav_changes: DataFrame | None, tv_changes: DataFrame | None, rates: DataFrame, gl_account: str,
    contracts: Sequence[ThresholdContract] = CONTRACTS, overrides: Mapping[str, str] = COMPANY_OVERRIDES,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(judged buckets, stored sums of the ledger, of the targets, touched buckets) after the changes.

    `before` are the judged buckets so far. Only touched buckets are compared and judged again; all others are taken as
    they were. A changed rate or rule touches every bucket, so then judge anew.
    """
    parts = [c.select(*GRAIN) for c in (nav_changes, tv_changes) if c is not None]
    touched = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
    touched = touched.distinct()
    new_nav = merged(nav, nav_changes) if nav_changes is not None else nav
    new_tv = merged(tv, tv_changes) if tv_changes is not None else tv
    again = judged(only_touched(new_nav, touched), only_touched(new_tv, touched), rates, gl_account, contracts, overrides)
    return untouched(before, touched).unionByName(again), new_nav, new_tv, touched


def review_again(review: DataFrame, touched: DataFrame, again: DataFrame, keys: Sequence[str] = GRAIN) -> DataFrame:
    """A review table whose touched buckets' rows are replaced by those made again."""
    return untouched(review, touched, keys).unionByName(again)
