"""Join helpers that stay balanced on skewed keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_key(key: Column, spread_by: Sequence[Column | str]) -> Column:
    """The key where present; a row-dependent text where it is null.

    Null keys of an outer join would all hash to one partition. They cannot match, so any
    deterministic text does, and the join condition still asks for a non-null key.
    """
    return F.coalesce(key.cast("string"), F.concat(F.lit("\0"), F.xxhash64(*spread_by).cast("string")))


def own_shuffle(key: Column) -> Column:
    """A key equal where `key` is equal, but by which no side is partitioned yet."""
    return F.concat(key.cast("string"), F.lit("|"))


def left_lookup(left: DataFrame, right: DataFrame, key: Column, spread_by: Sequence[str], also_on: Sequence[str] = ()) -> DataFrame:
    """Left join on a text key that may often be null, plus further equal columns.

    `right` names its key `lookup_key`; that column is not kept. `also_on` are equal columns
    present on both sides; the left copy is kept. Both sides join on a key derived from the text:
    `right` is mostly an aggregate by `lookup_key`, and only a join that shuffles it anew can be
    split by adaptive skew join where a key is hot.
    """
    keyed = left.withColumns({"_key": key, "_spread": own_shuffle(spread_key(key, spread_by))})
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in also_on}).withColumn("lookup_key", own_shuffle(F.col("lookup_key")))
    condition = (F.col("_spread") == F.col("lookup_key")) & F.col("_key").isNotNull()
    for c in also_on:
        condition = condition & (F.col(c) == F.col(f"_r_{c}"))
    return keyed.join(renamed, condition, "left").drop("_key", "_spread", "lookup_key", *[f"_r_{c}" for c in also_on])


def keys_as_one(keys: Sequence[str]) -> Column:
    """One text of several keys, null if one is; a join on it has a shuffle of its own on both sides."""
    return own_shuffle(F.concat(*[part for k in keys for part in (F.col(k).cast("string"), F.lit("\0"))]))


def semi_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `left` whose keys (none null) stand in `right`; a hot key of `left` can be split by adaptive skew join."""
    key = keys_as_one(keys)
    return left.withColumn("_semi", key).join(right.select(key.alias("_semi")), "_semi", "left_semi").drop("_semi")


def order_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full sort with nulls last; a range-partitioned sort, so it scales with the cluster."""
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys])


def stack_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column absent from one frame is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def beside(*one_row: DataFrame) -> DataFrame:
    """One-row totals side by side, without a join: stacked, then folded into one row."""
    stacked = stack_frames(one_row)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def head_rows(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """First n rows by an explicit order."""
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys]).limit(n)


def tail_rows(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Last n rows by an explicit order, returned from the last."""
    return df.orderBy(*[F.col(k).desc_nulls_first() for k in keys]).limit(n)
