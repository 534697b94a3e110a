"""Layouts that spare later reads and shuffles: tables by company and period, and bucketed tables by voucher key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closewright.functions.text import blank_to_null, voucher_key
from closewright.operators.joins import spread_key
from closewright.operators.naming import OPS_USAGE_ALIASES, VOUCHER_ALIASES, amount_column, rename_first_existing

COMPANY, PERIOD = "company_partition", "period_partition"
KEY = "voucher_key"


def write_by_period(df: DataFrame, path: str, company: str = "company_code", date: str = "posting_date", mode: str = "error") -> None:
    """The table in one folder per company and month (yyyymm, 0 without a date).

    Rows are rebalanced by folder first: a company with very many rows gets several files, small folders one.
    """
    placed = df.withColumns({COMPANY: F.coalesce(F.col(company), F.lit("-")), PERIOD: F.coalesce(F.date_format(date, "yyyyMM").cast("int"), F.lit(0))})
    placed.hint("rebalance", COMPANY, PERIOD).write.mode(mode).partitionBy(COMPANY, PERIOD).parquet(path)


def read_by_period(spark: SparkSession, path: str, companies: DataFrame | Sequence[str] | None = None, first: int | None = None, last: int | None = None) -> DataFrame:
    """Rows of the companies and months wanted; no other folder is listed or read.

    `companies` is a list, or a frame whose first column names them: then its rows, known only when the query runs,
    prune the folders if it is a selection (a filter on a table of companies).
    """
    df = spark.read.parquet(path)
    if first is not None:
        df = df.filter(F.col(PERIOD) >= first)
    if last is not None:
        df = df.filter(F.col(PERIOD) <= last)
    if isinstance(companies, DataFrame):
        wanted = companies.select(F.col(f"`{companies.columns[0]}`").alias(COMPANY)).distinct()
        df = df.join(wanted, COMPANY, "left_semi")
    elif companies is not None:
        df = df.filter(F.col(COMPANY).isin(*companies))
    return df.drop(COMPANY, PERIOD)


def write_bucketed(df: DataFrame, table: str, key: str = KEY, buckets: int = 200, path: str | None = None) -> DataFrame:
    """The frame as a table of sorted buckets by a key; tables with equal buckets join by it without a shuffle.

    For tables with few rows a key: all rows of a key lie in one bucket. Null keys match nothing in a join, so callers
    spread them.
    """
    writer = df.repartition(buckets, F.col(key)).write.bucketBy(buckets, key).sortBy(key).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def _spread(key: Column, by: Sequence[str]) -> Column:
    """The key, or where it is null a text that matches no key, so that nulls fill no bucket."""
    return spread_key(key, by)


def bucketed_vouchers(issuance: DataFrame, table: str, buckets: int = 200, path: str | None = None) -> DataFrame:
    """Issued vouchers by normalised key. Ids are nearly unique, so buckets are even."""
    vouchers = rename_first_existing(issuance, VOUCHER_ALIASES)
    keyed = vouchers.withColumns({"matchable": voucher_key("id").isNotNull(), KEY: _spread(voucher_key("id"), ["id", *[c for c in vouchers.columns if c != "id"][:3]])})
    return write_bucketed(keyed, table, KEY, buckets, path)


def bucketed_usage(ops: DataFrame, table: str, buckets: int = 200, path: str | None = None) -> DataFrame:
    """Used amount by normalised voucher key, one row a key: summed before the write, so a hot voucher is one row."""
    known = rename_first_existing(ops, OPS_USAGE_ALIASES)
    used = known.select(voucher_key("voucher_id").alias(KEY), amount_column(known, "amount_used").alias("amount_used")).filter(F.col(KEY).isNotNull())
    return write_bucketed(used.groupBy(KEY).agg(F.sum("amount_used").alias("ops_amount_used")), table, KEY, buckets, path)


def bucketed_keys(keys: DataFrame, table: str, buckets: int = 200, path: str | None = None) -> DataFrame:
    """Distinct keys (the first column) as a bucketed table, as of cancelled vouchers."""
    return write_bucketed(keys.select(F.col(f"`{keys.columns[0]}`").alias(KEY)).filter(F.col(KEY).isNotNull()).distinct(), table, KEY, buckets, path)


def bucketed_types(issuance: DataFrame, usage: DataFrame, column: str, ranks: tuple[int, int], table: str, buckets: int = 200, path: str | None = None) -> DataFrame:
    """One row per lookup key (`column` of the issued and used vouchers) with its stage and type, as of the voucher-type lookup."""
    from closewright.operators.lookup import _best_per_key, _candidates

    both = _candidates(issuance, column, ranks[0]).union(_candidates(usage, column, ranks[1]))
    return write_bucketed(_best_per_key(both, "lookup").withColumnRenamed("lookup_key", KEY), table, KEY, buckets, path)


def used_against_issued(vouchers: DataFrame, usage: DataFrame) -> DataFrame:
    """Issued vouchers with their used amount (0 without), from bucketed tables: no shuffle."""
    met = vouchers.join(usage, KEY, "left")
    return met.withColumn("ops_amount_used", F.coalesce("ops_amount_used", F.lit(0).cast("decimal(18,2)")))


def without_keys(vouchers: DataFrame, keys: DataFrame) -> DataFrame:
    """Issued vouchers whose key is not among the keys, from bucketed tables: no shuffle."""
    return vouchers.join(keys, KEY, "left_anti")


def types_of_keys(keys: DataFrame, types: DataFrame) -> DataFrame:
    """Stage and type of each distinct key, from bucketed tables: no shuffle. Lines join the result by a key that can be split."""
    return keys.join(types, KEY, "left")


def line_keys(lines: DataFrame, column: str, table: str, buckets: int = 200, path: str | None = None) -> DataFrame:
    """The distinct lookup keys of ledger lines as a bucketed table: a voucher with very many lines is one row."""
    return bucketed_keys(lines.select(blank_to_null(F.col(column)).alias(KEY)), table, buckets, path)
