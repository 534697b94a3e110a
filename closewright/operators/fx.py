"""Currency conversion through one rate per company."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closewright.operators.naming import rename_first_existing, require_columns

FX_ALIASES = {"company_code": ("Company_Code", "ID_Company", "ID_COMPANY"), "fx_rate": ("FX_rate", "Exchange Rate")}


def rate_table(rates: DataFrame, latest_by: str | None = None) -> DataFrame:
    """One usable rate per company as (`rate_company`, `rate`).

    Null and zero rates are ignored. Of several rates the latest period wins, or the highest
    when no period column is named; `duplicate_rates` lists such companies.
    """
    known = rename_first_existing(rates, FX_ALIASES)
    require_columns(known, ["company_code", "fx_rate"], "FX rates")
    rate = F.col("fx_rate").cast("double")
    usable = known.filter(F.col("company_code").isNotNull() & rate.isNotNull() & ~F.isnan(rate) & (rate != 0))
    picked = F.max_by(rate, F.struct(latest_by, rate)) if latest_by else F.max(rate)
    return usable.groupBy(F.col("company_code").cast("string").alias("rate_company")).agg(picked.alias("rate"))


def duplicate_rates(rates: DataFrame) -> DataFrame:
    """Companies with more than one usable rate."""
    known = rename_first_existing(rates, FX_ALIASES)
    rate = F.col("fx_rate").cast("double")
    return (
        known.filter(F.col("company_code").isNotNull() & rate.isNotNull() & (rate != 0))
        .groupBy("company_code").agg(F.count("*").alias("rates")).filter("rates > 1")
    )


def usd(amount: Column, default_rate: float = 1.0) -> Column:
    """Amount over the joined `rate`; a missing rate reads as the default and a missing amount as 0."""
    return F.coalesce(amount.cast("double") / F.coalesce(F.col("rate"), F.lit(default_rate)), F.lit(0.0))


def with_usd(
    df: DataFrame, amounts: Mapping[str, str], company: Column, rates: DataFrame, default_rate: float = 1.0,
    keep_rate: bool = False,
) -> DataFrame:
    """Add USD columns (`amounts` maps a local column to its USD name).

    `rates` is the output of `rate_table`: one row per company, so the join never multiplies
    rows and its side is small enough for the optimizer to broadcast by file size.
    """
    joined = df.withColumn("_company", company.cast("string")).join(
        rates, F.col("_company") == F.col("rate_company"), "left"
    )
    out = joined.withColumns({name: usd(F.col(local), default_rate) for local, name in amounts.items()})
    if keep_rate:
        out = out.withColumns({"fx_rate_used": F.col("rate"), "fx_missing": F.col("rate").isNull()})
    return out.drop("_company", "rate_company", "rate")


def company_rate_from_currency(spot: DataFrame, company: str, currency: str) -> DataFrame:
    """Rate table of one company from currency-level rates; empty when no usable rate exists.

    The latest usable rate of the currency is taken.
    """
    known = rename_first_existing(spot, {
        "currency_code": ("Currency Code", "Currency", "currency"),
        "rate_amount": ("Relational Exch_ Rate Amount", "relational_exch_rate_amount", "Exchange Rate", "FX_rate"),
        "starting_date": ("Starting Date",),
    })
    rate = F.col("rate_amount").cast("double")
    usable = known.filter((F.upper("currency_code") == currency.upper()) & rate.isNotNull() & (rate != 0))
    best = F.max_by(rate, F.struct("starting_date", rate)) if "starting_date" in known.columns else F.max(rate)
    return usable.agg(best.alias("fx_rate")).filter("fx_rate is not null").select(F.lit(company).alias("company_code"), "fx_rate")
