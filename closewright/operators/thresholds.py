"""Threshold contracts, resolved by one CASE in order of precedence."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, LINE_ITEM, COUNTRY = "BUCKET_USD", "LINE_ITEM_USD", "COUNTRY_MATERIALITY_USD"
DEFAULT = "DEFAULT"

# Thresholds when no contract applies.
FALLBACK_USD = {BUCKET: 1000.0, LINE_ITEM: 1000.0, COUNTRY: 10000.0}


@dataclass(frozen=True)
class ThresholdRule:
    threshold_type: str
    value_usd: float
    description: str
    gl_accounts: tuple[str, ...] = ()
    categories: tuple[str, ...] = ()
    voucher_types: tuple[str, ...] = ()

    def __post_init__(self):
        if self.threshold_type not in FALLBACK_USD:
            raise ValueError(f"unknown threshold type {self.threshold_type}")
        if self.value_usd < 0:
            raise ValueError("a threshold is not negative")

    @property
    def specificity(self) -> int:
        return sum(bool(scope) for scope in (self.gl_accounts, self.categories, self.voucher_types))


@dataclass(frozen=True)
class ThresholdContract:
    country_code: str
    version: int
    effective_date: str
    description: str
    rules: tuple[ThresholdRule, ...] = field(default_factory=tuple)

    def __post_init__(self):
        if self.version < 1 or not self.rules or not self.country_code:
            raise ValueError("a contract needs a country, a version from 1 and at least one rule")

    @property
    def content_hash(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()


# The default contract and the Egyptian one.
DEFAULT_CONTRACT = ThresholdContract(
    DEFAULT, 1, "2025-01-01", "Default thresholds",
    (
        ThresholdRule(BUCKET, 1000.0, "Default bucket variance threshold - investigate if abs(variance_usd) >= 1000"),
        ThresholdRule(LINE_ITEM, 500.0, "Default line-item materiality threshold for individual vouchers"),
        ThresholdRule(COUNTRY, 10000.0, "Default country-level materiality threshold (for aggregate reporting only)"),
    ),
)


def voucher_accrual_contract(country: str = "EG") -> ThresholdContract:
    return ThresholdContract(
        country, 1, "2025-01-01", "Thresholds for voucher accrual reconciliation",
        (
            ThresholdRule(BUCKET, 1000.0, "Voucher accrual bucket threshold for GL 18412", gl_accounts=("18412",)),
            ThresholdRule(LINE_ITEM, 5000.0, "Material line-item threshold for individual vouchers in GL 18412", gl_accounts=("18412",)),
            ThresholdRule(COUNTRY, 22000.0, "Egypt country-level materiality threshold (aggregate reporting only)"),
        ),
    )


CONTRACTS = (DEFAULT_CONTRACT, voucher_accrual_contract())


def latest_contracts(contracts: Sequence[ThresholdContract], version: int | None = None) -> dict[str, ThresholdContract]:
    """The pinned version of each country, or its highest."""
    chosen: dict[str, ThresholdContract] = {}
    for contract in sorted(contracts, key=lambda c: c.version):
        if version is None or contract.version == version:
            chosen[contract.country_code] = contract
    return chosen


def _in_scope(value: Column, allowed: tuple[str, ...]) -> Column:
    """A scoped rule also matches when the value is unknown (null or empty)."""
    return F.lit(True) if not allowed else value.isNull() | (value == "") | value.isin(*allowed)


def resolve_threshold(
    kind: str, country: Column, gl_account: Column | None = None, category: Column | None = None,
    voucher_type: Column | None = None, contracts: Sequence[ThresholdContract] = CONTRACTS, version: int | None = None,
) -> Column:
    """Struct of value_usd, contract_version, contract_hash, rule_description, source, specificity.

    The country contract beats the default contract, which beats the constant; inside a contract
    the most specific matching rule wins and ties keep contract order. Compiled to one CASE over
    the rules, so it needs no join.
    """
    unknown = F.lit(None).cast("string")
    gl_account, category, voucher_type = (unknown if c is None else c for c in (gl_account, category, voucher_type))
    chosen = latest_contracts(contracts, version)
    tiers = [c for code, c in chosen.items() if code != DEFAULT] + [c for code, c in chosen.items() if code == DEFAULT]

    def outcome(value, version_no, content_hash, text, source, specificity):
        return F.struct(
            F.lit(float(value)).alias("value_usd"), F.lit(version_no).cast("long").alias("contract_version"),
            F.lit(content_hash).alias("contract_hash"), F.lit(text).alias("rule_description"),
            F.lit(source).alias("source"), F.lit(specificity).cast("long").alias("specificity"),
        )

    case = None
    for contract in tiers:
        is_default = contract.country_code == DEFAULT
        rules = sorted((r for r in contract.rules if r.threshold_type == kind), key=lambda r: -r.specificity)
        for rule in rules:
            match = (
                _in_scope(gl_account, rule.gl_accounts) & _in_scope(category, rule.categories)
                & _in_scope(voucher_type, rule.voucher_types)
            )
            if not is_default:
                match = (country == contract.country_code) & match
            text = f"DEFAULT: {rule.description}" if is_default else rule.description
            result = outcome(rule.value_usd, contract.version, contract.content_hash, text, "catalog", rule.specificity)
            case = F.when(match, result) if case is None else case.when(match, result)
    value = FALLBACK_USD[kind]
    fallback = outcome(value, 0, "fallback", f"Hardcoded fallback: {value} USD", "fallback", 0)
    return fallback if case is None else case.otherwise(fallback)


def with_threshold(df: DataFrame, kind: str, gl_account: str, contracts: Sequence[ThresholdContract] = CONTRACTS, name: str = "threshold") -> DataFrame:
    """Add the resolved threshold of each row's bucket as a struct column."""
    return df.withColumn(
        name, resolve_threshold(kind, F.col("country_code"), F.lit(gl_account), F.col("category"), F.col("voucher_type"), contracts)
    )
