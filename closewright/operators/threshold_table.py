"""Threshold resolution with the rules as a table: any number of rules, versions by date, one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closewright.operators.thresholds import BUCKET, CONTRACTS, DEFAULT, FALLBACK_USD, ThresholdContract

#: A bucket's value that is not known matches every rule's scope.
UNKNOWN = "\u0001unknown"
_SCOPES = ("gl_account", "category", "voucher_type")
SCHEMA = (
    "country_code string, version int, effective_date string, contract_hash string, ordinal int, threshold_type string, value_usd double, description string, "
    "gl_accounts array<string>, categories array<string>, voucher_types array<string>"
)


def rule_table(spark: SparkSession, contracts: Sequence[ThresholdContract] = CONTRACTS) -> DataFrame:
    """One row per rule of all contracts and versions; an empty scope is a wildcard. Users may keep such a table themselves."""
    rows = [
        (c.country_code, c.version, c.effective_date, c.content_hash, n, r.threshold_type, float(r.value_usd), r.description, list(r.gl_accounts), list(r.categories), list(r.voucher_types))
        for c in contracts for n, r in enumerate(c.rules)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def rules_in_force(rules: DataFrame, as_of: str | None = None, version: int | None = None) -> DataFrame:
    """The rules of one version of each country: the pinned one, that of the latest effective date up to `as_of`, or the highest."""
    able = rules if version is None else rules.filter(F.col("version") == version)
    if as_of is not None:
        able = able.filter(F.col("effective_date") <= as_of)
    newest = F.struct(*([F.col("effective_date")] if as_of is not None else []), "version")
    chosen = able.groupBy("country_code").agg(F.max(newest).alias("m")).select(F.col("country_code").alias("_country"), F.col("m.version").alias("_version"))
    return able.join(chosen, (F.col("country_code") == F.col("_country")) & (F.col("version") == F.col("_version"))).drop("_country", "_version")


def _mask(scoped: Sequence[Column]) -> Column:
    """Which scopes a rule restricts, as a number from 0 to 7."""
    out = F.lit(0)
    for k, c in enumerate(scoped):
        out = out + F.when(c, 1 << k).otherwise(0)
    return out.cast("int")


def rule_keys(rules: DataFrame, kind: str) -> DataFrame:
    """probe (country, mask of restricted scopes, value of each) and the best rule under it.

    A restricted scope is listed once for each of its values and once for an unknown one. Under one key all rules are
    equally specific, so the first of the contract stays.
    """
    scopes = [F.coalesce(c, F.array().cast("array<string>")) for c in (F.col("gl_accounts"), F.col("categories"), F.col("voucher_types"))]
    listed = rules.filter(F.col("threshold_type") == kind).withColumn("mask", _mask([F.size(s) > 0 for s in scopes]))
    for name, scope in zip(_SCOPES, scopes, strict=True):
        values = F.when(F.size(scope) > 0, F.array_union(scope, F.array(F.lit(UNKNOWN)))).otherwise(F.array(F.lit("")))
        listed = listed.withColumn(name, F.explode(values))
    rule = F.struct("ordinal", "value_usd", "version", "contract_hash", "description")
    return listed.groupBy(F.struct("country_code", "mask", *_SCOPES).alias("probe")).agg(F.min_by(rule, "ordinal").alias("rule"))


def resolved(df: DataFrame, rules: DataFrame, kind: str = BUCKET, gl_account: str | None = None, name: str = "threshold") -> DataFrame:
    """Add the threshold of each row as the struct that `resolve_threshold` gives, from a table of rules in force.

    The rows' distinct scopes probe one key for each mask that occurs and each of the two tiers, the country's rules and
    the default ones; the best match of a scope is a maximum. Rules and scopes meet by an equality join, so neither their
    number nor a scope that very many rows share changes the plan.
    """
    given = {
        "_country": F.col("country_code"), "_gl_account": F.lit(gl_account).cast("string") if gl_account is not None or "gl_account" not in df.columns else F.col("gl_account"),
        "_category": F.col("category") if "category" in df.columns else F.lit(None).cast("string"), "_voucher_type": F.col("voucher_type") if "voucher_type" in df.columns else F.lit(None).cast("string"),
    }
    scoped = df.withColumns(given)
    names = list(given)
    scopes = scoped.select(*names).distinct()
    keys = rule_keys(rules, kind)
    masks = keys.agg(F.collect_set("probe.mask").alias("masks"))  # one row of at most eight numbers
    known = {s: F.when(F.col(f"_{s}").isNull() | (F.col(f"_{s}") == ""), UNKNOWN).otherwise(F.col(f"_{s}")) for s in _SCOPES}
    probing = scopes.withColumn("k", F.lit(1)).join(masks.withColumn("k", F.lit(1)), "k").drop("k")
    # A row without a country has the default tier only.
    tiers = F.filter(F.array(F.struct(F.lit(1).alias("own"), F.col("_country").alias("country")), F.struct(F.lit(0).alias("own"), F.lit(DEFAULT).alias("country"))), lambda t: t["country"].isNotNull() & ((t["own"] == 0) | (t["country"] != DEFAULT)))
    probing = probing.withColumn("mask", F.explode("masks")).withColumn("tier", F.explode(tiers))
    parts = [F.when(F.col("mask").bitwiseAND(1 << k) > 0, known[s]).otherwise("").alias(s) for k, s in enumerate(_SCOPES)]
    probing = probing.withColumn("probe", F.struct(F.col("tier.country").alias("country_code"), "mask", *parts))
    specificity = F.bit_count("mask").cast("long")
    met = probing.join(keys, "probe").groupBy(*names).agg(F.max_by(F.struct("rule", "tier", specificity.alias("specificity")), F.struct("tier.own", specificity.alias("s"), (-F.col("rule.ordinal")).alias("o"))).alias("best"))
    rule = F.col("best.rule")
    found = F.struct(
        rule["value_usd"].alias("value_usd"), rule["version"].cast("long").alias("contract_version"), rule["contract_hash"].alias("contract_hash"),
        F.when(F.col("best.tier.own") == 0, F.concat(F.lit("DEFAULT: "), rule["description"])).otherwise(rule["description"]).alias("rule_description"),
        F.lit("catalog").alias("source"), F.col("best.specificity").alias("specificity"),
    )
    value = FALLBACK_USD[kind]
    fallback = F.struct(
        F.lit(value).alias("value_usd"), F.lit(0).cast("long").alias("contract_version"), F.lit("fallback").alias("contract_hash"),
        F.lit(f"Hardcoded fallback: {value} USD").alias("rule_description"), F.lit("fallback").alias("source"), F.lit(0).cast("long").alias("specificity"),
    )
    # One text for each scope, nulls told from texts: rows of a scope that very many share can be split over tasks.
    key = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    told = met.select(key.alias("_key"), found.alias("_found"))
    return scoped.withColumn("_key", key).join(told, "_key", "left").withColumn(name, F.coalesce("_found", fallback)).drop("_key", "_found", *names)


def first_match(contracts: Sequence[ThresholdContract], kind: str, country: str | None, values: Sequence[str | None]) -> tuple:
    """(value, tier is own, specificity, description) of one bucket, rule by rule: what tests compare the table with."""
    best = None
    for contract in contracts:
        own = contract.country_code != DEFAULT
        if own and contract.country_code != country:
            continue
        for n, rule in enumerate(contract.rules):
            scopes = (rule.gl_accounts, rule.categories, rule.voucher_types)
            if rule.threshold_type == kind and all(not s or not v or v in s for s, v in zip(scopes, values, strict=True)):
                order = (own, rule.specificity, -n)
                if best is None or order > best[0]:
                    best = (order, (rule.value_usd, own, rule.specificity, rule.description))
    return best[1] if best else (FALLBACK_USD[kind], None, 0, None)
