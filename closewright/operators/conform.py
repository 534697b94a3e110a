"""Conform a frame to its contract in one projection, and report what changed in one aggregate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from closewright.functions.dates import midnight, to_timestamp
from closewright.functions.text import strip, to_number
from closewright.operators.quality import (
    ColumnExistsCheck, NoNullsCheck, QualityRule, SemanticValidityCheck,
)
from closewright.operators.reports import Report
from closewright.sources import contracts as C


class MissingColumns(ValueError):
    """A required column of the contract has no source column."""


def resolve_names(columns: list[str], contract: C.Contract) -> dict[str, str]:
    """Source column of each canonical name: the name itself, then its declared headings in order, as they are spelled.

    Fields are served in contract order and a source column serves one field. Other headings stay unknown.
    """
    free = set(columns)
    chosen: dict[str, str] = {}
    for f in contract.fields:
        found = next((name for name in (f.name, *f.aliases) if name in free), None)
        if found is not None:
            chosen[f.name] = found
            free.remove(found)
    return chosen


def missing_required(columns: list[str], contract: C.Contract) -> list[str]:
    chosen = resolve_names(columns, contract)
    return [f.name for f in contract.fields if f.required and f.name not in chosen]


def cast_to_tag(value: Column, source: DataType, field: C.Field) -> Column:
    """The value as its tag asks; unreadable values become null."""
    target = DataType.fromDDL(field.spark_type)
    if field.tag in (C.AMOUNT, C.RATE, C.FLAG, C.COUNT) or field.spark_type == C.INTEGER:
        if isinstance(source, StringType):
            value = F.translate(value, "$€£₦", "")
        number = to_number(value, source, DataType.fromDDL("double") if field.tag == C.RATE else DataType.fromDDL("decimal(20,2)"))
        return number.try_cast(target)
    if field.tag == C.DATE:
        return midnight(to_timestamp(value)) if isinstance(source, StringType) else midnight(value)
    text = strip(value)
    if field.tag in (C.KEY, C.ID, C.CODE):
        return F.when(~text.isin("", "nan", "None"), text)
    return text


def fill(value: Column, field: C.Field) -> Column:
    if field.fill == C.FILL_ZERO:
        return F.coalesce(value, F.lit(0).cast(field.spark_type))
    if field.fill == C.FILL_EMPTY:
        return F.coalesce(value, F.lit(""))
    return value


@dataclass(frozen=True)
class Preset:
    strict: bool
    track: bool


# Strict-lite checks required columns and casts; strict-full also reports; audit never fails on columns.
PRESETS = {"strict_lite": Preset(True, False), "strict_full": Preset(True, True), "audit_mode": Preset(False, True)}


def conform(df: DataFrame, contract: C.Contract, strict: bool = True, cast: bool = True, drop_unknown: bool = False) -> DataFrame:
    """Rename, check required columns, cast, fill. One projection, so column pruning still reaches the scan."""
    chosen = resolve_names(df.columns, contract)
    missing = [f.name for f in contract.fields if f.required and f.name not in chosen]
    if strict and missing:
        raise MissingColumns(f"{contract.dataset_id} v{contract.version}: missing required columns {missing}")
    out = []
    for f in contract.fields:
        if f.name not in chosen:
            continue
        value = F.col(f"`{chosen[f.name]}`")
        if cast:
            value = fill(cast_to_tag(value, df.schema[chosen[f.name]].dataType, f), f)
        out.append(value.alias(f.name, metadata={"semantic_tag": f.tag, "contract": f"{contract.dataset_id}/{contract.version}"}))
    used = set(chosen.values())
    unknown = [] if drop_unknown else [F.col(f"`{c}`") for c in df.columns if c not in used]
    return df.select(*out, *unknown)


def conform_report(df: DataFrame, contract: C.Contract) -> DataFrame:
    """One row per contract column: source, types, null counts, unreadable values, fills and violations.

    All counts come from one aggregate over the frame before the cast.
    """
    return contract_report(df, contract).of(df)


def contract_report(df: DataFrame, contract: C.Contract) -> Report:
    """The rows of `conform_report`, to be gathered by an aggregate or a write."""
    chosen = resolve_names(df.columns, contract)
    facts, rows = [], []
    for i, f in enumerate(contract.fields):
        head = [
            F.lit(contract.dataset_id).alias("dataset_id"), F.lit(contract.version).cast("long").alias("version"), F.lit(f.name).alias("column"),
            F.lit(chosen.get(f.name)).cast("string").alias("source_column"), F.lit(f.tag).alias("semantic_tag"), F.lit(f.required).alias("required"),
        ]
        if f.name in chosen:
            source = chosen[f.name]
            raw = F.col(f"`{source}`")
            value = cast_to_tag(raw, df.schema[source].dataType, f)
            fills = f.fill in (C.FILL_ZERO, C.FILL_EMPTY)
            facts += [
                F.count_if(raw.isNull()).alias(f"b{i}"), F.count_if(fill(value, f).isNull()).alias(f"a{i}"),
                F.count_if(raw.isNotNull() & value.isNull()).alias(f"x{i}"), (F.count_if(value.isNull()) if fills else F.count_if(F.lit(False))).alias(f"f{i}"),
            ]
            counts = [F.col(f"{k}{i}") for k in "baxf"]
            before = df.schema[source].dataType.simpleString()
            failed = (F.col(f"a{i}") > 0) if f.fill == C.FAIL_ON_NULL else F.lit(False)
        else:
            counts, before, failed = [F.lit(None).cast("long")] * 4, None, F.lit(f.required)
        names = ("nulls_before", "nulls_after", "invalid_to_null", "filled")
        rows.append(F.struct(
            *head, F.lit(before).cast("string").alias("type_before"), F.lit(f.spark_type).alias("type_after"),
            *[c.alias(n) for c, n in zip(counts, names)], failed.alias("violated"),
        ))
    return Report((F.count("*").alias("_rows"), *facts), lambda one: one.select(F.inline(F.array(*rows))))


def conform_as(df: DataFrame, contract: C.Contract, preset: str) -> tuple[DataFrame, DataFrame | None]:
    """The conformed frame and, for presets that track, its report."""
    chosen = PRESETS[preset]
    return conform(df, contract, strict=chosen.strict), conform_report(df, contract) if chosen.track else None


def unknown_columns(df: DataFrame, contract: C.Contract) -> list[str]:
    used = set(resolve_names(df.columns, contract).values())
    return [c for c in df.columns if c not in used]


def contract_rules(contract: C.Contract) -> list[QualityRule]:
    """Quality rules that follow from a contract."""
    rules: list[QualityRule] = []
    for f in contract.fields:
        if f.required:
            rules.append(ColumnExistsCheck(f.name))
            rules.append(SemanticValidityCheck(f.name, f.tag))
        if f.fill == C.FAIL_ON_NULL:
            rules.append(NoNullsCheck(f.name))
    return rules


