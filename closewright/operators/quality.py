"""Quality rules: all aggregate rules of a table run in one pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closewright.functions.dates import cutoff_lit, to_timestamp
from closewright.functions.text import null_if_nan, to_number
from closewright.operators.audit import key_counts
from closewright.operators.joins import beside, semi_on
from closewright.operators.naming import OPS_USAGE_ALIASES, is_numeric, rename_first_existing
from closewright.operators.reports import Report


@dataclass(frozen=True)
class Outcome:
    """What a rule needs: named aggregates, then pass flag and detail as functions of those aggregates."""

    facts: dict[str, Column] = field(default_factory=dict)
    passed: Callable[[Callable[[str], Column]], Column] = lambda get: F.lit(True)
    detail: Callable[[Callable[[str], Column]], Column] = lambda get: F.lit("")


def _failed(text: str) -> Outcome:
    return Outcome(passed=lambda get: F.lit(False), detail=lambda get: F.lit(text))


class QualityRule:
    """Extension point: subclass and implement `plan`; the rule joins the common pass."""

    def plan(self, df: DataFrame) -> Outcome:
        raise NotImplementedError

    @property
    def name(self) -> str:
        return type(self).__name__

    def checked_plan(self, df: DataFrame) -> Outcome:
        column = getattr(self, "column", None)
        if column is not None and column not in df.columns:
            return _failed("column not found")
        return self.plan(df)


@dataclass(frozen=True)
class RowCountCheck(QualityRule):
    min_rows: int
    max_rows: int | None = None

    def plan(self, df):
        def passed(get):
            ok = get("n") >= self.min_rows
            return ok if self.max_rows is None else ok & (get("n") <= self.max_rows)

        return Outcome({"n": F.count("*")}, passed, lambda get: F.concat(get("n").cast("string"), F.lit(" rows")))


@dataclass(frozen=True)
class ColumnExistsCheck(QualityRule):
    column: str

    def plan(self, df):
        return Outcome(detail=lambda get: F.lit("column exists"))


@dataclass(frozen=True)
class NumericSumCheck(QualityRule):
    column: str
    should_be_zero: bool

    def plan(self, df):
        if not is_numeric(df, self.column):
            return _failed("column is not numeric")
        return Outcome(
            {"s": F.coalesce(F.sum(null_if_nan(self.column, df.schema[self.column].dataType)), F.lit(0))},
            lambda get: (get("s") == 0) if self.should_be_zero else (get("s") != 0),
            lambda get: F.concat(F.lit("sum "), get("s").cast("string")),
        )


@dataclass(frozen=True)
class NoNullsCheck(QualityRule):
    column: str

    def plan(self, df):
        return Outcome(
            {"nulls": F.count_if(null_if_nan(self.column, df.schema[self.column].dataType).isNull()), "n": F.count("*")}, lambda get: get("nulls") == 0,
            lambda get: F.concat(get("nulls").cast("string"), F.lit(" nulls of "), get("n").cast("string"), F.lit(" rows")),
        )


FAMILIES = {
    "integer": ("int", "long", "short", "byte"), "float": ("float", "double", "decimal"), "datetime": ("date", "timestamp"),
    "string": ("string", "object"), "boolean": ("bool",),
}


def type_family(name: str) -> str:
    """integer, float, datetime, string or boolean, from a Spark or pandas-style type name."""
    low = name.lower()
    return next((family for family, marks in FAMILIES.items() if any(m in low for m in marks)), low)


@dataclass(frozen=True)
class DTypeCheck(QualityRule):
    column: str
    expected: str

    def plan(self, df):
        actual = dict(df.dtypes)[self.column]
        same = type_family(actual) == type_family(self.expected)
        return Outcome(passed=lambda get: F.lit(same), detail=lambda get: F.lit(f"is {actual}, expected {self.expected}"))


def _as_date(df: DataFrame, column: str) -> Column:
    return F.col(column) if type_family(dict(df.dtypes)[column]) == "datetime" else to_timestamp(column)


@dataclass(frozen=True)
class DateRangeCheck(QualityRule):
    column: str
    min_date: str | None = None
    max_date: str | None = None

    def plan(self, df):
        value = _as_date(df, self.column)
        early = value < cutoff_lit(self.min_date) if self.min_date else F.lit(False)
        late = value > cutoff_lit(self.max_date) if self.max_date else F.lit(False)
        return Outcome(
            {"valid": F.count(value), "early": F.count_if(early), "late": F.count_if(late), "lo": F.min(value), "hi": F.max(value)},
            lambda get: (get("valid") > 0) & (get("early") == 0) & (get("late") == 0),
            lambda get: F.concat(
                get("early").cast("string"), F.lit(" before, "), get("late").cast("string"), F.lit(" after, range "),
                F.coalesce(F.date_format(get("lo"), "yyyy-MM-dd"), F.lit("none")), F.lit(" to "),
                F.coalesce(F.date_format(get("hi"), "yyyy-MM-dd"), F.lit("none")),
            ),
        )


@dataclass(frozen=True)
class SemanticValidityCheck(QualityRule):
    """Amounts and dates: at least 95 % readable. Ids and keys: at most 5 % null. Others: not all null."""

    column: str
    tag: str

    def plan(self, df):
        c = null_if_nan(self.column, df.schema[self.column].dataType)
        n = F.count("*")
        if self.tag in ("amount", "date"):
            value = to_number(c, df.schema[self.column].dataType) if self.tag == "amount" else _as_date(df, self.column)
            return Outcome(
                {"valid": F.count(value), "n": n}, lambda get: (get("valid") > 0) & (get("valid") * 100 >= get("n") * 95),
                lambda get: F.concat(get("valid").cast("string"), F.lit(" readable of "), get("n").cast("string")),
            )
        nulls = F.count_if(c.isNull())
        if self.tag in ("id", "key"):
            return Outcome(
                {"nulls": nulls, "n": n}, lambda get: get("nulls") * 100 <= get("n") * 5,
                lambda get: F.concat(get("nulls").cast("string"), F.lit(" nulls of "), get("n").cast("string")),
            )
        return Outcome(
            {"nulls": nulls, "n": n}, lambda get: get("nulls") < get("n"),
            lambda get: F.concat(get("nulls").cast("string"), F.lit(" nulls of "), get("n").cast("string")),
        )


def run_quality(df: DataFrame, rules: Sequence[QualityRule], name: str = "table") -> DataFrame:
    """One row per rule: table, rule_no, rule, column, passed, detail. One aggregate over the table."""
    return rule_report(df, rules, name).of(df)


def rule_report(df: DataFrame, rules: Sequence[QualityRule], name: str = "table") -> Report:
    """The rows of `run_quality`, to be gathered by an aggregate or a write."""
    plans = [rule.checked_plan(df) for rule in rules]
    facts = [expr.alias(f"f{i}_{key}") for i, plan in enumerate(plans) for key, expr in plan.facts.items()]
    rows = []
    for i, (rule, plan) in enumerate(zip(rules, plans)):
        get = lambda key, i=i: F.col(f"f{i}_{key}")
        rows.append(F.struct(
            F.lit(i).cast("long").alias("rule_no"), F.lit(rule.name).alias("rule"), F.lit(getattr(rule, "column", None)).cast("string").alias("column"),
            plan.passed(get).alias("passed"), plan.detail(get).alias("detail"),
        ))
    return Report((F.count("*").alias("_rows"), *facts), lambda one: one.select(F.lit(name).alias("table"), F.inline(F.array(*rows))))


def quality_status(report: DataFrame) -> DataFrame:
    """One row per table: PASS when every rule passed."""
    return report.groupBy("table").agg(
        F.when(F.bool_and("passed"), "PASS").otherwise("FAIL").alias("status"), F.count("*").alias("rules"),
        F.count_if(~F.col("passed")).alias("failed_rules"),
    )


def primary_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, or hold a null, with their row counts."""
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return key_counts(df, keys).filter((F.col("rows") > 1) | has_null)


def control_totals(extract: DataFrame, expected: DataFrame, witnesses: DataFrame, excluded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Completeness, witness and exclusion controls as three rows of (control, expected, actual, status).

    Complete: row count equals the expected frame's. Witness: at least one witness key is present.
    Exclusion: no excluded key is present.
    """
    def present(wanted: DataFrame) -> DataFrame:
        return semi_on(extract, wanted.select(*keys).distinct(), keys).agg(F.count("*").alias("actual"))

    complete = beside(expected.agg(F.count("*").alias("expected")), extract.agg(F.count("*").alias("actual")))
    rows = [
        complete.select(F.lit("completeness").alias("control"), "expected", "actual", (F.col("expected") == F.col("actual")).alias("ok")),
        present(witnesses).select(F.lit("witness").alias("control"), F.lit(1).cast("long").alias("expected"), "actual", (F.col("actual") > 0).alias("ok")),
        present(excluded).select(F.lit("exclusion").alias("control"), F.lit(0).cast("long").alias("expected"), "actual", (F.col("actual") == 0).alias("ok")),
    ]
    return reduce(DataFrame.union, rows).select("control", "expected", "actual", F.when(F.col("ok"), "PASS").otherwise("FAIL").alias("status"))


def usage_validation(ops: DataFrame) -> DataFrame:
    """One row on operational usage: rows, distinct vouchers, null keys and amounts, duplicates, negatives, total."""
    known = rename_first_existing(ops, OPS_USAGE_ALIASES)
    missing = [c for c in OPS_USAGE_ALIASES if c not in known.columns]
    if missing:
        return known.agg(F.count("*").alias("row_count")).withColumns({"valid": F.lit(False), "missing_columns": F.lit(",".join(missing))})
    amount = to_number("amount_used", known.schema["amount_used"].dataType)
    per_voucher = known.groupBy("voucher_id").agg(
        F.count("*").alias("n"), F.count("amount_used").alias("with_amount"), F.count(amount).alias("readable"),
        F.count_if(amount < 0).alias("negative"), F.sum(amount).alias("total"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return per_voucher.agg(
        total("n").alias("row_count"), F.count("voucher_id").alias("unique_vouchers"),
        total(F.when(F.col("voucher_id").isNull(), F.col("n"))).alias("null_voucher_ids"),
        (total("n") - total("with_amount")).alias("null_amounts"),
        (total("with_amount") - total("readable")).alias("unreadable_amounts"),
        (total("n") - F.count("voucher_id")).alias("duplicate_vouchers"),
        total("negative").alias("negative_amounts"), F.sum("total").alias("total_amount"),
    ).withColumns({"valid": F.lit(True), "missing_columns": F.lit("")})
