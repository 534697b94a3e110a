"""A report as aggregates of a table and what is made of them, so that a write can gather them on the way."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from closewright.functions.text import null_if_nan
from closewright.operators.naming import is_numeric


@dataclass(frozen=True)
class Report:
    """`facts` are aliased aggregates without distinct counts; `finish` turns their one row into the report."""

    facts: tuple[Column, ...]
    finish: Callable[[DataFrame], DataFrame]

    def of(self, df: DataFrame) -> DataFrame:
        return self.finish(df.agg(*self.facts))


class Gathered:
    """Reports on frames that are gathered by the action that computes the frames, and read afterwards.

    Frames should be observed behind their last shuffle: a stage that runs again after a lost executor would count
    twice there, while the tasks that write count once each.
    """

    def __init__(self) -> None:
        self._held: dict[str, tuple[Observation, DataFrame, Report]] = {}

    def watch(self, df: DataFrame, reports: Mapping[str, Report]) -> DataFrame:
        """The frame, with the facts of the reports gathered wherever it is computed."""
        for name, report in reports.items():
            seen = Observation(name)
            # Its schema only: an analysed plan that never runs.
            self._held[name] = (seen, df.agg(*report.facts), report)
            df = df.observe(seen, *report.facts)
        return df

    def reports(self) -> dict[str, DataFrame]:
        """The reports, each from its one row of facts; to be called when the action is over."""
        out = {}
        for name, (seen, shape, report) in self._held.items():
            got = seen.get
            one = shape.sparkSession.createDataFrame([tuple(got[f] for f in shape.columns)], shape.schema)
            out[name] = report.finish(one)
        return out


def numeric_probe(df: DataFrame, checkpoint: str, columns: Sequence[str]) -> Report:
    """(checkpoint, metric, value) of rows, columns, and Σ, mean and non-null count of the numeric columns named."""
    parts: dict[str, Column] = {"row_count": F.count("*").cast("double"), "column_count": F.max(F.lit(float(len(df.columns))))}
    for c in columns:
        if c in df.columns and is_numeric(df, c):
            value = null_if_nan(c, df.schema[c].dataType)
            parts[f"{c}_non_null_count"] = F.count(value).cast("double")
            parts[f"{c}_sum"] = F.coalesce(F.sum(value).cast("double"), F.lit(0.0))
            parts[f"{c}_mean"] = F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0))
    names = list(parts)

    def finish(one: DataFrame) -> DataFrame:
        counted = one.withColumn("column_count", F.lit(float(len(df.columns))))
        entries = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"`{n}`").alias("value")) for n in names])
        return counted.select(F.lit(checkpoint).alias("checkpoint"), F.inline(entries))

    return Report(tuple(v.alias(n) for n, v in parts.items()), finish)
