"""Evidence: order-free dataset fingerprints and run audit records."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closewright.operators.reports import Report

DIGEST = "_digest"


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of the row as JSON with the columns in name order; nulls are written out."""
    ordered = F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    return F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256)


def fingerprint(df: DataFrame, dataset: str) -> DataFrame:
    """One row: rows, columns and a hash that does not depend on row order or partitioning.

    Six 32-bit parts of the row digests are summed exactly, so
    duplicates count and no sort is needed; the final hash covers sums, row count and columns.
    """
    return fingerprint_report(df.columns, dataset).of(df.select(row_digest(df).alias(DIGEST)))


def _limbs(digest: Column) -> list[Column]:
    """Six 32-bit parts of the first and the next 96 bits: their sums stay exact in decimal(38,0)."""
    return [F.conv(F.substring(digest, start + 8 * i, 8), 16, 10).cast("decimal(20,0)") for start in (1, 25) for i in range(3)]


def fingerprint_report(names: list[str], dataset: str) -> Report:
    """The row of `fingerprint` of a table of these columns, from a frame that holds each row's digest as `DIGEST`."""
    sums = [F.sum(limb) for limb in _limbs(F.col(DIGEST))]
    columns = ",".join(sorted(names))
    text = F.concat_ws("|", *[F.coalesce(F.col(f"s{i}"), F.lit(0)).cast("string") for i in range(len(sums))], F.col("data_rows").cast("string"), F.lit(columns))

    def finish(one: DataFrame) -> DataFrame:
        return one.select(
            F.lit(dataset).alias("dataset"), "data_rows", F.lit(len(names)).cast("long").alias("data_columns"),
            F.sha2(text, 256).alias("fingerprint"),
        )

    return Report((F.count("*").alias("data_rows"), *[s.alias(f"s{i}") for i, s in enumerate(sums)]), finish)


def verify_fingerprint(df: DataFrame, recorded: DataFrame, dataset: str) -> DataFrame:
    """Recompute and compare with the recorded fingerprint of the dataset; a missing record fails."""
    known = recorded.filter(F.col("dataset") == dataset).select("dataset", F.col("fingerprint").alias("recorded"), F.col("data_rows").alias("recorded_rows"))
    return fingerprint(df, dataset).join(known, "dataset", "left").select(
        "dataset", "data_rows", "recorded_rows", "fingerprint", "recorded",
        F.coalesce(F.col("fingerprint") == F.col("recorded"), F.lit(False)).alias("verified"),
    )


def run_record(df: DataFrame, dataset: str, query_text: str, params: dict, status: str, run_at: datetime) -> DataFrame:
    """One audit row per dataset and run, ready to append to a `run_audit` table."""
    return audit_row(fingerprint(df, dataset), query_text, params, status, run_at)


def audit_row(fingerprinted: DataFrame, query_text: str, params: dict, status: str, run_at: datetime) -> DataFrame:
    """A fingerprint with the query, parameters and status of its run."""
    return fingerprinted.withColumns({
        "query_text": F.lit(query_text), "params": F.lit(",".join(f"{k}={params[k]}" for k in sorted(params))),
        "validation_status": F.lit(status), "run_at": F.lit(run_at).cast("timestamp"),
    })


def with_lineage(df: DataFrame, dataset: str, extracted_at: datetime, cutoff: str) -> DataFrame:
    """Append the lineage columns of an extract."""
    return df.withColumns({
        "_dataset_id": F.lit(dataset), "_extraction_date": F.lit(extracted_at.isoformat()), "_cutoff_date": F.lit(cutoff)
    })
