"""Readers and writers of the close."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from closewright.functions.text import scrub_line_breaks
from closewright.operators.conform import conform
from closewright.operators.joins import head_rows, tail_rows
from closewright.operators.naming import OPS_USAGE_ALIASES, rename_first_existing
from closewright.sources.contract_tables import CONTRACTS, DATASET_ALIASES
from closewright.sources.contracts import Contract
from closewright.sources.csv_records import CORRUPT, csv_records, parsed

def read_jdbc(spark: SparkSession, url: str, query: str, options: Mapping[str, str] | None = None, split: tuple[str, int, int, int] | None = None) -> DataFrame:
    """A query over JDBC. `split` = (column, lower, upper, partitions) reads it in parallel ranges."""
    reader = spark.read.format("jdbc").option("url", url).options(**(options or {}))
    if split is None:
        return reader.option("query", query).load()
    column, lower, upper, partitions = split
    return (
        reader.option("dbtable", f"({query}) as t").option("partitionColumn", column).option("lowerBound", str(lower))
        .option("upperBound", str(upper)).option("numPartitions", str(partitions)).load()
    )


def run_query(spark: SparkSession, text: str, params: Mapping[str, object] | None = None, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """A query with named parameters (`:cutoff`) and frames as tables (`{gl}`); an unset parameter is an error."""
    return spark.sql(text, args=dict(params or {}), **(tables or {}))


def period_params(cutoff: str, countries: Sequence[str] = ()) -> dict[str, object]:
    """Parameters of the extracts from a cutoff and the selected countries."""
    from closewright.functions.dates import as_date, next_month_first
    from closewright.functions.labels import COUNTRY_COMPANY, COUNTRY_CURRENCY

    at = as_date(cutoff)
    codes = [c.upper().strip().split("_")[-1] for c in countries]
    return {
        "cutoff_date": at.isoformat(), "cutoff_year": at.year, "year": at.year, "month": at.month, "year_start": f"{at.year}-01-01",
        "year_end": f"{at.year}-12-31", "period_month_start": at.replace(day=1).isoformat(),
        "subsequent_month_start": next_month_first(at).isoformat(), "companies": [COUNTRY_COMPANY.get(c, f"EC_{c}") for c in codes],
        "currencies": sorted({COUNTRY_CURRENCY[c] for c in codes if c in COUNTRY_CURRENCY}),
    }


def read_csv(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """CSV as text columns plus `_corrupt_record`: rows with too many fields are kept apart, not dropped.

    Quoted fields may hold line breaks; a large file is still read by many tasks. A short row is filled with nulls, an
    empty field is null and a quoted empty one is an empty text.
    """
    return parsed(csv_records(spark, path, sep), columns, sep)


def header_of(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names of a CSV, from its first line only."""
    return spark.read.csv(path, header=True, sep=sep, escape='"', inferSchema=False).columns


def good_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_rows(df: DataFrame) -> DataFrame:
    """Unreadable rows with whatever was parsed; Spark does not serve the raw text column alone."""
    return df.filter(F.col(CORRUPT).isNotNull())


def read_conformed_csv(spark: SparkSession, path: str, contract: Contract | str, strict: bool = True) -> DataFrame:
    """Readable CSV rows conformed to a contract."""
    contract = CONTRACTS[contract] if isinstance(contract, str) else contract
    return conform(good_rows(read_csv(spark, path, header_of(spark, path))), contract, strict=strict)


def read_ops_usage(spark: SparkSession, path: str) -> DataFrame:
    """Operational voucher usage with canonical names."""
    return rename_first_existing(good_rows(read_csv(spark, path, header_of(spark, path))), OPS_USAGE_ALIASES)


def ingest(df: DataFrame, target: StructType, loaded_at: datetime | None = None) -> DataFrame:
    """Ingestion projection: line breaks out of text columns, load stamps, select and cast to the target."""
    stamp = F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp()
    clean = df.select(*[
        (scrub_line_breaks(f"`{f.name}`") if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")).alias(f.name) for f in df.schema.fields
    ])
    stamped = clean.withColumns({"dat_load_timestamp": stamp, "dat_load_date": stamp.cast("date")})
    return stamped.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.fields])


def write_table(df: DataFrame, table: str, mode: str = "append", partition_by: Sequence[str] = (), max_records: int = 5_000_000) -> None:
    """Save as a table; files are bounded by records and adaptive execution sizes the partitions."""
    writer = df.write.mode(mode).option("maxRecordsPerFile", str(max_records))
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV that `read_csv` reads back as it was: line breaks in quotes, quotes doubled, null empty and empty text quoted.

    A row of one column that is null would be a blank line, so in a frame of one column null is written as empty text.
    """
    if len(df.columns) == 1:
        df = df.select(F.coalesce(F.col(f"`{df.columns[0]}`").cast("string"), F.lit("")).alias(df.columns[0]))
    df.write.mode(mode).csv(path, header=True, escape='"', nullValue="", emptyValue='""', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", options: Mapping[str, str] | None = None) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {})).mode(mode).save()


def report_rows(df: DataFrame, keys: Sequence[str], n: int = 1000) -> tuple[DataFrame, DataFrame]:
    """First n rows by key for a report, and a one-row (total_rows, truncated) frame."""
    return head_rows(df, keys, n), df.agg(F.count("*").alias("total_rows")).withColumn("truncated", F.col("total_rows") > n)


def write_snapshot(df: DataFrame, keys: Sequence[str], path: str, n: int = 1000) -> None:
    """Last n rows by key as CSV evidence."""
    write_csv(tail_rows(df, keys, n), path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def resolve_dataset(
    spark: SparkSession, dataset: str, supplied: Mapping[str, DataFrame] | None = None, live=None, folder: str | None = None, company: str | None = None
) -> tuple[DataFrame | None, str]:
    """A dataset and where it came from: supplied frame, live source, company file, shared file, none.

    `live` is a function from dataset id to a frame or None. Files are parquet or CSV at
    `folder/company=<company>/<dataset>.*` and `folder/<dataset>.*`.
    """
    for name in (dataset, *_other_ids(dataset)):
        if supplied and name in supplied:
            return supplied[name], "supplied"
    if live is not None:
        frame = live(dataset)
        if frame is not None:
            return frame, "live"
    if folder:
        places = ([(f"company file {company}", os.path.join(folder, f"company={company}"))] if company else []) + [("shared file", folder)]
        for label, place in places:
            for name in (dataset, *_other_ids(dataset)):
                parquet, csv = f"{place}/{name}.parquet", f"{place}/{name}.csv"
                if _exists(spark, parquet):
                    return spark.read.parquet(parquet), label
                if _exists(spark, csv):
                    return good_rows(read_csv(spark, csv, header_of(spark, csv))), label
    return None, "none"


class FolderTables(Mapping):
    """Source tables of a folder by name, each a Parquet or CSV of that name; read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        for path, read in ((f"{self._folder}/{name}.parquet", self._spark.read.parquet), (f"{self._folder}/{name}.csv", self._csv)):
            if _exists(self._spark, path):
                return read(path)
        raise KeyError(name)

    def _csv(self, path: str) -> DataFrame:
        return good_rows(read_csv(self._spark, path, header_of(self._spark, path)))

    def __iter__(self):
        jvm = self._spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(self._folder)
        for status in target.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).listStatus(target):
            stem, _, kind = status.getPath().getName().rpartition(".")
            if kind in ("parquet", "csv"):
                yield stem

    def __len__(self) -> int:
        return sum(1 for _ in self)


def _other_ids(dataset: str) -> list[str]:
    pairs = {**DATASET_ALIASES, **{v: k for k, v in DATASET_ALIASES.items()}}
    return [pairs[dataset]] if dataset in pairs else []
