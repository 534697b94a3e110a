"""Staging of intermediate results that several consumers read."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`. Only a local session may go without: it gets one of its own."""
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {_SETTING} to a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="closewright-")
    spark.conf.set(_SETTING, folder)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written as a table in the shared folder and read back.

    Consumers then share one computation, a lost executor never recomputes it, columns are pruned
    on reading, and the optimizer knows the size: a small staged frame is broadcast because its
    files are small. The caller owns the table: `release` removes it.
    """
    path = os.path.join(shared_folder(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Remove the tables of staged frames, once nothing reads them any more."""
    for df in frames:
        spark = df.sparkSession
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
