"""Tables and files in the folder that all executors share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only a local session may go without: it gets a folder of its own."""
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {SETTING} to a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="closewright-")
    spark.conf.set(SETTING, folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: its lineage ends there, so a lost executor costs a read, not a rerun."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidied(task: Task) -> Task:
    """The task of a mapInArrow, which at its end gives the system back what it has freed.

    Spark's workers live on, and what their allocators hold stands beside all later tasks of the executor.
    """

    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
            if trim is not None:
                trim(0)

    return run


def least_hashes(share: float) -> int:
    """The 64-bit hash up to which a share of all hashes lies."""
    return min(2**63 - 1, int((2 * share - 1) * 2.0**63))


def removed(df: DataFrame) -> None:
    """Remove the table of a frame that `written` gave, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
