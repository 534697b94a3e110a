"""Result tables that appear together: written under a run, then named by a manifest that readers follow."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

_MANIFEST = re.compile(r"^(\d{12})-([0-9a-f]{32})\.json$")


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


@dataclass(frozen=True)
class Manifest:
    """What one finished run published."""

    number: int
    run_id: str
    attempt: str
    published_at: str
    tables: tuple[str, ...]

    def place(self, folder: str, table: str) -> str:
        if table not in self.tables:
            raise KeyError(f"run {self.run_id} published no table {table}")
        return f"{folder}/runs/{self.attempt}/{table}"


class Run:
    """An attempt at a run: its tables lie in a folder of their own until `publish` names them."""

    def __init__(self, spark: SparkSession, folder: str, run_id: str):
        self.spark, self.folder, self.run_id = spark, folder.rstrip("/"), run_id
        self.attempt = uuid.uuid4().hex
        self.tables: list[str] = []

    def new_table(self, name: str) -> str:
        """Where to write a table; it is published only if `keep` is called for it."""
        return f"{self.folder}/runs/{self.attempt}/{name}"

    def keep(self, name: str) -> None:
        self.tables.append(name)

    def write(self, name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(self.new_table(name))
        self.keep(name)
        return self.spark.read.schema(df.schema).parquet(self.new_table(name))

    def publish(self) -> Manifest:
        """Write the manifest: a whole file under a temporary name, renamed when complete. The last step of a run."""
        number = max((m.number for m in manifests(self.spark, self.folder)), default=0) + 1
        manifest = Manifest(number, self.run_id, self.attempt, datetime.now(timezone.utc).isoformat(), tuple(self.tables))
        text = json.dumps({"run_id": self.run_id, "published_at": manifest.published_at, "tables": self.tables})
        final = f"{self.folder}/manifests/{number:012d}-{self.attempt}.json"
        target, fs = _path(self.spark, final)
        begun, _ = _path(self.spark, f"{self.folder}/manifests/_{self.attempt}.tmp")
        out = fs.create(begun, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not fs.rename(begun, target):
            raise RuntimeError(f"the manifest of run {self.run_id} could not be published")
        return manifest


def manifests(spark: SparkSession, folder: str) -> list[Manifest]:
    """All published runs, from the first to the last. Two runs that end at once take one number; the attempt orders them."""
    target, fs = _path(spark, f"{folder.rstrip('/')}/manifests")
    if not fs.exists(target):
        return []
    found = []
    for status in fs.listStatus(target):
        name = status.getPath().getName()
        parts = _MANIFEST.match(name)
        if parts:
            held = json.loads(spark.read.option("wholetext", True).text(status.getPath().toString()).first()[0])
            found.append(Manifest(int(parts[1]), held["run_id"], parts[2], held["published_at"], tuple(held["tables"])))
    return sorted(found, key=lambda m: (m.number, m.attempt))


def current(spark: SparkSession, folder: str, run_id: str | None = None) -> Manifest | None:
    """The manifest readers follow: the last one, or the last of a run."""
    found = [m for m in manifests(spark, folder) if run_id is None or m.run_id == run_id]
    return found[-1] if found else None


def read_published(spark: SparkSession, folder: str, table: str, run_id: str | None = None) -> DataFrame:
    """A table of the last published run, or of the last publication of a run."""
    manifest = current(spark, folder, run_id)
    if manifest is None:
        raise FileNotFoundError(f"nothing is published in {folder}")
    return spark.read.parquet(manifest.place(folder.rstrip("/"), table))


def read_all_runs(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The rows of a table of all runs, of each run its last publication only: a repeated run adds nothing twice."""
    last = {m.run_id: m for m in manifests(spark, folder) if table in m.tables}
    if not last:
        raise FileNotFoundError(f"no run in {folder} published {table}")
    return spark.read.parquet(*[m.place(folder.rstrip("/"), table) for m in last.values()])


def remove_unpublished(spark: SparkSession, folder: str, keep: Sequence[str] = ()) -> list[str]:
    """Remove the folders of attempts that no manifest names, but those in `keep` (attempts still running)."""
    target, fs = _path(spark, f"{folder.rstrip('/')}/runs")
    if not fs.exists(target):
        return []
    named = {m.attempt for m in manifests(spark, folder)} | set(keep)
    removed = []
    for status in fs.listStatus(target):
        name = status.getPath().getName()
        if name not in named:
            fs.delete(status.getPath(), True)
            removed.append(name)
    return removed


def tables_of(manifest: Manifest, spark: SparkSession, folder: str) -> Mapping[str, DataFrame]:
    return {t: spark.read.parquet(manifest.place(folder.rstrip("/"), t)) for t in manifest.tables}
