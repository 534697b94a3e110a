"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that change results or plan quality. Parallelism and memory stay with the cluster.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cpus: str = "*", shuffle_partitions: int = 8, app: str = "closewright") -> SparkSession:
    """A single-JVM session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in REQUIRED.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        # Call-site capture on every Column call costs more than the small queries themselves.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
