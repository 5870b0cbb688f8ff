"""Spark session defaults and the shared scratch folder.

Every job in this package expects a session in UTC. Scratch output (round-trip
files, stream sinks, lineage cuts) goes under the folder the cluster names in
``spark.checkpoint.dir``; a private folder is created only when that setting is
unset, which happens in tests and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_SCRATCH_KEY = "spark.checkpoint.dir"

# Settings for a large cluster (~100 TB input, ~1000 executors).  Applied by
# the deployment (spark-defaults / submit), not by the queries themselves.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Upper bound for shuffles; AQE only merges, down to the advisory size at
    # runtime, so this must suit the largest one: 50 TB in 256 MB partitions.
    "spark.sql.shuffle.partitions": "200000",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Split partitions 5x the median and over 512 MB on the large join side.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # Broadcast only what is measured to be small (estimate, then AQE runtime size).
    # The static estimate of a Parquet scan is file bytes x this factor: count
    # columnar compression in, so the estimate errs on the large side.
    "spark.sql.sources.fileCompressionFactor": "4",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Partitioned overwrites replace only the partitions written.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "strata") -> SparkSession:
    """Session used by tests, bench and the command line."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Timestamps are UTC throughout (the data model says so)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """Root of the cluster-shared scratch folder.

    Read from the session; only when the cluster names none do we create a
    local one (tests, single-machine runs) and register it as the checkpoint dir.
    On a cluster a machine-local folder would scatter the files, so a missing
    setting is an error there.
    """
    current = spark.conf.get(_SCRATCH_KEY, None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set {_SCRATCH_KEY} to a folder that all executors share (master {master})")
        current = tempfile.mkdtemp(prefix="strata-")
        spark.sparkContext.setCheckpointDir(current)
        current = spark.sparkContext.getCheckpointDir() or current
        spark.conf.set(_SCRATCH_KEY, current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
