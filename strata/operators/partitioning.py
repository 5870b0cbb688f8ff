"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file or folder on whatever storage Spark reads it from."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a batch input over the cluster when it is read in too few splits.

    Per-row work (JSON parsing, validation, partial aggregation) runs one task
    per input split.  An input of fewer splits than ``min_partitions`` (the
    default parallelism) is dealt out anew; any other is returned unchanged, so
    the number of partitions never falls and a large scan gets no shuffle.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df
