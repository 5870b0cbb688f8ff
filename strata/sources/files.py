"""Batch sources: CSV, JSON (array documents and lines), Parquet, tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Header line, no inference: every column is text unless a schema is given."""
    r = spark.read.option("header", True)
    return (r.schema(schema) if schema is not None else r).csv(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON array documents (one document per file; rows are its elements)."""
    r = spark.read.option("multiLine", True)
    return (r.schema(schema) if schema is not None else r).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One JSON object per line; a schema projects at the reader."""
    r = spark.read
    return (r.schema(schema) if schema is not None else r).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def existing_ids(spark: SparkSession, bronze_path: str, fmt: str = "parquet",
                 schema: T.StructType | None = None, distinct: bool = True) -> DataFrame:
    """Event ids already in Bronze; empty when Bronze does not exist yet.

    With ``schema`` an existing but empty Bronze folder reads as zero rows.
    ``distinct=False`` skips the de-duplication (and its shuffle) for callers
    that only anti-join against the ids.
    """
    try:
        r = spark.read.format(fmt)
        ids = (r.schema(schema) if schema is not None else r).load(bronze_path).select("event_id")
        return ids.distinct() if distinct else ids
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "event_id string")


FILE_ORDER = ("_file", "_block", "_row")


def in_file_order(df: DataFrame) -> DataFrame:
    """Columns (``FILE_ORDER``) that sort the rows of file sources by path and place in the file.

    A file is read in blocks and a block's rows are numbered upwards, so the
    order holds however many splits a file has.
    """
    return (df.withColumn("_file", F.col("_metadata.file_path")).withColumn("_block", F.col("_metadata.file_block_start"))
              .withColumn("_row", F.monotonically_increasing_id()))


def with_lineage(df: DataFrame) -> DataFrame:
    """Source file of every row (path and file name), from the hidden ``_metadata`` column."""
    return (df.withColumn("source_path", F.col("_metadata.file_path"))
              .withColumn("source_file", F.col("_metadata.file_name")))
