"""Batch sinks: CSV, JSON lines, JSON array documents, Parquet, tables.

Batch layers are full refreshes (overwrite); the streaming Bronze appends
(see ``strata.streaming``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """CSV with a header line and a fixed column order."""
    (df.select(*(columns or df.columns)).write.mode("overwrite")
       .option("header", True).csv(path))


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_json_array(df: DataFrame, path: str) -> None:
    """One JSON array document per partition (the export format of the raw events).

    Each partition streams its rows into its own file, so no task ever holds
    more than its own partition and nothing passes through the driver.
    """
    def array_document(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # One partition -> one JSON array document: "[", rows joined by ",", "]".
        # Defined here so it is shipped by value: workers need pandas, not this package.
        first = True
        yield pd.DataFrame({"value": ["["]})
        for pdf in batches:
            if pdf.empty:
                continue
            rows = pdf["json"].tolist()
            lines = [("" if first and i == 0 else ",") + r for i, r in enumerate(rows)]
            first = False
            yield pd.DataFrame({"value": lines})
        yield pd.DataFrame({"value": ["]"]})

    as_json = df.select(F.to_json(F.struct(*df.columns)).alias("json"))
    as_json.mapInPandas(array_document, "value string").write.mode("overwrite").text(path)


def preview(df: DataFrame, rows: int = 20) -> None:
    """Console preview with full cell text (reads only the rows shown)."""
    df.show(rows, truncate=False)


def ensure_dataset(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> None:
    """Create an empty dataset at ``path`` if none is there (append of zero rows)."""
    spark.createDataFrame([], schema).write.mode("append").format(fmt).save(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def save_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None,
               bucket_by: tuple[int, str] | None = None) -> None:
    """Managed (or path-backed) table, full refresh.

    ``bucket_by=(n, key)`` stores the table hash-bucketed and sorted by ``key``,
    so later joins on ``key`` read it co-partitioned (no shuffle, no sort on
    this side).
    """
    if bucket_by is not None:
        df = df.repartition(*bucket_by)  # a task a bucket, so a file a bucket
    w = df.write.mode("overwrite").format(fmt)
    if path is not None:
        w = w.option("path", path)
    if bucket_by is not None:
        n, key = bucket_by
        w = w.bucketBy(n, key).sortBy(key)
    w.saveAsTable(name)


def create_external_table(spark: SparkSession, name: str, location: str,
                          columns: Sequence[tuple[str, str]]) -> None:
    """External Parquet table with a declared column contract."""
    cols = ", ".join(f"`{c}` {t}" for c, t in columns)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING PARQUET LOCATION '{location}'")


def insert_contract(df: DataFrame, name: str, columns: Sequence[tuple[str, str]]) -> None:
    """Cast to the contract's types and order, then overwrite the table's data."""
    df.select(*[F.col(c).cast(t).alias(c) for c, t in columns]).write.insertInto(name, overwrite=True)
