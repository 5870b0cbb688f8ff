"""Incremental summaries: a run enriches the Bronze rows committed since the last one and adds their sums.

Below ``<root>/enriched`` every run has a folder with its enriched rows (JSON
lines) and the sums so far: a row per summary and dimension, with the amount
still exact, so that sums add up in any split of the input.  One numbered file
per run (``FolderLog``) then says which folders count and up to which Bronze
commit they go; a run that dies before it leaves nothing visible.

A row keeps the attributes its dimensions had when it was enriched, and one that
found no customer or product under ``orphans="drop"`` is not taken up later;
``medallion.enrich_and_summarize`` rebuilds everything from all of Bronze.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import aggregate as G
from strata.plans import medallion as M
from strata.sinks.batch_store import BatchStore, FolderLog
from strata.sources import files as SF

#: Of ``sums``; whole cents.
SUMS_SCHEMA = "summary string, dimension string, purchase_count bigint, units_sold bigint, amount decimal(38,2)"


class Enriched:
    """The enriched rows and sums below ``root``, up to Bronze commit ``upto``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root}/enriched"
        self.log = FolderLog(spark, f"{self.root}/_runs")
        names = self.log.names()
        self.number = int(names[-1].split(".")[0]) if names else 0
        state = self.log.load(names[-1]) if names else {"upto": -1, "runs": [], "schema": None}
        self.upto, self.runs, self.schema = state["upto"], state["runs"], state["schema"]

    def commit(self, run: str, upto: int, rows: int, schema: str) -> None:
        """Counts the folder of a run; ``rows`` says if its enriched part is worth naming."""
        runs = [*[dict(r, sums=False) for r in self.runs if r["rows"]], {"run": run, "rows": rows, "sums": True}]
        self.log.put(f"{self.number + 1:012d}.json", {"upto": upto, "runs": runs, "schema": schema})
        self.log.delete(self.log.names()[:-2])
        self.number, self.upto, self.runs, self.schema = self.number + 1, upto, runs, schema

    def rows(self) -> DataFrame:
        """All enriched rows."""
        folders = [f"{self.root}/{r['run']}/silver" for r in self.runs if r["rows"]]
        if not folders:
            return self.spark.createDataFrame([], self.schema or "event_id string")
        return self.spark.read.schema(self.schema).json(folders)

    def sums(self) -> DataFrame:
        folders = [f"{self.root}/{r['run']}/sums" for r in self.runs if r["sums"]]
        return self.spark.read.schema(SUMS_SCHEMA).parquet(*folders) if folders else self.spark.createDataFrame([], SUMS_SCHEMA)

    def summary(self, name: str) -> DataFrame:
        """One of ``SUMMARY_DIMENSIONS``: dimension, purchase_count, units_sold, revenue."""
        return self.sums().where(F.col("summary") == name).select(
            "dimension", "purchase_count", "units_sold", F.round("amount", 2).cast("double").alias("revenue"))


def advance(spark: SparkSession, store: BatchStore, customers: DataFrame, products: DataFrame, root: str,
            orphans: str = "fail") -> int:
    """Takes in what ``store`` committed since the last run; returns how many rows were enriched.

    Reads the folders of those commits and the last sums, not the rest of Bronze.
    Only a folder that ``compact`` packed from both sides while a run was at work
    is compared by id with the rows there are; of it, rows that found no dimension
    before are tried again.
    """
    store.refresh()
    done = Enriched(spark, root)
    fresh, mixed, any_mixed = store.committed_after(done.upto)
    if any_mixed:
        fresh = fresh.unionByName(mixed.join(done.rows().select("event_id"), "event_id", "left_anti"))
    elif done.upto >= store.number:
        return 0
    run = f"run={uuid.uuid4().hex}"
    path, metrics = f"{done.root}/{run}", M.RunMetrics()
    enriched = M.enriched_rows(fresh, customers, products, orphans)
    M._write_observed(enriched, f"{path}/silver", "silver", metrics, "json")
    written = spark.read.schema(enriched.schema).json(f"{path}/silver")
    both = done.sums().unionByName(G.summary_sums(written))
    (both.groupBy("summary", "dimension")
     .agg(*[F.sum(c).alias(c) for c in ("purchase_count", "units_sold")], F.sum("amount").cast("decimal(38,2)").alias("amount"))
     .write.parquet(f"{path}/sums"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in enriched.schema)
    done.commit(run, store.number, metrics.rows["silver"], schema)
    return metrics.rows["silver"]
