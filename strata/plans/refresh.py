"""Write, audit, publish: layered runs that readers see whole or not at all.

A run writes Bronze, Silver and Gold into a folder of its own below the root.
The rules of the raw tables are counted while Bronze is written, keys and
foreign keys are then checked on the stored Bronze's key columns, and Silver and
Gold follow only when nothing failed.  One small numbered file then names the
run's folder: readers take the folder that the last such file names, so a run
that fails or dies leaves what they see as it was.

Two runs at once take the same number, and the second to finish fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from strata.operators.quality import QualityGateError
from strata.plans import medallion as M
from strata.sinks.batch_store import FolderLog


@dataclass(frozen=True)
class Snapshot:
    """One published run; its folder does not change any more."""
    spark: SparkSession
    number: int
    folder: str
    fmt: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.folder}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.format(self.fmt).load(self.path(layer, name))


class Snapshots:
    """The published runs below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = FolderLog(spark, f"{self.root}/_published")

    def number(self) -> int:
        """Of the last published run; 0 when there is none."""
        names = self.log.names()
        return int(names[-1].split(".")[0]) if names else 0

    def latest(self) -> Snapshot:
        """What to read; tables that belong together are read from one snapshot."""
        number = self.number()
        if not number:
            raise FileNotFoundError(f"nothing is published below {self.root}")
        entry = self.log.load(f"{number:012d}.json")
        return Snapshot(self.spark, number, f"{self.root}/{entry['run']}", entry["format"])

    def publish(self, number: int, run: str, fmt: str, rows: dict[str, int]) -> Snapshot:
        self.log.put(f"{number:012d}.json", {"run": run, "format": fmt, "rows": rows})
        return Snapshot(self.spark, number, f"{self.root}/{run}", fmt)

    def discard(self, runs: Sequence[str]) -> None:
        FolderLog(self.spark, self.root).delete(runs)

    def vacuum(self) -> int:
        """Deletes every run but the latest, and what failed runs left; returns how many.

        Only when no run is at work and nobody reads an older snapshot.
        """
        current = self.latest().folder.rsplit("/", 1)[1]
        here = FolderLog(self.spark, self.root)
        found = [s.getPath().getName() for s in here.fs.listStatus(here._path(self.root))]
        old = [n for n in found if n.startswith("run=") and n != current]
        here.delete(old)
        self.log.delete(self.log.names()[:-1])
        return len(old)


def refresh(spark: SparkSession, raw: dict[str, DataFrame], root: str, fmt: str = "parquet", orphans: str = "drop",
            event_order: Sequence[str] | None = None, gate: bool = True) -> tuple[Snapshot, M.RunMetrics]:
    """A layered run over raw ``customers``, ``products``, ``events``, published when its audit passes.

    A failing rule raises ``QualityGateError`` and the run's folder goes; with
    ``gate=False`` nothing is audited.
    """
    published = Snapshots(spark, root)
    number, run = published.number() + 1, f"run={uuid.uuid4().hex}"
    try:
        metrics = M.run_medallion(spark, raw, f"{published.root}/{run}", fmt=fmt, orphans=orphans,
                                  event_order=event_order, audit=gate)
    except QualityGateError:
        published.discard([run])
        raise
    return published.publish(number, run, fmt, metrics.rows), metrics


def register_tables(snapshot: Snapshot, database: str) -> None:
    """Catalog tables ``<database>.<layer>_<name>`` over a snapshot's files.

    A table that exists with the same columns is moved to the new files by one
    statement; readers of several tables are safer with ``Snapshots.latest``.
    """
    spark = snapshot.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = [(layer, name) for layer in ("bronze", "silver") for name in M.LAYER_TABLES]
    for layer, name in [*names, *(("gold", name) for name in M.GOLD_TABLES)]:
        table, path = f"{database}.{layer}_{name}", snapshot.path(layer, name)
        schema = snapshot.read(layer, name).schema
        if spark.catalog.tableExists(table):
            if spark.table(table).schema == schema:
                spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
                spark.catalog.refreshTable(table)
                continue
            spark.sql(f"DROP TABLE {table}")
        spark.catalog.createTable(table, path, snapshot.fmt)
