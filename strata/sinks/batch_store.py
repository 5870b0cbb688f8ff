"""Bronze and dead letters as committed batches behind a manifest.

A batch is staged in a folder of its own (``bronze/batch=<tag>/bucket=<k>`` and
``rejects/batch=<tag>``) and counts from the moment its entry is in the
manifest.  Readers take only the folders the manifest names, so a run that dies
in between leaves nothing visible, and the batch's next attempt overwrites the
folder.

Rows are dealt into buckets by a hash of ``event_id`` and sorted by it, with
Parquet Bloom filters on it.  Looking up a batch's ids reads the buckets those
ids hash to and no others.

The manifest is a log of small JSON files, one per commit; every ``SNAPSHOT``
commits a file states everything and the log before it goes.  Its size follows
the number of folders, which ``compact`` keeps small by packing the small ones.
One writer per store: a commit whose number is taken fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Commits between two manifest files that state everything.
SNAPSHOT = 32
#: Buckets of a new store: lookups read whole buckets, writes make a file each.
BUCKETS = 16
#: Folders under this many bytes are packed by ``compact``.
SMALL_BYTES = 128 << 20


class FolderLog:
    """Numbered JSON files in a folder, written under another name and then renamed."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.path, self.fs = path, self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._utf8 = jvm.java.nio.charset.StandardCharsets.UTF_8
        self._read = jvm.org.apache.commons.io.IOUtils

    def names(self) -> list[str]:
        folder = self._path(self.path)
        if not self.fs.exists(folder):
            return []
        found = [s.getPath().getName() for s in self.fs.listStatus(folder)]
        return sorted(n for n in found if n.endswith(".json"))

    def load(self, name: str) -> dict:
        stream = self.fs.open(self._path(f"{self.path}/{name}"))
        try:
            return json.loads(self._read.toString(stream, self._utf8))
        finally:
            stream.close()

    def put(self, name: str, value: dict) -> None:
        own = self._path(f"{self.path}/_{uuid.uuid4().hex}")
        stream = self.fs.create(own)
        try:
            stream.write(bytearray(json.dumps(value).encode()))
        finally:
            stream.close()
        target = self._path(f"{self.path}/{name}")
        if self.fs.exists(target) or not self.fs.rename(own, target):
            self.fs.delete(own, False)
            raise RuntimeError(f"{target.toString()} is taken: another writer uses this store")

    def delete(self, names: Iterable[str]) -> None:
        for name in names:
            self.fs.delete(self._path(f"{self.path}/{name}"), True)

    def bytes(self, folder: str) -> int:
        path = self._path(folder)
        return self.fs.getContentSummary(path).getLength() if self.fs.exists(path) else 0


def empty_state(buckets: int) -> dict:
    """``last`` is each stream's last whole batch, ``part`` how many messages are taken of the one after it."""
    return {"buckets": buckets, "bronze": {}, "rejects": {}, "last": {}, "part": {}, "totals": {}}


class BatchStore:
    """The committed batches below ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, fmt: str = "parquet", buckets: int = BUCKETS):
        self.spark, self.root, self.fmt = spark, root, fmt
        self.schema = schema
        self.log = FolderLog(spark, f"{root}/manifest")
        self.number, self.state = 0, empty_state(buckets)
        self.refresh()

    # ------------------------------------------------------------- manifest
    def refresh(self) -> None:
        names = self.log.names()
        whole = [n for n in names if n.endswith("-all.json")]
        if whole:
            self.state = self.log.load(whole[-1])
            self.number = int(whole[-1].split("-")[0])
        for name in names:
            number = int(name.split("-")[0])
            if number > self.number and not name.endswith("-all.json"):
                self._apply(self.log.load(name))
                self.number = number

    def _apply(self, change: dict) -> None:
        for kind in ("bronze", "rejects"):
            for name in change.get("drop", {}).get(kind, []):
                self.state[kind].pop(name, None)
            self.state[kind].update(change.get("add", {}).get(kind, {}))
        self.state["buckets"] = change.get("buckets", self.state["buckets"])
        self.state["last"].update(change.get("last", {}))
        for stream in change.get("whole", []):
            self.state["part"].pop(stream, None)
        self.state["part"].update(change.get("part", {}))
        for name, value in change.get("totals", {}).items():
            self.state["totals"][name] = self.state["totals"].get(name, 0) + value

    def _commit(self, change: dict) -> None:
        number = self.number + 1
        change["buckets"] = self.state["buckets"]
        self.log.put(f"{number:012d}-one.json", change)
        self._apply(change)
        self.number = number
        if number % SNAPSHOT == 0:
            self.log.put(f"{number:012d}-all.json", self.state)
            self.log.delete([n for n in self.log.names() if int(n.split("-")[0]) < number])

    # -------------------------------------------------------------- reading
    def bucket(self, column: str = "event_id"):
        return F.pmod(F.xxhash64(column), F.lit(self.state["buckets"])).cast("int")

    def _load(self, kind: str, schema: T.StructType, parts: Iterable[str] | None = None) -> DataFrame:
        names = sorted(self.state[kind]) if parts is None else sorted(parts)
        if not names:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{kind}"
        return (self.spark.read.schema(schema).option("basePath", base).format(self.fmt)
                .load([f"{base}/batch={name}" for name in names]))

    def bronze(self) -> DataFrame:
        """Committed rows, with the columns batch and bucket."""
        return self._load("bronze", self.read_schema(self.schema, "bucket"))

    def rejects(self) -> DataFrame:
        return self._load("rejects", self.read_schema(self.reject_schema))

    @staticmethod
    def read_schema(schema: T.StructType, *more: str) -> T.StructType:
        fields = [T.StructField("batch", T.StringType()), *(T.StructField(m, T.IntegerType()) for m in more)]
        return T.StructType([*schema.fields, *fields])

    reject_schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType()),
                                  T.StructField("arrival_ts", T.TimestampNTZType()), T.StructField("arrival_a", T.LongType()),
                                  T.StructField("arrival_b", T.LongType()), T.StructField("reasons", T.StringType())])

    def known(self, ids: DataFrame) -> DataFrame:
        """(event_id, bucket) of ``ids`` that are stored, reading only the buckets that ``ids`` fall into."""
        asked = ids.select("bucket", "event_id") if "bucket" in ids.columns else ids.select(self.bucket().alias("bucket"), "event_id")
        wanted = [r[0] for r in asked.select("bucket").distinct().collect()]  # at most all buckets
        stored = self.bronze().where(F.col("bucket").isin(wanted)) if wanted else self.bronze().limit(0)
        return stored.select("bucket", "event_id").join(asked, ["bucket", "event_id"], "left_semi").select("event_id", "bucket")

    # -------------------------------------------------------------- writing
    def _write(self, kind: str, df: DataFrame, name: str, expected: int = 0) -> None:
        path = f"{self.root}/{kind}/batch={name}"
        if kind == "rejects":
            df.write.mode("overwrite").format(self.fmt).save(path)
            return
        dealt, as_they_are = df.drop("batch"), "bucket" in df.columns
        if not as_they_are:
            dealt = dealt.withColumn("bucket", self.bucket()).repartition("bucket")
        dealt = dealt.sortWithinPartitions("bucket", "event_id")
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").format(self.fmt)
        if self.fmt == "parquet":  # a filter's size follows the ids a file may hold, or those it holds
            writer = writer.option("compression", "zstd").option("parquet.bloom.filter.enabled#event_id", "true")
            if as_they_are:
                writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
            else:
                ids = max(64, 2 * expected // self.state["buckets"])
                writer = writer.option("parquet.bloom.filter.expected.ndv#event_id", str(ids))
        writer.save(path)

    def stage(self, name: str, fresh: DataFrame, rejected: DataFrame | Callable[[], DataFrame | None],
              expected: int = 0) -> dict[str, int]:
        """Writes a batch's rows, which nobody reads before ``commit``; returns how many were written.

        ``expected`` is about how many ids there are at most, for the Bloom filters.  Rows
        with a column ``bucket`` are written by the tasks that have them, others are
        brought to a task a bucket first.  ``rejected`` may be a function that is asked once
        Bronze is written, and gives None if there are no rejects.
        """
        self._write("bronze", fresh, name, expected)
        rejected = rejected() if callable(rejected) else rejected
        if rejected is not None:
            self._write("rejects", rejected, name)
        return {"stored": self._load_bronze([name]).count(),
                "rejected": 0 if rejected is None else self._load_rejects([name]).count()}

    def commit(self, name: str, stream: str, batch_id: int, counts: dict[str, int], part: int | None = None) -> None:
        """Makes a staged batch visible; ``part`` is the number of messages taken of it so far, if some are left."""
        change: dict = {"add": {}, "totals": counts}
        for kind, rows in (("bronze", counts.get("stored", 0)), ("rejects", counts.get("rejected", 0))):
            if rows:
                change["add"][kind] = {name: {"rows": rows, "bytes": self.log.bytes(f"{self.root}/{kind}/batch={name}"),
                                              "from": self.number + 1, "to": self.number + 1}}
        if part is None:
            change["last"], change["whole"] = {stream: batch_id}, [stream]
        else:
            change["part"] = {stream: part}
        self._commit(change)

    def taken(self, stream: str, batch_id: int) -> int | None:
        """Messages of this batch that are committed already; None if the batch is whole."""
        if batch_id <= self.state["last"].get(stream, -1):
            return None
        return self.state["part"].get(stream, 0)

    def committed_after(self, number: int) -> tuple[DataFrame, DataFrame, bool]:
        """Bronze rows committed after commit ``number``, and those of folders packed from both sides of it, if any."""
        entries = self.state["bronze"]
        fresh = [n for n, e in entries.items() if e.get("from", 0) > number]
        mixed = [n for n, e in entries.items() if e.get("from", 0) <= number < e.get("to", 0)]
        return self._load_bronze(fresh), self._load_bronze(mixed), bool(mixed)

    def compact(self, small_bytes: int = SMALL_BYTES, mark: int = -1) -> int:
        """Packs the folders under ``small_bytes`` into new ones of about that size; returns how many are gone.

        Folders up to commit ``mark`` and later ones are packed apart, so that who has
        read up to there (``plans.incremental``) reads the later ones alone.

        The new folders replace the old in one commit.  The old files are deleted
        by the next ``vacuum``, so readers that have begun go on.
        """
        gone = 0
        for kind, load in (("bronze", self._load_bronze), ("rejects", self._load_rejects)):
            packs: list[list[str]] = []
            for later in (False, True):
                filled = small_bytes
                for name, entry in sorted(self.state[kind].items(), key=lambda e: e[1]["bytes"]):
                    if entry["bytes"] >= small_bytes or (entry.get("to", 0) > mark) != later:
                        continue
                    if filled + entry["bytes"] > small_bytes:
                        packs.append([])
                        filled = 0
                    packs[-1].append(name)
                    filled += entry["bytes"]
            for names in packs:
                if len(names) < 2:
                    continue
                packed, old = f"p{uuid.uuid4().hex}", [self.state[kind][n] for n in names]
                rows, total = load(names), sum(self.state[kind][n]["rows"] for n in names)
                self._write(kind, rows.drop("batch").coalesce(1) if kind == "rejects" else rows.drop("bucket"), packed, total)
                entry = {"rows": total, "bytes": self.log.bytes(f"{self.root}/{kind}/batch={packed}"),
                         "from": min(e.get("from", 0) for e in old), "to": max(e.get("to", 0) for e in old)}
                self._commit({"add": {kind: {packed: entry}}, "drop": {kind: names}})
                gone += len(names)
        return gone

    def _load_bronze(self, names: list[str]) -> DataFrame:
        return self._load("bronze", self.read_schema(self.schema, "bucket"), names)

    def _load_rejects(self, names: list[str]) -> DataFrame:
        return self._load("rejects", self.read_schema(self.reject_schema), names)

    def vacuum(self) -> int:
        """Deletes folders that the manifest does not name (staged by dead runs, or packed); returns how many.

        Only when neither a writer nor a reader of an older state is at work.
        """
        gone = 0
        for kind in ("bronze", "rejects"):
            folder = FolderLog(self.spark, f"{self.root}/{kind}")
            path = folder._path(folder.path)
            names = [s.getPath().getName() for s in folder.fs.listStatus(path)] if folder.fs.exists(path) else []
            old = [n for n in names if n.startswith("batch=") and n[6:] not in self.state[kind]]
            folder.delete(old)
            gone += len(old)
        return gone
