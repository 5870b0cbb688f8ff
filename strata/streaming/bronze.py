"""Streaming ingest: messages -> validated, de-duplicated Bronze + dead letters.

One ``foreachBatch`` per micro-batch:

1. judge every message,
2. keep the first arrival of each valid id inside the batch,
3. drop ids Bronze already holds (stored earlier or by an earlier batch),
4. stage Bronze rows, and rejects if there are any, in folders of the batch's own, and
5. commit them, with the batch's counts, in the store's manifest.

Retry safety: readers take only what is committed.  A batch that died before its
commit is staged anew under the same name; one that died after it is known as
whole and does nothing.  A replay under a new checkpoint finds every id stored.
One writer per Bronze path.

Scale: the batch is bounded by the trigger (``maxFilesPerTrigger`` /
``maxOffsetsPerTrigger``).  The Bronze check reads the id buckets that the batch's
ids fall into (``sinks.batch_store``); Spark broadcasts the ids when their bytes
are under its threshold and shuffles otherwise.  In-batch first arrival is a
partial-aggregated ``keep_first``, so an id repeated a million times in one
batch is combined map-side.  It groups by the bucket and the id, so its shuffle
is the only one of whole rows: the check against Bronze joins on it, and the
sink writes its tasks' rows, which come sorted, as they are.  A row dealt is the
arrival, the id and the text; the typed columns are read from the text again
where it is written.  Judged messages are not kept: judging them again for the
rejects costs less than keeping them, and is left out where every message was
accepted.  Only the ids of a batch that Bronze is asked for are kept meanwhile.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.functions import validate as V
from strata.operators import arrival as A
from strata.operators.dedup import keep_first
from strata.schemas import BRONZE_EVENTS
from strata.sinks.batch_store import BatchStore

ARRIVAL = ("arrival_ts", "arrival_a", "arrival_b")


class LimitReached(Exception):
    """The run has taken as many messages as it was asked for."""


class BronzeIngest:
    """The ``foreachBatch`` body; paths must be on storage every executor sees."""

    def __init__(self, spark: SparkSession, root: str, checkpoint: str, arrival: Sequence[str] = ARRIVAL,
                 sink_format: str = "parquet", max_messages: int | None = None):
        self.spark, self.checkpoint = spark, checkpoint
        self.store = BatchStore(spark, root, BRONZE_EVENTS, sink_format)
        self.arrival = list(arrival)
        self.limit = max_messages if max_messages is not None and max_messages > 0 else None
        self._run_id: str | None = None
        self.messages = 0  # taken by this run so far
        self.limit_reached = False

    def run_id(self) -> str:
        # The stream's id is stored in its checkpoint and survives restarts.
        if self._run_id is None:
            meta = self.spark.read.text(f"{self.checkpoint}/metadata").first()[0]
            self._run_id = json.loads(meta)["id"].replace("-", "")
        return self._run_id

    def _stop_at_limit(self) -> None:
        if self.limit is not None and self.messages >= self.limit:
            self.limit_reached = True
            raise LimitReached(f"{self.messages} messages taken")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        stream = self.run_id()
        taken = self.store.taken(stream, batch_id)
        if taken is None:
            return  # committed by a run that died before the stream noted it
        self._stop_at_limit()
        if self.limit is None and not taken:
            self._ingest(batch, stream, batch_id, 0, None)
            return
        # Some of the batch: its messages in arrival order, from the first that is not taken.
        ranges = A.ranges(batch, self.arrival)
        left = sum(n for *_, n in ranges) - taken
        take = left if self.limit is None else min(left, self.limit - self.messages)
        some, kept = A.between(batch, self.arrival, ["key", "value"], ranges, taken, take)
        try:
            self._ingest(some, stream, batch_id, taken, None if take == left else taken + take)
            if take < left:
                self._stop_at_limit()
        finally:
            for frame in kept:
                frame.unpersist()

    def _ingest(self, messages: DataFrame, stream: str, batch_id: int, taken: int, part: int | None) -> None:
        """Stages and commits messages; ``part`` is how many of the batch are taken then, None for all."""
        name = f"q{stream}_{batch_id}" + (f"_{taken}" if taken else "")
        judged = V.judged(messages, reasons=True)
        rejected = judged.filter(~F.col("is_valid")).select("key", "value", *self.arrival, "reasons")
        valid = judged.filter("is_valid").select(*self.arrival, "event.event_id", F.col("value").alias("message"))
        valid = valid.withColumn("bucket", self.store.bucket())
        n, seen, ids = messages.count(), None, None
        try:
            # First arrivals, dealt by their bucket and id.
            fresh = keep_first(valid, ["bucket", "event_id"], self.arrival, copies="_copies")
            if self.store.state["bronze"]:
                ids = valid.groupBy("bucket", "event_id").agg(F.count(F.lit(1)).alias("_copies")).persist()
                different, accepted = ids.agg(F.count(F.lit(1)), F.sum("_copies")).first()
                known = self.store.known(ids).distinct()
                # A replay has none that are new: then no whole row need be dealt.
                fresh = fresh.limit(0) if known.count() == different else fresh.join(known, ["bucket", "event_id"], "left_anti")
            else:
                seen = Observation()  # in the stage that writes, where each task counts once
                fresh = fresh.observe(seen, F.sum("_copies").alias("accepted"))
            fresh = V.typed(fresh.drop("_copies", *self.arrival)).select(*BRONZE_EVENTS.fieldNames(), "bucket")

            def rejects() -> DataFrame | None:
                return None if n == (accepted if seen is None else seen.get.get("accepted")) else rejected

            counts = {"messages": n, **self.store.stage(name, fresh, rejects, n)}
            self.store.commit(name, stream, batch_id, counts, part)
            self.messages += counts["messages"]
        finally:
            if ids is not None:
                ids.unpersist()


def start(spark: SparkSession, source: DataFrame, root: str, checkpoint: str | None = None,
          available_now: bool = True, processing_time: str | None = None,
          sink_format: str = "parquet", max_messages: int | None = None) -> tuple[StreamingQuery, BronzeIngest]:
    """Start the ingest stream; Bronze, rejects and the manifest live under ``root``.

    ``sink_format`` is the Bronze / dead-letter format: Parquet by default (the
    Bronze lookup then reads one column), ``json`` for JSON lines.
    """
    checkpoint = checkpoint or f"{root}/_checkpoint"
    sink = BronzeIngest(spark, root, checkpoint, sink_format=sink_format, max_messages=max_messages)
    w = source.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start(), sink


def run_available(spark: SparkSession, source: DataFrame, root: str, checkpoint: str | None = None,
                  timeout_s: int | None = None, sink_format: str = "parquet", max_messages: int | None = None) -> None:
    """Process everything available now, then stop; limits only where the caller sets them.

    With ``max_messages`` above 0 the run takes exactly so many messages (accepted,
    rejected and duplicate ones count), or all there are; in arrival order within
    a micro-batch, which it may leave half taken.  The next run goes on from there.
    """
    q, sink = start(spark, source, root, checkpoint, sink_format=sink_format, max_messages=max_messages)
    try:
        finished = q.awaitTermination(timeout_s)
    except StreamingQueryException:
        if sink.limit_reached:
            return
        raise
    if timeout_s is not None and not finished:
        q.stop()
        raise TimeoutError(f"stream did not finish within {timeout_s}s")


def open_store(spark: SparkSession, root: str, fmt: str = "parquet") -> BatchStore:
    return BatchStore(spark, root, BRONZE_EVENTS, fmt)


def read_bronze(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    return open_store(spark, root, fmt).bronze()


def read_rejects(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    return open_store(spark, root, fmt).rejects()


def read_quality(spark: SparkSession, root: str) -> DataFrame:
    """stored / rejected / duplicates over all committed batches, as the manifest has them."""
    t = open_store(spark, root).state["totals"]
    stored, rejected = t.get("stored", 0), t.get("rejected", 0)
    return spark.createDataFrame([(stored, rejected, t.get("messages", 0) - rejected - stored)],
                                 "stored bigint, rejected bigint, duplicates bigint")
