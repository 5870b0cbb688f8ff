"""Keyed event publishing: (key, value) records and a partitioned topic.

``publish_frame`` shapes events the way the producer does: key = customer id,
value = the event as JSON.  ``dealt`` states every record's partition, by a hash
of its key, and its number among the key's records; ``write_topic`` writes that
frame.  With a broker connector on the classpath it goes to ``format("kafka")``;
here the topic is a folder of Parquet files, one per partition, which the file
stream source reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOPIC_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("arrival_ts", T.TimestampNTZType()),
    T.StructField("arrival_a", T.LongType()),
    T.StructField("arrival_b", T.LongType()),
])

def publish_frame(events: DataFrame, key: str = "customer_id", fields: Sequence[str] | None = None,
                  keep: dict[str, str] | None = None) -> DataFrame:
    """key = text of ``key``; value = JSON object of ``fields`` (default: all columns).

    ``keep`` adds columns that order the records: topic column -> event column.
    """
    cols = list(fields or events.columns)
    return events.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*cols)).alias("value"),
                         *[F.col(c).alias(name) for name, c in (keep or {}).items()])


def keyed(df: DataFrame, partitions: int | None = None,
          order: Sequence[str] = ("arrival_ts", "arrival_a", "arrival_b")) -> DataFrame:
    """Same key -> same partition; arrival order kept inside a partition.

    Without ``partitions`` the shuffle setting and its size-driven merging decide.
    """
    present = [c for c in order if c in df.columns]
    dealt = df.repartition("key") if partitions is None else df.repartition(partitions, "key")
    return dealt.sortWithinPartitions("key", *present)


def dealt(df: DataFrame, partitions: int, order: Sequence[str] = ("arrival_ts", "arrival_a", "arrival_b")) -> DataFrame:
    """``df`` with ``partition`` (by a hash of the key, null keys together) and ``sequence`` (from 1, per key).

    A partition's rows are in one task, a task of its own, in arrival order, so any sink that writes
    a task's rows in turn keeps the order of every key.  Rows of one key that
    arrive at once follow each other by their values.
    """
    present = [c for c in order if c in df.columns]
    hashed = F.conv(F.substring(F.md5(F.coalesce(F.col("key"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("bigint")
    placed = df.withColumn("partition", (hashed % partitions).cast("int")).repartitionById(partitions, "partition")
    # A task has one partition, so neither sort begins with it: rows would be compared whole.
    numbered = placed.withColumn("sequence", F.row_number().over(
        Window.partitionBy("key", "partition").orderBy(*present, "value")).cast("bigint"))
    return numbered.sortWithinPartitions(*present, "key", "sequence")


def kafka_options(broker: str, topic: str, group_id: str | None = None, reading: bool = True) -> dict:
    """Connector options for a broker topic (consumer group only when reading)."""
    opts = {"kafka.bootstrap.servers": broker}
    if reading:
        opts["subscribe"] = topic
        if group_id:
            opts["kafka.group.id"] = group_id
    else:
        opts["topic"] = topic
    return opts


def write_topic(df: DataFrame, path: str, partitions: int | None = None, fmt: str = "parquet",
                options: dict | None = None) -> None:
    """Publish records to a topic; the default is a folder of per-partition files.

    Publishing appends (a topic only grows); the stream source picks up the new
    files on its next trigger.  ``fmt="kafka"`` writes to a broker (``options`` from
    ``kafka_options(..., reading=False)``).  Either way the records are those of
    ``dealt``, with their partition stated, so a key keeps to one partition and
    its order.  Without ``partitions`` the shuffle setting gives their number.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = dealt(df.select(*[c for c in TOPIC_SCHEMA.fieldNames() if c in df.columns]), n)
    if fmt == "kafka":
        broker_frame(out).write.format("kafka").options(**(options or {})).save()
        return
    for c in TOPIC_SCHEMA.fieldNames():
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(TOPIC_SCHEMA[c].dataType))
    writer = out.select(*TOPIC_SCHEMA.fieldNames(), "partition", "sequence").write.mode("append").format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")
    writer.save(path)


def broker_frame(records: DataFrame) -> DataFrame:
    """The columns a broker sink takes: key, value and the partition to put the record in."""
    return records.select("key", "value", "partition")


def read_topic_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None, options: dict | None = None,
                      max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of a topic (file source here; ``kafka`` with a connector).

    A new stream starts at the earliest offset; a restarted one resumes from
    its checkpoint (the committed position).  ``max_*_per_trigger`` bounds each
    micro-batch.
    """
    if fmt == "kafka":
        r = spark.readStream.format("kafka").options(**(options or {})).option("startingOffsets", "earliest")
        if max_offsets_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        return (r.load()
                .select(F.col("key").cast("string"), F.col("value").cast("string"),
                        F.col("timestamp").cast("timestamp_ntz").alias("arrival_ts"),
                        F.col("partition").cast("bigint").alias("arrival_a"),
                        F.col("offset").alias("arrival_b")))
    r = spark.readStream.schema(TOPIC_SCHEMA).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)
