"""Batch ingest: validate -> quarantine -> first-arrival dedup -> skip stored ids.

Order matters: only valid messages claim an id, so a rejected message never
blocks a later valid one with the same id.  The Bronze check is a left anti
join on event_id; see ``streaming.bronze`` for the incremental form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import validate as V
from strata.operators.dedup import keep_first


def split(messages: DataFrame, text_col: str = "value",
          keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(valid Bronze rows, rejected rows with reasons) from message texts."""
    return parts(V.classify(messages, text_col), text_col, keep)


def parts(classified: DataFrame, text_col: str = "value", keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The two halves of messages already classified (``validate.classify``)."""
    valid = V.to_bronze(classified, keep=tuple(keep))
    rejected = classified.filter(~F.col("is_valid")).select(
        *keep, F.col(text_col).alias("value"), F.array_join("reasons", ",").alias("reasons"))
    return valid, rejected


def first_arrivals(valid: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """One row per event_id: the earliest by the arrival order."""
    return keep_first(valid, "event_id", list(arrival))


def new_only(batch: DataFrame, stored_ids: DataFrame) -> DataFrame:
    """Rows whose event_id is not stored yet."""
    return batch.join(stored_ids.select("event_id"), "event_id", "left_anti")


def quality(messages: DataFrame, stored_ids: DataFrame | None = None,
            text_col: str = "value") -> DataFrame:
    """stored / rejected / duplicates for one ingest run, from one parse.

    Messages are grouped by their id when valid (rejects share the null group,
    which the map-side partial aggregate collapses); each valid id stores once
    unless Bronze already holds it; every other valid message is a duplicate.
    Which copy of an id wins does not change these counts.
    """
    classified = V.classify(messages, text_col)
    per_id = (classified
              .groupBy(F.when(F.col("is_valid"), V.field("event_id")).alias("event_id"))
              .agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("is_valid")).alias("r")))
    if stored_ids is not None:
        known = stored_ids.select("event_id").distinct().withColumn("_stored", F.lit(True))
        per_id = per_id.join(known, "event_id", "left")
    else:
        per_id = per_id.withColumn("_stored", F.lit(None).cast("boolean"))
    fresh = F.col("event_id").isNotNull() & F.col("_stored").isNull()
    totals = per_id.agg(F.sum("n").alias("messages"), F.sum("r").alias("rejected"),
                        F.count_if(fresh).alias("stored"))
    return totals.select(
        F.coalesce(F.col("stored"), F.lit(0)).cast("bigint").alias("stored"),
        F.coalesce(F.col("rejected"), F.lit(0)).cast("bigint").alias("rejected"),
        F.coalesce(F.col("messages") - F.col("rejected") - F.col("stored"), F.lit(0)).cast("bigint")
        .alias("duplicates"))
