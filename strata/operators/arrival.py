"""A stretch of a frame's rows in arrival order, without a global sort in one task.

``ranges`` and ``between`` find it by the arrival columns: only the rows of the
ranges that the stretch begins and ends in are dealt whole and put in order
(``in_order``, ``stretch``), the others are taken or left as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

#: ``monotonically_increasing_id`` has the partition above these bits and the row's place in it below.
_PLACE_BITS = 33


def ranges(df: DataFrame, arrival: Sequence[str]) -> list[tuple[Row, Row, int]]:
    """(first arrival, last arrival, rows) of ranges that follow each other and hold all rows of ``df``.

    Arrivals are given as text, which no time zone of the driver shifts.
    """
    place = F.struct(*arrival)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # stated, so that none are merged
    found = (df.select(*arrival).repartitionByRange(n, *arrival).groupBy(F.spark_partition_id().alias("range"))
             .agg(F.min(place).alias("low"), F.max(place).alias("high"), F.count(F.lit(1)).alias("rows"))
             .select("range", *[F.struct(*[F.col(f"{end}.{c}").cast("string").alias(c) for c in arrival]).alias(end) for end in ("low", "high")],
                     "rows").collect())  # a row per range
    return [(r["low"], r["high"], r["rows"]) for r in sorted(found, key=lambda r: r["range"])]


def _arrived(df: DataFrame, arrival: Sequence[str], low: Row, high: Row) -> DataFrame:
    """Rows that arrived from ``low`` to ``high``; nulls arrive first."""
    place = F.struct(*arrival)

    def at(row: Row):
        return F.struct(*[F.lit(row[c]).cast("string").cast(df.schema[c].dataType).alias(c) for c in arrival])

    return df.where((place >= at(low)) & (place <= at(high)))


def between(df: DataFrame, arrival: Sequence[str], ties: Sequence[str], found: list[tuple[Row, Row, int]],
            skip: int, take: int) -> tuple[DataFrame, list[DataFrame]]:
    """(rows number ``skip`` to ``skip + take - 1`` of ``df``, the frames persisted for them).

    ``ties`` order rows that arrive at once; ``found`` are the ``ranges`` of ``df``.
    Ranges that lie whole in the stretch are one filter of ``df``.
    """
    parts, kept, whole, before = [], [], [], 0
    for low, high, rows in found:
        begin, end = max(skip - before, 0), min(skip + take - before, rows)
        if begin == 0 and end == rows:
            whole.append((low, high))
        elif begin < end:
            dealt, counts = in_order(_arrived(df, arrival, low, high), [*arrival, *ties])
            kept.append(dealt)
            parts.append(stretch(dealt, counts, begin, end - begin))
        before += rows
    if whole:  # they follow each other
        parts.append(_arrived(df, arrival, whole[0][0], whole[-1][1]))
    out = df.limit(0) if not parts else parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out, kept


def in_order(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, list[tuple[int, int]]]:
    """(``df`` dealt into ranges of ``order`` with each row's ``_place``, rows of each range).

    The frame is persisted, since a place holds only within one dealing; the caller
    unpersists it.
    """
    dealt = (df.repartitionByRange(*order).sortWithinPartitions(*order)
             .withColumn("_place", F.monotonically_increasing_id()).persist())
    counts = dealt.groupBy(F.shiftright("_place", _PLACE_BITS).alias("range")).count().collect()  # a row per range
    return dealt, sorted((r["range"], r["count"]) for r in counts)


def stretch(dealt: DataFrame, counts: list[tuple[int, int]], skip: int, take: int) -> DataFrame:
    """Rows number ``skip`` to ``skip + take - 1`` of an ``in_order`` frame, by prefix sums over its ranges."""
    def place(number: int) -> int | None:
        before = 0
        for part, rows in counts:
            if number < before + rows:
                return (part << _PLACE_BITS) + number - before
            before += rows
        return None

    begin, end = place(skip), place(skip + take)
    some = dealt.where(F.lit(False)) if begin is None else dealt.where(F.col("_place") >= begin)
    return (some if end is None else some.where(F.col("_place") < end)).drop("_place")
