"""Deterministic de-duplication.

``keep_first`` / ``keep_last`` choose one row per key by a total order.  They are
grouped ``min`` / ``max`` over ``struct(order..., payload)``, not a window: the
aggregation runs a partial (map-side) step first, so a key that holds a third
of all rows is reduced to one row per input partition before the shuffle and
never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _as_list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _pick(df: DataFrame, key: str | Sequence[str], order: Sequence[str] | None, last: bool,
          copies: str | None = None) -> DataFrame:
    keys = _as_list(key)
    payload = [c for c in df.columns if c not in keys]
    order = list(order) if order is not None else payload
    # Order columns lead the struct (struct comparison is field by field);
    # the rest of the row follows, so each column is carried once.
    fields = order + [c for c in payload if c not in order]
    ranked = F.struct(*[F.col(c).alias(f"_f{i}") for i, c in enumerate(fields)])
    chosen = (F.max if last else F.min)(ranked).alias("_w")
    pos = {c: i for i, c in enumerate(fields)}
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    return df.groupBy(*keys).agg(chosen, *counted).select(
        *[F.col(c) if c in keys else F.col(f"_w._f{pos[c]}").alias(c) for c in df.columns], *([copies] if copies else []))


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str] | None = None,
               copies: str | None = None) -> DataFrame:
    """One row per key: the smallest by ``order`` (default: all non-key columns).

    ``copies`` names a column to add: how many rows the key has.
    """
    return _pick(df, key, order, last=False, copies=copies)


def keep_last(df: DataFrame, key: str | Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the largest by ``order`` ("last row wins" given a file-order column)."""
    return _pick(df, key, order, last=True)


def duplicate_count(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """rows, distinct keys and surplus copies in one aggregation."""
    keys = _as_list(key)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.sum("_n").cast("bigint").alias("rows"),
                       F.count(F.lit(1)).alias("distinct_keys"),
                       F.sum(F.col("_n") - 1).cast("bigint").alias("duplicates"))
