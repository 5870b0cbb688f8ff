"""Silver conform: trim text, parse types, drop rows without keys, de-duplicate.

Unparsable values become null (``try_*``) and are then filtered, which is what
the layer's filters intend; ANSI mode stays on.  ``trim`` strips spaces only
(tabs and newlines survive), as Spark's ``trim`` does.  Rows are filtered
before de-duplication, so a bad twin never displaces a good row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.dedup import keep_first, keep_last


def _text(df: DataFrame, name: str) -> Column:
    """Trim a text column; other types pass through."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.trim(F.col(name))
    return F.col(name)


def _timestamp(df: DataFrame, name: str) -> Column:
    dt = df.schema[name].dataType
    if isinstance(dt, T.StringType):
        return F.try_to_timestamp(F.col(name))
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name)
    return F.try_to_timestamp(F.col(name).cast("string"))


def _try_cast(c: Column, sql_type: str) -> Column:
    return c.try_cast(sql_type)


def _one_per_key(conformed: DataFrame, key: str, last_by: Sequence[str] | None) -> DataFrame:
    if last_by is None:
        return keep_first(conformed, key)
    return keep_last(conformed, key, list(last_by)).drop(*last_by)


def silver_customers(raw: DataFrame, last_by: Sequence[str] | None = None) -> DataFrame:
    """customer_id, customer_name, country, signup_date (date), [extra columns kept].

    Of several rows of a key the last by ``last_by`` (columns then dropped) stays,
    without it the smallest.
    """
    extra = [c for c in raw.columns if c not in ("customer_id", "name", "country", "signup_date")]
    conformed = raw.select(
        _text(raw, "customer_id").alias("customer_id"),
        _text(raw, "name").alias("customer_name"),
        _text(raw, "country").alias("country"),
        F.try_to_date(F.col("signup_date").cast("string")).alias("signup_date"),
        *extra,
    ).filter(F.col("customer_id").isNotNull())
    return _one_per_key(conformed, "customer_id", last_by)


def silver_products(raw: DataFrame, last_by: Sequence[str] | None = None) -> DataFrame:
    """product_id, product_name, category, price decimal(10,2) (HALF_UP, overflow -> null), [extra columns kept]."""
    extra = [c for c in raw.columns if c not in ("product_id", "product_name", "category", "price")]
    price = raw.schema["price"].dataType
    price_col = F.trim(F.col("price")) if isinstance(price, T.StringType) else F.col("price")
    conformed = raw.select(
        _text(raw, "product_id").alias("product_id"),
        _text(raw, "product_name").alias("product_name"),
        _text(raw, "category").alias("category"),
        _try_cast(price_col, "decimal(10,2)").alias("price"),
        *extra,
    ).filter(F.col("product_id").isNotNull() & F.col("price").isNotNull())
    return _one_per_key(conformed, "product_id", last_by)


def conform_event_columns(raw: DataFrame) -> DataFrame:
    """Typed Silver event columns (no filter, no dedup)."""
    extra = [c for c in raw.columns
             if c not in ("event_id", "customer_id", "product_id", "event_type", "timestamp", "quantity")]
    return raw.select(
        _text(raw, "event_id").alias("event_id"),
        _text(raw, "customer_id").alias("customer_id"),
        _text(raw, "product_id").alias("product_id"),
        F.upper(_text(raw, "event_type")).alias("event_type"),
        _timestamp(raw, "timestamp").alias("event_timestamp"),
        _try_cast(F.col("quantity"), "int").alias("quantity"),
        *extra,
    )


def usable_events() -> Column:
    return (F.col("event_id").isNotNull() & F.col("event_timestamp").isNotNull()
            & (F.col("quantity") > 0))


def silver_events(raw: DataFrame, order: Sequence[str] | None = None, dedup: bool = True) -> DataFrame:
    """Filter first, then keep the earliest row per event_id by a total order.

    ``order`` names Silver columns; by default the event time, then every other column.
    """
    typed = conform_event_columns(raw).filter(usable_events())
    if not dedup:
        return typed
    if order is None:
        order = ["event_timestamp"] + [c for c in typed.columns if c not in ("event_id", "event_timestamp")]
    return keep_first(typed, "event_id", order)
