"""Attach dimension attributes to facts under an explicit orphan policy.

orphans = "drop"  inner join; a fact whose key has no dimension row disappears
          "keep"  left join; the fact stays with null attributes
          "fail"  left join plus a guard that raises on the first orphan, lazily,
                  inside the same job (no extra pass, no collect)

Join strategy is Spark's: the dimension is broadcast only when its size
estimate is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks with
runtime sizes); otherwise it is a shuffle join, with AQE splitting skewed keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.schemas import DEFAULT_CURRENCY

POLICIES = ("drop", "keep", "fail")


def attach(facts: DataFrame, dim: DataFrame, key: str, orphans: str = "drop",
           label: str | None = None) -> DataFrame:
    """Join ``dim`` (key + attributes) onto ``facts`` by ``key`` under the policy."""
    if orphans not in POLICIES:
        raise ValueError(f"orphans must be one of {POLICIES}, got {orphans!r}")
    if orphans == "drop":
        return facts.join(dim, key, "inner")
    if orphans == "keep":
        return facts.join(dim, key, "left")
    marker = f"_found_{key}"
    joined = facts.join(dim.withColumn(marker, F.lit(True)), key, "left")
    guard = F.when(F.col(marker).isNull() & F.col(key).isNotNull(),
                   F.raise_error(F.concat(F.lit(f"orphan {label or key}: "), F.col(key).cast("string"))))
    return joined.filter(F.coalesce(guard.cast("boolean"), F.lit(True))).drop(marker)


def orphans_of(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Facts whose key is missing from the dimension (left anti)."""
    return facts.join(dim.select(key), key, "left_anti")


def members_of(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Facts whose key exists in the dimension (left semi)."""
    return facts.join(dim.select(key), key, "left_semi")


def enrich_events(events: DataFrame, customers: DataFrame, products: DataFrame,
                  orphans: str = "fail", event_type_col: str = "event_type",
                  purchase_value: str = "purchase") -> DataFrame:
    """Silver "enriched" rows: customer country, product attributes, amounts.

    ``events`` needs event_id, customer_id, product_id, event_type, event_timestamp,
    quantity and optionally currency; ``customers`` customer_id, country;
    ``products`` product_id, product_name, category, price (decimal).
    total_amount = price * quantity for purchases (exact decimal, then double), else 0.
    """
    cur = F.col("currency") if "currency" in events.columns else F.lit(DEFAULT_CURRENCY)
    ev = events.select("event_id", "customer_id", "product_id", event_type_col, "event_timestamp",
                       "quantity", cur.alias("currency"))
    withc = attach(ev, customers.select("customer_id", F.col("country").alias("customer_country")),
                   "customer_id", orphans, "customer")
    full = attach(withc, products.select("product_id", "product_name", "category", "price"),
                  "product_id", orphans, "product")
    amount = F.when(F.col(event_type_col) == purchase_value, F.col("price") * F.col("quantity")) \
        .otherwise(F.lit(0))
    return full.select(
        "event_id", "customer_id", "customer_country", "product_id", "product_name", "category",
        F.col(event_type_col).alias("event_type"), "currency",
        "event_timestamp", "quantity",
        F.col("price").cast("double").alias("unit_price"),
        amount.cast("double").alias("total_amount"),
    )


def iso_text(ts_col: str = "event_timestamp") -> Column:
    """ISO-8601 text with an explicit offset; microseconds kept when present."""
    c = F.col(ts_col).cast("timestamp")
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssxxx")
    frac = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.date_format(c, "SSSSSS") == "000000", whole).otherwise(frac)
