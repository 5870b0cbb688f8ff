"""Silver and Gold frames built from the driver tables (through the adapters).

These are the building blocks the registered queries and the bench share.
Each function is lazy: it returns a DataFrame and runs nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import aggregate as G
from strata.operators import conform as C
from strata.operators.enrich import enrich_events
from strata.schemas import EVENT_TYPES
from strata.sources import adapters as A


def silver_customers(spark: SparkSession, sf_dir: str, segment: bool = False) -> DataFrame:
    raw = (A.segment_customers if segment else A.raw_customers)(spark, sf_dir)
    return C.silver_customers(raw.drop("segment"))


def silver_products(spark: SparkSession, sf_dir: str, segment: bool = False) -> DataFrame:
    raw = (A.segment_products if segment else A.raw_products)(spark, sf_dir)
    return C.silver_products(raw)


def silver_events_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.silver_events(A.events_e(spark, sf_dir))


def silver_events_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["event_timestamp", "product_id", "supplier_id"]
    return C.silver_events(A.events_l(spark, sf_dir), order=order)


def gold(spark: SparkSession, sf_dir: str, kind: str, orphans: str = "drop",
         segment: bool = False, events: str = "e") -> DataFrame:
    ev = silver_events_e(spark, sf_dir) if events == "e" else silver_events_l(spark, sf_dir)
    if events != "e":
        ev = ev.drop("supplier_id")
    cu = silver_customers(spark, sf_dir, segment)
    pr = silver_products(spark, sf_dir, segment)
    build = {"country": G.gold_sales_by_country, "category": G.gold_sales_by_category,
             "products": G.gold_top_products}[kind]
    return build(ev, cu, pr, orphans)


def enriched_e(spark: SparkSession, sf_dir: str, orphans: str = "fail", segment: bool = False) -> DataFrame:
    """V1-style enriched rows over adapter E.

    Only events an ingest would accept take part (domain type, exact case;
    quantity > 0; a time); the event type keeps its input case.
    """
    raw = A.events_e(spark, sf_dir)
    accepted = raw.filter(F.col("event_type").isin(*EVENT_TYPES) & (F.col("quantity") > 0)
                          & F.col("event_id").isNotNull() & F.col("timestamp").isNotNull())
    events = accepted.select("event_id", "customer_id", "product_id", "event_type",
                             F.col("timestamp").alias("event_timestamp"), "quantity")
    cu = silver_customers(spark, sf_dir, segment)
    pr = silver_products(spark, sf_dir, segment)
    return enrich_events(events, cu, pr, orphans=orphans)
