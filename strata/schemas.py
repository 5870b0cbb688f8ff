"""Schemas and domains of the e-commerce data model.

Raw files keep everything as text (CSV) or as the JSON parser sees it; Silver
holds typed columns; Gold holds the external table contract.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (must equal the source system's rules) -------------------
# Event types accepted at ingest (exact, lower case).
EVENT_TYPES = ("view", "add_to_cart", "purchase")
# Supported currency codes; an absent currency defaults to USD.
SUPPORTED_CURRENCIES = ("AUD", "AED", "BRL", "CAD", "EUR", "GBP", "INR", "JPY", "SAR", "USD")
DEFAULT_CURRENCY = "USD"
# Fields every event must carry.
REQUIRED_EVENT_FIELDS = ("event_id", "customer_id", "product_id", "event_type", "timestamp", "quantity")
# Event type that counts as a sale in Silver (upper-cased there).
PURCHASE = "PURCHASE"
# ---------------------------------------------------------------------------

RAW_CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("signup_date", T.StringType()),
])

RAW_PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.StringType()),
])

RAW_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("currency", T.StringType()),
])

# The five Silver columns the typed category summary reads (projection at the reader).
SILVER_SUMMARY_READ = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("total_amount", T.DoubleType(), False),
])

# Gold external-table contract: column -> SQL type.
GOLD_MEASURES = (("purchase_count", "bigint"), ("units_sold", "bigint"), ("revenue", "double"))
GOLD_CONTRACT = {
    "gold_sales_by_country": (("country", "string"),) + GOLD_MEASURES,
    "gold_sales_by_category": (("category", "string"),) + GOLD_MEASURES,
    "gold_top_products": (("product_id", "string"), ("product_name", "string"),
                          ("category", "string")) + GOLD_MEASURES,
}

# Bronze events as stored by the ingest (quantity is the validated integer value,
# message the text as sent: fields without a column are kept in it).
BRONZE_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("currency", T.StringType()),
    T.StructField("message", T.StringType()),
])
