"""Deterministic raw-data generation, driven by existing tables.

Each generated row takes its sequence number from a row of a source table
(``customer``, ``part``, ``events``), so the work is spread over that table's
partitions and grows with it.  Choices come from ``xxhash64`` of (number, seed,
field) instead of a sequential random stream, so any partition can compute its
rows alone and the same seed always gives the same data.  Keys are ``C%03d`` / ``P%03d`` / ``E%04d`` and widen past
the pad; event foreign keys always point at generated customers and products.
"""

from __future__ import annotations

import calendar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values (the sample catalogue the generator draws from) -----------
FIRST_NAMES = ["Amira", "Omar", "Sofia", "Daniel", "Aisha", "Liam", "Maya", "Yuki", "Chloe", "Ravi",
               "Fatima", "Lucas"]
LAST_NAMES = ["Al-Tamimi", "Khan", "Martinez", "Smith", "Chen", "Okafor", "Dubois", "Silva", "Andersson",
              "Patel", "Sato", "Haddad"]
COUNTRIES = ["Saudi Arabia", "United Arab Emirates", "United States", "United Kingdom", "Canada", "Germany",
             "India", "Japan", "Brazil", "Australia", "Nigeria", "South Africa"]
PRODUCTS = [
    ("Wireless Keyboard", "Electronics", 279.00),
    ("USB-C Laptop Hub", "Electronics", 149.00),
    ("Data Engineering Handbook", "Books", 159.00),
    ("Insulated Water Bottle", "Home", 85.00),
    ("Noise Cancelling Headphones", "Electronics", 599.00),
    ("Running Shoes", "Sports", 349.00),
    ("Cotton Overshirt", "Clothing", 179.00),
    ("Smart LED Desk Lamp", "Home", 129.00),
]
EVENT_TYPES = ["view", "add_to_cart", "purchase"]
SIGNUP_START, SIGNUP_DAYS = "2026-01-01", 90
EVENTS_START, EVENTS_SECONDS = (2026, 3, 1), 14 * 24 * 60 * 60
QUANTITY_MAX = 3
DEFAULT_SEED = 42
# -----------------------------------------------------------------------------

def draw(number: Column, seed: int, field_no: int) -> Column:
    """Pseudo-random integer >= 0 for (number, seed, field); different fields are independent."""
    return F.pmod(F.xxhash64(number.cast("bigint"), F.lit(seed), F.lit(field_no)), F.lit(2**62))


def _pick(values: list, index: Column) -> Column:
    return F.array(*[F.lit(v) for v in values])[index.cast("int")]


def customers(source: DataFrame, number_col: str = "c_custkey", seed: int = DEFAULT_SEED) -> DataFrame:
    """customer_id, name, country, signup_date (text), one per source row."""
    n = F.col(number_col) + 1
    return source.select(
        F.format_string("C%03d", n).alias("customer_id"),
        F.concat_ws(" ", _pick(FIRST_NAMES, draw(n, seed, 1) % len(FIRST_NAMES)),
                    _pick(LAST_NAMES, draw(n, seed, 2) % len(LAST_NAMES))).alias("name"),
        _pick(COUNTRIES, draw(n, seed, 3) % len(COUNTRIES)).alias("country"),
        F.date_format(F.date_add(F.lit(SIGNUP_START).cast("date"), (draw(n, seed, 4) % SIGNUP_DAYS).cast("int")),
                      "yyyy-MM-dd").alias("signup_date"),
    )


def products(source: DataFrame, number_col: str = "p_partkey") -> DataFrame:
    """product_id, product_name, category, price: the catalogue cycled, numbered past its end."""
    n = F.col(number_col) + 1
    slot = (n - 1) % len(PRODUCTS)
    name = _pick([p[0] for p in PRODUCTS], slot)
    return source.select(
        F.format_string("P%03d", n).alias("product_id"),
        F.when(n <= len(PRODUCTS), name).otherwise(F.concat_ws(" ", name, n.cast("string"))).alias("product_name"),
        _pick([p[1] for p in PRODUCTS], slot).alias("category"),
        _pick([p[2] for p in PRODUCTS], slot).alias("price"),
    )


def events(source: DataFrame, number_col: str, customer_col: str, product_col: Column,
           seed: int = DEFAULT_SEED) -> DataFrame:
    """event_id, customer_id, product_id, event_type, timestamp (ISO, Z), quantity.

    Foreign keys come from the source row's customer and product numbers, so
    they exist whenever the generated dimensions cover those numbers.
    """
    n = F.col(number_col) + 1
    start = calendar.timegm((*EVENTS_START, 0, 0, 0))
    ts = F.timestamp_seconds(F.lit(start) + draw(n, seed, 6) % EVENTS_SECONDS)
    return source.select(
        F.format_string("E%04d", n).alias("event_id"),
        F.format_string("C%03d", F.col(customer_col) + 1).alias("customer_id"),
        F.format_string("P%03d", product_col + 1).alias("product_id"),
        _pick(EVENT_TYPES, draw(n, seed, 5) % len(EVENT_TYPES)).alias("event_type"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        (draw(n, seed, 7) % QUANTITY_MAX + 1).cast("int").alias("quantity"),
    )


def from_counts(spark, customers_n: int, products_n: int, events_n: int,
                seed: int = DEFAULT_SEED) -> dict[str, DataFrame]:
    """All three raw tables from counts alone (the generator's command-line form).

    Rows come from ``spark.range`` (split over the cluster); each event draws its
    customer and product numbers from the mix, so every foreign key exists.
    """
    cust = customers(spark.range(customers_n).withColumnRenamed("id", "c_custkey"), seed=seed)
    prod = products(spark.range(products_n).withColumnRenamed("id", "p_partkey"))
    n = F.col("id") + 1
    ev_src = spark.range(events_n).select(
        "id", (draw(n, seed, 8) % customers_n).alias("c"), (draw(n, seed, 9) % products_n).alias("p"))
    return {"customers": cust, "products": prod, "events": events(ev_src, "id", "c", F.col("p"), seed=seed)}
