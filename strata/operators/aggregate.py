"""Purchase summaries (Gold).

Every summary carries the same measures: purchase_count, units_sold and
revenue = round(sum(quantity * price), 2), computed in exact decimal and cast to
double at the contract.

Plan shape: each purchase joins the two dimensions, and a partial + final
aggregate sums what comes out.  Nothing is grouped by (customer, product)
first: at scale nearly every such pair is a single purchase, so that step would
shuffle all purchases once more and combine nothing.  The joins are Spark's to
choose (broadcast by bytes, else shuffles whose skewed partitions AQE splits), a
hot customer or product is one row per map task in the aggregate, and the
product summaries, which need a customer only to exist, sum by product before
they meet the product table, on the partitioning that join needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.enrich import attach, members_of
from strata.schemas import PURCHASE


def measures(count_col: Column, units_col: Column, amount_col: Column) -> list[Column]:
    return [
        count_col.cast("bigint").alias("purchase_count"),
        units_col.cast("bigint").alias("units_sold"),
        F.round(amount_col, 2).cast("double").alias("revenue"),
    ]


#: Gold table -> its key columns.
GOLD_KEYS = {
    "sales_by_country": ["country"],
    "sales_by_category": ["category"],
    "top_products": ["product_id", "product_name", "category"],
}


def purchases(silver_events: DataFrame) -> DataFrame:
    return silver_events.filter(F.col("event_type") == PURCHASE).select(
        "customer_id", "product_id", F.col("event_id").isNotNull().cast("bigint").alias("n"),
        F.col("quantity").cast("bigint").alias("units"))


def _amount(money: str) -> Column:
    if money not in ("decimal", "double"):
        raise ValueError(f"money must be 'decimal' or 'double', got {money!r}")
    amount = F.col("units") * F.col("price")
    return amount.cast("double") if money == "double" else amount


def priced_purchases(silver_events: DataFrame, customers: DataFrame, products: DataFrame,
                     orphans: str = "drop", money: str = "decimal") -> DataFrame:
    """Every purchase with its country, product attributes and amount.

    ``money="double"`` casts each purchase's amount to double before any sum
    (one variant of the source jobs); the default stays exact decimal until the
    contract.
    """
    amount = _amount(money)
    facts = attach(purchases(silver_events), customers.select("customer_id", "country"), "customer_id", orphans, "customer")
    facts = attach(facts, products.select("product_id", "product_name", "category", "price"),
                   "product_id", orphans, "product")
    return facts.withColumn("amount", amount)


def summarize(priced: DataFrame, by: Sequence[str]) -> DataFrame:
    return priced.groupBy(*by).agg(*measures(F.sum("n"), F.sum("units"), F.sum("amount")))


def purchase_totals(silver_events, customers, products, orphans="drop") -> DataFrame:
    """Purchases summed per country and product: the rows that every Gold table is a sum of."""
    keys = ["country", "product_id", "product_name", "category"]
    return priced_purchases(silver_events, customers, products, orphans).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("units").alias("units"), F.sum("amount").alias("amount"))


def gold_sales_by_country(silver_events, customers, products, orphans="drop", money="decimal"):
    """Sales by customer country."""
    return summarize(priced_purchases(silver_events, customers, products, orphans, money), GOLD_KEYS["sales_by_country"])


def _per_product(silver_events, customers, products, orphans, money) -> DataFrame:
    """Purchases that pass the customer check, summed per product, then priced.

    Only the customer's existence matters here (semi join for "drop", guard for
    "fail", nothing for "keep"), and price depends on the product alone, so the
    exact sum of quantity x price is price x the sum of quantities.  Doubles are
    cast per purchase, so that form prices every purchase.
    """
    if money != "decimal":
        return priced_purchases(silver_events, customers, products, orphans, money)
    facts = purchases(silver_events)
    if orphans == "drop":
        facts = members_of(facts, customers, "customer_id")
    elif orphans == "fail":
        facts = attach(facts, customers.select("customer_id"), "customer_id", "fail", "customer")
    totals = facts.groupBy("product_id").agg(F.sum("n").alias("n"), F.sum("units").alias("units"))
    priced = attach(totals, products.select("product_id", "product_name", "category", "price"),
                    "product_id", orphans, "product")
    return priced.withColumn("amount", _amount(money))


def gold_sales_by_category(silver_events, customers, products, orphans="drop", money="decimal"):
    """Sales by product category."""
    return summarize(_per_product(silver_events, customers, products, orphans, money), GOLD_KEYS["sales_by_category"])


def gold_top_products(silver_events, customers, products, orphans="drop", money="decimal"):
    """Sales per product."""
    return summarize(_per_product(silver_events, customers, products, orphans, money), GOLD_KEYS["top_products"])


def ranked(summary: DataFrame, tie_break: Sequence[str], limit: int | None = None) -> DataFrame:
    """Revenue descending, ties broken by the key; ``limit`` gives a top-k."""
    out = summary.orderBy(F.col("revenue").desc_nulls_last(), *[F.col(c).asc() for c in tie_break])
    return out.limit(limit) if limit is not None else out


# ----------------------------------------------------------- enriched summaries
# The enriched summaries' output names -> enriched column.
SUMMARY_DIMENSIONS = {
    "revenue_by_country": "customer_country",
    "revenue_by_category": "category",
    "revenue_by_product": "product_name",
}


def _exact_amount() -> Column:
    # total_amount holds whole cents; bring it back to exact decimal before summing
    # (wide enough for the largest bigint quantity at the largest price).
    return F.col("total_amount").cast("decimal(32,2)")


def summary(enriched: DataFrame, dimension: str, purchase_value: str = "purchase") -> DataFrame:
    """One enriched summary: key column named ``dimension``, purchases only."""
    return (enriched.filter(F.col("event_type") == purchase_value)
            .groupBy(F.col(dimension).alias("dimension"))
            .agg(*measures(F.count(F.lit(1)), F.sum("quantity"), F.sum(_exact_amount()))))


def summary_all(enriched: DataFrame, purchase_value: str = "purchase") -> DataFrame:
    """All enriched summaries from one scan: GROUPING SETS + a label column."""
    return _by_dimension(enriched, purchase_value, *measures(F.count(F.lit(1)), F.sum("quantity"), F.sum(_exact_amount())))


def summary_sums(enriched: DataFrame, purchase_value: str = "purchase") -> DataFrame:
    """The same before rounding: sums (purchase_count, units_sold, amount) that add up over parts of the input."""
    return _by_dimension(enriched, purchase_value, F.count(F.lit(1)).alias("purchase_count"),
                         F.sum("quantity").cast("bigint").alias("units_sold"),
                         F.sum(_exact_amount()).cast("decimal(38,2)").alias("amount"))


def _by_dimension(enriched: DataFrame, purchase_value: str, *totals: Column) -> DataFrame:
    dims = list(SUMMARY_DIMENSIONS.items())
    purchases = enriched.filter(F.col("event_type") == purchase_value)
    grouped = purchases.groupingSets([[c] for _, c in dims], *[c for _, c in dims])
    agg = grouped.agg(*totals,
                      *[F.grouping(c).alias(f"_g{i}") for i, (_, c) in enumerate(dims)])
    label = value = None
    for i, (name, c) in enumerate(dims):
        hit = F.col(f"_g{i}") == 0
        label = F.when(hit, F.lit(name)) if label is None else label.when(hit, F.lit(name))
        value = F.when(hit, F.col(c)) if value is None else value.when(hit, F.col(c))
    return agg.select(label.alias("summary"), value.alias("dimension"),
                      *[c for c in agg.columns[len(dims):] if not c.startswith("_g")])
