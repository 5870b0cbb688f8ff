"""strata: a Spark-native medallion engine for e-commerce events.

Raw customers, products and JSON events are validated (bad messages are
quarantined with reasons), de-duplicated, conformed, enriched with dimension
attributes under an explicit orphan policy, gated on data-quality rules and
published as purchase summaries by country, category and product.
"""

__all__ = ["session", "schemas"]
