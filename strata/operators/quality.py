"""Data-quality rules and the gate that stops a run before it writes.

Rules produce one small table ``(rule, table_name, checked, failed)``.  Each
rule set is a single aggregation over its table (``count_if`` per rule), so a
gate over N tables costs N scans, not one per rule.  The gate collects only
that rules table (one row per rule) to decide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.enrich import orphans_of
from strata.schemas import DEFAULT_CURRENCY, EVENT_TYPES


class QualityGateError(RuntimeError):
    """Raised when a gated run finds a failing rule."""


def blank(c: Column) -> Column:
    """Null or empty text (a single space is not blank)."""
    return c.isNull() | (c.cast("string") == "")


# The accepted text forms of a day, and of a day with or without a time of day.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_TIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def not_iso_date(c: Column) -> Column:
    text = c.cast("string")
    return ~F.coalesce(text.rlike(ISO_DATE) & F.try_to_date(text).isNotNull(), F.lit(False))


def not_iso_time(c: Column) -> Column:
    """Neither text of the accepted form that names a real instant nor a timestamp."""
    text = c.cast("string")
    return ~F.coalesce(text.rlike(ISO_TIME) & F.try_to_timestamp(F.regexp_replace(text, ",", ".")).isNotNull(), F.lit(False))


def any_blank(*columns: Column) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | blank(c)
    return out


def rule_table(df: DataFrame, table_name: str, rules: Sequence[tuple[str, Column]],
               unique: str | None = None) -> DataFrame:
    """Evaluate ``(rule, failed?)`` pairs in one pass; long format output.

    ``unique`` adds the rule ``primary_key``: surplus rows of that column and blank ones.
    """
    names = [name for name, _ in rules]
    tests = [F.count_if(F.coalesce(failed, F.lit(True))) for _, failed in rules]
    if unique is not None:
        key = F.col(unique).cast("string")
        names.append("primary_key")
        tests.append(F.count(key) - F.count_distinct(key) + F.count_if(blank(key)))
    agg = df.agg(F.count(F.lit(1)).alias("checked"), *[t.alias(f"_r{i}") for i, t in enumerate(tests)])
    stack = ", ".join(f"'{name}', _r{i}" for i, name in enumerate(names))
    return agg.select(F.expr(f"stack({len(names)}, {stack}) AS (rule, failed)"),
                      F.lit(table_name).alias("table_name"), "checked") \
        .select("rule", "table_name", F.col("checked").cast("bigint"), F.col("failed").cast("bigint"))


def primary_key(df: DataFrame, key: str, table_name: str) -> DataFrame:
    """rows, distinct keys and blank keys of one table (unique and truthy PK)."""
    k = F.col(key).cast("string")
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                  F.count_distinct(k).cast("bigint").alias("distinct_keys"),
                  F.count_if(blank(k)).cast("bigint").alias("blanks")) \
        .select(F.lit(table_name).alias("table_name"), "rows", "distinct_keys", "blanks")


def foreign_key(facts: DataFrame, dim: DataFrame, key: str, edge: str) -> DataFrame:
    """Number of facts whose ``key`` has no row in ``dim`` (a null key counts).

    Facts are counted per key first (partial aggregate: a hot key is one row per
    map task), so the anti join sees distinct keys, not every fact.
    """
    per_key = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return orphans_of(per_key, dim, key).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphans")) \
        .select(F.lit(edge).alias("edge"), "orphans")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def pk_rules_as_checks(pk: DataFrame) -> DataFrame:
    """PK summary -> rule rows (duplicates and blanks both fail the key)."""
    return pk.select(F.lit("primary_key").alias("rule"), "table_name", F.col("rows").alias("checked"),
                     ((F.col("rows") - F.col("distinct_keys")) + F.col("blanks")).alias("failed"))


def fk_rules_as_checks(fk: DataFrame) -> DataFrame:
    return fk.select(F.lit("foreign_key").alias("rule"), F.col("edge").alias("table_name"),
                     F.lit(None).cast("bigint").alias("checked"), F.col("orphans").alias("failed"))


def source_domains(customers: DataFrame, products: DataFrame, events: DataFrame) -> dict[str, list[tuple[str, Column]]]:
    """Of each raw table its rules that a row alone decides, as ``(rule, failed?)``."""
    present = [F.col(c) for c in events.columns if not c.startswith("_")]
    if "currency" in events.columns:  # may be absent: then the default applies
        present = [F.col(c) for c in events.columns if not c.startswith("_") and c != "currency"]
        present.append(F.coalesce(F.col("currency"), F.lit(DEFAULT_CURRENCY)))
    return {
        "customers": [("required_present", any_blank(*[F.col(c) for c in customers.columns])),
                      ("signup_date_iso", not_iso_date(F.col("signup_date")))],
        "products": [("required_present", any_blank(*[F.col(c) for c in products.columns])),
                     ("price_positive", ~(F.trim(F.col("price").cast("string")).try_cast("decimal(38,10)") > 0))],
        "events": [("required_present", any_blank(*present)),
                   ("event_type_domain", ~F.col("event_type").isin(*EVENT_TYPES)),
                   ("quantity_positive", ~(F.col("quantity").try_cast("bigint") > 0)),
                   ("timestamp_iso", not_iso_time(F.col("timestamp")))],
    }


def observed(rules: Sequence[tuple[str, Column]]) -> list[Column]:
    """Rules as aggregates that a write can count on its way (``DataFrame.observe``)."""
    return [F.count_if(F.coalesce(failed, F.lit(True))).alias(rule) for rule, failed in rules]


def key_rules(customers: DataFrame, products: DataFrame, events: DataFrame) -> DataFrame:
    """Primary and foreign keys of the three tables; reads nothing but their key columns."""
    keys = [("customers", customers, "customer_id"), ("products", products, "product_id"), ("events", events, "event_id")]
    unique = [rule_table(df.select(key), name, [], unique=key) for name, df, key in keys]
    known = [foreign_key(events.select(key), dim.select(key), key, "events")
             .select(F.lit(rule).alias("rule"), F.col("edge").alias("table_name"),
                     F.lit(None).cast("bigint").alias("checked"), F.col("orphans").alias("failed"))
             for rule, dim, key in (("customer_known", customers, "customer_id"), ("product_known", products, "product_id"))]
    return union_all([*unique, *known])


def source_rules(customers: DataFrame, products: DataFrame, events: DataFrame) -> DataFrame:
    """Every rule on the raw frames: keys, foreign keys and domains, one pass over each table.

    The events meet the distinct keys of both dimensions in left joins, so
    their foreign-key rules are counted in the same pass as their domains.
    """
    known = [dim.select(F.col(key)).where(F.col(key).isNotNull()).distinct().withColumn(f"_has_{key}", F.lit(True))
             for dim, key in ((customers, "customer_id"), (products, "product_id"))]
    joined = events.join(known[0], "customer_id", "left").join(known[1], "product_id", "left")
    domains = source_domains(customers, products, events)
    return union_all([
        rule_table(customers, "customers", domains["customers"], unique="customer_id"),
        rule_table(products, "products", domains["products"], unique="product_id"),
        rule_table(joined, "events", [
            *domains["events"],
            ("customer_known", F.col("_has_customer_id").isNull()),
            ("product_known", F.col("_has_product_id").isNull())], unique="event_id"),
    ])


def assert_clean(rules: DataFrame) -> None:
    """Raise ``QualityGateError`` naming every failing rule (the rules table is tiny)."""
    assert_none({f"{r['table_name']}.{r['rule']}": r["failed"] for r in rules.filter(F.col("failed") > 0).collect()})


def assert_none(failed: dict[str, int]) -> None:
    """The same for counted rules: ``<table>.<rule>`` -> failing rows."""
    if any(failed.values()):
        names = ", ".join(f"{rule}={n}" for rule, n in failed.items() if n)
        raise QualityGateError(f"data-quality gate failed: {names}")
