"""Data-quality rules on crafted rows: blanks, ISO dates, positive prices, keys."""

import pytest
from pyspark.sql import functions as F

from strata.operators import quality as Q


def test_blank_is_null_or_empty_not_space(spark):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("x",)], "v string")
    assert [r.b for r in df.select(Q.blank(F.col("v")).alias("b")).collect()] == [True, True, False, False]


def test_rule_table_counts_each_rule_once(spark):
    df = spark.createDataFrame([("2026-01-12", " 9.50 "), ("2026-02-30", "abc"), ("nope", "123456789012.00"),
                                ("2026-03-01", "-1")], "d string, price string")
    rules = Q.rule_table(df, "t", [
        ("date_iso", F.try_to_date("d").isNull()),
        ("price_positive", ~(F.trim("price").try_cast("decimal(38,10)") > 0)),
    ])
    got = {r.rule: (r.table_name, r.checked, r.failed) for r in rules.collect()}
    assert got == {"date_iso": ("t", 4, 2), "price_positive": ("t", 4, 2)}


def test_primary_key_summary(spark):
    df = spark.createDataFrame([("C1",), ("C1",), ("",), (None,), ("C2",)], "id string")
    r = Q.primary_key(df, "id", "customers").first()
    assert (r.rows, r.distinct_keys, r.blanks) == (5, 3, 2)
    check = Q.pk_rules_as_checks(Q.primary_key(df, "id", "customers")).first()
    assert check.failed == (5 - 3) + 2


def test_foreign_key_counts_null_keys_as_orphans(spark):
    facts = spark.createDataFrame([("C1",), ("C1",), ("C9",), (None,)], "customer_id string")
    dim = spark.createDataFrame([("C1",)], "customer_id string")
    assert Q.foreign_key(facts, dim, "customer_id", "e.c").first().orphans == 2


def test_gate_names_failing_rules(spark):
    rules = spark.createDataFrame([("a", "t", 3, 0), ("b", "t", 3, 1)],
                                  "rule string, table_name string, checked bigint, failed bigint")
    with pytest.raises(Q.QualityGateError, match=r"t\.b=1"):
        Q.assert_clean(rules)
    Q.assert_clean(rules.filter("rule = 'a'"))
