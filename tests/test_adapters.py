"""Adapter invariants the queries and oracles rely on (whole tables, no sampling)."""

from pyspark.sql import functions as F

from strata.sources import adapters as A

SF = "/root/testdata/sf0.01"


def test_every_event_becomes_one_message(spark):
    events = A.table(spark, SF, "events").count()
    msgs = A.messages_d(spark, SF)
    assert msgs.count() == events
    assert msgs.select("record_id").distinct().count() == events


def test_order_lines_carry_natural_duplicates(spark):
    lines = A.events_l(spark, SF)
    assert lines.count() == A.table(spark, SF, "lineitem").count()
    assert lines.select("event_id").distinct().count() == 45832
    assert {r.event_type for r in lines.select("event_type").distinct().collect()} == \
        {"purchase", "add_to_cart", "view"}


def test_segment_dimensions_drop_only_the_uncovered_segment(spark):
    full, seg = A.raw_customers(spark, SF), A.segment_customers(spark, SF)
    missing = full.join(seg, "customer_id", "left_anti")
    assert missing.filter(F.col("segment") != A.UNCOVERED_SEGMENT).count() == 0
    assert missing.count() == full.filter(F.col("segment") == A.UNCOVERED_SEGMENT).count() > 0


def test_events_adapter_keys_resolve(spark):
    ev = A.events_e(spark, SF)
    assert ev.join(A.raw_customers(spark, SF), "customer_id", "left_anti").count() == 0
    assert ev.join(A.raw_products(spark, SF), "product_id", "left_anti").count() == 0
