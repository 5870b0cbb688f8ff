"""Plan properties the design relies on (guards against regressions)."""

import contextlib
import io

from strata.plans.registry import REGISTRY

SF = "/root/testdata/sf0.01"


def _plan(spark, key):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        REGISTRY[key](spark, SF).explain("formatted")
    return out.getvalue()


def test_purchase_filter_reaches_the_scan(spark):
    plan = _plan(spark, "summary_all")
    assert "EqualTo(event_type,purchase)" in plan


def test_gold_pre_aggregates_before_exchanges(spark):
    plan = _plan(spark, "gold_top_products")
    assert "partial_sum" in plan
    assert "Window" not in plan


def test_dedup_is_a_partial_aggregate_not_a_window(spark):
    plan = _plan(spark, "dedup_events")
    assert "partial_min" in plan and "Window" not in plan


def test_each_message_is_parsed_once(spark):
    plan = _plan(spark, "valid_events")
    assert "Generate" in plan
    # the generator's text has line feeds of its own
    assert plan.count("inline(") >= 1 and plan.count("from_json(") == plan.count("inline(")
