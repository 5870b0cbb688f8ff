"""Golden values on the six-event sample: layered run, counts, Gold rows, the gate."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.plans import medallion as M
from strata.session import scratch_path
from strata.sources import files as SF

FIX = os.path.join(os.path.dirname(__file__), "fixtures")


@pytest.fixture(scope="module")
def raw(spark):
    return {"customers": SF.read_csv(spark, f"{FIX}/customers.csv"),
            "products": SF.read_csv(spark, f"{FIX}/products.csv"),
            "events": SF.read_json_array(spark, f"{FIX}/events.json")}


@pytest.fixture(scope="module")
def run(spark, raw):
    dst = scratch_path(spark, "sample")
    metrics = M.run_medallion(spark, raw, dst)
    return dst, metrics


def test_raw_schemas(raw):
    assert all(t == "string" for _, t in raw["customers"].dtypes)
    assert dict(raw["events"].dtypes)["quantity"] == "bigint"


def test_layer_counts(spark, run):
    dst, metrics = run
    counts = {r.table_name: r.rows for r in M.layer_counts(spark, dst).collect()}
    assert counts == {"bronze_customers": 5, "bronze_products": 5, "bronze_events": 6,
                      "silver_customers": 5, "silver_products": 5, "silver_events": 6}
    assert metrics.rows["gold_top_products"] == 3


def test_gold_golden_rows(spark, run):
    dst, _ = run
    top = {r.product_id: (r.purchase_count, r.units_sold, r.revenue)
           for r in spark.read.parquet(f"{dst}/gold/top_products").collect()}
    assert top == {"P002": (1, 2, 298.0), "P004": (1, 3, 255.0), "P003": (1, 1, 159.0)}
    country = {r.country: (r.purchase_count, r.units_sold, r.revenue)
               for r in spark.read.parquet(f"{dst}/gold/sales_by_country").collect()}
    assert country == {"Japan": (1, 2, 298.0), "United States": (1, 3, 255.0), "Saudi Arabia": (1, 1, 159.0)}
    cat = {r.category: (r.purchase_count, r.units_sold, r.revenue)
           for r in spark.read.parquet(f"{dst}/gold/sales_by_category").collect()}
    assert cat == {"Electronics": (1, 2, 298.0), "Home": (1, 3, 255.0), "Books": (1, 1, 159.0)}


def test_silver_types(spark, run):
    dst, _ = run
    ev = dict(spark.read.parquet(f"{dst}/silver/events").dtypes)
    assert ev["quantity"] == "int" and ev["event_timestamp"] == "timestamp"
    pr = dict(spark.read.parquet(f"{dst}/silver/products").dtypes)
    assert pr["price"] == "decimal(10,2)"
    types = {r.event_type for r in spark.read.parquet(f"{dst}/silver/events").collect()}
    assert types == {"VIEW", "PURCHASE", "ADD_TO_CART"}


def _gate_rules(raw):
    ev, cu, pr = raw["events"], raw["customers"], raw["products"]
    pk = Q.union_all([Q.primary_key(cu, "customer_id", "customers"),
                      Q.primary_key(pr, "product_id", "products"),
                      Q.primary_key(ev, "event_id", "events")])
    fk = Q.union_all([Q.foreign_key(ev, cu, "customer_id", "events.customer_id"),
                      Q.foreign_key(ev, pr, "product_id", "events.product_id")])
    domains = Q.rule_table(ev, "events", [
        ("event_type_domain", ~F.col("event_type").isin("view", "add_to_cart", "purchase")),
        ("quantity_positive", ~(F.col("quantity") > 0)),
        ("timestamp_iso", F.try_to_timestamp("timestamp").isNull()),
    ])
    return Q.pk_rules_as_checks(pk).unionByName(Q.fk_rules_as_checks(fk)).unionByName(domains)


def test_gate_passes_on_sample(raw):
    Q.assert_clean(_gate_rules(raw))


def test_gate_stops_bad_input(spark, raw):
    bad = dict(raw)
    bad["events"] = raw["events"].unionByName(SF.read_json_array(spark, f"{FIX}/invalid_event.json"))
    with pytest.raises(Q.QualityGateError, match="quantity_positive"):
        Q.assert_clean(_gate_rules(bad))


def test_gold_contract_types_and_sql_order(spark):
    from strata.plans.registry import REGISTRY
    d = "/root/testdata/sf0.001"
    contract = REGISTRY["gold_contract"](spark, d)
    assert contract.dtypes == [("product_id", "string"), ("product_name", "string"), ("category", "string"),
                               ("purchase_count", "bigint"), ("units_sold", "bigint"), ("revenue", "double")]
    revenue = [r.revenue for r in REGISTRY["external_gold_query"](spark, d).collect()]
    assert revenue == sorted(revenue, reverse=True) and len(revenue) > 0


def test_bucketed_dimensions_join_without_dimension_shuffle(spark):
    import uuid

    from strata.operators import aggregate as G
    from strata.plans.registry import _raw_e
    db = f"strata_{uuid.uuid4().hex[:8]}"
    dst = scratch_path(spark, "bucketed")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force the shuffle-join plan
    try:
        M.run_medallion(spark, _raw_e(spark, "/root/testdata/sf0.001"), dst, database=db, dim_buckets=4)
        ev, cu, pr = (spark.table(f"{db}.silver_{n}") for n in ("events", "customers", "products"))
        plan = G.gold_sales_by_country(ev, cu, pr)._jdf.queryExecution().executedPlan().toString()
        lines = plan.split("\n")
        assert "SortMergeJoin" in plan
        for name in ("silver_customers", "silver_products"):
            at = next(k for k, line in enumerate(lines) if f"{name}[" in line or f".{name}" in line)
            assert "Bucketed: true" in lines[at]
            depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
            above = []  # the operators between the scan and its join
            for line in reversed(lines[:at]):
                d = len(line) - len(line.lstrip(" :+-"))
                if d < depth:
                    above.append(line)
                    depth = d
                    if "Join" in line:
                        break
            assert above and "Join" in above[-1] and not any("Exchange" in line for line in above)
        assert spark.read.parquet(f"{dst}/gold/sales_by_country").count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_silver_carries_bronze_ingest_time(spark, run):
    dst, _ = run
    for name in ("customers", "products", "events"):
        bronze = {r[0] for r in spark.read.parquet(f"{dst}/bronze/{name}").select("_ingested_at").distinct().collect()}
        silver = {r[0] for r in spark.read.parquet(f"{dst}/silver/{name}").select("_ingested_at").distinct().collect()}
        assert len(bronze) == 1 and silver == bronze
