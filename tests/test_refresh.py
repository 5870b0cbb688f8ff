"""Write, audit, publish: what readers see after good, failing and broken runs."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators.quality import QualityGateError
from strata.plans import medallion as M
from strata.plans import refresh as R
from strata.session import scratch_path

FIX = os.path.join(os.path.dirname(__file__), "fixtures")


@pytest.fixture(scope="module")
def raw(spark):
    return M.read_raw(spark, FIX)


def top(snapshot):
    return {r.product_id: r.revenue for r in snapshot.read("gold", "top_products").collect()}


def runs(root):
    return sorted(n for n in os.listdir(root.replace("file:", "")) if n.startswith("run="))


def test_nothing_is_published_at_first(spark):
    with pytest.raises(FileNotFoundError):
        R.Snapshots(spark, scratch_path(spark, "none")).latest()


def test_failing_input_leaves_the_published_layers(spark, raw):
    root = scratch_path(spark, "refresh")
    first, metrics = R.refresh(spark, raw, root)
    want = {"P002": 298.0, "P004": 255.0, "P003": 159.0}
    assert (first.number, top(first), metrics.rows["bronze_events"]) == (1, want, 6)
    for column, value, rule in (("event_type", "click", "event_type_domain"), ("timestamp", "2026-01-05Tjunk", "timestamp_iso"),
                                ("customer_id", "nobody", "customer_known"), ("product_id", None, "product_known"),
                                ("event_id", "E001", "primary_key"), ("quantity", 0, "quantity_positive")):
        kind = raw["events"].schema[column].dataType
        with pytest.raises(QualityGateError, match=f"events.{rule}="):
            R.refresh(spark, {**raw, "events": raw["events"].withColumn(column, F.lit(value).cast(kind))}, root)
    with pytest.raises(QualityGateError, match="products.price_positive=5"):
        R.refresh(spark, {**raw, "products": raw["products"].withColumn("price", F.lit("-1"))}, root)
    seen = R.Snapshots(spark, root).latest()
    assert (seen.number, top(seen), len(runs(root))) == (1, want, 1)  # failed runs leave no folder


def test_audit_finds_what_the_gate_finds(spark, raw):
    from strata.operators import quality as Q
    events = raw["events"].unionByName(raw["events"].withColumn("customer_id", F.lit(None).cast("string")).limit(2))
    with pytest.raises(QualityGateError) as before:
        Q.assert_clean(Q.source_rules(raw["customers"], raw["products"], events))
    with pytest.raises(QualityGateError) as after:
        R.refresh(spark, {**raw, "events": events}, scratch_path(spark, "same"))

    def named(e):
        return set(str(e.value).split(": ")[1].split(", "))
    assert named(before) == named(after)


def test_readers_see_whole_runs_only(spark, raw, monkeypatch):
    root = scratch_path(spark, "whole")
    old, _ = R.refresh(spark, raw, root)
    held = old.read("gold", "top_products")
    fewer = {**raw, "events": raw["events"].where("product_id <> 'P002'")}
    write, done = M._write_observed, []

    def dies(df, path, stage, *args, **more):
        if stage == "gold_sales_by_category":
            raise OSError("lost")
        done.append(stage)
        return write(df, path, stage, *args, **more)

    monkeypatch.setattr(M, "_write_observed", dies)
    with pytest.raises(OSError, match="lost"):
        R.refresh(spark, fewer, root)
    assert "silver_events" in done  # half-way
    assert top(R.Snapshots(spark, root).latest()) == top(old) and len(runs(root)) == 2
    monkeypatch.undo()
    new, _ = R.refresh(spark, fewer, root)
    assert new.number == 2 and "P002" not in top(new)
    assert held.count() == 3  # begun before, still whole
    assert R.Snapshots(spark, root).vacuum() == 2 and len(runs(root)) == 1
    assert top(R.Snapshots(spark, root).latest()) == top(new)
    again, _ = R.refresh(spark, raw, root)
    assert again.number == 3


def test_the_second_of_two_runs_at_once_fails(spark, raw):
    root = scratch_path(spark, "twice")
    published = R.Snapshots(spark, root)
    published.publish(1, "run=a", "parquet", {})
    with pytest.raises(RuntimeError, match="taken"):
        published.publish(1, "run=b", "parquet", {})
    assert published.latest().folder.endswith("run=a")


def test_raw_events_are_read_once_and_bronze_keys_only(spark, raw):
    from strata.operators import quality as Q
    root = scratch_path(spark, "plans")
    snapshot, _ = R.refresh(spark, raw, root)
    keys = Q.key_rules(*(snapshot.read("bronze", n) for n in M.LAYER_TABLES))
    plan = keys._jdf.queryExecution().executedPlan().toString()
    schemas = {line.split("ReadSchema: ")[1] for line in plan.split("\n") if "ReadSchema: " in line}
    assert schemas == {f"struct<{k}:string>" for k in ("customer_id", "product_id", "event_id")}


def test_catalog_tables_follow_the_snapshot(spark, raw):
    from strata.__main__ import run
    lake, database = scratch_path(spark, "lake"), "strata_refresh_test"
    try:
        for _ in range(2):
            assert run(["medallion", "--raw", FIX, "--lake", lake, "--database", database, "--vacuum"], spark) == 0
        counts = {r.table_name: r.rows for r in M.table_counts_sql(spark, database).collect()}
        assert counts["bronze_events"] == 6 and counts["silver_customers"] == 5
        assert spark.table(f"{database}.gold_top_products").count() == 3 and len(runs(lake)) == 1
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_empty_tables_are_published(spark, raw):
    empty = {name: df.limit(0) for name, df in raw.items()}
    snapshot, metrics = R.refresh(spark, empty, scratch_path(spark, "empty"))
    assert top(snapshot) == {} and metrics.rows["silver_events"] == 0


def test_preview_shows_whole_cells_of_the_rows_asked_for(spark, capsys):
    from strata.sinks.files import preview
    preview(spark.createDataFrame([("x" * 60,), ("y",)], "v string").orderBy("v"), rows=1)
    out = capsys.readouterr().out
    assert "x" * 60 in out and "|y" not in out
