"""Incremental summaries: runs over parts equal one over all, read only what is new, survive a crash and compaction."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators import aggregate as G
from strata.plans import incremental as INC
from strata.schemas import BRONZE_EVENTS
from strata.session import scratch_path
from strata.sinks.batch_store import BatchStore


@pytest.fixture(scope="module")
def dims(spark):
    cu = spark.createDataFrame([("C1", "Japan"), ("C2", None)], "customer_id string, country string")
    pr = spark.createDataFrame([("P1", "Hub", "Electronics", 1.1), ("P2", "Cup", "Home", 2.25)],
                               "product_id string, product_name string, category string, price double")
    return cu, pr.withColumn("price", F.col("price").cast("decimal(10,2)"))


def put(spark, store, batch, ids, kind="purchase", customer=None, time="2026-03-10T09:15:00Z"):
    rows = [{"event_id": f"E{i}", "customer_id": customer or f"C{i % 2 + 1}", "product_id": f"P{i % 2 + 1}", "event_type": kind,
             "timestamp": time, "quantity": i, "currency": "USD", "message": "{}"} for i in ids]
    frame = spark.createDataFrame([tuple(r.get(f.name) for f in BRONZE_EVENTS.fields) for r in rows], BRONZE_EVENTS)
    empty = spark.createDataFrame([], BatchStore.reject_schema)
    store.commit(f"b{batch}", "s", batch, store.stage(f"b{batch}", frame, empty))


def whole(spark, store, dims):
    from strata.plans import medallion as M
    every = G.summary_all(M.enriched_rows(store.bronze(), *dims))
    return sorted((tuple(r) for r in every.collect()), key=str)


def seen(spark, root):
    done = INC.Enriched(spark, root)
    return sorted((tuple(r) for name in G.SUMMARY_DIMENSIONS
                   for r in done.summary(name).select(F.lit(name), "dimension", "purchase_count", "units_sold", "revenue").collect()),
                  key=str)


def test_runs_over_parts_equal_one_over_all(spark, dims):
    root = scratch_path(spark, "parts")
    store = BatchStore(spark, root, BRONZE_EVENTS, buckets=2)
    assert INC.advance(spark, store, *dims, root) == 0 and seen(spark, root) == []
    put(spark, store, 1, range(1, 6))
    assert INC.advance(spark, store, *dims, root) == 5
    put(spark, store, 2, range(6, 8), kind="view")
    put(spark, store, 3, [8], time="soon")      # no time, no sale
    put(spark, store, 4, [9, 10, 3_000_000])
    assert INC.advance(spark, store, *dims, root) == 5
    assert INC.advance(spark, store, *dims, root) == 0       # nothing new: nothing counted twice
    assert seen(spark, root) == whole(spark, store, dims)
    assert INC.Enriched(spark, root).rows().count() == 10


def test_a_run_reads_its_own_commits_only(spark, dims):
    root = scratch_path(spark, "own")
    store = BatchStore(spark, root, BRONZE_EVENTS, buckets=2)
    for batch in range(1, 5):
        put(spark, store, batch, range(10 * batch, 10 * batch + 3))
    INC.advance(spark, store, *dims, root)
    put(spark, store, 5, [99])
    fresh, _, mixed = store.committed_after(INC.Enriched(spark, root).upto)
    files = {f.split("/batch=")[1].split("/")[0] for f in fresh.inputFiles()}
    assert files == {"b5"} and not mixed


def test_compaction_keeps_what_is_new_apart(spark, dims):
    root = scratch_path(spark, "packed")
    store = BatchStore(spark, root, BRONZE_EVENTS, buckets=2)
    for batch in (1, 2):
        put(spark, store, batch, [batch])
    INC.advance(spark, store, *dims, root)
    for batch in (3, 4):
        put(spark, store, batch, [batch])
    assert store.compact(mark=INC.Enriched(spark, root).upto) == 4 and len(store.state["bronze"]) == 2
    assert INC.advance(spark, store, *dims, root) == 2
    put(spark, store, 5, [5])
    assert store.compact() == 3                  # without a mark old and new are mixed
    assert INC.advance(spark, store, *dims, root) == 1
    assert INC.advance(spark, store, *dims, root) == 0
    assert seen(spark, root) == whole(spark, store, dims)


def test_a_run_that_dies_counts_nothing(spark, dims, monkeypatch):
    root = scratch_path(spark, "dies")
    store = BatchStore(spark, root, BRONZE_EVENTS, buckets=2)
    put(spark, store, 1, [1, 2])
    INC.advance(spark, store, *dims, root)
    before = seen(spark, root)
    put(spark, store, 2, [3, 4])
    monkeypatch.setattr(INC.Enriched, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        INC.advance(spark, store, *dims, root)
    monkeypatch.undo()
    assert seen(spark, root) == before
    assert INC.advance(spark, store, *dims, root) == 2 and seen(spark, root) == whole(spark, store, dims)


def test_orphans_follow_the_policy(spark, dims):
    root = scratch_path(spark, "orphans")
    store = BatchStore(spark, root, BRONZE_EVENTS, buckets=2)
    put(spark, store, 1, [1, 2])
    put(spark, store, 2, [3], customer="nobody")
    with pytest.raises(Exception, match="orphan customer"):
        INC.advance(spark, store, *dims, root)
    assert seen(spark, root) == []
    assert INC.advance(spark, store, *dims, root, orphans="drop") == 2


def test_command(spark):
    from strata.__main__ import run
    fix = os.path.join(os.path.dirname(__file__), "fixtures")
    topic, root = scratch_path(spark, "topic"), scratch_path(spark, "v1")
    for _ in range(2):
        assert run(["publish", "--events", f"{fix}/events.json", "--topic", topic], spark) == 0
        assert run(["ingest", "--topic", topic, "--root", root], spark) == 0
        assert run(["enrich", "--root", root, "--raw", fix, "--incremental"], spark) == 0
        assert run(["compact", "--root", root], spark) == 0
    got = {r.dimension: r.revenue for r in INC.Enriched(spark, root).summary("revenue_by_country").collect()}
    assert got == {"Japan": 298.0, "United States": 255.0, "Saudi Arabia": 159.0}
