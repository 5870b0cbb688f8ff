"""Streams (in order, replay, resume), keyed partitions, generators, driver entry."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from strata.operators import generate as GEN
from strata.plans.registry import REGISTRY
from strata.session import scratch_path
from strata.streaming import bronze as SB
from strata.streaming import topic as T

SF001 = "/root/testdata/sf0.001"


def _messages(spark, rows):
    return spark.createDataFrame(rows, "key string, value string, arrival_a long") \
        .withColumn("arrival_ts", F.lit(None).cast("timestamp_ntz")) \
        .withColumn("arrival_b", F.lit(0).cast("bigint"))


def _ev(eid, qty, t="view"):
    return (f'{{"event_id":"{eid}","customer_id":"C1","product_id":"P1","event_type":"{t}",'
            f'"timestamp":"2026-03-10T09:15:00Z","quantity":{qty}}}')


def test_stream_replay_and_resume_leave_bronze_unchanged(spark):
    topic = scratch_path(spark, "topic")
    T.write_topic(_messages(spark, [("C1", _ev("E1", 1), 1), ("C1", _ev("E1", 2), 2),
                                    ("C1", _ev("E2", -1), 3), ("C1", _ev("E2", 5), 4)]), topic)
    root = scratch_path(spark, "stream")
    for ck in ("a", "a", "b"):
        SB.run_available(spark, T.read_topic_stream(spark, topic, max_files_per_trigger=1), root,
                         checkpoint=f"{root}/_ck_{ck}")
        rows = sorted((r.event_id, r.quantity) for r in SB.read_bronze(spark, root).collect())
        assert rows == [("E1", 1), ("E2", 5)]
    # runs: 4 messages, then nothing new (resume), then the same 4 again (replay);
    # every replayed valid message is a duplicate, the bad one is rejected again
    q = SB.read_quality(spark, root).first()
    assert (q.stored, q.rejected, q.duplicates) == (2, 2, 4)
    rej = SB.read_rejects(spark, root).collect()
    assert len(rej) == 2 and all(r.reasons == "bad_quantity" for r in rej)


def test_keyed_partitions(spark):
    rows = REGISTRY["keyed_order"](spark, SF001).collect()
    assert rows and all((r.partitions, r.inversions) == (1, 0) for r in rows)


def test_generators_deterministic_and_widen(spark):
    src = spark.range(0, 12500).withColumnRenamed("id", "n")
    a = GEN.events(src.withColumn("c", F.col("n") % 10).withColumn("k", F.col("n") % 10), "n", "c", F.col("k"))
    b = GEN.events(src.withColumn("c", F.col("n") % 10).withColumn("k", F.col("n") % 10), "n", "c", F.col("k"))
    assert a.exceptAll(b).count() == 0
    ids = {r.event_id for r in a.filter(F.col("event_id").isin("E0001", "E12345")).collect()}
    assert ids == {"E0001", "E12345"}
    q = a.agg(F.min("quantity"), F.max("quantity")).first()
    assert (q[0], q[1]) == (1, 3)
    p = GEN.products(spark.range(0, 10).withColumnRenamed("id", "p_partkey")).collect()
    assert p[0].product_name == "Wireless Keyboard" and p[8].product_name == "Wireless Keyboard 9"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["product_id", "product_name", "category", "purchase_count", "units_sold", "revenue"]
    assert df.count() > 0


def test_every_query_has_a_callable():
    qs, oq = E.queries(), E.oracle_sql()
    assert len(qs) >= 60
    assert set(oq) <= set(qs)


def test_processing_time_trigger(spark):
    topic = scratch_path(spark, "topic")
    T.write_topic(_messages(spark, [("C1", _ev("E7", 1), 1), ("C2", _ev("E8", 0), 2)]), topic)
    root = scratch_path(spark, "stream")
    q, _ = SB.start(spark, T.read_topic_stream(spark, topic), root, available_now=False,
                    processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert [r.event_id for r in SB.read_bronze(spark, root).collect()] == ["E7"]
    assert SB.read_rejects(spark, root).count() == 1


def test_stream_first_arrival_and_late_valid_copy(spark):
    # batch 1 (one file per key): E5 arrives twice, the later copy first in the
    # file; E6 arrives only invalid.  batch 2: E6 arrives valid, E5 again.
    topic1, topic2 = scratch_path(spark, "topic"), scratch_path(spark, "topic")
    T.write_topic(_messages(spark, [("C1", _ev("E5", 2), 20), ("C1", _ev("E5", 1), 10),
                                    ("C1", _ev("E6", -3), 30)]), topic1, partitions=1)
    T.write_topic(_messages(spark, [("C1", _ev("E6", 4), 40), ("C1", _ev("E5", 9), 50)]), topic2, partitions=1)
    root = scratch_path(spark, "stream")
    for t in (topic1, topic2):
        SB.run_available(spark, T.read_topic_stream(spark, t), root, checkpoint=f"{root}/_ck_{t[-12:]}")
    rows = sorted((r.event_id, r.quantity) for r in SB.read_bronze(spark, root).collect())
    assert rows == [("E5", 1), ("E6", 4)]
    q = SB.read_quality(spark, root).first()
    assert (q.stored, q.rejected, q.duplicates) == (2, 1, 2)


def test_json_lines_topic(spark):
    topic = scratch_path(spark, "topic_json")
    T.write_topic(_messages(spark, [("C1", _ev("E9", 2), 1), ("C1", _ev("E9", 3), 2)]), topic, fmt="json")
    root = scratch_path(spark, "stream")
    SB.run_available(spark, T.read_topic_stream(spark, topic, fmt="json"), root)
    assert [(r.event_id, r.quantity) for r in SB.read_bronze(spark, root).collect()] == [("E9", 2)]


def test_generated_data_ranges_foreign_keys_and_free_fields(spark):
    raw = GEN.from_counts(spark, 200, 40, 20000)
    ev, cu, pr = raw["events"], raw["customers"], raw["products"]
    assert ev.join(cu, "customer_id", "left_anti").count() == 0
    assert ev.join(pr, "product_id", "left_anti").count() == 0
    r = ev.agg(F.min("timestamp"), F.max("timestamp")).first()
    assert "2026-03-01T00:00:00Z" <= r[0] and r[1] < "2026-03-15T00:00:00Z"
    s = cu.agg(F.min("signup_date"), F.max("signup_date")).first()
    assert "2026-01-01" <= s[0] and s[1] <= "2026-03-31"
    # fields are drawn independently: every pair of values occurs
    assert ev.select("event_type", "quantity").distinct().count() == 9
    assert ev.select("customer_id", "product_id").distinct().count() > 7000
    assert cu.select("name").distinct().count() > 90


def test_json_lines_bronze_and_dead_letters(spark):
    topic = scratch_path(spark, "topic")
    T.write_topic(_messages(spark, [("C1", _ev("E11", 2), 1), ("C1", _ev("E12", -2), 2)]), topic)
    root = scratch_path(spark, "stream")
    for ck in ("a", "b"):   # the second run replays under a new checkpoint
        SB.run_available(spark, T.read_topic_stream(spark, topic), root, checkpoint=f"{root}/_ck_{ck}",
                         sink_format="json")
    assert [(r.event_id, r.quantity) for r in SB.read_bronze(spark, root, fmt="json").collect()] == [("E11", 2)]
    assert SB.read_rejects(spark, root, fmt="json").count() == 2


def test_second_publish_reaches_a_resumed_stream(spark):
    topic, root = scratch_path(spark, "topic"), scratch_path(spark, "stream")
    T.write_topic(_messages(spark, [("C1", _ev("E21", 1), 1)]), topic)
    SB.run_available(spark, T.read_topic_stream(spark, topic), root, checkpoint=f"{root}/_ck")
    T.write_topic(_messages(spark, [("C1", _ev("E22", 1), 2), ("C1", _ev("E21", 5), 3)]), topic)
    SB.run_available(spark, T.read_topic_stream(spark, topic), root, checkpoint=f"{root}/_ck")
    assert sorted((r.event_id, r.quantity) for r in SB.read_bronze(spark, root).collect()) == [("E21", 1), ("E22", 1)]


def test_python_worker_code_does_not_need_the_package(tmp_path):
    # The driver may import this repo by path from any directory; Spark's Python
    # workers then cannot import `strata`, so code shipped to them must travel
    # by value.  Run the one such path from a foreign directory.
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = (
        "import sys; sys.path.insert(0, %r)\n"
        "from strata.session import build_session\n"
        "from strata.plans.registry import REGISTRY\n"
        "spark = build_session(master='local[2]', shuffle_partitions=2)\n"
        "print('rows', REGISTRY['scan_json_array'](spark, '/root/testdata/sf0.001').count())\n" % root)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=300)
    assert "rows 1000" in out.stdout, out.stderr[-2000:]
