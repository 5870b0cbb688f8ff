"""The incremental path end to end on the sample files.

events.json -> keyed publish -> topic -> streaming ingest (validate, dedup) ->
Bronze -> enriched Silver -> summaries by country, category and product name.
"""

import os

import pytest
from pyspark.sql import functions as F

from strata.plans import medallion as M
from strata.plans.refresh import Snapshots
from strata.session import scratch_path
from strata.sources import files as SF
from strata.streaming import bronze as SB
from strata.streaming import topic as T

FIX = os.path.join(os.path.dirname(__file__), "fixtures")


def _publish(spark, path, topic):
    ev = SF.read_json_array(spark, path)
    pub = T.publish_frame(ev, "customer_id",
                          ["event_id", "customer_id", "product_id", "event_type", "timestamp", "quantity"])
    T.write_topic(pub.withColumn("arrival_a", F.monotonically_increasing_id()), topic)


def test_stream_to_summaries(spark):
    topic, root = scratch_path(spark, "topic"), scratch_path(spark, "v1")
    _publish(spark, f"{FIX}/events.json", topic)
    _publish(spark, f"{FIX}/invalid_event.json", topic + "_bad")
    for t in (topic, topic + "_bad", topic):          # the good topic twice: a replay
        SB.run_available(spark, T.read_topic_stream(spark, t), root, checkpoint=f"{root}/_ck_{os.path.basename(t)}")
    bronze = SB.read_bronze(spark, root)
    assert bronze.count() == 6
    assert SB.read_rejects(spark, root).count() == 1
    cu, pr = M.dimensions_from_files(spark, FIX)
    M.enrich_and_summarize(spark, bronze, cu, pr, root)
    got = {r.dimension: (r.purchase_count, r.units_sold, r.revenue)
           for r in SF.read_json_lines(spark, f"{root}/gold/revenue_by_product").collect()}
    assert got == {"USB-C Laptop Hub": (1, 2, 298.0), "Insulated Water Bottle": (1, 3, 255.0),
                   "Data Engineering Handbook": (1, 1, 159.0)}
    country = {r.dimension: r.revenue
               for r in SF.read_json_lines(spark, f"{root}/gold/revenue_by_country").collect()}
    assert country == {"Japan": 298.0, "United States": 255.0, "Saudi Arabia": 159.0}
    silver = SF.read_json_lines(spark, f"{root}/silver_enriched")
    e002 = silver.filter("event_id = 'E002'").first()
    assert (e002.event_timestamp, e002.currency, e002.unit_price, e002.total_amount) == \
        ("2026-03-10T09:17:32+00:00", "USD", 159.0, 159.0)


def test_medallion_from_files(spark):
    dst = scratch_path(spark, "files")
    M.medallion_from_files(spark, FIX, dst)
    top = {r.product_id: r.revenue for r in spark.read.parquet(f"{dst}/gold/top_products").collect()}
    assert top == {"P002": 298.0, "P004": 255.0, "P003": 159.0}


def test_job_entry_points(spark):
    from strata.__main__ import run
    out, lake = scratch_path(spark, "gen"), scratch_path(spark, "lake")
    assert run(["generate", "--tables", "/root/testdata/sf0.001", "--out", out], spark) == 0
    assert run(["medallion", "--raw", out, "--lake", lake], spark) == 0
    gold = Snapshots(spark, lake).latest().read("gold", "sales_by_country")
    # every generated event resolves, so Gold covers all purchases
    purchases = SF.read_json_array(spark, f"{out}/events.json").filter("event_type = 'purchase'").count()
    assert gold.agg(F.sum("purchase_count")).first()[0] == purchases


def test_generate_from_counts(spark):
    from strata.__main__ import run
    out, lake = scratch_path(spark, "gen_counts"), scratch_path(spark, "lake")
    assert run(["generate", "--out", out, "--customers", "10", "--products", "12", "--events", "50"], spark) == 0
    raw = M.read_raw(spark, out)
    assert (raw["customers"].count(), raw["products"].count(), raw["events"].count()) == (10, 12, 50)
    assert raw["events"].join(raw["customers"], "customer_id", "left_anti").count() == 0
    assert raw["events"].join(raw["products"], "product_id", "left_anti").count() == 0
    names = {r.product_name for r in raw["products"].collect()}
    assert "Wireless Keyboard" in names and "Wireless Keyboard 9" in names
    assert run(["medallion", "--raw", out, "--lake", lake], spark) == 0


def test_ingest_and_enrich_commands(spark):
    from strata.__main__ import run
    topic, root = scratch_path(spark, "topic"), scratch_path(spark, "v1")
    _publish(spark, f"{FIX}/events.json", topic)
    assert run(["ingest", "--topic", topic, "--root", root, "--sink-format", "json"], spark) == 0
    assert run(["enrich", "--root", root, "--raw", FIX, "--sink-format", "json"], spark) == 0
    got = {r.dimension: r.revenue for r in SF.read_json_lines(spark, f"{root}/gold/revenue_by_category").collect()}
    assert got == {"Electronics": 298.0, "Home": 255.0, "Books": 159.0}


def test_publish_command_keeps_file_order(spark):
    from strata.__main__ import run
    topic, root = scratch_path(spark, "topic"), scratch_path(spark, "v1")
    assert run(["publish", "--events", f"{FIX}/events.json", "--topic", topic], spark) == 0
    assert run(["publish", "--events", f"{FIX}/invalid_event.json", "--topic", topic], spark) == 0
    assert run(["ingest", "--topic", topic, "--root", root, "--max-messages", "1000"], spark) == 0
    bronze = SB.read_bronze(spark, root)
    assert bronze.count() == 6 and SB.read_rejects(spark, root).count() == 1
    records = spark.read.schema(T.TOPIC_SCHEMA).parquet(topic).where(F.col("arrival_b").isNotNull()).orderBy("arrival_b").collect()
    assert len(records) == 7 and all(r.key in r.value for r in records)


def test_broker_options_reach_the_connector():
    assert T.kafka_options("b:9092", "orders", "g") == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "orders", "kafka.group.id": "g"}
    assert T.kafka_options("b:9092", "orders", reading=False) == {"kafka.bootstrap.servers": "b:9092", "topic": "orders"}


def test_batch_ingest_keeps_dead_letters_across_runs(spark):
    msgs = spark.createDataFrame([('{"event_id":"E1"}', 1), ("not json", 2)], "value string, at long")
    dst = scratch_path(spark, "batch_ingest")
    M.ingest_messages(spark, msgs, dst, ("at",))
    M.ingest_messages(spark, msgs, dst, ("at",))
    M.ingest_messages(spark, msgs, dst, ("at",), run_id="fixed")
    M.ingest_messages(spark, msgs, dst, ("at",), run_id="fixed")      # a retried run rewrites its own folder
    assert SF.read_json_lines(spark, f"{dst}/rejected").count() == 2 * 3
    with pytest.raises(ValueError, match="arrival"):
        M.ingest_messages(spark, msgs, dst, ())


def test_first_arrival_whole_event_and_large_quantity(spark):
    def message(customer, quantity, time="2026-03-10T09:15:00Z", more=""):
        return (f'{{"event_id":"{{}}","customer_id":"{customer}","product_id":"P001","event_type":"purchase",'
                f'"timestamp":"{time}","quantity":{quantity}{more}}}')
    rows = [(message("C1", 5, more=',"channel":"web"').replace("{}", "E1"), 1), (message("A1", 9).replace("{}", "E1"), 2),
            (message("C1", 3_000_000_000).replace("{}", "E2"), 3), (message("C1", 1, "soon").replace("{}", "E3"), 4)]
    dst = scratch_path(spark, "awkward")
    cu = spark.createDataFrame([("C1", "Japan"), ("A1", "Chad")], "customer_id string, country string")
    pr = spark.createDataFrame([("P001", "Hub", "Electronics", 2.0)], "product_id string, product_name string, category string, price double") \
        .withColumn("price", F.col("price").cast("decimal(10,2)"))
    M.run_enriched(spark, spark.createDataFrame(rows, "value string, at long"), cu, pr, dst, ("at",))
    bronze = {r.event_id: r for r in spark.read.parquet(f"{dst}/bronze").collect()}
    assert (bronze["E1"].customer_id, bronze["E1"].quantity) == ("C1", 5) and '"channel":"web"' in bronze["E1"].message
    gold = SF.read_json_lines(spark, f"{dst}/gold/revenue_by_country").collect()
    # the event without a time is no sale
    assert [(r.dimension, r.purchase_count, r.units_sold, r.revenue) for r in gold] == [("Japan", 2, 3_000_000_005, 6_000_000_010.0)]


def test_last_row_of_a_key_wins_in_files(spark, tmp_path):
    raw = str(tmp_path)
    with open(f"{raw}/customers.csv", "w") as f:
        f.write("customer_id,name,country,signup_date\n" + "".join(
            f"C1,Ann,{c},2026-01-01\n" for c in ("Brazil", "Zambia", "Chile", "Zimbabwe", "Peru")))
    with open(f"{raw}/products.csv", "w") as f:
        f.write("product_id,product_name,category,price\nP1,Hub,Z,9.00\nP1,Hub,A,1.00\nP1,Hub,M,5.00\n")
    with open(f"{raw}/events.json", "w") as f:
        f.write("[]")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    try:
        cu, pr = (d.collect() for d in M.dimensions_from_files(spark, raw))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.country for r in cu] == ["Peru"] and [(r.category, float(r.price)) for r in pr] == [("M", 5.0)]


def test_gate_stops_a_run_before_anything_is_written(spark):
    from strata.operators.quality import QualityGateError
    raw = M.read_raw(spark, FIX)
    good, bad = scratch_path(spark, "gate_good"), scratch_path(spark, "gate_bad")
    M.run_medallion(spark, raw, good, gate=True)
    assert spark.read.parquet(f"{good}/gold/top_products").count() == 3
    for column, value, rule in (("event_type", "click", "event_type_domain"), ("timestamp", "2026-01-05Tjunk", "timestamp_iso"),
                                ("customer_id", "nobody", "customer_known"), ("event_id", "E001", "primary_key"),
                                ("currency", "", "required_present")):
        events = raw["events"].withColumn(column, F.lit(value))
        with pytest.raises(QualityGateError, match=f"events.{rule}"):
            M.run_medallion(spark, {**raw, "events": events}, bad, gate=True)
        assert not os.path.exists(bad.replace("file:", ""))


def test_iso_rules_are_strict(spark):
    from strata.operators import quality as Q
    days = {"2026-01-05": True, "2026": False, "2026-1-5": False, "2026-01-05Tjunk": False, "2026-02-30": False, None: False}
    times = {"2026-01-05T10:11:12Z": True, "2026-01-05 10:11": True, "2026-01-05T10:11:12.5+03:00": True, "2026-01-05": True,
             "12:30": False, "2026": False, "2026-01-05T25:00:00": False, "": False, None: False}
    got = {r.c: not r.bad for r in spark.createDataFrame([(x,) for x in days], "c string").withColumn("bad", Q.not_iso_date(F.col("c"))).collect()}
    assert got == days
    got = {r.c: not r.bad for r in spark.createDataFrame([(x,) for x in times], "c string").withColumn("bad", Q.not_iso_time(F.col("c"))).collect()}
    assert got == times


def test_summaries_as_json_array_documents(spark):
    topic, root = scratch_path(spark, "topic"), scratch_path(spark, "v1")
    _publish(spark, f"{FIX}/events.json", topic)
    SB.run_available(spark, T.read_topic_stream(spark, topic), root)
    cu, pr = M.dimensions_from_files(spark, FIX)
    M.enrich_and_summarize(spark, SB.read_bronze(spark, root), cu, pr, root, summary_format="array")
    got = {r.dimension: r.revenue for r in SF.read_json_array(spark, f"{root}/gold/revenue_by_country").collect()}
    assert got == {"Japan": 298.0, "United States": 255.0, "Saudi Arabia": 159.0}


def test_tasks_of_parsed_events_follow_the_bytes_of_the_table(spark, monkeypatch):
    from strata.operators.partitioning import stored_bytes
    from strata.sources import adapters as A
    d = "/root/testdata/sf0.01"
    least = spark.sparkContext.defaultParallelism
    unit = stored_bytes(spark, f"{d}/events.parquet") // (3 * least)
    monkeypatch.setattr(A, "EVENTS_UNIT", unit)
    for df in (A.events_e(spark, d), A.messages_d(spark, d)):
        assert df.rdd.getNumPartitions() >= 3 * least


def test_judged_messages_keep_the_reasons_and_no_parsed_view(spark):
    from strata.functions import validate as V
    from strata.sources import adapters as A
    messages = A.messages_d(spark, "/root/testdata/sf0.001")
    judged = V.judged(messages, reasons=True)
    assert set(judged.columns) == {"record_id", "value", "is_valid", "event", "reasons"}
    classified = V.classify(messages)
    event = F.when(F.col("is_valid"), F.struct(*V.bronze_fields())).alias("event")
    want = classified.select("record_id", "value", "is_valid", event,
                             F.when(~F.col("is_valid"), F.array_join("reasons", ",")).alias("reasons"))
    assert judged.select(want.columns).exceptAll(want).count() == 0 and judged.count() == want.count()
    assert judged.where(F.col("is_valid") != F.col("reasons").isNull()).count() == 0


def test_enriched_rows_are_compressed_json_lines(spark):
    import glob
    import gzip
    import json
    dst = scratch_path(spark, "compressed")
    messages = spark.createDataFrame([(json.dumps({
        "event_id": "E1", "customer_id": "C001", "product_id": "P001", "event_type": "purchase",
        "timestamp": "2026-03-10T09:15:00Z", "quantity": 2}), 1)], "value string, at long")
    cu, pr = M.dimensions_from_files(spark, FIX)
    M.run_enriched(spark, messages, cu, pr, dst, ("at",))
    files = glob.glob(dst.replace("file:", "") + "/silver_enriched/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    lines = [json.loads(line) for f in files for line in gzip.open(f, "rt")]
    assert [r["event_id"] for r in lines] == ["E1"]
    assert [r.event_id for r in SF.read_json_lines(spark, f"{dst}/silver_enriched").collect()] == ["E1"]
