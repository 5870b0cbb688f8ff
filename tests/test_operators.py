"""Single-operator behaviour, including the cases the sample never exercises."""

import pytest
from pyspark.sql import functions as F

from strata.operators import aggregate as G
from strata.operators import conform as C
from strata.operators import ingest as I
from strata.operators.dedup import keep_first, keep_last
from strata.operators.enrich import attach, enrich_events, iso_text
from strata.schemas import SILVER_SUMMARY_READ
from strata.session import scratch_path
from strata.sources import files as SF


@pytest.fixture
def dims(spark):
    cu = spark.createDataFrame([("C001", "Saudi Arabia")], "customer_id string, country string")
    pr = spark.createDataFrame([("P001", "Wireless Keyboard", "Electronics", "279.00")],
                               "product_id string, product_name string, category string, price string")
    return cu, pr.withColumn("price", F.col("price").cast("decimal(10,2)"))


def _event(spark, etype="purchase", qty=2, product="P001"):
    return spark.createDataFrame(
        [("E001", "C001", product, etype, "2026-03-10T09:17:32Z", qty)],
        "event_id string, customer_id string, product_id string, event_type string, timestamp string, quantity int",
    ).withColumn("event_timestamp", F.try_to_timestamp("timestamp")).drop("timestamp")


def test_enrich_purchase(spark, dims):
    cu, pr = dims
    row = enrich_events(_event(spark), cu, pr).first()
    assert (row.customer_country, row.product_name, row.quantity, row.total_amount, row.currency) == \
        ("Saudi Arabia", "Wireless Keyboard", 2, 558.0, "USD")


def test_enrich_view_has_no_amount(spark, dims):
    cu, pr = dims
    assert enrich_events(_event(spark, "view", 1), cu, pr).first().total_amount == 0.0


def test_summary_counts_purchases_only(spark):
    rows = spark.createDataFrame([("view", "Electronics", 1, 0.0), ("purchase", "Electronics", 2, 558.0)],
                                 "event_type string, category string, quantity int, total_amount double")
    out = [r.asDict() for r in G.summary(rows, "category").collect()]
    assert out == [{"dimension": "Electronics", "purchase_count": 1, "units_sold": 2, "revenue": 558.0}]


def test_typed_category_summary(spark):
    path = scratch_path(spark, "silver_jsonl")
    spark.createDataFrame(
        [("E001", "purchase", "Electronics", 2, 298.0, "x"), ("E002", "view", "Electronics", 1, 0.0, "y")],
        "event_id string, event_type string, category string, quantity int, total_amount double, extra string",
    ).write.json(path)
    silver = SF.read_json_lines(spark, path, SILVER_SUMMARY_READ)
    assert silver.columns == [f.name for f in SILVER_SUMMARY_READ]
    from strata.plans.registry import category_summary
    row = category_summary(silver).where("category = 'Electronics'").first()
    assert (row.purchase_count, row.units_sold, row.revenue) == (1, 2, 298.0)


def test_existing_ids(spark):
    path = scratch_path(spark, "bronze")
    spark.createDataFrame([("E001", 1)], "event_id string, quantity int").write.parquet(path)
    assert {r.event_id for r in SF.existing_ids(spark, path).collect()} == {"E001"}
    assert SF.existing_ids(spark, path + "-missing").count() == 0


def test_bad_twin_never_displaces_good_row(spark):
    raw = spark.createDataFrame([("E1", "C1", "P1", "purchase", "2026-03-10T09:17:32Z", -1),
                                 ("E1", "C1", "P1", "purchase", "2026-03-10T09:18:00Z", 2)],
                                "event_id string, customer_id string, product_id string, event_type string, "
                                "timestamp string, quantity bigint")
    rows = C.silver_events(raw).collect()
    assert [(r.event_id, r.quantity) for r in rows] == [("E1", 2)]


def test_rejected_id_can_arrive_valid_later(spark):
    msgs = spark.createDataFrame(
        [(1, '{"event_id":"E1","customer_id":"C1","product_id":"P1","event_type":"purchase",'
             '"timestamp":"t","quantity":-1}'),
         (2, '{"event_id":"E1","customer_id":"C1","product_id":"P1","event_type":"purchase",'
             '"timestamp":"t","quantity":3}')], "n long, value string")
    valid, rejected = I.split(msgs, keep=("n",))
    firsts = I.first_arrivals(valid, ["n"]).collect()
    assert [(r.event_id, r.quantity) for r in firsts] == [("E1", 3)]
    assert rejected.count() == 1


def test_quality_counts_add_up(spark):
    msgs = spark.createDataFrame(
        [('{"event_id":"E1","customer_id":"C1","product_id":"P1","event_type":"view","timestamp":"t","quantity":1}',),
         ('{"event_id":"E1","customer_id":"C1","product_id":"P1","event_type":"view","timestamp":"t","quantity":2}',),
         ('{"event_id":"E2","customer_id":"C1","product_id":"P1","event_type":"view","timestamp":"t","quantity":1}',),
         ('{"event_id":"E3"}',), ("not json",)], "value string")
    stored = spark.createDataFrame([("E2",)], "event_id string")
    row = I.quality(msgs, stored).first()
    assert (row.stored, row.rejected, row.duplicates) == (1, 2, 2)
    assert row.stored + row.rejected + row.duplicates == 5


@pytest.mark.parametrize("policy,expected", [("drop", 1), ("keep", 2)])
def test_orphan_policies(spark, policy, expected):
    facts = spark.createDataFrame([("P1", 1), ("P9", 2)], "product_id string, q int")
    dim = spark.createDataFrame([("P1", "a")], "product_id string, name string")
    out = attach(facts, dim, "product_id", policy).collect()
    assert len(out) == expected
    if policy == "keep":
        assert {r.product_id: r.name for r in out} == {"P1": "a", "P9": None}


def test_orphan_policy_fail(spark):
    facts = spark.createDataFrame([("P1", 1), ("P9", 2)], "product_id string, q int")
    dim = spark.createDataFrame([("P1", "a")], "product_id string, name string")
    with pytest.raises(Exception, match="orphan"):
        attach(facts, dim, "product_id", "fail").collect()


def test_orphan_keeps_null_group_with_null_revenue(spark):
    ev = spark.createDataFrame([("E1", "C9", "P1", "PURCHASE", 2)],
                               "event_id string, customer_id string, product_id string, event_type string, quantity int")
    cu = spark.createDataFrame([("C1", "X")], "customer_id string, country string")
    pr = spark.createDataFrame([("P9", "n", "c")], "product_id string, product_name string, category string") \
        .withColumn("price", F.lit(1).cast("decimal(10,2)"))
    row = G.gold_sales_by_country(ev, cu, pr, "keep").first()
    assert (row.country, row.purchase_count, row.units_sold, row.revenue) == (None, 1, 2, None)


def test_dimension_last_row_wins(spark):
    rows = spark.createDataFrame([("C1", "A", 0), ("C1", "B", 1)], "id string, name string, pos int")
    assert [r.name for r in keep_last(rows, "id", ["pos"]).collect()] == ["B"]


def test_product_name_vs_id_grouping(spark):
    enriched = spark.createDataFrame(
        [("purchase", "P1", "Lamp", 1, 10.0), ("purchase", "P2", "Lamp", 1, 20.0)],
        "event_type string, product_id string, product_name string, quantity int, total_amount double")
    assert G.summary(enriched, "product_name").count() == 1
    assert G.summary(enriched, "product_id").count() == 2


def test_trim_keeps_tabs(spark):
    raw = spark.createDataFrame([("\tC1 ", "n", "c", "2026-01-01")],
                                "customer_id string, name string, country string, signup_date string")
    assert C.silver_customers(raw).first().customer_id == "\tC1"


def test_iso_text(spark):
    df = spark.createDataFrame([("2026-03-10T09:15:00Z",), ("2026-03-10T09:15:00.5Z",)], "t string") \
        .select(F.try_to_timestamp("t").alias("event_timestamp"))
    assert [r.iso for r in df.select(iso_text().alias("iso")).collect()] == \
        ["2026-03-10T09:15:00+00:00", "2026-03-10T09:15:00.500000+00:00"]


def test_price_rounds_half_up_and_overflow_is_null(spark):
    raw = spark.createDataFrame([("P1", "a", "c", "279.005"), ("P2", "b", "c", "123456789.50")],
                                "product_id string, product_name string, category string, price string")
    rows = {r.product_id: r.price for r in C.silver_products(raw).collect()}
    assert str(rows["P1"]) == "279.01" and "P2" not in rows


def test_hot_key_dedup_is_partial_aggregated(spark):
    # a third of all rows share one id
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("event_id"),
        F.col("id").alias("arrival"))
    out = keep_first(df, "event_id", ["arrival"])
    assert out.filter("event_id = 'HOT'").first().arrival == 0
    assert out.count() == 2001
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_grouping_sets_equal_separate_groupbys(spark):
    from strata.plans import layers as L
    d = "/root/testdata/sf0.001"
    enriched = L.enriched_e(spark, d)
    combined = G.summary_all(enriched)
    for name, col in G.SUMMARY_DIMENSIONS.items():
        a = sorted(tuple(r) for r in combined.filter(F.col("summary") == name).drop("summary").collect())
        b = sorted(tuple(r) for r in G.summary(enriched, col).collect())
        assert a == b


def test_revenue_totals_agree_across_dimensions(spark):
    from strata.plans import layers as L
    d = "/root/testdata/sf0.001"
    totals = [L.gold(spark, d, k).agg(F.sum("revenue")).first()[0] for k in ("country", "category", "products")]
    assert max(totals) - min(totals) < 1e-6


def test_hot_customer_gold_is_exact_and_pre_aggregated(spark):
    # one customer makes a third of all purchases
    n = 3000
    ev = spark.range(0, n).select(
        F.col("id").cast("string").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50 + 1).alias("customer_id"),
        (F.col("id") % 7).alias("product_id"),
        F.lit("PURCHASE").alias("event_type"),
        (F.col("id") % 4 + 1).cast("int").alias("quantity"))
    cu = spark.range(0, 51).select(F.col("id").alias("customer_id"),
                                   F.when(F.col("id") == 0, "HOT").otherwise("OTHER").alias("country"))
    pr = spark.range(0, 7).select(F.col("id").alias("product_id"), F.lit("p").alias("product_name"),
                                  F.lit("c").alias("category"),
                                  (F.col("id") + F.lit(0.25)).cast("decimal(10,2)").alias("price"))
    out = {r.country: (r.purchase_count, r.units_sold, r.revenue)
           for r in G.gold_sales_by_country(ev, cu, pr).collect()}
    rows = [(i, 0 if i % 3 == 0 else i % 50 + 1, i % 7, i % 4 + 1) for i in range(n)]
    def expect(hot):
        sel = [r for r in rows if (r[1] == 0) == hot]
        return (len(sel), sum(r[3] for r in sel), round(sum(r[3] * (r[2] + 0.25) for r in sel), 2))
    assert out == {"HOT": expect(True), "OTHER": expect(False)}
    plan = G.gold_sales_by_country(ev, cu, pr)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_json_array_documents_roundtrip(spark):
    from strata.sinks import files as SK
    path = scratch_path(spark, "json_array")
    df = spark.range(0, 25, numPartitions=8).filter("id < 20").select(
        F.col("id").alias("n"), F.concat(F.lit("x"), F.col("id").cast("string")).alias("s"))
    SK.write_json_array(df.repartition(8), path)   # some partitions are empty
    back = SF.read_json_array(spark, path)
    assert sorted((r.n, r.s) for r in back.collect()) == [(i, f"x{i}") for i in range(20)]


def _exchanges(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange SinglePartition")


def test_shared_totals_give_the_same_golds(spark):
    from strata.plans import layers as L
    d = "/root/testdata/sf0.001"
    ev, cu, pr = L.silver_events_e(spark, d), L.silver_customers(spark, d), L.silver_products(spark, d)
    builds = {"sales_by_country": G.gold_sales_by_country, "sales_by_category": G.gold_sales_by_category,
              "top_products": G.gold_top_products}
    for orphans in ("drop", "keep"):
        shared = G.purchase_totals(ev, cu, pr, orphans)
        for name, build in builds.items():
            a = sorted((tuple(r) for r in build(ev, cu, pr, orphans).collect()), key=repr)
            b = sorted((tuple(r) for r in G.summarize(shared, G.GOLD_KEYS[name]).collect()), key=repr)
            assert a == b


def test_gold_shuffles_the_purchases_once_per_join(spark):
    ev = spark.range(100).select(F.col("id").cast("string").alias("event_id"), (F.col("id") % 9).alias("customer_id"),
                                 (F.col("id") % 7).alias("product_id"), F.lit("PURCHASE").alias("event_type"),
                                 F.lit(1).alias("quantity"))
    cu = spark.range(9).select(F.col("id").alias("customer_id"), F.lit("X").alias("country"))
    pr = spark.range(7).select(F.col("id").alias("product_id"), F.lit("p").alias("product_name"), F.lit("c").alias("category"),
                               F.lit(1).cast("decimal(10,2)").alias("price"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # both sides of two joins, and the sums
        assert _exchanges(G.gold_sales_by_country(ev, cu, pr)) == 5
        # both sides of the customer join, the sums by product (which the product join reads as they lie), products, no more
        assert _exchanges(G.gold_top_products(ev, cu, pr)) <= 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_spread_never_lowers_the_number_of_partitions(spark, tmp_path):
    from strata.operators.partitioning import spread
    path = f"{tmp_path}/wide"
    spark.range(20000).repartition(1).write.option("parquet.block.size", 8192).parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        wide = spark.read.parquet(path)
        n = wide.rdd.getNumPartitions()
        assert n > spark.sparkContext.defaultParallelism
        assert spread(wide) is wide
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    few = spark.read.parquet(path).coalesce(1)
    assert spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_missing_shared_folder_is_an_error_off_local_masters(spark):
    from strata import session as S

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.shared_dir(Session())


def test_existing_ids_tells_absent_from_broken(spark, tmp_path):
    assert SF.existing_ids(spark, f"{tmp_path}/none").count() == 0
    spark.range(3).write.parquet(f"{tmp_path}/other")
    with pytest.raises(Exception, match="event_id"):
        SF.existing_ids(spark, f"{tmp_path}/other")


def test_double_money_variant_agrees_to_the_cent(spark):
    from strata.plans import layers as L
    d = "/root/testdata/sf0.001"
    ev, cu, pr = L.silver_events_e(spark, d), L.silver_customers(spark, d), L.silver_products(spark, d)
    exact = {r.country: r.revenue for r in G.gold_sales_by_country(ev, cu, pr).collect()}
    double = {r.country: r.revenue for r in G.gold_sales_by_country(ev, cu, pr, money="double").collect()}
    assert exact.keys() == double.keys()
    assert all(abs(exact[k] - double[k]) < 0.011 for k in exact)
    with pytest.raises(ValueError):
        G.gold_sales_by_country(ev, cu, pr, money="float")


def test_ranked_top_k_and_tie_break(spark):
    summary = spark.createDataFrame([("P3", 10.0), ("P1", 10.0), ("P2", 30.0), ("P4", None)],
                                    "product_id string, revenue double")
    full = [r.product_id for r in G.ranked(summary, ["product_id"]).collect()]
    assert full == ["P2", "P1", "P3", "P4"]          # revenue desc, nulls last, key breaks ties
    top = G.ranked(summary, ["product_id"], limit=2)
    assert [r.product_id for r in top.collect()] == ["P2", "P1"]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_grouping_sets_label_null_dimension_values_by_set(spark):
    enriched = spark.createDataFrame(
        [("purchase", None, "Books", "Handbook", 1, 10.0),
         ("purchase", "Japan", None, "Hub", 2, 20.0),
         ("purchase", "Japan", "Books", None, 3, 30.0),
         ("view", "Japan", "Books", "Hub", 9, 0.0)],
        "event_type string, customer_country string, category string, product_name string, "
        "quantity int, total_amount double")
    got = [(r.summary, r.dimension, r.purchase_count, r.units_sold, r.revenue)
           for r in G.summary_all(enriched).collect()]
    want = sorted(
        [("revenue_by_country", None, 1, 1, 10.0), ("revenue_by_country", "Japan", 2, 5, 50.0),
         ("revenue_by_category", "Books", 2, 4, 40.0), ("revenue_by_category", None, 1, 2, 20.0),
         ("revenue_by_product", "Handbook", 1, 1, 10.0), ("revenue_by_product", "Hub", 1, 2, 20.0),
         ("revenue_by_product", None, 1, 3, 30.0)], key=repr)
    assert sorted(got, key=repr) == want
