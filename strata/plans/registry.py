"""Registered queries: key -> (spark, sf_dir) -> DataFrame.

Each query reads the driver's tables in full through the adapters and runs
the library's operators over them.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions import validate as V
from strata.operators import aggregate as G
from strata.operators import conform as C
from strata.operators import ingest as I
from strata.operators import quality as Q
from strata.operators.dedup import keep_last
from strata.operators.enrich import iso_text, members_of, orphans_of
from strata.plans import layers as L
from strata.plans import incremental as INC
from strata.plans import medallion as M
from strata.plans import refresh as R
from strata.schemas import BRONZE_EVENTS, EVENT_TYPES, GOLD_CONTRACT, REQUIRED_EVENT_FIELDS, SILVER_SUMMARY_READ
from strata.session import ensure_utc, scratch_path
from strata.sinks import files as SK
from strata.sources import adapters as A
from strata.sources import files as SF
from strata.streaming import bronze as SB
from strata.streaming import topic as T

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)  # the data model is UTC whatever session we are handed
            return fn(spark, sf_dir)
        REGISTRY[name] = run
        return fn
    return deco


# ------------------------------------------------------------------ gold
@register("gold_top_products")
def gold_top_products(spark, d):
    """SURVEY AGG6, JOI2, FLT2, PRJ12, PRJ14."""
    return L.gold(spark, d, "products")


@register("gold_sales_by_country")
def gold_sales_by_country(spark, d):
    """SURVEY AGG4, JOI2, FLT2."""
    return L.gold(spark, d, "country")


@register("gold_sales_by_category")
def gold_sales_by_category(spark, d):
    """SURVEY AGG5, JOI2, FLT2."""
    return L.gold(spark, d, "category")


@register("ranked_products")
def ranked_products(spark, d):
    """SURVEY SRT1."""
    return G.ranked(L.gold(spark, d, "products"), ["product_id"])


@register("gold_country_left")
def gold_country_left(spark, d):
    """SURVEY JOI3, AGG4 (orphans kept)."""
    return L.gold(spark, d, "country", orphans="keep", segment=True)


@register("gold_category_left")
def gold_category_left(spark, d):
    """SURVEY JOI3, AGG5 (orphans kept)."""
    return L.gold(spark, d, "category", orphans="keep", segment=True)


@register("gold_products_left")
def gold_products_left(spark, d):
    """SURVEY JOI3, AGG6 (orphans kept)."""
    return L.gold(spark, d, "products", orphans="keep", segment=True)


@register("gold_country_segment")
def gold_country_segment(spark, d):
    """SURVEY JOI2 (orphans dropped)."""
    return L.gold(spark, d, "country", orphans="drop", segment=True)


# ------------------------------------------------------------ silver conform


@register("conform_customers")
def conform_customers(spark, d):
    """SURVEY PRJ1, PRJ3, PRJ4, FLT3, DED1."""
    s = C.silver_customers(A.dirty_customers(spark, d))
    return s.select("customer_id", "customer_name", "country",
                    F.col("signup_date").cast("string").alias("signup_date"))


@register("conform_products")
def conform_products(spark, d):
    """SURVEY PRJ1, PRJ6, FLT3, FLT4, DED1."""
    s = C.silver_products(A.dirty_products(spark, d))
    return s.select("product_id", "product_name", "category", F.col("price").cast("double").alias("price"))


def _decoded_fields(spark, d):
    """Adapter D decoded into raw text fields (what a JSON reader would give)."""
    parsed = V.with_parsed(A.messages_d(spark, d))
    return parsed.select("record_id", *[V.field(f).alias(f) for f in
                                        ("event_id", "customer_id", "product_id", "event_type",
                                         "timestamp", "quantity")])


@register("conform_events")
def conform_events(spark, d):
    """SURVEY PRJ2, PRJ3, PRJ5, PRJ7, FLT5, DED1."""
    s = C.silver_events(_decoded_fields(spark, d).drop("record_id"))
    return s.select("event_id", "customer_id", "product_id", "event_type",
                    F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_ts"),
                    "quantity")


@register("dedup_events")
def dedup_events(spark, d):
    """SURVEY DED1."""
    return L.silver_events_l(spark, d).select("event_id", "customer_id", "product_id", "quantity")


@register("dim_last_wins")
def dim_last_wins(spark, d):
    """SURVEY SRC2, DED3."""
    return keep_last(A.versioned_products(spark, d), "product_id", ["file_order"]) \
        .select("product_id", "product_name")


@register("iso_timestamp")
def iso_timestamp(spark, d):
    """SURVEY PRJ9."""
    return A.events_e(spark, d).select("event_id", iso_text("timestamp").alias("iso"))


# ----------------------------------------------------- validation / quarantine
@register("decode_events")
def decode_events(spark, d):
    """SURVEY SRC8."""
    parsed = V.with_parsed(A.messages_d(spark, d))
    return parsed.select("record_id", V.field("event_id").alias("event_id"),
                         V.field("event_type").alias("event_type"),
                         V.field("quantity").alias("quantity_text"),
                         V.has("currency").alias("has_currency"))


@register("normalize_currency")
def normalize_currency(spark, d):
    """SURVEY PRJ8."""
    parsed = V.with_parsed(A.messages_d(spark, d)).filter("_msg_is_object")
    return parsed.select("record_id", V.field("event_id").alias("event_id"),
                         V.normalized_currency().alias("currency"))


@register("valid_events")
def valid_events(spark, d):
    """SURVEY FLT7, VAL1-5."""
    valid, _ = I.split(A.messages_d(spark, d), keep=("record_id",))
    return valid.drop("timestamp", "message")


@register("rejected_events")
def rejected_events(spark, d):
    """SURVEY VAL6, SNK4."""
    _, rejected = I.split(A.messages_d(spark, d), keep=("record_id",))
    return rejected.select("record_id", "reasons")


@register("reject_reason_counts")
def reject_reason_counts(spark, d):
    """SURVEY VAL6."""
    classified = V.classify(A.messages_d(spark, d))
    return (classified.select(F.explode("reasons").alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


def _ingest_messages(spark, d):
    dm = A.messages_d(spark, d)
    dm = dm.select(F.lit(None).cast("timestamp_ntz").alias("arrival_ts"), F.col("record_id").alias("arrival_a"),
                   F.lit(0).cast("bigint").alias("arrival_b"), "value")
    return dm.unionByName(A.messages_l(spark, d).drop("key"))


ARRIVAL = ("arrival_ts", "arrival_a", "arrival_b")


@register("ingest_quality")
def ingest_quality(spark, d):
    """SURVEY AGG8, DED4."""
    return I.quality(_ingest_messages(spark, d))


# ------------------------------------------------------- enrich and summaries


@register("enrich_events")
def enrich_events_q(spark, d):
    """SURVEY JOI1, PRJ10, PRJ11."""
    return L.enriched_e(spark, d).select(
        "event_id", "customer_country", "product_name", "category", "event_type", "currency",
        "quantity", "unit_price", "total_amount")


def _summary(dimension):
    """SURVEY AGG1, FLT1 (one enriched summary per dimension)."""
    def q(spark, d):
        return G.summary(L.enriched_e(spark, d), dimension)
    return q


register("summary_country")(_summary("customer_country"))
register("summary_category")(_summary("category"))
register("summary_product_name")(_summary("product_name"))


@register("summary_all")
def summary_all_q(spark, d):
    """SURVEY AGG2."""
    return G.summary_all(L.enriched_e(spark, d))


def _silver_jsonl(spark, d):
    """Enriched Silver written as JSON lines, then read back with the 5-column schema."""
    path = scratch_path(spark, "silver_enriched")
    SK.write_json_lines(L.enriched_e(spark, d), path)
    return SF.read_json_lines(spark, path, SILVER_SUMMARY_READ)


def category_summary(silver: DataFrame) -> DataFrame:
    return G.summary(silver, "category").withColumnRenamed("dimension", "category").orderBy("category")


@register("category_summary_typed")
def category_summary_typed(spark, d):
    """SURVEY SRC5, AGG3, SRT2."""
    return category_summary(_silver_jsonl(spark, d))


# Fixed value: the category looked up by the point query.
POINT_CATEGORY = "PROMO"


@register("point_lookup")
def point_lookup(spark, d):
    """SURVEY FLT6, LIM1."""
    return category_summary(_silver_jsonl(spark, d)).where(f"category = '{POINT_CATEGORY}'").limit(1)


# ------------------------------------------------------------- data quality
@register("dq_primary_keys")
def dq_primary_keys(spark, d):
    """SURVEY DQ1, AGG7."""
    return Q.union_all([
        Q.primary_key(A.raw_customers(spark, d), "customer_id", "customers"),
        Q.primary_key(A.raw_products(spark, d), "product_id", "products"),
        Q.primary_key(A.events_e(spark, d), "event_id", "events"),
        Q.primary_key(A.events_l(spark, d), "event_id", "order_lines"),
    ])


@register("dq_foreign_keys")
def dq_foreign_keys(spark, d):
    """SURVEY DQ2, JOI4."""
    ev = A.events_e(spark, d)
    return Q.union_all([
        Q.foreign_key(ev, A.segment_customers(spark, d), "customer_id", "events.customer_id"),
        Q.foreign_key(ev, A.segment_products(spark, d), "product_id", "events.product_id"),
    ])


@register("fk_orphans")
def fk_orphans(spark, d):
    """SURVEY JOI4."""
    ev = A.events_e(spark, d).select("event_id", "customer_id", "product_id")
    c = orphans_of(ev, A.segment_customers(spark, d), "customer_id").select(
        F.lit("events.customer_id").alias("edge"), "event_id")
    p = orphans_of(ev, A.segment_products(spark, d), "product_id").select(
        F.lit("events.product_id").alias("edge"), "event_id")
    return c.unionByName(p)


@register("fk_valid")
def fk_valid(spark, d):
    """SURVEY JOI4."""
    ev = A.events_e(spark, d).select("event_id", "customer_id", "product_id")
    ev = members_of(ev, A.segment_customers(spark, d), "customer_id")
    return members_of(ev, A.segment_products(spark, d), "product_id").select("event_id")


def domain_rules(spark, d) -> DataFrame:
    """The source-data rules over the raw text inputs (dirty dims, message events). [SURVEY DQ3-DQ5]"""
    cu = A.dirty_customers(spark, d)
    pr = A.dirty_products(spark, d)
    msgs = V.with_parsed(A.messages_d(spark, d))
    # every field that a message carries, and those it must
    ev_required = Q.any_blank(*[V.field(f) for f in REQUIRED_EVENT_FIELDS]) | F.exists(
        F.map_values(F.col("_msg_map")), lambda v: v.isNull() | (v == ""))
    q = V.quantity_value()
    return Q.union_all([
        Q.rule_table(cu, "customers", [
            ("required_present", Q.any_blank(*[F.col(c) for c in cu.columns])),
            ("signup_date_iso", Q.not_iso_date(F.col("signup_date"))),
        ]),
        Q.rule_table(pr, "products", [
            ("required_present", Q.any_blank(*[F.col(c) for c in pr.columns])),
            ("price_positive", ~(F.trim("price").try_cast("decimal(38,10)") > 0)),
        ]),
        Q.rule_table(msgs, "events", [
            ("required_present", ev_required),
            ("event_type_domain", ~V.field("event_type").isin(*EVENT_TYPES)),
            ("quantity_positive", ~(q > 0)),
            ("timestamp_iso", Q.not_iso_time(V.field("timestamp"))),
        ]),
    ])


register("dq_domains")(domain_rules)


@register("gated_gold")
def gated_gold(spark, d):
    """Key and referential-integrity rules must pass before Gold is built (raises otherwise). [SURVEY DQ6]"""
    pk = Q.union_all([
        Q.primary_key(A.raw_customers(spark, d), "customer_id", "customers"),
        Q.primary_key(A.raw_products(spark, d), "product_id", "products"),
        Q.primary_key(A.events_e(spark, d), "event_id", "events"),
    ])
    ev = A.events_e(spark, d)
    fk = Q.union_all([
        Q.foreign_key(ev, A.raw_customers(spark, d), "customer_id", "events.customer_id"),
        Q.foreign_key(ev, A.raw_products(spark, d), "product_id", "events.product_id"),
    ])
    Q.assert_clean(Q.pk_rules_as_checks(pk).unionByName(Q.fk_rules_as_checks(fk)))
    return L.gold(spark, d, "country")


@register("gated_pipeline")
def gated_pipeline(spark, d):
    """The layered run over accepted events behind every rule: keys, foreign keys, domains. [SURVEY DQ6, PIP1]"""
    dst = scratch_path(spark, "gated")
    M.run_medallion(spark, _accepted_e(spark, d), dst, gate=True)
    return spark.read.parquet(f"{dst}/gold/sales_by_country")


@register("published_gold")
def published_gold(spark, d):
    """What readers see after a run over accepted events, which is published, and one over all events, whose
    types and quantities fail the audit. [SURVEY DQ6, PIP1, SNK6, SNK7]"""
    root = scratch_path(spark, "published")
    R.refresh(spark, _accepted_e(spark, d), root)
    try:
        R.refresh(spark, _raw_e(spark, d), root)
    except Q.QualityGateError:
        pass
    seen = R.Snapshots(spark, root).latest()
    return seen.read("gold", "sales_by_country").withColumn("version", F.lit(seen.number).cast("bigint"))


@register("gold_country_double")
def gold_country_double(spark, d):
    """Each purchase's amount cast to double before the sum. [SURVEY PRJ13]"""
    return G.gold_sales_by_country(L.silver_events_e(spark, d), L.silver_customers(spark, d),
                                   L.silver_products(spark, d), money="double")


# ------------------------------------------------------ layered runs and I/O


def _raw_e(spark, d):
    return {"customers": A.raw_customers(spark, d).drop("segment"),
            "products": A.raw_products(spark, d),
            "events": A.events_e(spark, d)}


def _accepted_e(spark, d):
    raw = _raw_e(spark, d)
    accepted = raw["events"].filter(F.col("event_type").isin(*EVENT_TYPES) & (F.col("quantity") > 0)
                                    & F.col("timestamp").isNotNull())
    return {**raw, "events": accepted}


def _medallion_run(spark, d):
    dst = scratch_path(spark, "medallion")
    M.run_medallion(spark, _raw_e(spark, d), dst)
    return dst


@register("medallion_gold")
def medallion_gold(spark, d):
    """SURVEY PIP1, SNK6, SNK7."""
    return spark.read.parquet(f"{_medallion_run(spark, d)}/gold/sales_by_country")


@register("medallion_table_counts")
def medallion_table_counts(spark, d):
    """Layers written as catalog tables, counted with one SQL UNION ALL. [SURVEY AGG9, SET1, SNK6]"""
    database = f"strata_{uuid.uuid4().hex[:10]}"
    M.run_medallion(spark, _raw_e(spark, d), scratch_path(spark, "medallion"), database=database,
                    dim_buckets=spark.sparkContext.defaultParallelism)
    counts = M.table_counts_sql(spark, database).collect()  # a row per table
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.createDataFrame(counts, "table_name string, rows bigint")


@register("run_metrics")
def run_metrics(spark, d):
    """SURVEY AGG10."""
    dst = scratch_path(spark, "medallion")
    return M.run_medallion(spark, _raw_e(spark, d), dst).to_frame(spark)


@register("run_stage_rows")
def run_stage_rows(spark, d):
    """Rows written per stage of a layered run (the deterministic part of the run metrics). [SURVEY AGG10]"""
    dst = scratch_path(spark, "medallion")
    return M.run_medallion(spark, _raw_e(spark, d), dst).to_frame(spark).select("stage", "rows")


@register("enriched_gold")
def enriched_gold(spark, d):
    """SURVEY PIP2, SNK2, SNK5."""
    dst = scratch_path(spark, "enriched")
    cu = M.string_keyed(C.silver_customers(A.raw_customers(spark, d).drop("segment")), "customer_id")
    pr = M.string_keyed(C.silver_products(A.raw_products(spark, d)), "product_id")
    arrival = {"arrival_ts": "timestamp", "arrival_a": "event_id"}
    M.run_enriched(spark, M.to_messages(A.events_e(spark, d), arrival), cu, pr, dst, tuple(arrival))
    return SF.read_json_lines(spark, f"{dst}/gold/revenue_by_country").select(
        "dimension", "purchase_count", "units_sold", "revenue")


@register("enriched_gold_dirty")
def enriched_gold_dirty(spark, d):
    """Order lines as messages: copies of an id from different times, an extra field, quantities past 2^31,
    unparsable times. [SURVEY PIP2, DED2, SNK3]"""
    dst = scratch_path(spark, "enriched_dirty")
    cu = M.string_keyed(L.silver_customers(spark, d), "customer_id")
    pr = M.string_keyed(L.silver_products(spark, d), "product_id")
    M.run_enriched(spark, A.messages_l_dirty(spark, d), cu, pr, dst, ARRIVAL)
    stored = spark.read.schema(BRONZE_EVENTS).parquet(f"{dst}/bronze").select(
        F.lit("kept channel").alias("dimension"), F.get_json_object("message", "$.channel").alias("channel"))
    kept = stored.where(F.col("channel") == "web").groupBy("dimension").agg(
        F.count(F.lit(1)).alias("purchase_count"), F.lit(0).cast("bigint").alias("units_sold"), F.lit(0.0).alias("revenue"))
    gold = spark.read.json(f"{dst}/gold/revenue_by_country")
    return gold.select("dimension", "purchase_count", "units_sold", "revenue").unionByName(kept)


def _contract_tables(spark, d):
    """Gold written into external Parquet tables declared with the contract types."""
    root = scratch_path(spark, "gold_contract")
    database = f"strata_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/_catalog'")
    names = {}
    for table, cols in GOLD_CONTRACT.items():
        name = f"{database}.{table}"
        SK.create_external_table(spark, name, f"{root}/{table}", cols)
        kind = {"gold_sales_by_country": "country", "gold_sales_by_category": "category",
                "gold_top_products": "products"}[table]
        SK.insert_contract(L.gold(spark, d, kind), name, cols)
        names[table] = name
    return names


@register("gold_contract")
def gold_contract(spark, d):
    """SURVEY SNK10, SRC6."""
    return spark.table(_contract_tables(spark, d)["gold_top_products"])


@register("external_gold_query")
def external_gold_query(spark, d):
    """SURVEY SRC9, SRT1."""
    name = _contract_tables(spark, d)["gold_top_products"]
    return spark.sql(f"SELECT product_id, product_name, category, purchase_count, units_sold, revenue "
                     f"FROM {name} ORDER BY revenue DESC, product_id")


def _text_events(spark, d):
    """Adapter E shaped as the raw export: ids as text, ISO time with Z."""
    e = A.events_e(spark, d)
    return e.select(F.col("event_id"), F.col("customer_id").cast("string").alias("customer_id"),
                    F.col("product_id").cast("string").alias("product_id"), "event_type",
                    F.date_format(F.col("timestamp").cast("timestamp"),
                                  "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
                    "quantity")


def _text_customers(spark, d):
    c = A.raw_customers(spark, d)
    return c.select(F.col("customer_id").cast("string").alias("customer_id"), "name", "country", "signup_date")


@register("scan_csv")
def scan_csv(spark, d):
    """SURVEY SRC1."""
    path = scratch_path(spark, "customers_csv")
    SK.write_csv(_text_customers(spark, d), path)
    return SF.read_csv(spark, path)


@register("roundtrip_csv")
def roundtrip_csv(spark, d):
    """SURVEY SNK1."""
    path = scratch_path(spark, "products_csv")
    p = A.raw_products(spark, d)
    text = p.select(*[F.col(c).cast("string").alias(c) for c in p.columns])
    SK.write_csv(text, path, ["product_id", "product_name", "category", "price"])
    return SF.read_csv(spark, path)


@register("scan_json_array")
def scan_json_array(spark, d):
    """SURVEY SRC3."""
    path = scratch_path(spark, "events_json_array")
    SK.write_json_array(_text_events(spark, d), path)
    return SF.read_json_array(spark, path)


@register("scan_json_array_split")
def scan_json_array_split(spark, d):
    """SURVEY SRC3, a document read by many tasks; the units are small, so that documents are cut at any size."""
    from strata.sources.json_arrays import read_json_array_split
    path = scratch_path(spark, "events_json_array")
    events = _text_events(spark, d).withColumn("quantity", F.col("quantity").cast("bigint"))
    SK.write_json_array(events, path)
    return read_json_array_split(spark, path, events.schema, unit_bytes=1 << 20)


@register("scan_jsonl")
def scan_jsonl(spark, d):
    """SURVEY SRC4."""
    path = scratch_path(spark, "events_jsonl")
    SK.write_json_lines(_text_events(spark, d), path)
    return SF.read_json_lines(spark, path)


@register("roundtrip_json")
def roundtrip_json(spark, d):
    """SURVEY SNK2."""
    path = scratch_path(spark, "gold_json")
    SK.write_json_lines(L.gold(spark, d, "country"), path)
    return SF.read_json_lines(spark, path)


@register("roundtrip_parquet")
def roundtrip_parquet(spark, d):
    """SURVEY SNK7."""
    path = scratch_path(spark, "silver_parquet")
    SK.write_parquet(L.silver_events_e(spark, d), path)
    s = SF.read_parquet(spark, path)
    return s.select("event_id", "customer_id", "product_id", "event_type",
                    F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_ts"), "quantity")


@register("with_lineage")
def with_lineage(spark, d):
    """SURVEY SRC11."""
    lineage = SF.with_lineage(A.table(spark, d, "events"))
    return lineage.select("event_id", F.col("source_file").endswith(".parquet").alias("from_parquet"),
                          F.col("source_path").contains("/events.parquet").alias("from_events"))


@register("with_ingest_time")
def with_ingest_time(spark, d):
    """SURVEY PRJ15."""
    loaded = _text_customers(spark, d).withColumn("_ingested_at", F.current_timestamp())
    return loaded.agg(F.count(F.lit(1)).alias("rows"), F.count("_ingested_at").alias("timed"),
                      F.count_distinct("_ingested_at").alias("times"))


def _bronze_before_cutoff(spark, d):
    """Bronze holding the order lines shipped before the cutoff (first arrivals)."""
    path = scratch_path(spark, "bronze_l")
    silver = L.silver_events_l(spark, d)
    SK.write_parquet(silver.filter(F.col("event_timestamp") < F.lit(A.BRONZE_CUTOFF).cast("timestamp")), path)
    return path


@register("existing_ids")
def existing_ids_q(spark, d):
    """SURVEY SRC10."""
    return SF.existing_ids(spark, _bronze_before_cutoff(spark, d))


@register("new_events_only")
def new_events_only(spark, d):
    """SURVEY JOI5."""
    stored = SF.existing_ids(spark, _bronze_before_cutoff(spark, d), distinct=False)
    return I.new_only(L.silver_events_l(spark, d), stored).select("event_id", "customer_id", "product_id",
                                                                  "quantity")


# ----------------------------------------------------------------- streaming


def _topic_l(spark, d):
    return A.messages_l(spark, d)


def _topic_d(spark, d):
    m = A.messages_d(spark, d, with_key=True)
    return m.select("key", "value", F.lit(None).cast("timestamp_ntz").alias("arrival_ts"),
                    F.col("record_id").alias("arrival_a"), F.lit(0).cast("bigint").alias("arrival_b"))


def _stream_ingest(spark, *runs):
    """Run the ingest stream once per (checkpoint, frame): the frame, if any, is published to the topic first.

    The same checkpoint name resumes, a new one replays.
    """
    topic, root = scratch_path(spark, "topic"), scratch_path(spark, "stream")
    for name, frame in runs:
        if frame is not None:
            T.write_topic(frame, topic)
        SB.run_available(spark, T.read_topic_stream(spark, topic), root, checkpoint=f"{root}/_checkpoint_{name}")
    return root


def _bronze_cols(df):
    return df.select("event_id", "customer_id", "product_id", "quantity")


@register("stream_bronze")
def stream_bronze(spark, d):
    """SURVEY STR1, DED2, SNK3, SRC7, LIM2."""
    return _bronze_cols(SB.read_bronze(spark, _stream_ingest(spark, ("a", _topic_l(spark, d)))))


@register("stream_replay")
def stream_replay(spark, d):
    """SURVEY STR3."""
    root = _stream_ingest(spark, ("a", _topic_l(spark, d)), ("b", None))
    return _bronze_cols(SB.read_bronze(spark, root))


@register("stream_resume")
def stream_resume(spark, d):
    """The stream stops inside a backlog, part of a batch taken, and a second run goes on from there. [SURVEY STR2]"""
    topic, root = scratch_path(spark, "topic"), scratch_path(spark, "stream")
    T.write_topic(_topic_l(spark, d), topic)
    for most in (A.INTAKE_LIMIT, None):
        SB.run_available(spark, T.read_topic_stream(spark, topic), root, max_messages=most)
    return _bronze_cols(SB.read_bronze(spark, root))


@register("stream_limit")
def stream_limit(spark, d):
    """The first ``INTAKE_LIMIT`` messages in arrival order, no more and no fewer. [SURVEY LIM2]"""
    topic, root = scratch_path(spark, "topic"), scratch_path(spark, "stream")
    T.write_topic(_topic_l(spark, d), topic)
    SB.run_available(spark, T.read_topic_stream(spark, topic), root, max_messages=A.INTAKE_LIMIT)
    return _bronze_cols(SB.read_bronze(spark, root))


@register("incremental_gold")
def incremental_gold(spark, d):
    """Summaries of a backlog taken in two runs, the Bronze of the second packed in between. [SURVEY PIP2, AGG1]"""
    topic, root = scratch_path(spark, "topic"), scratch_path(spark, "incremental")
    cu = M.string_keyed(C.silver_customers(A.raw_customers(spark, d).drop("segment")), "customer_id")
    pr = M.string_keyed(C.silver_products(A.raw_products(spark, d)), "product_id")
    messages = M.to_messages(A.events_e(spark, d), {"key": "customer_id", "arrival_a": "event_id"})
    T.write_topic(messages.select(F.col("key").cast("string").alias("key"), "value", F.lit(None).cast("timestamp_ntz").alias("arrival_ts"),
                                  F.col("arrival_a").cast("bigint").alias("arrival_a"), F.lit(0).cast("bigint").alias("arrival_b")), topic)
    for most in (A.INTAKE_LIMIT, None):
        SB.run_available(spark, T.read_topic_stream(spark, topic), root, max_messages=most)
        store = SB.open_store(spark, root)
        store.compact(mark=INC.Enriched(spark, root).upto)
        INC.advance(spark, store, cu, pr, root)
    return INC.Enriched(spark, root).summary("revenue_by_country")


@register("stream_rejects")
def stream_rejects(spark, d):
    """SURVEY SNK4."""
    root = _stream_ingest(spark, ("a", _topic_d(spark, d)))
    return SB.read_rejects(spark, root).select(F.col("arrival_a").alias("record_id"), "reasons")


@register("stream_quality")
def stream_quality(spark, d):
    """SURVEY STR5."""
    topic = _topic_d(spark, d).unionByName(_topic_l(spark, d))
    return SB.read_quality(spark, _stream_ingest(spark, ("a", topic)))


@register("publish_payload")
def publish_payload(spark, d):
    """SURVEY SNK8."""
    ev = _text_events(spark, d)
    pub = T.publish_frame(ev, "customer_id")
    parsed = pub.select("key", F.from_json("value", ev.schema).alias("e"))
    return parsed.select("key", "e.event_id", "e.customer_id", "e.product_id", "e.event_type", "e.quantity")


@register("publish_order")
def publish_order(spark, d):
    """What a topic or broker gets: each event's partition and its number among its customer's events. [SURVEY SNK8]"""
    ev = _text_events(spark, d).withColumn("arrival_ts", F.to_timestamp_ntz(F.substring("timestamp", 1, 26)))
    pub = T.publish_frame(ev.drop("arrival_ts"), "customer_id").withColumn(
        "arrival_ts", F.to_timestamp_ntz(F.substring(F.get_json_object("value", "$.timestamp"), 1, 26))).withColumn(
        "arrival_a", F.get_json_object("value", "$.event_id").cast("bigint"))
    return T.dealt(pub, 8).select("key", "partition", "sequence", F.col("arrival_a").alias("event_id"))


@register("keyed_order")
def keyed_order(spark, d):
    """Per key of the published topic: its partitions (one) and events after a later one (none). [SURVEY SNK9, STR4]"""
    ev = _text_events(spark, d).withColumn("arrival_ts", F.to_timestamp_ntz(F.substring("timestamp", 1, 26)))
    pub = T.publish_frame(ev.drop("arrival_ts"), "customer_id").withColumn(
        "arrival_ts", F.to_timestamp_ntz(F.substring(F.get_json_object("value", "$.timestamp"), 1, 26)))
    topic = T.keyed(pub, order=("arrival_ts",)).select(
        "key", "arrival_ts", F.spark_partition_id().alias("partition"), F.monotonically_increasing_id().alias("place"))
    before = F.lag("arrival_ts").over(Window.partitionBy("key").orderBy("place"))  # on the topic's own partitioning
    return topic.withColumn("late", F.coalesce(before > F.col("arrival_ts"), F.lit(False))).groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("partition").alias("partitions"),
        F.count_if("late").alias("inversions"))


# ------------------------------------------------- gold over order-line events
@register("l_gold_sales_by_country")
def l_gold_sales_by_country(spark, d):
    """SURVEY AGG4 over order lines (DED1 first)."""
    return L.gold(spark, d, "country", events="l")


@register("l_gold_top_products")
def l_gold_top_products(spark, d):
    """SURVEY AGG6 over order lines (DED1 first)."""
    return L.gold(spark, d, "products", events="l")
