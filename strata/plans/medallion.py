"""Layered runs: raw -> Bronze -> Silver -> Gold, each layer written and re-read.

Silver reads the *stored* Bronze and Gold the stored Silver, so every layer is
computed once and lineage is cut at each write (a retried stage re-reads a
finished layer instead of recomputing from raw).  Batch layers are full
refreshes.  ``fmt`` selects the file format (``parquet`` by default).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.functions import validate as V
from strata.operators import aggregate as G
from strata.operators import conform as C
from strata.operators import ingest as I
from strata.operators import quality as Q
from strata.operators.enrich import enrich_events, iso_text
from strata.schemas import BRONZE_EVENTS, RAW_CUSTOMERS, RAW_EVENTS, RAW_PRODUCTS
from strata.sinks import files as SK
from strata.sources import files as SF
from strata.sources.json_arrays import read_json_array_split

LAYER_TABLES = ("customers", "products", "events")
GOLD_TABLES = tuple(G.GOLD_KEYS)


@dataclass
class RunMetrics:
    """Rows written and wall time per stage (``Observation`` on each write)."""
    rows: dict = field(default_factory=dict)
    duration_ms: dict = field(default_factory=dict)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        data = [(k, int(self.rows.get(k, 0)), float(self.duration_ms[k])) for k in self.duration_ms]
        return spark.createDataFrame(data, "stage string, rows bigint, duration_ms double")


def _write_observed(df: DataFrame, path: str, stage: str, metrics: RunMetrics, fmt: str,
                    table: str | None = None, bucket_by: tuple[int, str] | None = None,
                    also: Sequence[Column] = (), compression: str | None = None) -> dict[str, int]:
    """Writes ``df``, counting its rows and the aggregates ``also`` on the way; returns what was counted."""
    obs = Observation(stage)
    started = time.perf_counter()
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *also)
    if table is None:
        options = {"compression": compression} if compression else {}
        observed.write.mode("overwrite").format(fmt).options(**options).save(path)
    else:
        SK.save_table(observed, table, fmt=fmt, path=path, bucket_by=bucket_by)
    metrics.duration_ms[stage] = round((time.perf_counter() - started) * 1000, 2)
    metrics.rows[stage] = obs.get["rows"]
    return obs.get


def run_medallion(spark: SparkSession, raw: dict[str, DataFrame], dst: str, fmt: str = "parquet",
                  orphans: str = "drop", event_order: Sequence[str] | None = None,
                  database: str | None = None, dim_buckets: int | None = None, gate: bool = False,
                  audit: bool = False) -> RunMetrics:
    """Batch medallion over raw ``customers``, ``products``, ``events`` frames.

    With ``gate`` the key, foreign-key and domain rules are checked on the raw
    frames first, and nothing is written when one fails (``QualityGateError``).
    With ``audit`` the same rules are counted as Bronze is written and on its key
    columns, without another pass over the raw frames; a failing one raises before
    Silver, with Bronze written (``strata.plans.refresh`` publishes such runs).

    With ``database`` every layer is also a catalog table ``<database>.<layer>_<name>``
    (data under ``dst``, full refresh); without it, plain folders.  With
    ``dim_buckets`` too, the Silver dimensions are stored bucketed and sorted by
    their key, so Gold's joins read them co-partitioned: at scale the large
    dimensions are then never re-shuffled, only the pair totals are.
    """
    metrics = RunMetrics()
    if gate:
        Q.assert_clean(Q.source_rules(raw["customers"], raw["products"], raw["events"]))
    if database is not None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{dst}/_catalog'")

    def table(layer: str, name: str) -> str | None:
        return None if database is None else f"{database}.{layer}_{name}"

    rules = Q.source_domains(raw["customers"], raw["products"], raw["events"]) if audit else {}
    failed = {}
    for name in LAYER_TABLES:
        bronze = raw[name].withColumn("_ingested_at", F.current_timestamp())
        counted = _write_observed(bronze, f"{dst}/bronze/{name}", f"bronze_{name}", metrics, fmt, table("bronze", name),
                                  also=Q.observed(rules.get(name, [])))
        failed.update({f"{name}.{rule}": counted[rule] for rule, _ in rules.get(name, [])})

    def stored(layer: str, name: str) -> DataFrame:
        t = table(layer, name)
        return spark.table(t) if t else spark.read.format(fmt).load(f"{dst}/{layer}/{name}")

    if audit:
        keys = Q.key_rules(*(stored("bronze", name) for name in LAYER_TABLES)).collect()  # a row per rule
        Q.assert_none({**failed, **{f"{r['table_name']}.{r['rule']}": r["failed"] for r in keys}})

    # Silver carries the stored Bronze ingest time (one time per load, not a new
    # one per write).  It is constant within a load, so it never decides which
    # copy survives; the event order names the business columns only.
    ev_order = list(event_order or ("event_timestamp", "customer_id", "product_id", "event_type", "quantity"))
    silver = {
        "customers": C.silver_customers(stored("bronze", "customers")),
        "products": C.silver_products(stored("bronze", "products")),
        "events": C.silver_events(stored("bronze", "events"), order=ev_order),
    }
    dim_keys = {"customers": "customer_id", "products": "product_id"}
    for name in LAYER_TABLES:
        bucket = (dim_buckets, dim_keys[name]) if dim_buckets and database and name in dim_keys else None
        _write_observed(silver[name], f"{dst}/silver/{name}", f"silver_{name}", metrics, fmt,
                        table("silver", name), bucket)

    # All Golds are sums over the same joined purchases: joined once, summed to a
    # row per country and product, and the three tables come from those rows.
    cu, pr, ev = stored("silver", "customers"), stored("silver", "products"), stored("silver", "events")
    shared = G.purchase_totals(ev, cu, pr, orphans).persist()
    try:
        for name, keys in G.GOLD_KEYS.items():
            _write_observed(G.summarize(shared, keys), f"{dst}/gold/{name}", f"gold_{name}", metrics, fmt, table("gold", name))
    finally:
        shared.unpersist()
    return metrics


def layer_counts(spark: SparkSession, dst: str, fmt: str = "parquet") -> DataFrame:
    """Row count of every Bronze and Silver folder (UNION ALL of counts)."""
    frames = [spark.read.format(fmt).load(f"{dst}/{layer}/{name}")
              .agg(F.count(F.lit(1)).alias("rows"))
              .select(F.lit(f"{layer}_{name}").alias("table_name"), "rows")
              for layer in ("bronze", "silver") for name in LAYER_TABLES]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def table_counts_sql(spark: SparkSession, database: str) -> DataFrame:
    """Row count per Bronze and Silver table, as one SQL UNION ALL over the catalog."""
    parts = [f"SELECT '{layer}_{name}' AS table_name, COUNT(*) AS rows FROM {database}.{layer}_{name}"
             for layer in ("bronze", "silver") for name in LAYER_TABLES]
    return spark.sql("\nUNION ALL\n".join(parts))


def to_messages(events: DataFrame, arrival: dict[str, str] | None = None) -> DataFrame:
    """Raw events -> JSON message texts (ids as text, ISO time with Z).

    ``arrival`` names the columns that order the messages: output name -> event column.
    """
    ts = F.date_format(F.col("timestamp").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return events.select(*[F.col(c).alias(name) for name, c in (arrival or {}).items()], F.to_json(F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("product_id").cast("string").alias("product_id"),
        "event_type", ts.alias("timestamp"), "quantity")).alias("value"))


def ingest_messages(spark: SparkSession, messages: DataFrame, dst: str, arrival: Sequence[str],
                    metrics: RunMetrics | None = None, run_id: str | None = None) -> RunMetrics:
    """Batch ingest: valid, first-arriving, not-yet-stored events appended to ``dst/bronze``;
    rejects (with reasons) kept per run under ``dst/rejected/run=<run_id>``.

    ``arrival`` are the message columns in whose order copies of an id arrive;
    without one there is no first copy.  Dead letters accumulate across runs; a
    retried run (same ``run_id``) rewrites its own folder instead of adding copies.
    Messages are parsed once for both outputs; meanwhile their typed columns are kept,
    not the parsed view, which takes several times the room.
    """
    if not arrival:
        raise ValueError("arrival columns are needed to tell which copy of an event came first")
    metrics = metrics or RunMetrics()
    run_id = run_id or uuid.uuid4().hex
    judged = V.judged(messages, reasons=True).persist()
    try:
        valid = judged.filter("is_valid").select(*arrival, "event.*", F.col("value").alias("message"))
        rejected = judged.filter(~F.col("is_valid")).select(*arrival, "value", "reasons")
        _store_ingest(spark, I.first_arrivals(valid, arrival), rejected, dst, arrival, metrics, run_id)
    finally:
        judged.unpersist()
    return metrics


def _store_ingest(spark: SparkSession, firsts: DataFrame, rejected: DataFrame, dst: str, arrival: Sequence[str],
                  metrics: RunMetrics, run_id: str) -> None:
    SK.ensure_dataset(spark, f"{dst}/bronze", BRONZE_EVENTS)
    stored = SF.existing_ids(spark, f"{dst}/bronze", schema=BRONZE_EVENTS, distinct=False)
    fresh = I.new_only(firsts, stored)
    obs = Observation("bronze")
    started = time.perf_counter()
    fresh.drop(*arrival).observe(obs, F.count(F.lit(1)).alias("rows")) \
        .write.mode("append").parquet(f"{dst}/bronze")
    metrics.duration_ms["bronze"] = round((time.perf_counter() - started) * 1000, 2)
    metrics.rows["bronze"] = obs.get["rows"]
    _write_observed(rejected.drop(*arrival), f"{dst}/rejected/run={run_id}", "rejected", metrics, "json")


def enriched_rows(bronze: DataFrame, customers: DataFrame, products: DataFrame, orphans: str = "fail") -> DataFrame:
    """Bronze events with their dimensions' attributes; those without a readable time are left out."""
    typed = bronze.select(
        "event_id", "customer_id", "product_id", "event_type", "currency",
        F.try_to_timestamp("timestamp").alias("event_timestamp"), F.col("quantity").cast("bigint").alias("quantity")
    ).where(F.col("event_timestamp").isNotNull())
    enriched = enrich_events(typed, customers, products, orphans=orphans)
    return enriched.withColumn("event_timestamp", iso_text("event_timestamp"))


def enrich_and_summarize(spark: SparkSession, bronze: DataFrame, customers: DataFrame, products: DataFrame,
                         dst: str, orphans: str = "fail", metrics: RunMetrics | None = None,
                         summary_format: str = "jsonl") -> RunMetrics:
    """Bronze events -> enriched Silver (JSON lines, gzip) -> one summary per dimension.

    An event whose time cannot be parsed is no sale, as in ``silver_events``, and
    is left out.  Summaries are JSON lines, or JSON array documents with
    ``summary_format="array"`` (one document per partition, sorted by the
    dimension within it).  They come from one scan of the stored Silver.
    """
    if summary_format not in ("jsonl", "array"):
        raise ValueError(f"summary_format must be 'jsonl' or 'array', got {summary_format!r}")
    metrics = metrics or RunMetrics()
    enriched = enriched_rows(bronze, customers, products, orphans)
    _write_observed(enriched, f"{dst}/silver_enriched", "silver_enriched", metrics, "json", compression="gzip")

    silver = SF.read_json_lines(spark, f"{dst}/silver_enriched", enriched.schema)
    every = G.summary_all(silver).persist()
    try:
        for name in G.SUMMARY_DIMENSIONS:
            summary = every.where(F.col("summary") == name).drop("summary")
            if summary_format == "array":
                started = time.perf_counter()
                SK.write_json_array(summary.sortWithinPartitions("dimension"), f"{dst}/gold/{name}")
                metrics.duration_ms[f"gold_{name}"] = round((time.perf_counter() - started) * 1000, 2)
            else:
                _write_observed(summary, f"{dst}/gold/{name}", f"gold_{name}", metrics, "json")
    finally:
        every.unpersist()
    return metrics


def run_enriched(spark: SparkSession, messages: DataFrame, customers: DataFrame, products: DataFrame,
                 dst: str, arrival: Sequence[str], orphans: str = "fail") -> RunMetrics:
    """Incremental path: messages -> Bronze (validated, deduped) -> enriched Silver -> summaries.

    Bronze is appended with only ids it does not hold; rejects go to their own
    folder with reasons.  Silver and the summaries are rebuilt from Bronze.
    """
    metrics = ingest_messages(spark, messages, dst, arrival)
    bronze = spark.read.schema(BRONZE_EVENTS).parquet(f"{dst}/bronze")
    return enrich_and_summarize(spark, bronze, customers, products, dst, orphans, metrics)


def string_keyed(df: DataFrame, key: str) -> DataFrame:
    """Dimension with its key as text (messages carry ids as text)."""
    return df.withColumn(key, F.col(key).cast("string"))


# ------------------------------------------------------------ raw-file entry
RAW_FILES = {"customers": "customers.csv", "products": "products.csv", "events": "events.json"}


def read_raw(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """The three raw exports: header CSVs (all text) and a JSON array of events."""
    return {
        "customers": SF.read_csv(spark, f"{raw_dir}/{RAW_FILES['customers']}", RAW_CUSTOMERS),
        "products": SF.read_csv(spark, f"{raw_dir}/{RAW_FILES['products']}", RAW_PRODUCTS),
        "events": read_json_array_split(spark, f"{raw_dir}/{RAW_FILES['events']}", RAW_EVENTS),
    }


def medallion_from_files(spark: SparkSession, raw_dir: str, dst: str, fmt: str = "parquet",
                         orphans: str = "drop", database: str | None = None, gate: bool = False) -> RunMetrics:
    """The batch medallion over a raw folder, as the managed job runs it."""
    return run_medallion(spark, read_raw(spark, raw_dir), dst, fmt=fmt, orphans=orphans, database=database, gate=gate)


def dimensions_from_files(spark: SparkSession, raw_dir: str) -> tuple[DataFrame, DataFrame]:
    """Conformed customer and product dimensions from the raw CSVs; a key's last row in the files wins."""
    raw = read_raw(spark, raw_dir)
    return (C.silver_customers(SF.in_file_order(raw["customers"]), last_by=SF.FILE_ORDER),
            C.silver_products(SF.in_file_order(raw["products"]), last_by=SF.FILE_ORDER))
