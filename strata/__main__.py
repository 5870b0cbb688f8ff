"""Job entry points: ``python -m strata <command>``, or on a cluster
``spark-submit --py-files strata.zip strata/__main__.py <command>``.

    medallion --raw DIR --lake DIR [--format parquet] [--database NAME] [--orphans drop|keep|fail] [--no-gate] [--vacuum]
    publish   --events FILE --topic DIR|NAME [--broker HOST:PORT]
    ingest    --topic DIR|NAME --root DIR [--format parquet] [--broker HOST:PORT [--group ID] [--max-offsets N]]
              [--max-files N] [--max-messages N] [--every "1 minute"] [--sink-format parquet|json]
    enrich    --root DIR --raw DIR [--orphans fail|drop|keep] [--sink-format parquet|json] [--incremental]
    generate  --out DIR (--tables DIR | --customers N --products N --events N) [--seed 42]

The session comes from the submitting environment (cluster settings,
``spark.checkpoint.dir``); nothing here sets cluster configuration.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.operators import generate as GEN
from strata.plans import incremental as INC
from strata.plans import medallion as M
from strata.plans import refresh as R
from strata.session import ensure_utc
from strata.sinks import files as SK
from strata.sources import adapters as A
from strata.sources import files as SF
from strata.streaming import bronze as SB
from strata.streaming import topic as T


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strata", description=__doc__.split("\n")[0])
    sub = p.add_subparsers(dest="command", required=True)
    m = sub.add_parser("medallion", help="raw exports -> Bronze/Silver/Gold (full refresh)")
    m.add_argument("--raw", required=True)
    m.add_argument("--lake", required=True)
    m.add_argument("--format", default="parquet")
    m.add_argument("--database")
    m.add_argument("--orphans", default="drop", choices=("drop", "keep", "fail"))
    m.add_argument("--gate", action=argparse.BooleanOptionalAction, default=True,
                   help="check keys, foreign keys and domains; publish nothing if one fails")
    m.add_argument("--vacuum", action="store_true", help="delete older runs afterwards; only while nobody reads them")
    u = sub.add_parser("publish", help="a JSON array of events -> keyed topic")
    u.add_argument("--events", required=True)
    u.add_argument("--topic", required=True, help="folder, or topic name with --broker")
    u.add_argument("--broker")
    i = sub.add_parser("ingest", help="topic -> validated, de-duplicated Bronze + dead letters")
    i.add_argument("--topic", required=True)
    i.add_argument("--root", required=True)
    i.add_argument("--format", default="parquet")
    i.add_argument("--broker", help="read the topic of this name from a Kafka broker")
    i.add_argument("--group", help="consumer group at the broker")
    i.add_argument("--max-offsets", type=int, help="most messages of a micro-batch from a broker")
    i.add_argument("--max-files", type=int)
    i.add_argument("--max-messages", type=int, help="take exactly this many, if there are so many; 0 or less: no limit")
    i.add_argument("--every", help="processing-time trigger; default: process what is available, then stop")
    i.add_argument("--sink-format", default="parquet", choices=("parquet", "json"))
    k = sub.add_parser("compact", help="pack the small folders of an ingest root; with --vacuum delete what is no longer named")
    k.add_argument("--root", required=True)
    k.add_argument("--sink-format", default="parquet", choices=("parquet", "json"))
    k.add_argument("--vacuum", action="store_true", help="only while nobody reads or writes the root")
    e = sub.add_parser("enrich", help="Bronze -> enriched Silver -> summaries")
    e.add_argument("--root", required=True)
    e.add_argument("--raw", required=True)
    e.add_argument("--orphans", default="fail", choices=("drop", "keep", "fail"))
    e.add_argument("--sink-format", default="parquet", choices=("parquet", "json"))
    e.add_argument("--incremental", action="store_true", help="take in only what was committed since the last such run")
    g = sub.add_parser("generate", help="raw exports from the rows of existing tables, or from counts")
    g.add_argument("--tables", help="folder with customer/part/events parquet")
    g.add_argument("--customers", type=int, default=10)
    g.add_argument("--products", type=int, default=10)
    g.add_argument("--events", type=int, default=50)
    g.add_argument("--out", required=True)
    g.add_argument("--seed", type=int, default=GEN.DEFAULT_SEED)
    return p


def run(argv: list[str], spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"strata-{args.command}").getOrCreate()
    ensure_utc(spark)
    if args.command == "medallion":
        snapshot, _ = R.refresh(spark, M.read_raw(spark, args.raw), args.lake, fmt=args.format, orphans=args.orphans,
                                gate=args.gate)
        if args.database:
            R.register_tables(snapshot, args.database)
        if args.vacuum:
            R.Snapshots(spark, args.lake).vacuum()
    elif args.command == "publish":
        events = SF.in_file_order(SF.read_json_array(spark, args.events))
        fields = [c for c in events.columns if c not in SF.FILE_ORDER]
        records = T.publish_frame(events, "customer_id", fields, keep={"arrival_a": "_block", "arrival_b": "_row"})
        if args.broker:
            T.write_topic(records, args.topic, fmt="kafka", options=T.kafka_options(args.broker, args.topic, reading=False))
        else:
            T.write_topic(records, args.topic)
    elif args.command == "ingest":
        options = T.kafka_options(args.broker, args.topic, args.group) if args.broker else None
        source = T.read_topic_stream(spark, args.topic, fmt="kafka" if args.broker else args.format, options=options,
                                     max_files_per_trigger=args.max_files, max_offsets_per_trigger=args.max_offsets)
        if args.every:
            query, _ = SB.start(spark, source, args.root, available_now=False, processing_time=args.every,
                                sink_format=args.sink_format)
            query.awaitTermination()
        else:
            SB.run_available(spark, source, args.root, sink_format=args.sink_format, max_messages=args.max_messages)
    elif args.command == "compact":
        store = SB.open_store(spark, args.root, args.sink_format)
        store.compact(mark=INC.Enriched(spark, args.root).upto)
        if args.vacuum:
            store.vacuum()
    elif args.command == "enrich":
        cu, pr = M.dimensions_from_files(spark, args.raw)
        if args.incremental:
            INC.advance(spark, SB.open_store(spark, args.root, args.sink_format), cu, pr, args.root, args.orphans)
            return 0
        bronze = SB.read_bronze(spark, args.root, fmt=args.sink_format)
        M.enrich_and_summarize(spark, bronze, cu, pr, args.root, args.orphans)
    elif args.command == "generate":
        if args.tables:
            ev = A.table(spark, args.tables, "events")
            raw = {"customers": GEN.customers(A.table(spark, args.tables, "customer"), seed=args.seed),
                   "products": GEN.products(A.table(spark, args.tables, "part")),
                   "events": GEN.events(ev, "event_id", "user_id",
                                        F.get_json_object("props", "$.k").cast("bigint"), seed=args.seed)}
        else:
            raw = GEN.from_counts(spark, args.customers, args.products, args.events, seed=args.seed)
        SK.write_csv(raw["customers"], f"{args.out}/customers.csv")
        SK.write_csv(raw["products"].withColumn("price", F.col("price").cast("string")), f"{args.out}/products.csv")
        SK.write_json_array(raw["events"], f"{args.out}/events.json")
    return 0


if __name__ == "__main__":
    sys.exit(run(sys.argv[1:]))
