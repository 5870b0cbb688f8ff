"""Map the driver's star-schema tables onto customers / products / events.

Adapter E  : ``events`` -> raw events (one per row, ids unique).
Adapter L  : ``lineitem`` join ``orders`` -> raw events with natural duplicate ids.
Adapter D  : ``events`` -> raw JSON message text with deterministic dirt, used by
             the validation / quarantine operators.
Dimensions : ``customer`` join ``nation`` -> customers; ``part`` -> products.

Every adapter reads its whole table; nothing is sampled or capped.  The
"segment" dimension variants stand for a dimension export that covers only some
market segments / product types, which is how orphan facts arise; they feed the
orphan-policy operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.partitioning import spread, stored_bytes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Stored bytes of ``events`` a task: as parsed messages its rows take some forty times as much.
EVENTS_UNIT = 2 << 20


def fact_table(spark: SparkSession, sf_dir: str, name: str, unit_bytes: int | None = None) -> DataFrame:
    """A fact table, spread when it is read in too few splits: fewer than cores, or than its size holds units."""
    least = spark.sparkContext.defaultParallelism
    if unit_bytes:
        least = max(least, -(-stored_bytes(spark, f"{sf_dir.rstrip('/')}/{name}.parquet") // unit_bytes))
    return spread(table(spark, sf_dir, name), least)


# ---------------------------------------------------------------- dimensions
def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer join nation; signup_date is derived (no source column exists)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("country"),
        F.date_format(F.date_add(F.lit("2026-01-01").cast("date"),
                                 (F.col("c_custkey") % 90).cast("int")), "yyyy-MM-dd").alias("signup_date"),
        F.col("c_mktsegment").alias("segment"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


# The dimension exports used by the orphan-policy operators cover
# every market segment but this one, and every product type but this one.
UNCOVERED_SEGMENT = "AUTOMOBILE"
UNCOVERED_TYPE = "ECONOMY"


def segment_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_customers(spark, sf_dir).filter(F.col("segment") != UNCOVERED_SEGMENT)


def segment_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_products(spark, sf_dir).filter(F.col("category") != UNCOVERED_TYPE)


# -------------------------------------------------------------------- events
def events_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter E: typed raw events from the ``events`` table."""
    e = fact_table(spark, sf_dir, "events", EVENTS_UNIT)
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").alias("customer_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        F.col("event_type"),
        F.col("ts").alias("timestamp"),
        F.floor("value").cast("int").alias("quantity"),
    )


# Order-line return flag -> event type.
FLAG_TO_TYPE = {"N": "purchase", "A": "add_to_cart", "R": "view"}


def _flag_to_type(flag: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in FLAG_TO_TYPE.items() for x in kv])[flag]


def events_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter L: order lines as events; (order, line) repeats give duplicates.

    ``l_shipdate, l_partkey, l_suppkey`` is a total order within an id and is
    carried so first-arrival dedup is deterministic.
    """
    li = fact_table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        _flag_to_type(F.col("l_returnflag")).alias("event_type"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_suppkey").alias("supplier_id"),
    )


L_ORDER = ("timestamp", "product_id", "supplier_id")


# ------------------------------------------------------- dirty JSON messages
def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _by_case(m: Column, cases: dict, default: Column | None) -> Column:
    out = None
    for k, v in cases.items():
        out = F.when(m == k, v) if out is None else out.when(m == k, v)
    return out if default is None else out.otherwise(default)


def messages_d(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    """Adapter D: one JSON message text per ``events`` row.

    Columns: record_id (source row id, stands for the topic offset), value (text).
    The case number ``event_id % 25`` decides which field gets which dirt; every
    row is emitted.  Case 0 carries an extra nested field, 24 is cut short or, every
    other time, followed by a second object.
    """
    e = fact_table(spark, sf_dir, "events", EVENTS_UNIT)
    m = F.col("event_id") % 25
    user = F.col("user_id").cast("string")
    etype = F.col("event_type")
    q = F.floor("value").cast("bigint").cast("string")
    ts_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    members = [
        ("event_id", _quoted(F.col("event_id").cast("string")), None),
        ("customer_id", _by_case(m, {1: F.lit('""'), 3: F.lit('" "'), 4: user}, _quoted(user)), m == 2),
        ("product_id", _by_case(m, {5: F.lit("null")}, _quoted(F.get_json_object("props", "$.k"))), None),
        ("event_type", _by_case(m, {6: _quoted(F.upper(etype)),
                                    7: _quoted(F.concat(F.lit(" "), etype))}, _quoted(etype)), None),
        ("timestamp", _by_case(m, {9: F.lit('"not a time"')}, _quoted(ts_text)), m == 8),
        ("quantity", _by_case(m, {
            10: _quoted(q),
            11: _quoted(F.concat(q, F.lit(".5"))),
            12: F.concat(q, F.lit(".7")),
            13: F.concat(F.lit("-"), q),
            14: F.lit("true"),
            15: F.lit("false"),
            16: F.lit("null"),
            17: _quoted(F.concat(F.lit(" "), q, F.lit(" "))),
            18: F.lit('"x"'),
            19: F.concat(q, F.lit("e0")),
        }, q), None),
        ("currency", _by_case(m, {20: F.lit('"SAR"'), 21: F.lit('"XXX"'),
                                  22: F.lit("null"), 23: F.lit('""')}, None), ~m.isin(20, 21, 22, 23)),
        ("meta", F.lit('{"z":1}'), m != 0),
    ]
    parts = []
    for name, value, absent in members:
        part = F.concat(F.lit(f'"{name}":'), value)
        parts.append(part if absent is None else F.when(~absent, part))
    body = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    text = (F.when(F.col("event_id") % 50 == 24, F.expr("substring(_body, 1, length(_body) - 1)"))
             .when(F.col("event_id") % 50 == 49, F.concat("_body", F.lit('{"x":1}'))).otherwise(F.col("_body")))
    key = [F.col("user_id").cast("string").alias("key")] if with_key else []
    return (e.withColumn("_body", body)
            .select(F.col("event_id").alias("record_id"), text.alias("value"), *key))


# ------------------------------------------------------ dirty dimension text
def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer join nation as raw CSV-like text with deterministic dirt.

    Case ``c_custkey % 10``: 1 padded id, 2 padded name, 3 unparsable date,
    4 empty id, 5 null id, 6 impossible date, 7 tab before country (kept: trim
    strips spaces only), 8 padded country, 9 id of the previous customer (a
    duplicate key).
    """
    base = raw_customers(spark, sf_dir)
    m = F.col("customer_id") % 10
    cid = F.col("customer_id").cast("string")
    return base.select(
        _by_case(m, {1: F.concat(F.lit("  "), cid, F.lit("  ")), 4: F.lit(""),
                     5: F.lit(None).cast("string"),
                     9: (F.col("customer_id") - 1).cast("string")}, cid).alias("customer_id"),
        _by_case(m, {2: F.concat(F.lit(" "), F.col("name"), F.lit(" "))}, F.col("name")).alias("name"),
        _by_case(m, {7: F.concat(F.lit("\t"), F.col("country")),
                     8: F.concat(F.lit("  "), F.col("country"))}, F.col("country")).alias("country"),
        _by_case(m, {3: F.lit("not-a-date"), 6: F.lit("2026-02-30")}, F.col("signup_date")).alias("signup_date"),
    )


def dirty_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as raw CSV-like text with deterministic dirt.

    Case ``p_partkey % 10``: 1 padded price, 2 non-numeric price, 3 price with a
    third decimal (rounds half up), 4 null id, 5 price overflowing decimal(10,2),
    6 negative price, 7 padded name, 8 padded category, 9 id of the previous part.
    """
    base = raw_products(spark, sf_dir)
    m = F.col("product_id") % 10
    pid = F.col("product_id").cast("string")
    price = F.col("price").cast("string")
    return base.select(
        _by_case(m, {4: F.lit(None).cast("string"),
                     9: (F.col("product_id") - 1).cast("string")}, pid).alias("product_id"),
        _by_case(m, {7: F.concat(F.lit("  "), F.col("product_name"), F.lit(" "))},
                 F.col("product_name")).alias("product_name"),
        _by_case(m, {8: F.concat(F.col("category"), F.lit("  "))}, F.col("category")).alias("category"),
        _by_case(m, {1: F.concat(F.lit(" "), price, F.lit(" ")), 2: F.lit("abc"),
                     3: F.concat(F.floor("price").cast("string"), F.lit(".005")),
                     5: F.lit("123456789.50"), 6: F.concat(F.lit("-"), price)}, price).alias("price"),
    )


def versioned_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part twice, as two exports of one catalogue, with a file-order column.

    The second export renames every product (upper case) and sits after the
    first one for parts larger than size 25, before it otherwise.
    """
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    first = p.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                     (F.col("p_partkey") * 2).alias("file_order"))
    second = p.select(F.col("p_partkey").alias("product_id"), F.upper("p_name").alias("product_name"),
                      F.when(F.col("p_size") > 25, F.col("p_partkey") * 2 + 1)
                       .otherwise(F.col("p_partkey") * 2 - 1).alias("file_order"))
    return first.unionByName(second)


# Fixed value: order lines shipped before this day are already in Bronze.
BRONZE_CUTOFF = "1998-06-01"
# Fixed value: messages that a bounded intake run takes.
INTAKE_LIMIT = 2500


def messages_l_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter L as messages, with what a batch ingest must cope with.

    Case ``supplier_id % 4``: 1 carries the extra field ``channel``, 2 a quantity
    past 32 bits, 3 a time that cannot be parsed.
    """
    m = F.col("supplier_id") % 4
    return messages_l(spark, sf_dir, extra=[F.when(m == 1, F.lit("web")).alias("channel")],
                      quantity=F.when(m == 2, F.col("quantity") + F.lit(3_000_000_000)).otherwise(F.col("quantity").cast("bigint")),
                      time=F.when(m == 3, F.lit("some day")))


def messages_l(spark: SparkSession, sf_dir: str, extra: Sequence[Column] = (), quantity: Column | None = None,
               time: Column | None = None) -> DataFrame:
    """Adapter L as JSON message texts; arrival order is (timestamp, product, supplier)."""
    ev = events_l(spark, sf_dir)
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    payload = F.to_json(F.struct(
        "event_id", F.col("customer_id").cast("string").alias("customer_id"),
        F.col("product_id").cast("string").alias("product_id"), "event_type",
        (stamp if time is None else F.coalesce(time, stamp)).alias("timestamp"),
        (F.col("quantity") if quantity is None else quantity).alias("quantity"), *extra))
    return ev.select(F.col("customer_id").cast("string").alias("key"),
                     F.col("timestamp").alias("arrival_ts"), F.col("product_id").alias("arrival_a"),
                     F.col("supplier_id").alias("arrival_b"), payload.alias("value"))
