"""DuckDB oracle SQL for every registered query (see ``__spark_entry__``).

Written independently of the Spark code, straight from the data-model rules:
each string runs on the driver's pre-registered views (region nation customer
supplier part orders lineitem events ...).  Output column names and types
match the Spark side; money is summed in exact decimal and cast to double.
"""

from __future__ import annotations

# ------------------------------------------------------------------ shared CTEs
EV = """ev AS (
  SELECT cast(event_id AS varchar) AS event_id, user_id AS customer_id,
         cast(json_extract_string(props, '$.k') AS bigint) AS product_id,
         upper(trim(event_type)) AS event_type, ts AS event_timestamp,
         cast(floor(value) AS int) AS quantity
  FROM events),
sev AS (
  SELECT * FROM ev WHERE event_id IS NOT NULL AND event_timestamp IS NOT NULL AND quantity > 0
  QUALIFY row_number() OVER (PARTITION BY event_id
          ORDER BY event_timestamp, customer_id, product_id, event_type, quantity) = 1)"""

CUST = """cust AS (
  SELECT c_custkey AS customer_id, trim(c_name) AS customer_name, trim(n_name) AS country,
         c_mktsegment AS segment
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

PROD = """prod AS (
  SELECT p_partkey AS product_id, trim(p_name) AS product_name, trim(p_type) AS category,
         cast(p_retailprice AS decimal(10,2)) AS price
  FROM part)"""

SEG_CUST = "scust AS (SELECT * FROM cust WHERE segment <> 'AUTOMOBILE')"
SEG_PROD = "sprod AS (SELECT * FROM prod WHERE category <> 'ECONOMY')"

MEASURES = """count(event_id) AS purchase_count, cast(sum(quantity) AS bigint) AS units_sold,
       cast(round(sum(quantity * price), 2) AS double) AS revenue"""

GOLD_KEYS = {"country": "country", "category": "category",
             "products": "product_id, product_name, category"}


def gold_sql(kind: str, join: str = "JOIN", segment: bool = False) -> str:
    keys = GOLD_KEYS[kind]
    c, p = ("scust", "sprod") if segment else ("cust", "prod")
    return f"""WITH {EV}, {CUST}, {PROD}, {SEG_CUST}, {SEG_PROD}
SELECT {keys}, {MEASURES}
FROM sev {join} {c} USING (customer_id) {join} {p} USING (product_id)
WHERE event_type = 'PURCHASE'
GROUP BY {keys}"""


# Dirty message cases (event_id % 25), restated from the data-model rules.
DMSG = """dm AS (
  SELECT event_id AS record_id, event_id % 25 AS m, cast(floor(value) AS bigint) AS q,
         user_id, json_extract_string(props, '$.k') AS k, event_type AS et, ts
  FROM events),
dr AS (
  SELECT *,
    m = 24 AS malformed,
    m <> 24 AND m IN (2, 8) AS missing_field,
    m <> 24 AND m IN (1, 5, 16) AS null_or_blank,
    m <> 24 AND (m IN (6, 7) OR et NOT IN ('view', 'add_to_cart', 'purchase')) AS bad_event_type,
    m <> 24 AND (m IN (11, 13, 15, 18) OR (m NOT IN (11, 13, 14, 15, 16, 18) AND q <= 0)) AS bad_quantity,
    m IN (21, 22, 23) AS bad_currency
  FROM dm),
dv AS (
  SELECT *, concat_ws(',',
      CASE WHEN malformed THEN 'malformed' END, CASE WHEN missing_field THEN 'missing_field' END,
      CASE WHEN null_or_blank THEN 'null_or_blank' END, CASE WHEN bad_event_type THEN 'bad_event_type' END,
      CASE WHEN bad_quantity THEN 'bad_quantity' END, CASE WHEN bad_currency THEN 'bad_currency' END) AS reasons
  FROM dr)"""


RAWEV = """rev AS (
  SELECT cast(event_id AS varchar) AS event_id, user_id AS customer_id,
         cast(json_extract_string(props, '$.k') AS bigint) AS product_id,
         event_type, ts, cast(floor(value) AS int) AS quantity
  FROM events
  WHERE event_type IN ('view', 'add_to_cart', 'purchase') AND ts IS NOT NULL AND floor(value) > 0),
enr AS (
  SELECT event_id, country AS customer_country, product_name, category, event_type, 'USD' AS currency,
         quantity, price,
         CASE WHEN event_type = 'purchase' THEN quantity * price ELSE 0 END AS amount
  FROM rev JOIN cust USING (customer_id) JOIN prod USING (product_id))"""

SUMMARY_MEASURES = """count(*) AS purchase_count, cast(sum(quantity) AS bigint) AS units_sold,
       cast(round(sum(amount), 2) AS double) AS revenue"""


def summary_sql(col: str) -> str:
    return f"""WITH {CUST}, {PROD}, {RAWEV}
SELECT {col} AS dimension, {SUMMARY_MEASURES}
FROM enr WHERE event_type = 'purchase' GROUP BY {col}"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["gold_top_products"] = gold_sql("products")
    q["gold_sales_by_country"] = gold_sql("country")
    q["gold_sales_by_category"] = gold_sql("category")
    q["ranked_products"] = gold_sql("products") + "\nORDER BY revenue DESC, product_id"
    q["gold_country_left"] = gold_sql("country", "LEFT JOIN", segment=True)
    q["gold_category_left"] = gold_sql("category", "LEFT JOIN", segment=True)
    q["gold_products_left"] = gold_sql("products", "LEFT JOIN", segment=True)
    q["gold_country_segment"] = gold_sql("country", "JOIN", segment=True)

    # ---- silver conform over dirty text
    q["conform_customers"] = f"""WITH {CUST}, raw AS (
  SELECT customer_id % 10 AS m, customer_id AS id, customer_name AS name, country,
         strftime(DATE '2026-01-01' + CAST(customer_id % 90 AS INTEGER), '%Y-%m-%d') AS signup
  FROM cust),
dirty AS (
  SELECT CASE m WHEN 1 THEN '  ' || id || '  ' WHEN 4 THEN '' WHEN 5 THEN NULL
                WHEN 9 THEN cast(id - 1 AS varchar) ELSE cast(id AS varchar) END AS customer_id,
         CASE m WHEN 2 THEN ' ' || name || ' ' ELSE name END AS name,
         CASE m WHEN 7 THEN chr(9) || country WHEN 8 THEN '  ' || country ELSE country END AS country,
         CASE m WHEN 3 THEN 'not-a-date' WHEN 6 THEN '2026-02-30' ELSE signup END AS signup_date
  FROM raw),
typed AS (
  SELECT trim(customer_id) AS customer_id, trim(name) AS customer_name, trim(country) AS country,
         try_cast(signup_date AS date) AS signup_date
  FROM dirty WHERE customer_id IS NOT NULL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id
             ORDER BY customer_name NULLS FIRST, country NULLS FIRST, signup_date NULLS FIRST) AS rn
  FROM typed)
SELECT customer_id, customer_name, country, cast(signup_date AS varchar) AS signup_date
FROM ranked WHERE rn = 1"""
    q["conform_products"] = f"""WITH raw AS (
  SELECT p_partkey % 10 AS m, p_partkey AS id, p_name AS name, p_type AS cat, p_retailprice AS price
  FROM part),
dirty AS (
  SELECT CASE m WHEN 4 THEN NULL WHEN 9 THEN cast(id - 1 AS varchar) ELSE cast(id AS varchar) END AS product_id,
         CASE m WHEN 7 THEN '  ' || name || ' ' ELSE name END AS product_name,
         CASE m WHEN 8 THEN cat || '  ' ELSE cat END AS category,
         CASE m WHEN 1 THEN ' ' || cast(price AS varchar) || ' ' WHEN 2 THEN 'abc'
                WHEN 3 THEN cast(cast(floor(price) AS bigint) AS varchar) || '.005'
                WHEN 5 THEN '123456789.50' WHEN 6 THEN '-' || cast(price AS varchar)
                ELSE cast(price AS varchar) END AS price
  FROM raw),
typed AS (
  SELECT trim(product_id) AS product_id, trim(product_name) AS product_name, trim(category) AS category,
         try_cast(trim(price) AS decimal(10,2)) AS price
  FROM dirty),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY product_id
             ORDER BY product_name NULLS FIRST, category NULLS FIRST, price NULLS FIRST) AS rn
  FROM typed WHERE product_id IS NOT NULL AND price IS NOT NULL)
SELECT product_id, product_name, category, cast(price AS double) AS price FROM ranked WHERE rn = 1"""
    q["conform_events"] = f"""WITH {DMSG}
SELECT cast(record_id AS varchar) AS event_id,
       CASE m WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN '' ELSE cast(user_id AS varchar) END AS customer_id,
       CASE m WHEN 5 THEN NULL ELSE k END AS product_id,
       upper(et) AS event_type,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_ts,
       cast(CASE WHEN m IN (11, 12, 14, 15, 16, 18, 19) THEN NULL WHEN m = 13 THEN -q ELSE q END AS int) AS quantity
FROM dm
WHERE m NOT IN (8, 9, 24)
  AND (CASE WHEN m IN (11, 12, 14, 15, 16, 18, 19) THEN NULL WHEN m = 13 THEN -q ELSE q END) > 0"""
    q["dedup_events"] = """WITH l AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber) AS event_id, o_custkey AS customer_id,
         l_partkey AS product_id, cast(l_quantity AS int) AS quantity,
         l_shipdate, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY l_shipdate, product_id, l_suppkey) AS rn
  FROM l WHERE quantity > 0 AND l_shipdate IS NOT NULL)
SELECT event_id, customer_id, product_id, quantity FROM ranked WHERE rn = 1"""
    q["dim_last_wins"] = """WITH v AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_partkey * 2 AS file_order FROM part
  UNION ALL
  SELECT p_partkey, upper(p_name), CASE WHEN p_size > 25 THEN p_partkey * 2 + 1 ELSE p_partkey * 2 - 1 END
  FROM part),
ranked AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY file_order DESC) AS rn FROM v)
SELECT product_id, product_name FROM ranked WHERE rn = 1"""
    q["iso_timestamp"] = """SELECT cast(event_id AS varchar) AS event_id,
       CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00')
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS iso
FROM events"""
    # ---- validation / quarantine over dirty messages
    q["decode_events"] = f"""WITH {DMSG}
SELECT record_id,
       CASE WHEN m = 24 THEN NULL ELSE cast(record_id AS varchar) END AS event_id,
       CASE WHEN m = 24 THEN NULL WHEN m = 6 THEN upper(et) WHEN m = 7 THEN ' ' || et ELSE et END AS event_type,
       CASE WHEN m = 24 THEN NULL
            WHEN m = 11 THEN cast(q AS varchar) || '.5'
            WHEN m = 12 THEN cast(q AS varchar) || '.7'
            WHEN m = 13 THEN CASE WHEN q = 0 THEN '0' ELSE '-' || cast(q AS varchar) END
            WHEN m = 14 THEN 'true' WHEN m = 15 THEN 'false' WHEN m = 16 THEN NULL
            WHEN m = 17 THEN ' ' || cast(q AS varchar) || ' '
            WHEN m = 18 THEN 'x'
            WHEN m = 19 THEN cast(q AS varchar) || '.0'
            ELSE cast(q AS varchar) END AS quantity_text,
       CASE WHEN m = 24 THEN NULL ELSE m IN (20, 21, 22, 23) END AS has_currency
FROM dm"""
    q["normalize_currency"] = f"""WITH {DMSG}
SELECT record_id, cast(record_id AS varchar) AS event_id,
       CASE m WHEN 20 THEN 'SAR' WHEN 21 THEN 'XXX' WHEN 22 THEN NULL WHEN 23 THEN '' ELSE 'USD' END AS currency
FROM dm WHERE m <> 24"""
    q["valid_events"] = f"""WITH {DMSG}
SELECT record_id, cast(record_id AS varchar) AS event_id,
       CASE m WHEN 3 THEN ' ' ELSE cast(user_id AS varchar) END AS customer_id,
       k AS product_id, et AS event_type,
       CASE m WHEN 14 THEN 1 ELSE q END AS quantity,
       CASE m WHEN 20 THEN 'SAR' ELSE 'USD' END AS currency
FROM dv WHERE reasons = ''"""
    q["rejected_events"] = f"""WITH {DMSG}
SELECT record_id, reasons FROM dv WHERE reasons <> ''"""
    q["reject_reason_counts"] = f"""WITH {DMSG}
SELECT reason, count(*) AS n
FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM dv WHERE reasons <> '') t
GROUP BY reason"""
    q["ingest_quality"] = f"""WITH {DMSG},
l AS (SELECT concat_ws('-', l_orderkey, l_linenumber) AS event_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT cast((SELECT count(*) FROM dv WHERE reasons = '') + (SELECT count(DISTINCT event_id) FROM l) AS bigint) AS stored,
       cast((SELECT count(*) FROM dv WHERE reasons <> '') AS bigint) AS rejected,
       cast((SELECT count(*) - count(DISTINCT event_id) FROM l) AS bigint) AS duplicates"""
    # ---- enrich and summaries
    q["enrich_events"] = f"""WITH {CUST}, {PROD}, {RAWEV}
SELECT event_id, customer_country, product_name, category, event_type, currency, quantity,
       cast(price AS double) AS unit_price, cast(amount AS double) AS total_amount
FROM enr"""
    q["summary_country"] = summary_sql("customer_country")
    q["summary_category"] = summary_sql("category")
    q["summary_product_name"] = summary_sql("product_name")
    q["summary_all"] = " UNION ALL ".join(
        f"SELECT '{name}' AS summary, dimension, purchase_count, units_sold, revenue FROM ({summary_sql(col)})"
        for name, col in (("revenue_by_country", "customer_country"), ("revenue_by_category", "category"),
                          ("revenue_by_product", "product_name")))
    cat = f"""WITH {CUST}, {PROD}, {RAWEV}
SELECT category, {SUMMARY_MEASURES}
FROM enr WHERE event_type = 'purchase' GROUP BY category"""
    q["category_summary_typed"] = cat
    q["point_lookup"] = f"SELECT * FROM ({cat}) WHERE category = 'PROMO'"
    # ---- data quality
    pk = """SELECT '{t}' AS table_name, cast(count(*) AS bigint) AS rows,
       cast(count(DISTINCT cast({k} AS varchar)) AS bigint) AS distinct_keys,
       cast(count(*) FILTER (WHERE {k} IS NULL OR cast({k} AS varchar) = '') AS bigint) AS blanks
FROM {src}"""
    q["dq_primary_keys"] = " UNION ALL ".join([
        pk.format(t="customers", k="c_custkey", src="customer JOIN nation ON c_nationkey = n_nationkey"),
        pk.format(t="products", k="p_partkey", src="part"),
        pk.format(t="events", k="event_id", src="events"),
        pk.format(t="order_lines", k="concat_ws('-', l_orderkey, l_linenumber)",
                  src="lineitem JOIN orders ON l_orderkey = o_orderkey"),
    ])
    q["dq_foreign_keys"] = f"""WITH {EV}, {CUST}, {PROD}, {SEG_CUST}, {SEG_PROD}
SELECT 'events.customer_id' AS edge,
       cast(count(*) FILTER (WHERE customer_id NOT IN (SELECT customer_id FROM scust)) AS bigint) AS orphans
FROM ev
UNION ALL
SELECT 'events.product_id', cast(count(*) FILTER (WHERE product_id NOT IN (SELECT product_id FROM sprod)) AS bigint)
FROM ev"""
    q["fk_orphans"] = f"""WITH {EV}, {CUST}, {PROD}, {SEG_CUST}, {SEG_PROD}
SELECT 'events.customer_id' AS edge, event_id FROM ev WHERE customer_id NOT IN (SELECT customer_id FROM scust)
UNION ALL
SELECT 'events.product_id', event_id FROM ev WHERE product_id NOT IN (SELECT product_id FROM sprod)"""
    q["fk_valid"] = f"""WITH {EV}, {CUST}, {PROD}, {SEG_CUST}, {SEG_PROD}
SELECT event_id FROM ev
WHERE customer_id IN (SELECT customer_id FROM scust) AND product_id IN (SELECT product_id FROM sprod)"""
    q["dq_domains"] = f"""WITH {DMSG}
SELECT 'required_present' AS rule, 'customers' AS table_name, cast(count(*) AS bigint) AS checked,
       cast(count(*) FILTER (WHERE c_custkey % 10 IN (4, 5)) AS bigint) AS failed FROM customer
UNION ALL SELECT 'signup_date_iso', 'customers', count(*), count(*) FILTER (WHERE c_custkey % 10 IN (3, 6)) FROM customer
UNION ALL SELECT 'required_present', 'products', count(*), count(*) FILTER (WHERE p_partkey % 10 = 4) FROM part
UNION ALL SELECT 'price_positive', 'products', count(*), count(*) FILTER (WHERE p_partkey % 10 IN (2, 6)) FROM part
UNION ALL SELECT 'required_present', 'events', count(*), count(*) FILTER (WHERE m IN (1, 2, 5, 8, 16, 22, 23, 24)) FROM dm
UNION ALL SELECT 'event_type_domain', 'events', count(*),
       count(*) FILTER (WHERE m IN (6, 7, 24) OR et NOT IN ('view', 'add_to_cart', 'purchase')) FROM dm
UNION ALL SELECT 'quantity_positive', 'events', count(*),
       count(*) FILTER (WHERE m IN (11, 13, 15, 16, 18, 24) OR (m <> 14 AND q <= 0)) FROM dm
UNION ALL SELECT 'timestamp_iso', 'events', count(*), count(*) FILTER (WHERE m IN (8, 9, 24)) FROM dm"""
    q["gated_gold"] = gold_sql("country")
    # ---- layered runs and I/O
    q["medallion_gold"] = gold_sql("country")
    q["medallion_table_counts"] = f"""WITH {EV}
SELECT 'bronze_customers' AS table_name, cast(count(*) AS bigint) AS rows FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'bronze_products', count(*) FROM part
UNION ALL SELECT 'bronze_events', count(*) FROM events
UNION ALL SELECT 'silver_customers', count(DISTINCT c_custkey) FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'silver_products', count(DISTINCT p_partkey) FROM part WHERE p_retailprice IS NOT NULL
UNION ALL SELECT 'silver_events', count(DISTINCT event_id) FROM sev"""
    q["enriched_gold"] = summary_sql("customer_country")
    q["incremental_gold"] = summary_sql("customer_country")
    contract = f"""WITH {EV}, {CUST}, {PROD}
SELECT cast(product_id AS varchar) AS product_id, product_name, category,
       cast(count(event_id) AS bigint) AS purchase_count, cast(sum(quantity) AS bigint) AS units_sold,
       cast(round(sum(quantity * price), 2) AS double) AS revenue
FROM sev JOIN cust USING (customer_id) JOIN prod USING (product_id)
WHERE event_type = 'PURCHASE'
GROUP BY product_id, product_name, category"""
    q["gold_contract"] = contract
    q["external_gold_query"] = contract + "\nORDER BY revenue DESC, product_id"
    text_events = """SELECT cast(event_id AS varchar) AS event_id, cast(user_id AS varchar) AS customer_id,
       json_extract_string(props, '$.k') AS product_id, event_type,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp, cast(floor(value) AS bigint) AS quantity
FROM events"""
    q["scan_json_array"] = text_events
    q["scan_json_array_split"] = text_events
    q["scan_jsonl"] = text_events
    q["scan_csv"] = """SELECT cast(c_custkey AS varchar) AS customer_id, c_name AS name, n_name AS country,
       strftime(DATE '2026-01-01' + CAST(c_custkey % 90 AS INTEGER), '%Y-%m-%d') AS signup_date
FROM customer JOIN nation ON c_nationkey = n_nationkey"""
    q["roundtrip_csv"] = """SELECT cast(p_partkey AS varchar) AS product_id, p_name AS product_name,
       p_type AS category, cast(p_retailprice AS varchar) AS price FROM part"""
    q["roundtrip_json"] = gold_sql("country")
    q["roundtrip_parquet"] = f"""WITH {EV}
SELECT event_id, customer_id, product_id, event_type,
       strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS event_ts, quantity FROM sev"""
    lines = """l AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber) AS event_id, o_custkey AS customer_id,
         l_partkey AS product_id, cast(l_quantity AS int) AS quantity, l_shipdate, l_suppkey, l_returnflag,
         row_number() OVER (PARTITION BY concat_ws('-', l_orderkey, l_linenumber)
                            ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
    q["existing_ids"] = f"""WITH {lines}
SELECT DISTINCT event_id FROM l WHERE rn = 1 AND l_shipdate < TIMESTAMP '1998-06-01'"""
    q["new_events_only"] = f"""WITH {lines}
SELECT event_id, customer_id, product_id, quantity FROM l
WHERE rn = 1 AND event_id NOT IN (SELECT event_id FROM l WHERE rn = 1 AND l_shipdate < TIMESTAMP '1998-06-01')"""
    # ---- streaming
    bronze_l = f"""WITH {lines}
SELECT event_id, cast(customer_id AS varchar) AS customer_id, cast(product_id AS varchar) AS product_id,
       cast(quantity AS bigint) AS quantity
FROM l WHERE rn = 1"""
    q["stream_bronze"] = bronze_l
    q["stream_replay"] = bronze_l
    q["stream_resume"] = bronze_l
    q["stream_limit"] = """WITH l AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber) AS event_id, cast(o_custkey AS varchar) AS customer_id,
         cast(l_partkey AS varchar) AS product_id, cast(l_quantity AS bigint) AS quantity, l_shipdate, l_partkey, l_suppkey, l_returnflag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
taken AS (SELECT * FROM l ORDER BY l_shipdate, l_partkey, l_suppkey, customer_id, event_id, l_returnflag, quantity LIMIT 2500)
SELECT event_id, customer_id, product_id, quantity FROM taken
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY l_shipdate, l_partkey, l_suppkey) = 1"""
    q["publish_order"] = """SELECT cast(user_id AS varchar) AS key,
       cast(('0x' || substr(md5(cast(user_id AS varchar)), 1, 8))::bigint % 8 AS int) AS partition,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sequence, event_id
FROM events"""
    q["stream_rejects"] = q["rejected_events"]
    q["stream_quality"] = q["ingest_quality"]
    q["publish_payload"] = """SELECT cast(user_id AS varchar) AS key, cast(event_id AS varchar) AS event_id,
       cast(user_id AS varchar) AS customer_id, json_extract_string(props, '$.k') AS product_id, event_type,
       cast(floor(value) AS int) AS quantity
FROM events"""
    # ---- gold over order-line events (dedup first)
    for key, kind in (("l_gold_sales_by_country", "country"), ("l_gold_top_products", "products")):
        keys = GOLD_KEYS[kind]
        q[key] = f"""WITH {lines}, {CUST}, {PROD},
sl AS (SELECT * FROM l WHERE rn = 1 AND l_returnflag = 'N' AND quantity > 0)
SELECT {keys}, {MEASURES}
FROM sl JOIN cust USING (customer_id) JOIN prod USING (product_id)
GROUP BY {keys}"""
    # ---- lineage: the file each row was read from
    q["with_lineage"] = "SELECT event_id, true AS from_parquet, true AS from_events FROM events"
    q["with_ingest_time"] = "SELECT count(*) AS rows, count(*) AS timed, cast(1 AS bigint) AS times FROM customer JOIN nation ON c_nationkey = n_nationkey"
    q["keyed_order"] = """SELECT cast(user_id AS varchar) AS key, count(*) AS n, cast(1 AS bigint) AS partitions,
       cast(0 AS bigint) AS inversions FROM events GROUP BY user_id"""
    q["gold_country_double"] = f"""WITH {EV}, {CUST}, {PROD}
SELECT country, count(event_id) AS purchase_count, cast(sum(quantity) AS bigint) AS units_sold,
       round(sum(cast(quantity * price AS double)), 2) AS revenue
FROM sev JOIN cust USING (customer_id) JOIN prod USING (product_id)
WHERE event_type = 'PURCHASE' GROUP BY country"""
    q["enriched_gold_dirty"] = f"""WITH {CUST}, {PROD},
lines AS (
  SELECT l_orderkey || '-' || l_linenumber AS event_id, o_custkey AS customer_id, l_partkey AS product_id,
         l_returnflag = 'N' AS sale, l_suppkey % 4 AS m,
         cast(l_quantity AS bigint) + CASE WHEN l_suppkey % 4 = 2 THEN 3000000000 ELSE 0 END AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY l_shipdate, l_partkey, l_suppkey) = 1)
SELECT country AS dimension, count(*) AS purchase_count, cast(sum(quantity) AS bigint) AS units_sold,
       cast(round(sum(cast(quantity * price AS decimal(32,2))), 2) AS double) AS revenue
FROM lines JOIN cust USING (customer_id) JOIN prod USING (product_id) WHERE sale AND m <> 3 GROUP BY country
UNION ALL SELECT 'kept channel', count(*), cast(0 AS bigint), 0.0::double FROM lines WHERE m = 1"""
    q["gated_pipeline"] = gold_sql("country")
    q["published_gold"] = f"SELECT *, cast(1 AS bigint) AS version FROM ({gold_sql('country')})"
    # ---- rows written per stage of a layered run
    q["run_stage_rows"] = f"""WITH {EV}, {CUST}, {PROD}
SELECT 'bronze_customers' AS stage, cast(count(*) AS bigint) AS rows FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'bronze_products', count(*) FROM part
UNION ALL SELECT 'bronze_events', count(*) FROM events
UNION ALL SELECT 'silver_customers', count(DISTINCT c_custkey) FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'silver_products', count(DISTINCT p_partkey) FROM part WHERE p_retailprice IS NOT NULL
UNION ALL SELECT 'silver_events', count(DISTINCT event_id) FROM sev
UNION ALL SELECT 'gold_sales_by_country', count(*) FROM ({gold_sql("country")})
UNION ALL SELECT 'gold_sales_by_category', count(*) FROM ({gold_sql("category")})
UNION ALL SELECT 'gold_top_products', count(*) FROM ({gold_sql("products")})"""
    return q
