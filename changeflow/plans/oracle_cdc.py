"""DuckDB oracles for the change-event queries.

Expected results come from ``events`` columns and the fixed injection rules
(FIXTURES.md §3), not from parsing the JSON text the Spark side parses.
"""

CDC_BASE = """cdc_base AS (
  SELECT *, event_id % 200 AS id, cast(1 + event_id % 5 AS integer) AS quantity,
         'PROD' || lpad(cast(event_id % 50 AS varchar), 3, '0') AS product_id,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'u' WHEN 'click' THEN 'u'
                         WHEN 'purchase' THEN 'r' ELSE 'd' END AS op,
         CASE event_id % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'confirmed' WHEN 2 THEN 'shipped'
                           WHEN 3 THEN 'delivered' ELSE 'cancelled' END AS status
  FROM events)"""

# The payload text exactly as the fixture writes it (used for dead letters).
PAYLOAD_TEXT = """CASE
  WHEN event_id % 97 = 0 THEN 'invalid json'
  WHEN event_id % 71 = 0 THEN '{"op":"' || op || '"}'
  ELSE '{"payload":{"op":"' || CASE WHEN event_id % 73 = 0 THEN 'x' ELSE op END
    || '","' || CASE WHEN op = 'd' THEN 'before' ELSE 'after' END || '":{"id":' || cast(id AS varchar)
    || CASE WHEN event_id % 89 = 0 THEN '' ELSE ',"customer_id":' || cast(user_id AS varchar) END
    || ',"product_id":"' || product_id
    || '","quantity":' || CASE WHEN event_id % 79 = 0 THEN '"x"' WHEN event_id % 101 = 0 THEN '3000000000'
                               ELSE cast(quantity AS varchar) END
    || ',"price":' || CASE WHEN event_id % 83 = 0 THEN '"invalid"' WHEN event_id % 67 = 0 THEN 'null'
                           WHEN event_id % 101 = 0 THEN '0' ELSE cast(value AS varchar) END
    || ',"status":"' || status || '"' || CASE WHEN event_id % 10 = 0 THEN ',"note":"k' || (event_id % 7) || '"' ELSE '' END
    || CASE WHEN event_id % 9 = 0 THEN ',"coupon":null' ELSE '' END || '}}}' END"""

PAYLOAD = """payload AS (
  SELECT *,
    CASE WHEN event_id % 97 = 0 THEN 'malformed_json'
         WHEN event_id % 71 = 0 THEN 'no_payload'
         WHEN event_id % 73 = 0 OR op NOT IN ('c', 'u', 'd') THEN 'unsupported_op' END AS parse_reason,
    CASE WHEN event_id % 97 = 0 THEN 'malformed_json'
         WHEN event_id % 71 = 0 THEN 'no_payload'
         WHEN event_id % 73 = 0 OR op NOT IN ('c', 'u', 'd') THEN 'unsupported_op'
         WHEN event_id % 89 = 0 THEN 'missing_field:customer_id' END AS reject_reason,
    CASE WHEN event_id % 83 = 0 OR event_id % 67 = 0 OR event_id % 101 = 0 THEN 0.0 ELSE value END AS price_c,
    cast(CASE WHEN event_id % 79 = 0 THEN 1 WHEN event_id % 101 = 0 THEN 3000000000 ELSE quantity END AS bigint) AS quantity_c
  FROM cdc_base)"""

# Envelope: whole-row dirt %97 (malformed) and %71 ('{}') read as all-NULL; %67 has no
# record image and %83 no readable id.
ENVELOPE = """env AS (
  SELECT event_id, ts, user_id, status, value, op AS base_op,
    CASE WHEN event_id % 83 <> 0 THEN id END AS id,
    event_id % 97 = 0 OR event_id % 71 = 0 AS unreadable,
    event_id % 67 = 0 AS no_image,
    CASE WHEN event_id % 97 = 0 OR event_id % 71 = 0 THEN NULL
         WHEN event_id % 73 = 0 THEN 'x' ELSE op END AS op_out
  FROM cdc_base),
env1 AS (
  SELECT *,
    CASE WHEN unreadable OR no_image THEN NULL
         WHEN op_out IN ('c', 'u', 'r') THEN (CASE WHEN base_op <> 'd' THEN 1 END)
         ELSE (CASE WHEN base_op IN ('d', 'u') THEN 1 END) END AS has_image,
    CASE WHEN unreadable THEN NULL ELSE CASE op_out WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE'
         WHEN 'd' THEN 'DELETE' WHEN 'r' THEN 'SNAPSHOT' END END AS label
  FROM env),
env2 AS (
  SELECT *, CASE WHEN unreadable THEN 'unreadable' WHEN op_out NOT IN ('c', 'u', 'd', 'r') THEN 'unsupported_op'
                 WHEN has_image IS NULL THEN 'empty_image' WHEN id IS NULL THEN 'null_key' END AS reject_reason
  FROM env1)"""


def _w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def payload_parse() -> str:
    return _w(CDC_BASE, PAYLOAD) + """
SELECT event_id, op AS _cdc_operation, op = 'd' AS _deleted, ts AS _cdc_timestamp
FROM payload WHERE parse_reason IS NULL"""


def payload_rejects() -> str:
    return _w(CDC_BASE, PAYLOAD) + """
SELECT event_id, parse_reason AS reject_reason FROM payload WHERE parse_reason IS NOT NULL"""


def required_fields() -> str:
    return _w(CDC_BASE, PAYLOAD) + """
SELECT event_id, id, user_id AS customer_id, product_id FROM payload WHERE reject_reason IS NULL"""


def coerce() -> str:
    return _w(CDC_BASE, PAYLOAD) + """
SELECT event_id, price_c AS price, quantity_c AS quantity FROM payload WHERE reject_reason IS NULL"""


def enrich() -> str:
    return _w(CDC_BASE, PAYLOAD) + """
SELECT event_id, id, user_id AS customer_id, product_id, quantity_c AS quantity, price_c AS price,
       cast(NULL AS varchar) AS order_date, status, price_c * quantity_c AS total_amount,
       op = 'd' AS _deleted, op AS _cdc_operation, true AS _processed, '1.0.0' AS _pipeline_version
FROM payload WHERE reject_reason IS NULL"""


def dead_letter() -> str:
    return _w(CDC_BASE, PAYLOAD) + f"""
SELECT event_id, reject_reason, {PAYLOAD_TEXT} AS value FROM payload WHERE reject_reason IS NOT NULL"""


def quality_report() -> str:
    return _w(CDC_BASE, PAYLOAD) + """
SELECT coalesce(reject_reason, 'accepted') AS outcome, count(*) AS events,
       cast(count(*) AS double) / cast(sum(count(*)) OVER () AS double) AS share
FROM payload GROUP BY 1"""


def consume_bounded(n: int = 100) -> str:
    return _w(CDC_BASE, PAYLOAD) + f"""
SELECT event_id, id, user_id AS customer_id, product_id, quantity_c AS quantity, price_c AS price,
       price_c * quantity_c AS total_amount
FROM payload WHERE reject_reason IS NULL ORDER BY event_id LIMIT {int(n)}"""


def envelope_parse() -> str:
    return _w(CDC_BASE, ENVELOPE) + """
SELECT event_id, op_out AS op,
       CASE WHEN NOT unreadable THEN cast(epoch_us(ts) // 1000 AS varchar) END AS ts_ms,
       CASE WHEN NOT unreadable THEN 'orders' END AS source_table,
       CASE WHEN NOT unreadable THEN 'orders_db' END AS source_db,
       CASE WHEN NOT unreadable THEN event_id * 4294967296 + 17 END AS source_lsn,
       CASE WHEN NOT unreadable THEN 1000 + event_id END AS source_txid,
       CASE WHEN NOT unreadable AND NOT no_image AND base_op IN ('d', 'u') THEN id END AS before_id,
       CASE WHEN NOT unreadable AND NOT no_image AND base_op <> 'd' THEN id END AS after_id, reject_reason
FROM env2"""


def change_type() -> str:
    return _w(CDC_BASE, ENVELOPE) + "SELECT event_id, coalesce(label, 'UNKNOWN') AS change_type FROM env2"


def _amount_b64() -> str:
    return ("to_base64(from_hex(CASE WHEN event_id % 59 = 0 THEN '01' || lpad(hex(cast(round(value * 100) AS bigint)), 16, '0') "
            "ELSE lpad(hex(((cast(round(value * 100) AS bigint) * CASE WHEN event_id % 13 = 0 THEN -1 ELSE 1 END) "
            "% 4294967296 + 4294967296) % 4294967296), 8, '0') END))")


def _amount() -> str:
    wide = "cast(cast(18446744073709551616 AS hugeint) + cast(round(value * 100) AS bigint) AS decimal(36,0)) * cast(0.01 AS decimal(2,2))"
    return (f"CASE WHEN event_id % 59 = 0 THEN cast({wide} AS decimal(38,2)) "
            "ELSE cast(CASE WHEN event_id % 13 = 0 THEN -value ELSE value END AS decimal(38,2)) END")


def record_image() -> str:
    return _w(CDC_BASE, ENVELOPE) + """
SELECT event_id, coalesce(label, 'UNKNOWN') AS change_type,
       CASE WHEN has_image = 1 THEN id END AS order_id,
       CASE WHEN has_image = 1 THEN status END AS status
FROM env2"""


def flatten() -> str:
    return _w(CDC_BASE, ENVELOPE) + f"""
SELECT event_id, op_out AS operation,
       CASE WHEN NOT unreadable THEN 'orders' END AS source_table,
       CASE WHEN NOT unreadable THEN 'orders_db' END AS source_database,
       CASE WHEN NOT unreadable THEN cast(epoch_us(ts) // 1000 AS varchar) END AS event_timestamp,
       coalesce(label, 'UNKNOWN') AS change_type,
       CASE WHEN has_image = 1 THEN id END AS order_id,
       CASE WHEN has_image = 1 THEN 'Customer#' || lpad(cast(user_id AS varchar), 9, '0') END AS customer_name,
       CASE WHEN has_image = 1 THEN 'customer' || cast(user_id AS varchar) || '@example.com' END AS customer_email,
       CASE WHEN has_image = 1 THEN {_amount_b64()} END AS total_amount_encoded,
       CASE WHEN has_image = 1 THEN status END AS status,
       CASE WHEN has_image = 1 THEN ts END AS order_created_at,
       CASE WHEN has_image = 1 THEN ts END AS order_updated_at,
       CASE WHEN has_image = 1 THEN {_amount()} END AS total_amount, reject_reason
FROM env2"""


def decode_amount() -> str:
    return _w(CDC_BASE, ENVELOPE) + f"""
SELECT event_id, {_amount_b64()} AS total_amount_encoded, {_amount()} AS total_amount
FROM env2 WHERE has_image = 1"""


def snapshot_rows() -> str:
    return _w(CDC_BASE, ENVELOPE) + f"""
SELECT event_id, CASE WHEN has_image = 1 THEN id END AS order_id, CASE WHEN has_image = 1 THEN status END AS status,
       CASE WHEN has_image = 1 THEN {_amount()} END AS total_amount
FROM env2 WHERE label = 'SNAPSHOT'"""


def warehouse_append() -> str:
    return _w(CDC_BASE, ENVELOPE) + f"""
SELECT event_id, op_out AS operation, label AS change_type, id AS order_id, status,
       {_amount()} AS total_amount, ts AS order_updated_at
FROM env2 WHERE reject_reason IS NULL"""


def current_state() -> str:
    return _w(CDC_BASE, ENVELOPE) + f"""
, latest AS (
  SELECT id, arg_max(event_id, event_id) AS last_event_id FROM env2 WHERE reject_reason IS NULL GROUP BY id)
SELECT e.id AS order_id, 'Customer#' || lpad(cast(e.user_id AS varchar), 9, '0') AS customer_name,
       e.status, e.amount AS total_amount, e.ts AS order_updated_at, e.event_id AS last_event_id
FROM latest l JOIN (SELECT *, {_amount()} AS amount FROM env2) e ON e.event_id = l.last_event_id
WHERE e.op_out <> 'd'"""


def state_by_position() -> str:
    return _w(CDC_BASE, ENVELOPE) + f"""
, placed AS (SELECT *, (CASE WHEN base_op = 'r' THEN event_id // 2 ELSE event_id END) * 4294967296 + 17 AS log_lsn,
    base_op <> 'r' AND op_out <> 'r' AS log_change FROM env2 WHERE reject_reason IS NULL),
newest AS (SELECT * FROM placed QUALIFY row_number() OVER (PARTITION BY id ORDER BY log_lsn DESC, log_change DESC, event_id DESC) = 1)
SELECT id AS order_id, 'Customer#' || lpad(cast(user_id AS varchar), 9, '0') AS customer_name, status,
       {_amount()} AS total_amount, label AS change_type, cast(log_lsn AS bigint) AS log_lsn, event_id
FROM newest WHERE op_out <> 'd'"""


def dedup() -> str:
    return _w(CDC_BASE) + "SELECT event_id, ts FROM cdc_base"


FLAT = """flat AS (
  SELECT event_id, ts,
    event_id % 97 = 0 AS malformed,
    CASE WHEN event_id % 97 <> 0 THEN cast(id AS integer) END AS order_id,
    CASE WHEN event_id % 97 <> 0 AND event_id % 89 <> 0 THEN cast(user_id AS integer) END AS customer_id,
    CASE WHEN event_id % 97 <> 0 THEN product_id END AS product_name,
    CASE WHEN event_id % 97 <> 0 THEN CASE WHEN event_id % 103 = 0 THEN cast(2000000000 AS integer) ELSE quantity END END AS quantity,
    CASE WHEN event_id % 97 <> 0 AND event_id % 83 <> 0 AND event_id % 67 <> 0
         THEN CASE WHEN event_id % 103 = 0 THEN 99999999.99::decimal(10,2) ELSE cast(value AS decimal(10,2)) END END AS unit_price,
    event_id % 97 <> 0 AND event_id % 83 <> 0 AS unit_price_present,
    CASE WHEN event_id % 97 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS order_date,
    CASE WHEN event_id % 97 <> 0 THEN status END AS status,
    CASE WHEN event_id % 97 <> 0 AND event_id % 59 <> 0 AND event_id % 53 <> 0
         THEN CASE op WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' ELSE 'READ' END END AS operation,
    event_id % 97 <> 0 AND event_id % 59 <> 0 AS operation_present,
    event_id % 97 <> 0 AND (event_id % 47 = 0 OR event_id % 4 = 0) AS timestamp_present,
    CASE WHEN event_id % 97 <> 0 AND event_id % 47 <> 0 AND event_id % 4 = 0 THEN ts - INTERVAL 1 DAY END AS record_time,
    CASE WHEN event_id % 97 = 0 THEN 'c' ELSE op END AS op, value, id, user_id
  FROM cdc_base WHERE event_id % 61 <> 0)"""


def flat_parse() -> str:
    return _w(CDC_BASE, FLAT) + """
SELECT event_id, order_id, customer_id, product_name, quantity, unit_price, order_date, status, operation, op,
       CASE op WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' WHEN 'r' THEN 'SNAPSHOT'
               ELSE 'UNKNOWN' END AS change_type,
       CASE WHEN malformed THEN 'malformed_json' END AS reject_reason
FROM flat"""


LOADED = """loaded AS (
  SELECT event_id, order_id, customer_id, product_name, quantity,
    CASE WHEN unit_price_present THEN unit_price ELSE cast(0 AS decimal(10,2)) END AS unit_price,
    try_cast(cast(quantity AS decimal(18,0)) * CASE WHEN unit_price_present THEN unit_price ELSE 0 END AS decimal(12,2)) AS total_amount,
    cast(order_date AS timestamp) AS order_date, status,
    CASE WHEN operation_present THEN operation ELSE 'INSERT' END AS event_type, ts AS processed_at,
    CASE WHEN timestamp_present THEN record_time ELSE ts END AS source_timestamp,
    CASE WHEN malformed THEN 'malformed_json'
         WHEN order_id IS NULL THEN 'null:order_id' WHEN customer_id IS NULL THEN 'null:customer_id'
         WHEN product_name IS NULL THEN 'null:product_name' WHEN quantity IS NULL THEN 'null:quantity'
         WHEN unit_price_present AND unit_price IS NULL THEN 'null:unit_price'
         WHEN operation_present AND operation IS NULL THEN 'null:event_type'
         WHEN timestamp_present AND record_time IS NULL THEN 'null:source_timestamp'
         WHEN event_id % 103 = 0 AND unit_price_present THEN 'out_of_range:total_amount' END AS reject_reason
  FROM flat)"""


def load_order_events() -> str:
    return _w(CDC_BASE, FLAT, LOADED) + """
SELECT event_id, order_id, customer_id, product_name, quantity, unit_price, total_amount, order_date, status,
       event_type, processed_at, source_timestamp
FROM loaded WHERE reject_reason IS NULL"""


def warehouse_compacted() -> str:
    return _w(CDC_BASE, FLAT, LOADED) + """
SELECT event_id, order_id, quantity, total_amount, status, event_type, cast(event_id % 3 AS bigint) AS batch_id,
       cast(processed_at AS date) AS processed_date
FROM loaded WHERE reject_reason IS NULL"""


def load_rejects() -> str:
    return _w(CDC_BASE, FLAT, LOADED) + "SELECT event_id, reject_reason FROM loaded WHERE reject_reason IS NOT NULL"


def daily_stats() -> str:
    return _w(CDC_BASE, FLAT, LOADED) + """
, ok AS (SELECT * FROM loaded WHERE reject_reason IS NULL),
d AS (SELECT cast(max(processed_at) AS date) AS day FROM ok)
SELECT (SELECT day FROM d) AS date, count(*) AS total_events, count(DISTINCT order_id) AS unique_orders,
       count(DISTINCT customer_id) AS unique_customers,
       coalesce(cast(sum(quantity * unit_price) AS double), 0.0) AS total_revenue
FROM ok WHERE processed_at >= cast((SELECT day FROM d) AS timestamp)
  AND processed_at < cast((SELECT day FROM d) + 1 AS timestamp)"""


def _trimmed(number: str) -> str:
    """A decimal number as text without trailing zeros."""
    return f"CASE WHEN contains({number}, '.') THEN rtrim(rtrim({number}, '0'), '.') ELSE {number} END"


def etl_message_format() -> str:
    """The record's keys in alphabetical order, absent ones left out and nulls kept."""
    ts = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
    op = "CASE op WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' ELSE 'INSERT' END"
    key = "coalesce(cast(order_id AS varchar), '')"
    opt = lambda cond, null, text: f"CASE WHEN {cond} THEN '' WHEN {null} THEN {text[0]} ELSE {text[1]} END"
    record = " || ".join([
        "'{\"__deleted\":\"' || CASE WHEN op = 'd' THEN 'true' ELSE 'false' END || '\",\"__op\":\"' || op || '\"'",
        "CASE WHEN customer_id IS NULL THEN '' ELSE ',\"customer_id\":' || customer_id END",
        "CASE WHEN event_id % 10 = 0 THEN ',\"note\":\"k' || (event_id % 7) || '\"' ELSE '' END",
        opt("NOT operation_present", "operation IS NULL", ("',\"operation\":null'", "',\"operation\":\"' || operation || '\"'")),
        "',\"order_date\":\"' || order_date || '\",\"order_id\":' || order_id || ',\"product_name\":\"' || product_name "
        "|| '\",\"quantity\":' || quantity || ',\"status\":\"' || status || '\"'",
        opt("NOT timestamp_present", "record_time IS NULL", ("',\"timestamp\":null'",
            "',\"timestamp\":\"' || strftime(record_time, '%Y-%m-%dT%H:%M:%S.%f') || '\"'")),
        opt("NOT unit_price_present", "event_id % 67 = 0", ("',\"unit_price\":null'",
            f"',\"unit_price\":' || {_trimmed("CASE WHEN event_id % 103 = 0 THEN '99999999.99' ELSE cast(value AS varchar) END")}")),
        "'}'"])
    value = (f"'{{\"topic\":\"cdc-events\",\"key\":\"' || {key} || '\",\"value\":' || {record} || ',\"timestamp\":\"' || {ts} "
             f"|| '\",\"source\":\"orders-db\",\"operation\":\"' || {op} || '\"}}'")
    return _w(CDC_BASE, FLAT) + f"""
SELECT event_id, 'cdc-events' AS topic, cast(order_id AS varchar) AS key, {value} AS value, {ts} AS timestamp,
       'orders-db' AS source, {op} AS operation
FROM flat WHERE NOT malformed"""


def json_out() -> str:
    """The record's own keys in alphabetical order, then the processed ones."""
    doc = ("""'{' || CASE WHEN event_id % 9 = 0 THEN '"coupon":null,' ELSE '' END"""
           """ || '"customer_id":' || user_id || ',"id":' || id"""
           """ || CASE WHEN event_id % 10 = 0 THEN ',"note":"k' || (event_id % 7) || '"' ELSE '' END"""
           """ || ',"product_id":"' || product_id || '","status":"' || status"""
           """ || '","price":' || cast(price_c AS varchar) || ',"quantity":' || cast(quantity_c AS varchar)"""
           """ || ',"total_amount":' || cast(price_c * quantity_c AS varchar)"""
           """ || ',"_cdc_operation":"' || op || '","_cdc_timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"""
           """ || '","_deleted":' || CASE WHEN op = 'd' THEN 'true' ELSE 'false' END"""
           """ || ',"_processed":true,"_pipeline_version":"1.0.0"}'""")
    return _w(CDC_BASE, PAYLOAD) + f"SELECT event_id, {doc} AS json FROM payload WHERE reject_reason IS NULL"


def record_image_reference() -> str:
    """Reference image choice: ``after`` only for c/u, so snapshots read ``before`` (absent)."""
    return _w(CDC_BASE, ENVELOPE) + """
SELECT event_id, coalesce(label, 'UNKNOWN') AS change_type,
       CASE WHEN NOT unreadable AND NOT no_image AND ((op_out IN ('c', 'u') AND base_op <> 'd')
                                     OR (op_out NOT IN ('c', 'u') AND base_op IN ('d', 'u'))) THEN id END AS order_id
FROM env2"""
