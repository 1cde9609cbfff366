"""Fixture views over the test tables.

``order_lines`` maps the TPC-H-like ``lineitem ⋈ orders`` onto the canonical
order shape; ``cdc_base`` / ``cdc_raw`` / ``envelope_raw`` / ``flat_raw`` turn
``events`` into change-event streams in the three wire shapes with known,
rule-based dirt, so the decoders' accept and reject counts are predictable.
Everything is a lazy DataFrame over the given tables; nothing is made up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.session import scratch_path
from changeflow.sources.tables import read_table

# Fixed values of the fixture (see FIXTURES.md): the seconds-of-day hash that
# gives each line a time of day, and the status mapping.
_SECOND_OF_DAY = "cast((l_orderkey * 7919 + l_linenumber * 131 + l_partkey * 17) % 86400 as int)"
_STATUS = ("case when l_returnflag = 'R' then 'cancelled' when o_orderstatus = 'P' then 'pending' "
           "when o_orderstatus = 'O' then 'confirmed' when l_linestatus = 'F' then 'delivered' "
           "else 'shipped' end")


# Declared columns of the given tables, so that no job reads footers to infer them.
_LINEITEM = ("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double, l_extendedprice double, "
             "l_returnflag string, l_linestatus string")
_ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderstatus string"
_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events(spark: SparkSession, base_dir: str) -> DataFrame:
    """The ``events`` table with its declared columns."""
    return read_table(spark, base_dir, "events", _EVENTS)


def events_wide(spark: SparkSession, base_dir: str) -> DataFrame:
    """``events`` with some values that do not fit a narrow decimal: 5e10 when event_id % 103 = 0, else 1e30,
    more than 28 digits, when % 107 = 0."""
    large = F.expr("case when event_id % 103 = 0 then 5e10 when event_id % 107 = 0 then 1e30 else value end")
    return events(spark, base_dir).withColumn("value", large)


def order_lines(spark: SparkSession, base_dir: str) -> DataFrame:
    """Canonical orders (id, customer_id, product_id, quantity, price, order_date, status) and ``order_day``.

    One row per line item. ``id`` is not unique in the test data, so no
    operator keys on it. The join is an equi-join on the order key; Spark
    plans it as a sort-merge (or broadcast when ``orders`` is small enough at
    runtime, decided by AQE from real sizes). ``order_day`` is the order's own
    date column, so the window helpers' bound on it reaches the scan of ``orders``.
    """
    li = read_table(spark, base_dir, "lineitem", _LINEITEM)
    od = read_table(spark, base_dir, "orders", _ORDERS)
    joined = li.join(od, li.l_orderkey == od.o_orderkey)
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        (F.col("o_orderdate") + F.expr(f"make_dt_interval(0, 0, 0, {_SECOND_OF_DAY})")).alias("order_date"),
        F.expr(_STATUS).alias("status"),
        F.col("o_orderdate").alias("order_day"),
    )


def latest_order_time(spark: SparkSession, base_dir: str, days: int = 30) -> str:
    """The newest ``order_date`` as text, for reports that are anchored at the data.

    The newest day comes from ``orders`` alone; only its last ``days`` days are then joined with the
    line items. All days are, if none of those orders has a line.
    """
    newest = read_table(spark, base_dir, "orders", _ORDERS).agg(F.max("o_orderdate")).first()[0]
    lines = order_lines(spark, base_dir)
    recent = lines.where(F.col("order_day") >= F.date_sub(F.to_date(F.lit(str(newest))), days))
    last = recent.agg(F.max("order_date")).first()[0] or lines.agg(F.max("order_date")).first()[0]
    return str(last) if last is not None else "1970-01-01 00:00:00"


def stored_order_lines(spark: SparkSession, base_dir: str) -> DataFrame:
    """``order_lines`` written once in day order and read back, for reports of many passes: no pass repeats the
    join, and file statistics prune the windowed ones to their days."""
    path = scratch_path(spark, "order-lines")
    order_lines(spark, base_dir).repartitionByRange("order_day").sortWithinPartitions("order_day").write.parquet(path)
    return spark.read.parquet(path)


def cdc_base(spark: SparkSession, base_dir: str) -> DataFrame:
    """``events`` plus the change-event attributes derived from it, dealt by event as a topic deals its messages."""
    return events(spark, base_dir).repartition("event_id").select(
        "*",
        (F.col("event_id") % 200).alias("id"),
        (F.col("event_id") % 5 + 1).cast("int").alias("quantity"),
        F.concat(F.lit("PROD"), F.lpad((F.col("event_id") % 50).cast("string"), 3, "0")).alias("product_id"),
        F.expr("case event_type when 'signup' then 'c' when 'view' then 'u' when 'click' then 'u' "
               "when 'purchase' then 'r' else 'd' end").alias("op"),
        F.expr("case event_id % 5 when 0 then 'pending' when 1 then 'confirmed' when 2 then 'shipped' "
               "when 3 then 'delivered' else 'cancelled' end").alias("status"),
    )


# Dirt injected by event_id (fixed rules, first match wins for whole-row cases).
_PAYLOAD_JSON = """case
  when event_id % 97 = 0 then 'invalid json'
  when event_id % 71 = 0 then concat('{"op":"', op, '"}')
  else concat('{"payload":{"op":"', case when event_id % 73 = 0 then 'x' else op end,
    '","', case when op = 'd' then 'before' else 'after' end, '":{"id":', cast(id as string),
    case when event_id % 89 = 0 then '' else concat(',"customer_id":', cast(user_id as string)) end,
    ',"product_id":"', product_id,
    '","quantity":', case when event_id % 79 = 0 then '"x"' when event_id % 101 = 0 then '3000000000'
                          else cast(quantity as string) end,
    ',"price":', case when event_id % 83 = 0 then '"invalid"' when event_id % 67 = 0 then 'null'
                      when event_id % 101 = 0 then '0' else cast(value as string) end,
    ',"status":"', status, '"',
    case when event_id % 10 = 0 then concat(',"note":"k', cast(event_id % 7 as string), '"') else '' end,
    case when event_id % 9 = 0 then ',"coupon":null' else '' end, '}}}') end"""


def cdc_raw(spark: SparkSession, base_dir: str) -> DataFrame:
    """Payload-wrapped change events as JSON text: (event_id, ts, value)."""
    return cdc_base(spark, base_dir).select("event_id", "ts", F.expr(_PAYLOAD_JSON).alias("value"))


# Envelope shape: base64 4-byte two's-complement amount (negated when
# event_id % 13 = 0, 9 bytes wide with 2^64 added when event_id % 59 = 0),
# epoch-micro created_at when event_id % 11 = 0, a 64-bit lsn, and dirt: %97
# malformed, %71 empty object, %73 op 'x', %67 no image, %83 an id that is text.
_ENVELOPE_JSON = """case
  when event_id % 97 = 0 then 'invalid json'
  when event_id % 71 = 0 then '{}'
  else replace(to_json(named_struct(
    'before', case when event_id % 67 = 0 then null when op = 'd' or op = 'u' then image end,
    'after', case when event_id % 67 = 0 or op = 'd' then null else image end,
    'source', named_struct('version', '2.4.0', 'connector', 'postgresql', 'name', 'orders_db',
        'ts_ms', cast(unix_millis(cast(ts as timestamp)) as string),
        'snapshot', case when op = 'r' then 'true' else 'false' end,
        'db', 'orders_db', 'sequence', null, 'schema', 'public', 'table', 'orders',
        'txId', 1000 + event_id, 'lsn', event_id * 4294967296 + 17),
    'op', case when event_id % 73 = 0 then 'x' else op end,
    'ts_ms', cast(unix_millis(cast(ts as timestamp)) as string),
    'transaction', null)),
    case when event_id % 83 = 0 then concat('"id":', cast(id as string), ',') else '"' end,
    case when event_id % 83 = 0 then '"id":"x",' else '"' end) end"""

_ENVELOPE_IMAGE = """named_struct(
    'id', id,
    'customer_name', concat('Customer#', lpad(cast(user_id as string), 9, '0')),
    'customer_email', concat('customer', cast(user_id as string), '@example.com'),
    'total_amount', base64(unhex(case when event_id % 59 = 0
        then concat('01', lpad(hex(cast(round(value * 100) as bigint)), 16, '0'))
        else lpad(hex(pmod(cast(round(value * 100) as bigint) * case when event_id % 13 = 0 then -1 else 1 end,
                           4294967296)), 8, '0') end)),
    'status', status,
    'created_at', case when event_id % 11 = 0 then cast(unix_micros(cast(ts as timestamp)) as string)
                       else date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") end,
    'updated_at', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))"""


def envelope_raw(spark: SparkSession, base_dir: str) -> DataFrame:
    """Envelope change events as JSON text: (event_id, ts, value)."""
    base = cdc_base(spark, base_dir).withColumn("image", F.expr(_ENVELOPE_IMAGE))
    return base.select("event_id", "ts", F.expr(_ENVELOPE_JSON).alias("value"))


def envelope_log_raw(spark: SparkSession, base_dir: str) -> DataFrame:
    """The envelope events with log positions that differ from the order they arrive in.

    A snapshot row (op ``r``) was read at half of its event's number, so it arrives long after changes that it does
    not know of; all others are at their own. ``lsn`` = that number * 2^32 + 17.
    """
    at = F.expr("case when op = 'r' then event_id div 2 else event_id end * 4294967296 + 17")
    base = cdc_base(spark, base_dir).withColumn("image", F.expr(_ENVELOPE_IMAGE)).withColumn("at", at)
    json = _ENVELOPE_JSON.replace("event_id * 4294967296 + 17", "at")
    return base.select("event_id", "ts", F.expr(json).alias("value"))


# Flat (unwrapped) shape: tombstone (NULL value) when event_id % 61 = 0,
# malformed when %97 = 0; customer_id key missing when %89 = 0, unit_price key
# missing when %83 = 0 and JSON null when %67 = 0; operation key missing when
# %59 = 0 and JSON null when %53 = 0; timestamp JSON null when %47 = 0 and present,
# a day before the event, when %4 = 0; an unknown key when %10 = 0; rewritten
# deletes carry __deleted = 'true'; a quantity and a price whose product does not fit the fact table when %103 = 0.
_FLAT_JSON = """case
  when event_id % 61 = 0 then null
  when event_id % 97 = 0 then 'invalid json'
  else concat('{"order_id":', cast(id as string),
    case when event_id % 89 = 0 then '' else concat(',"customer_id":', cast(user_id as string)) end,
    ',"product_name":"', product_id, '","quantity":', cast(case when event_id % 103 = 0 then 2000000000 else quantity end as string),
    case when event_id % 83 = 0 then '' when event_id % 67 = 0 then ',"unit_price":null'
         when event_id % 103 = 0 then ',"unit_price":99999999.99' else concat(',"unit_price":', cast(value as string)) end,
    ',"order_date":"', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), '","status":"', status,
    '"', case when event_id % 59 = 0 then '' when event_id % 53 = 0 then ',"operation":null' else concat(',"operation":"',
        case op when 'c' then 'INSERT' when 'u' then 'UPDATE' when 'd' then 'DELETE' else 'READ' end, '"') end,
    case when event_id % 47 = 0 then ',"timestamp":null' when event_id % 4 = 0
         then concat(',"timestamp":"', date_format(ts - interval 1 day, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), '"') else '' end,
    case when event_id % 10 = 0 then concat(',"note":"k', cast(event_id % 7 as string), '"') else '' end,
    ',"__op":"', op, '","__deleted":"', case when op = 'd' then 'true' else 'false' end, '"}') end"""


def flat_raw(spark: SparkSession, base_dir: str) -> DataFrame:
    """Unwrapped change events as JSON text: (event_id, ts, value)."""
    return cdc_base(spark, base_dir).select("event_id", "ts", F.expr(_FLAT_JSON).alias("value"))
