"""Fixed schemas: the canonical order shape and the three wire shapes of change events."""

from pyspark.sql.types import (
    DateType, DecimalType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampNTZType, TimestampType,
)

# Canonical order row: every decoder maps onto this and every analytics
# operator reads it.
ORDER = StructType([
    StructField("id", LongType()),
    StructField("customer_id", LongType()),
    StructField("product_id", StringType()),
    StructField("quantity", IntegerType()),
    StructField("price", DecimalType(12, 2)),
    StructField("order_date", TimestampNTZType()),
    StructField("status", StringType()),
])

# Warehouse tables: the writers cast to these and the DDL is made from them. NOT NULL
# marks what a row must have to be loaded.
ORDER_EVENT = StructType([
    StructField("event_id", LongType()),
    StructField("order_id", IntegerType(), False),
    StructField("customer_id", IntegerType(), False),
    StructField("product_name", StringType(), False),
    StructField("quantity", IntegerType(), False),
    StructField("unit_price", DecimalType(10, 2), False),
    StructField("total_amount", DecimalType(12, 2)),
    StructField("order_date", TimestampNTZType(), False),
    StructField("status", StringType(), False),
    StructField("event_type", StringType(), False),
    StructField("processed_at", TimestampType()),
    StructField("source_timestamp", TimestampNTZType(), False),
])
ORDER_EVENT_REQUIRED = tuple(f.name for f in ORDER_EVENT.fields if not f.nullable)

DIM_CUSTOMER = StructType([
    StructField("customer_id", LongType(), False),
    StructField("customer_name", StringType()),
    StructField("customer_email", StringType()),
    StructField("created_at", TimestampType()),
    StructField("updated_at", TimestampType()),
])

DAILY_ORDER_SUMMARY = StructType([
    StructField("total_orders", LongType(), False),
    StructField("total_revenue", DecimalType(15, 2), False),
    StructField("avg_order_value", DecimalType(10, 2), False),
    StructField("unique_customers", LongType(), False),
])

# Columns that the stored tables are partitioned by.
ORDER_EVENT_PARTITIONS = StructType([StructField("processed_date", DateType())])
DAILY_SUMMARY_PARTITIONS = StructType([StructField("summary_date", DateType())])

# Mergeable moments of a day's orders (see operators.moments).
MOMENTS = StructType([
    StructField("orders", LongType()), StructField("value_sum", DecimalType(38, 2)), StructField("value_m2", DoubleType()),
    StructField("quantity_sum", LongType()), StructField("quantity_m2", DoubleType()),
])

# Envelope wire shape (before/after/source/op/ts_ms). Timestamps are kept as
# strings because connectors emit either ISO text or epoch micros; txId and lsn
# are 64-bit in practice.
ENVELOPE_IMAGE = StructType([
    StructField("id", LongType()),
    StructField("customer_name", StringType()),
    StructField("customer_email", StringType()),
    StructField("total_amount", StringType()),   # base64 big-endian unscaled decimal
    StructField("status", StringType()),
    StructField("created_at", StringType()),
    StructField("updated_at", StringType()),
])
ENVELOPE_SOURCE = StructType([
    StructField("version", StringType()),
    StructField("connector", StringType()),
    StructField("name", StringType()),
    StructField("ts_ms", StringType()),
    StructField("snapshot", StringType()),
    StructField("db", StringType()),
    StructField("sequence", StringType()),
    StructField("schema", StringType()),
    StructField("table", StringType()),
    StructField("txId", LongType()),
    StructField("lsn", LongType()),
])
ENVELOPE = StructType([
    StructField("before", ENVELOPE_IMAGE),
    StructField("after", ENVELOPE_IMAGE),
    StructField("source", ENVELOPE_SOURCE),
    StructField("op", StringType()),
    StructField("ts_ms", StringType()),
    StructField("transaction", StringType()),
])
