"""Warehouse loading and warehouse-side reports.

``load_order_events`` is the set-based form of the reference's per-row insert:
one projection computes the fact row and the reason it would violate a NOT
NULL constraint, and :func:`accepted` / :func:`rejected` split on it. No row is
lost: a failing row lands in the rejects with its reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from changeflow.functions.cdc import parse_event_time
from changeflow.functions.time import resolve_as_of, same_day
from changeflow.operators.cdc import settle
from changeflow.schemas import (
    DAILY_ORDER_SUMMARY, DAILY_SUMMARY_PARTITIONS, DIM_CUSTOMER, ORDER, ORDER_EVENT, ORDER_EVENT_PARTITIONS,
    ORDER_EVENT_REQUIRED,
)
from changeflow.streaming.facts import ORIGIN, DayTableSink
from changeflow.streaming.sinks import MANUAL


def load_order_events(flat: DataFrame, processed_at: Column | None = None, epoch_unit: str = "micros") -> DataFrame:
    """Map decoded flat changes onto the ``order_events`` fact shape (K4, K5).

    Defaults are for a missing key only, a JSON null fails: ``unit_price`` → 0,
    ``operation`` → 'INSERT', the record's ``timestamp`` → the event's time.
    ``total_amount`` is the generated column quantity × unit_price; a product beyond
    its type is a reject (``out_of_range:total_amount``). ``epoch_unit`` is the unit of event times
    that are numbers. ``processed_at`` defaults to load time; backfills pass the event time.
    """
    unit_price = F.when(F.col("unit_price_present"), F.col("unit_price")).otherwise(
        F.lit(0).cast("decimal(10,2)"))
    row = flat.select(
        *[c for c in ("event_id",) if c in flat.columns],
        F.col("order_id"), F.col("customer_id"), F.col("product_name"), F.col("quantity"),
        unit_price.alias("unit_price"),
        (F.col("quantity") * unit_price).try_cast("decimal(12,2)").alias("total_amount"),
        parse_event_time(F.col("order_date"), epoch_unit).cast("timestamp_ntz").alias("order_date"),
        F.col("status"),
        F.when(F.col("operation_present"), F.col("operation")).otherwise("INSERT").alias("event_type"),
        (processed_at if processed_at is not None else F.current_timestamp()).alias("processed_at"),
        F.when(F.col("timestamp_present"), parse_event_time(F.col("timestamp"), epoch_unit).cast("timestamp_ntz"))
         .otherwise(F.coalesce(F.col("event_time").cast("timestamp_ntz"), F.localtimestamp())).alias("source_timestamp"),
        F.col("reject_reason").alias("_upstream_reason"),
    )
    check = None
    for c in ORDER_EVENT_REQUIRED:
        check = F.when(F.col(c).isNull(), f"null:{c}") if check is None else check.when(F.col(c).isNull(), f"null:{c}")
    check = check.when(F.col("total_amount").isNull(), "out_of_range:total_amount")
    return settle(row.withColumn("reject_reason", F.coalesce(F.col("_upstream_reason"), check))
                  .drop("_upstream_reason"))


def _fitted(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the columns and types of a warehouse table; columns it lacks are NULL."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


class OrderEventsSink(DayTableSink):
    """``foreachBatch`` handler adding the accepted rows of a batch to the ``order_events`` facts.

    See :mod:`changeflow.streaming.facts`: a replay replaces its batch even on another day, and
    :func:`compact_order_events` moves batches to the day partitions of the catalog table ``table``.
    """

    def __init__(self, path: str, table: str | None = None):
        super().__init__(path, ORDER_EVENT, "processed_at", "processed_date", table)

    def __call__(self, batch: DataFrame, batch_id: int, stream: str = MANUAL) -> None:
        super().__call__(_fitted(batch.where(F.col("reject_reason").isNull()), ORDER_EVENT), batch_id, stream)


def append_order_events(loaded: DataFrame, path: str, batch_id: int, stream: str = MANUAL,
                        table: str | None = None) -> None:
    """Append one batch of accepted fact rows; see :class:`OrderEventsSink`."""
    OrderEventsSink(path, table)(loaded, batch_id, stream)


def read_order_events(spark: SparkSession, path: str) -> DataFrame:
    """All fact rows, moved to their days or not, each once. A filter on ``processed_date`` prunes."""
    return OrderEventsSink(path).on(spark).read()


def compact_order_events(spark: SparkSession, path: str, table: str | None = None) -> dict[str, int]:
    """Move the finished batches to day partitions; the newest moved batch of each query."""
    return OrderEventsSink(path, table).on(spark).compact()


def write_daily_summary(summary: DataFrame, path: str) -> None:
    """Store ``daily_order_summary`` rows, replacing only the days present in
    ``summary`` (dynamic partition overwrite by ``summary_date``)."""
    schema = StructType([*DAILY_ORDER_SUMMARY.fields, *DAILY_SUMMARY_PARTITIONS.fields])
    (_fitted(summary, schema).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("summary_date").parquet(path))


def _day_measures() -> list[Column]:
    revenue = F.sum(F.col("quantity") * F.col("unit_price")).cast("double")
    return [F.count(F.lit(1)).alias("total_events"), F.count_distinct("order_id").alias("unique_orders"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.coalesce(revenue, F.lit(0.0)).alias("total_revenue")]


def daily_stats(order_events: DataFrame, day=None) -> DataFrame:
    """Events processed on ``day`` (default today; ``"latest"`` = newest day).

    On the stored table ``"latest"`` is found from the ``processed_date`` partitions, and only that
    day is read. Elsewhere all days are aggregated in one pass and the newest is kept, so
    the input is not computed twice.
    """
    stored = "processed_date" in order_events.columns           # partition column of the stored table
    if isinstance(day, str) and day == "latest" and not stored:
        days = order_events.groupBy(F.to_date("processed_at").alias("date")).agg(*_day_measures())
        row = F.struct("total_events", "unique_orders", "unique_customers", "total_revenue")
        newest = days.agg(F.max("date").alias("date"), F.max_by(row, F.col("date")).alias("r"))
        return newest.select("date", *[F.coalesce(F.col(f"r.{c}"), F.lit(0)).cast(t).alias(c) for c, t in (
            ("total_events", "bigint"), ("unique_orders", "bigint"), ("unique_customers", "bigint"),
            ("total_revenue", "double"))])
    anchor = resolve_as_of(order_events, day, ts_col="processed_at", day_col="processed_date")
    ts_type = order_events.schema["processed_at"].dataType.simpleString()
    today = order_events.where(same_day(F.col("processed_at"), anchor, ts_type))
    if stored:
        today = today.where(F.col("processed_date") == F.to_date(anchor))
    return today.agg(F.to_date(anchor).alias("date"), *_day_measures())


def dim_customers(customers: DataFrame, key: str = "customer_id", order_by: str | None = None) -> DataFrame:
    """Customer dimension: the latest record per customer.

    ``customers`` has (customer_id, customer_name, customer_email[, ts]); with
    ``order_by`` the newest version wins (``max_by``, combined map-side) and
    created_at/updated_at are the first/last change times.
    """
    name = F.col("customer_name")
    email = F.col("customer_email") if "customer_email" in customers.columns else F.lit(None).cast("string")
    if order_by is None:
        return customers.select(F.col(key).alias("customer_id"), name.alias("customer_name"),
                                email.alias("customer_email"),
                                F.lit(None).cast("timestamp").alias("created_at"),
                                F.lit(None).cast("timestamp").alias("updated_at"))
    o = F.col(order_by)
    return customers.groupBy(F.col(key).alias("customer_id")).agg(
        F.max_by(name, o).alias("customer_name"), F.max_by(email, o).alias("customer_email"),
        F.min(o).alias("created_at"), F.max(o).alias("updated_at"))


def orders_with_customer(orders: DataFrame, dim: DataFrame) -> DataFrame:
    """Fact rows with their customer attributes (J3), left join on customer_id.

    No broadcast hint: the dimension grows with the customer base, so Spark
    decides at runtime (AQE turns the sort-merge join into a broadcast join
    only when the measured dimension is under the broadcast threshold).
    """
    return orders.join(dim.select("customer_id", "customer_name", "customer_email"), "customer_id", "left")


def lifecycle_tiers(orders: DataFrame, as_of=None, hot_days: int = 30, warm_months: int = 6) -> DataFrame:
    """Add year/month partition columns and a hot / warm / cold tier (D3)."""
    anchor = resolve_as_of(orders, as_of)
    ts = F.col("order_date")
    tier = (F.when(ts >= F.date_sub(F.to_date(anchor), hot_days).cast("timestamp_ntz"), "hot")
            .when(ts >= F.add_months(F.to_date(anchor), -warm_months).cast("timestamp_ntz"), "warm")
            .otherwise("cold"))
    return orders.select("*", F.year(ts).alias("year"), F.month(ts).alias("month"), tier.alias("tier"))


def write_orders_by_day(orders: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store canonical orders partitioned by ``order_day``.

    The analytics window helpers add the matching ``order_day`` bound, so
    "last N days / minutes" reports read only those day folders; only the
    days present in the written data are replaced (dynamic overwrite).
    """
    (orders.withColumn("order_day", F.to_date("order_date"))
     .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("order_day").parquet(path))


def write_partitioned(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write by year/month with dynamic partition overwrite (only touched months
    are replaced), so date predicates prune whole folders on read."""
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy("year", "month").parquet(path))


# The warehouse tables (K9): columns and partition columns.
WAREHOUSE_TABLES = {
    "order_events": (StructType([*ORDER_EVENT.fields, *ORIGIN.fields]), ORDER_EVENT_PARTITIONS),
    "dim_customers": (DIM_CUSTOMER, StructType()),
    "daily_order_summary": (DAILY_ORDER_SUMMARY, DAILY_SUMMARY_PARTITIONS),
    "orders": (StructType([*ORDER.fields, StructField("created_at", TimestampType()),
                           StructField("updated_at", TimestampType())]), StructType()),
}


def table_ddl(name: str, db: str = "", location: str = "") -> str:
    """``CREATE TABLE IF NOT EXISTS`` of a warehouse table, made from its schema."""
    columns, partitions = WAREHOUSE_TABLES[name]
    cols = ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in [*columns.fields, *partitions.fields])
    by = f" PARTITIONED BY ({', '.join(partitions.names)})" if partitions.fields else ""
    return f"CREATE TABLE IF NOT EXISTS {db}{name} ({cols}) USING parquet{by}{location}"


def create_tables(spark, base_path: str | None = None, database: str | None = None) -> list[str]:
    """Create the warehouse tables if missing; returns the table names.

    With ``base_path`` each table lives in ``<base_path>/<name>`` (external);
    the fact table is partitioned by processing date, so daily reports prune.
    """
    db = f"{database}." if database else ""
    made = []
    for name in WAREHOUSE_TABLES:
        loc = f" LOCATION '{base_path.rstrip('/')}/{name}'" if base_path else ""
        spark.sql(table_ddl(name, db, loc))
        made.append(f"{db}{name}")
    return made
