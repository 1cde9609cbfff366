"""Time-window metrics over events (T8, T9), for batch tables and streams.

On a stream pass ``watermark`` (e.g. "10 minutes"): the time column is cast
to ``timestamp`` (watermarks reject ``timestamp_ntz``), late rows beyond the
watermark are dropped by Spark, and windows are emitted once closed (append
mode). A value that is no decimal of 28 digits (too large, NaN) does not fail the
job: it is left out of the sum and counted in ``unfit_values``. Distinct counts are exact in batch and HyperLogLog on streams (Spark
rejects exact distinct aggregates on streams).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _prepare(events: DataFrame, ts_col: str, watermark: str | None) -> DataFrame:
    if watermark is None:
        return events
    return events.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, watermark)


# Values are summed exactly in this type; a value that it can't hold is counted, not summed.
VALUE = "decimal(28,2)"


def _value(value_col: str) -> Column:
    return F.col(value_col).try_cast(VALUE)


def _unfit(value_col: str) -> Column:
    return F.count_if(F.col(value_col).isNotNull() & _value(value_col).isNull()).alias("unfit_values")


def _measures(events: DataFrame, value_col: str, user_col: str, distinct: str) -> list[Column]:
    exact = distinct == "exact" and not events.isStreaming
    users = F.count_distinct(user_col) if exact else F.approx_count_distinct(user_col)
    return [
        F.count(F.lit(1)).alias("events"),
        F.sum(_value(value_col)).cast("double").alias("total_value"),
        users.alias("unique_users"), _unfit(value_col),
    ]


def tumbling_metrics(events: DataFrame, duration: str = "5 minutes", *, ts_col: str = "ts",
                     key: str = "event_type", value_col: str = "value", user_col: str = "user_id",
                     watermark: str | None = None, distinct: str = "exact") -> DataFrame:
    """Per fixed window and key: events, Σ value, distinct users."""
    df = _prepare(events, ts_col, watermark)
    g = df.groupBy(F.window(F.col(ts_col), duration).alias("w"), key).agg(
        *_measures(df, value_col, user_col, distinct))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key,
                    "events", "total_value", "unique_users", "unfit_values")


def sliding_metrics(events: DataFrame, duration: str = "10 minutes", slide: str = "5 minutes", *,
                    ts_col: str = "ts", key: str = "event_type", value_col: str = "value",
                    user_col: str = "user_id", watermark: str | None = None,
                    distinct: str = "exact") -> DataFrame:
    """Per overlapping window (``duration`` every ``slide``) and key."""
    df = _prepare(events, ts_col, watermark)
    g = df.groupBy(F.window(F.col(ts_col), duration, slide).alias("w"), key).agg(
        *_measures(df, value_col, user_col, distinct))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key,
                    "events", "total_value", "unique_users", "unfit_values")


def session_metrics(events: DataFrame, gap: str = "30 minutes", *, ts_col: str = "ts", key: str = "user_id",
                    value_col: str = "value", watermark: str | None = None,
                    split_seconds: int = 3_600) -> DataFrame:
    """Activity sessions per key: a session ends after ``gap`` without events.

    Streams use ``session_window`` with a watermark (state kept by Spark).
    Batch is exact and skew-safe in two phases: sessions are first built
    per (key, ``split_seconds`` time slice), and the partial sessions, one row
    per piece, are then merged across slice borders with a running "starts a
    new session" flag. A key holding a third of all rows is spread over its
    slices; the rows of one key in one slice meet in one task, so a busier
    key wants a smaller slice. Phase 2 sees one row per partial session, and of a
    hot key only the two border pieces of each slice together.
    """
    if events.isStreaming:
        df = _prepare(events, ts_col, watermark)
        g = df.groupBy(F.session_window(F.col(ts_col), gap).alias("s"), key).agg(
            F.count(F.lit(1)).alias("events"),
            F.sum(_value(value_col)).cast("double").alias("total_value"), _unfit(value_col))
        return g.select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                        "events", "total_value", "unfit_values")
    gap_iv = F.expr(f"INTERVAL {gap}")
    slice_start = F.floor(F.unix_micros(F.col(ts_col).cast("timestamp")) / F.lit(split_seconds * 1_000_000))
    part = (events.groupBy(key, slice_start.alias("_slice"), F.session_window(F.col(ts_col), gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("events"),
                 F.sum(_value(value_col)).alias("_value"), _unfit(value_col),
                 F.min(ts_col).alias("_first"), F.max(ts_col).alias("_last")))
    # Only the first and the last piece of a slice can touch a slice border. Those of a
    # key are merged together; a piece between them is a session, so it stays with its slice.
    in_slice = Window.partitionBy(key, "_slice")
    border = (F.col("_first") == F.min("_first").over(in_slice)) | (F.col("_last") == F.max("_last").over(in_slice))
    part = part.withColumn("_group", F.when(~border, F.col("_slice")))
    w = Window.partitionBy(key, "_group").orderBy("_first", "_last")
    prev_end = F.max(F.col("_last")).over(w.rowsBetween(Window.unboundedPreceding, -1)) + gap_iv
    flagged = part.withColumn("_new", F.when(prev_end.isNull() | (F.col("_first") >= prev_end), 1).otherwise(0))
    numbered = flagged.withColumn("_sid", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy(key, "_group", "_sid").agg(
        F.min("_first").alias("session_start"), (F.max("_last") + gap_iv).alias("session_end"),
        F.sum("events").alias("events"), F.sum("_value").cast("double").alias("total_value"),
        F.sum("unfit_values").alias("unfit_values"))
    return merged.select(key, "session_start", "session_end", "events", "total_value", "unfit_values")


def order_window_metrics(orders: DataFrame, duration: str = "1 day", *, watermark: str | None = None,
                         ts_col: str = "order_date") -> DataFrame:
    """Streaming twin of the daily summary / recent metrics (A16, A7):
    per time window of non-cancelled orders — orders, revenue, mean order
    value and distinct customers (HyperLogLog on streams, exact in batch)."""
    df = _prepare(orders.where(F.col("status") != "cancelled"), ts_col, watermark)
    customers = (F.approx_count_distinct("customer_id") if df.isStreaming
                 else F.count_distinct("customer_id"))
    g = df.groupBy(F.window(F.col(ts_col), duration).alias("w")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(F.col("quantity") * F.col("price")).alias("_revenue"),
        customers.alias("unique_customers"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "total_orders", F.col("_revenue").cast("double").alias("total_revenue"),
                    (F.col("_revenue").cast("double") / F.col("total_orders").cast("double")).alias("avg_order_value"),
                    "unique_customers")
