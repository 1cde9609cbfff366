"""Pipeline and data-quality metrics (M1-M4).

All one-row results come from one aggregate over the orders plus scalar
subqueries over the other inputs — no joins, nothing collected to Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.functions.time import last_minutes, resolve_as_of, seconds_between, since_minutes

# Freshness limit and the documented alert thresholds.
FRESH_SECONDS = 300
DEFAULT_RULES = {
    "cdc_lag_seconds": 30.0,
    "consumer_lag_messages": 1000.0,
    "batch_duration_seconds": 5.0,
    "query_response_seconds": 2.0,
}


def data_freshness(orders: DataFrame, as_of=None, fresh_seconds: int = FRESH_SECONDS) -> DataFrame:
    """Newest order time and seconds since it: 'fresh' under the limit,
    'stale' otherwise, 'unknown' without data. Cancelled orders count."""
    anchor = resolve_as_of(orders, as_of)
    latest = orders.agg(F.max("order_date").alias("latest_order"))
    secs = seconds_between(anchor, F.col("latest_order"))
    return latest.select(
        "latest_order", secs.alias("seconds_since_last"),
        F.when(secs.isNull(), "unknown").when(secs < fresh_seconds, "fresh").otherwise("stale").alias("status"))


def throughput(orders: DataFrame, window_minutes: int = 5, as_of=None) -> DataFrame:
    """Orders in the last window (all statuses) and per-hour / per-day estimates."""
    anchor = resolve_as_of(orders, as_of)
    n = last_minutes(orders, anchor, window_minutes).agg(
        F.count(F.lit(1)).alias("orders_in_window"))
    per_hour = 60.0 / window_minutes
    return n.select(
        F.lit(int(window_minutes)).cast("bigint").alias("window_minutes"), "orders_in_window",
        (F.col("orders_in_window") * F.lit(per_hour)).alias("orders_per_hour_estimate"),
        (F.col("orders_in_window") * F.lit(per_hour * 24)).alias("orders_per_day_estimate"))


def pipeline_health(orders: DataFrame, decoded: DataFrame | None = None, as_of=None,
                    window_minutes: int = 5, max_error_rate: float = 0.05,
                    fresh_seconds: int = FRESH_SECONDS) -> DataFrame:
    """Freshness + throughput + real error rate and latency (M3).

    ``error_rate`` = rejected / all decoded events; ``latency_ms`` = mean of
    (processing time − event time) over the decoded events. Status is
    'healthy' when fresh and under the error limit, 'degraded' otherwise,
    'unknown' without orders.
    """
    anchor = resolve_as_of(orders, as_of)
    one = orders.agg(
        F.max("order_date").alias("latest_order"),
        F.count(F.when(since_minutes(F.col("order_date"), anchor, window_minutes), 1)).alias("orders_in_window"))
    if decoded is not None:
        lag = (F.unix_micros(F.col("_processed_at").cast("timestamp"))
               - F.unix_micros(F.col("_cdc_timestamp").cast("timestamp")))
        q = decoded.agg(F.struct(
            F.try_divide(F.count(F.when(F.col("reject_reason").isNotNull(), 1)).cast("double"),
                         F.count(F.lit(1)).cast("double")).alias("error_rate"),
            F.try_divide(F.sum(lag.cast("decimal(38,0)")).cast("double"), F.count(lag).cast("double") * 1000.0)
            .alias("latency_ms"),
        )).scalar()
        err, lat = F.coalesce(q["error_rate"], F.lit(0.0)), q["latency_ms"]
    else:
        err, lat = F.lit(0.0), F.lit(None).cast("double")
    secs = seconds_between(anchor, F.col("latest_order"))
    fresh = F.when(secs.isNull(), "unknown").when(secs < fresh_seconds, "fresh").otherwise("stale")
    return one.select(
        anchor.alias("timestamp"),
        F.when(fresh == "unknown", "unknown").when((fresh == "fresh") & (err <= max_error_rate), "healthy")
         .otherwise("degraded").alias("pipeline_status"),
        "latest_order", secs.alias("seconds_since_last"), fresh.alias("freshness_status"),
        "orders_in_window",
        (F.col("orders_in_window") * F.lit(60.0 / window_minutes)).alias("orders_per_hour_estimate"),
        err.alias("error_rate"), lat.alias("latency_ms"))


def alert_rules(metrics: DataFrame, rules: dict | None = None) -> DataFrame:
    """Evaluate ``value > threshold`` per metric (M4).

    ``metrics`` is long format (metric, value). Thresholds are a map literal
    looked up per row, so this is a narrow projection — no join, whatever
    the number of metric rows. Metrics without a rule are dropped.
    """
    rules = dict(DEFAULT_RULES if rules is None else rules)
    if not rules:
        raise ValueError("no alert rules")
    lookup = F.create_map(*[x for k, v in sorted(rules.items()) for x in (F.lit(k), F.lit(float(v)))])
    limit = F.element_at(lookup, F.col("metric"))
    return (metrics.where(F.col("metric").isin(*rules))
            .select("metric", F.col("value").cast("double").alias("value"), limit.alias("threshold"),
                    (F.col("value").cast("double") > limit).alias("breached")))


def metrics_long(one_row: DataFrame, columns: list[str]) -> DataFrame:
    """Unpivot selected columns of a one-row metrics frame to (metric, value)."""
    return one_row.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "metric", "value")
