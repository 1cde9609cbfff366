"""DuckDB oracles of the queries over moments, sketches, late rows and metrics, from the data itself."""

from __future__ import annotations

from changeflow.plans.oracle_sql import LIVE, ORDER_LINES, _with

# The batch that an event arrives in, read by both engines.
ARRIVAL = ("cast(floor((dayofyear(ts) - 1) / 8) as bigint) + case when event_id % 13 = 0 then 2 else 0 end")


def customers_by_range(ranges: list[tuple]) -> str:
    spans = ", ".join(f"(DATE '{a}', DATE '{b}')" for a, b in ranges)
    return _with(ORDER_LINES, LIVE, f"spans(first_day, last_day) AS (VALUES {spans})") + """
SELECT first_day, last_day, cast(count(*) AS bigint) AS total_orders, cast(sum(quantity * price) AS double) AS total_revenue,
       count(DISTINCT customer_id) AS exact_customers, true AS within_error
FROM spans JOIN live ON cast(order_date AS date) BETWEEN first_day AND last_day GROUP BY 1, 2"""


def late_rows() -> str:
    return f"""
WITH arrived AS (SELECT event_id, ts, {ARRIVAL} AS arrival FROM events),
newest AS (SELECT arrival, max(date_trunc('milliseconds', max(ts))) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - INTERVAL 1 HOUR AS watermark FROM arrived GROUP BY arrival),
judged AS (SELECT event_id, watermark, coalesce(date_trunc('day', ts) + INTERVAL 1 DAY <= watermark, false) AS late
  FROM arrived JOIN newest USING (arrival))
SELECT event_id, CASE WHEN late THEN 'late' END AS reject_reason, CASE WHEN late THEN watermark END AS watermark FROM judged"""


def alert_metrics() -> str:
    return """
WITH m AS (
  SELECT 'cdc_lag_seconds' AS metric, (epoch_us(max(ts)) - epoch_us(max(ts) FILTER (event_id % 5 < 3))) / 1000000.0 AS value,
         30.0 AS threshold FROM events
  UNION ALL SELECT 'consumer_lag_messages', count(*) FILTER (event_id % 5 >= 3), 1000.0 FROM events)
SELECT metric, cast(value AS double) AS value, cast(threshold AS double) AS threshold, value > 0 AS measured, value > threshold AS breached FROM m
UNION ALL SELECT metric, NULL, 3600.0, true, false FROM (VALUES ('batch_duration_seconds'), ('query_response_seconds')) v(metric)"""
