"""DuckDB oracles for metrics, warehouse-side and SQL-interface queries."""

from changeflow.plans.oracle_sql import ASOF, ORDER_LINES, _with
from changeflow.plans.oracle_cdc import CDC_BASE, PAYLOAD


def _asof(minutes: int) -> str:
    """The anchor, some minutes after the newest order."""
    return f"((SELECT t FROM anchor) + INTERVAL {int(minutes)} MINUTE)"


def data_freshness(later: int = 0) -> str:
    return _with(ORDER_LINES, ASOF) + f"""
SELECT max(order_date) AS latest_order,
       (epoch_us({_asof(later)}) - epoch_us(max(order_date))) / 1000000.0 AS seconds_since_last,
       CASE WHEN max(order_date) IS NULL THEN 'unknown'
            WHEN (epoch_us({_asof(later)}) - epoch_us(max(order_date))) / 1000000.0 < 300 THEN 'fresh'
            ELSE 'stale' END AS status
FROM order_lines"""


def throughput(minutes: int = 5) -> str:
    per_hour = 60.0 / minutes
    return _with(ORDER_LINES, ASOF) + f"""
SELECT cast({minutes} AS bigint) AS window_minutes, count(*) AS orders_in_window,
       cast(count(*) AS double) * cast({per_hour!r} AS double) AS orders_per_hour_estimate,
       cast(count(*) AS double) * cast({per_hour * 24!r} AS double) AS orders_per_day_estimate
FROM order_lines WHERE order_date >= (SELECT t FROM anchor) - INTERVAL {minutes} MINUTE"""


def _health(minutes: int, later: int = 0, max_error: float = 0.05) -> str:
    t = _asof(later)
    since = f"(epoch_us({t}) - epoch_us(max(order_date))) / 1000000.0"
    recent = f"count(*) FILTER (WHERE order_date >= {t} - INTERVAL {minutes} MINUTE)"
    return _with(ORDER_LINES, ASOF, CDC_BASE, PAYLOAD, """q AS (
  SELECT cast(count(*) FILTER (WHERE reject_reason IS NOT NULL) AS double) / cast(count(*) AS double) AS err,
         cast(sum(event_id % 7 * 1000000) AS double) / (cast(count(*) AS double) * 1000.0) AS lat
  FROM payload)""") + f"""
SELECT {t} AS timestamp,
       CASE WHEN max(order_date) IS NULL THEN 'unknown'
            WHEN {since} < 300 AND (SELECT err FROM q) <= {max_error} THEN 'healthy' ELSE 'degraded' END AS pipeline_status,
       max(order_date) AS latest_order, {since} AS seconds_since_last,
       CASE WHEN max(order_date) IS NULL THEN 'unknown' WHEN {since} < 300 THEN 'fresh' ELSE 'stale' END AS freshness_status,
       {recent} AS orders_in_window,
       cast({recent} AS double) * cast({60.0 / minutes!r} AS double) AS orders_per_hour_estimate,
       coalesce((SELECT err FROM q), 0.0) AS error_rate, (SELECT lat FROM q) AS latency_ms
FROM order_lines"""


def pipeline_health(minutes: int = 5, later: int = 0) -> str:
    return _health(minutes, later, 0.5)


def insights_bundle(top_n: int, trend_days: int, minutes: int) -> str:
    """Every number of the bundle as a row, from the sections' own statements."""
    from changeflow.plans import oracle_sql as S

    def rows(section: str, sql: str, measures: str, rank: str = "0", item: str = "''") -> str:
        names = [m.strip() for m in measures.split(",")]
        quoted = ", ".join(f'"{m}"' for m in names)
        picked = ", ".join(f'cast("{m}" AS double) AS "{m}"' for m in names)
        return (f"SELECT '{section}' AS section, cast(rank AS integer) AS rank, item, measure, value FROM ("
                f"SELECT {rank} AS rank, cast({item} AS varchar) AS item, {picked} FROM ({sql}) s) "
                f"UNPIVOT INCLUDE NULLS (value FOR measure IN ({quoted}))")

    return " UNION ALL ".join([
        rows("summary", S.order_summary(),
             "total_orders, unique_customers, unique_products, avg_quantity, avg_price, total_revenue"),
        rows("top_customers", S.top_customers(top_n), "order_count, total_quantity, total_value, avg_order_value",
             "row_number() OVER (ORDER BY total_value DESC, customer_id)", "customer_id"),
        rows("top_products", S.product_performance(top_n),
             "order_count, total_sold, avg_quantity_per_order, avg_price, total_revenue, unique_customers",
             "row_number() OVER (ORDER BY total_revenue DESC, product_id)", "product_id"),
        rows("recent_trend", S.recent_trend(trend_days), "daily_avg_orders, daily_avg_revenue, growth_rate, days_present"),
        rows("status_distribution", S.status_distribution(), "count, percentage, total_value",
             'row_number() OVER (ORDER BY "count" DESC, status)', "status"),
        rows("real_time", S.recent_metrics(minutes),
             "recent_orders, active_customers, recent_revenue, avg_recent_price, time_window_minutes"),
        rows("recent_anomalies", f'SELECT count(*) AS "count" FROM ({S.detect_anomalies(2.0, 7, 1)}) a', "count"),
    ])


def alert_rules() -> str:
    from changeflow.plans.oracle_sql import detect_anomalies
    return f"""WITH h AS ({_health(60)}),
a AS (SELECT count(*) AS n FROM ({detect_anomalies(1.0, 90, 30)}) x),
m AS (
  SELECT 'seconds_since_last' AS metric, cast(seconds_since_last AS double) AS value, 300.0 AS threshold FROM h
  UNION ALL SELECT 'error_rate', cast(error_rate AS double), 0.05 FROM h
  UNION ALL SELECT 'anomalies', cast((SELECT n FROM a) AS double), 100.0)
SELECT metric, value, cast(threshold AS double) AS threshold, value > threshold AS breached FROM m"""


def param_sql() -> str:
    return _with(ORDER_LINES) + """
SELECT customer_id, count(*) AS order_count, cast(sum(quantity * price) AS double) AS total_value
FROM order_lines WHERE status <> 'cancelled' GROUP BY customer_id
ORDER BY sum(quantity * price) DESC, customer_id LIMIT 5"""


def dim_customers() -> str:
    return "SELECT c_custkey AS customer_id, c_name AS customer_name, cast(NULL AS varchar) AS customer_email FROM customer"


def orders_with_customer() -> str:
    return _with(ORDER_LINES) + """
SELECT o.id, o.customer_id, c.c_name AS customer_name, o.product_id, o.status, cast(o.price AS double) AS price
FROM order_lines o LEFT JOIN customer c ON o.customer_id = c.c_custkey"""


def lifecycle_tiers() -> str:
    return _with(ORDER_LINES, ASOF) + """
SELECT CASE WHEN order_date >= cast(cast((SELECT t FROM anchor) AS date) - INTERVAL 30 DAY AS timestamp) THEN 'hot'
            WHEN order_date >= cast(cast((SELECT t FROM anchor) AS date) - INTERVAL 6 MONTH AS timestamp) THEN 'warm'
            ELSE 'cold' END AS tier,
       cast(year(order_date) AS integer) AS year, cast(month(order_date) AS integer) AS month, count(*) AS orders
FROM order_lines GROUP BY 1, 2, 3"""
