"""DuckDB oracle SQL, one statement per registered query.

Written independently of the Spark code: the CDC oracles compute expected
results straight from ``events`` columns and the injection rules, not by
parsing the JSON the Spark side parses. Measures use the same exact-sum
formulas (decimal sum → double, double(sum)/count) so values match to the bit.
"""

# The canonical orders view over the test tables (fixed fixture definition).
ORDER_LINES = """order_lines AS (
  SELECT l_orderkey * 10 + l_linenumber AS id,
         o_custkey AS customer_id,
         l_partkey AS product_id,
         cast(l_quantity AS integer) AS quantity,
         cast(l_extendedprice AS decimal(12,2)) AS price,
         o_orderdate + to_seconds(cast((l_orderkey * 7919 + l_linenumber * 131 + l_partkey * 17) % 86400 AS integer)) AS order_date,
         CASE WHEN l_returnflag = 'R' THEN 'cancelled' WHEN o_orderstatus = 'P' THEN 'pending'
              WHEN o_orderstatus = 'O' THEN 'confirmed' WHEN l_linestatus = 'F' THEN 'delivered'
              ELSE 'shipped' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

ASOF = "anchor AS (SELECT max(order_date) AS t FROM order_lines)"
LIVE = "live AS (SELECT * FROM order_lines WHERE status <> 'cancelled')"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _day_start(days: int) -> str:
    return f"cast(cast((SELECT t FROM anchor) AS date) - INTERVAL {int(days)} DAY AS timestamp)"


def _minutes_ago(minutes: int) -> str:
    return f"((SELECT t FROM anchor) - INTERVAL {int(minutes)} MINUTE)"


def order_summary() -> str:
    return _with(ORDER_LINES, LIVE) + """
SELECT count(*) AS total_orders,
       count(DISTINCT customer_id) AS unique_customers,
       count(DISTINCT product_id) AS unique_products,
       cast(sum(quantity) AS double) / nullif(count(quantity), 0) AS avg_quantity,
       cast(sum(price) AS double) / nullif(count(price), 0) AS avg_price,
       cast(sum(quantity * price) AS double) AS total_revenue,
       min(order_date) AS earliest_order,
       max(order_date) AS latest_order
FROM live"""


def top_customers(limit: int = 10) -> str:
    return _with(ORDER_LINES, LIVE) + f"""
SELECT customer_id, count(*) AS order_count, cast(sum(quantity) AS bigint) AS total_quantity,
       cast(sum(quantity * price) AS double) AS total_value,
       cast(sum(price) AS double) / count(price) AS avg_order_value,
       max(order_date) AS last_order_date
FROM live GROUP BY customer_id
ORDER BY sum(quantity * price) DESC, customer_id LIMIT {int(limit)}"""


def product_performance(limit: int = 20) -> str:
    return _with(ORDER_LINES, LIVE) + f"""
SELECT product_id, count(*) AS order_count, cast(sum(quantity) AS bigint) AS total_sold,
       cast(sum(quantity) AS double) / count(quantity) AS avg_quantity_per_order,
       cast(sum(price) AS double) / count(price) AS avg_price,
       cast(sum(quantity * price) AS double) AS total_revenue,
       count(DISTINCT customer_id) AS unique_customers
FROM live GROUP BY product_id
ORDER BY sum(quantity * price) DESC, product_id LIMIT {int(limit)}"""


def daily_trends(days: int = 30) -> str:
    return _with(ORDER_LINES, LIVE, ASOF) + f"""
SELECT cast(order_date AS date) AS order_day, count(*) AS daily_orders,
       count(DISTINCT customer_id) AS daily_customers, cast(sum(quantity) AS bigint) AS daily_quantity,
       cast(sum(quantity * price) AS double) AS daily_revenue,
       cast(sum(price) AS double) / count(price) AS avg_daily_price
FROM live WHERE order_date >= {_day_start(days)}
GROUP BY 1 ORDER BY 1 DESC"""


def status_distribution() -> str:
    return _with(ORDER_LINES) + """
SELECT status, count(*) AS count,
       cast(count(*) AS double) * 100.0 / cast(sum(count(*)) OVER () AS double) AS percentage,
       cast(sum(quantity * price) AS double) AS total_value
FROM order_lines GROUP BY status ORDER BY count DESC, status"""


def hourly_pattern() -> str:
    return _with(ORDER_LINES, LIVE) + """
SELECT cast(hour(order_date) AS bigint) AS hour_of_day, count(*) AS order_count,
       cast(sum(quantity * price) AS double) / count(quantity * price) AS avg_order_value
FROM live GROUP BY 1 ORDER BY 1"""


def recent_metrics(minutes: int = 5) -> str:
    return _with(ORDER_LINES, LIVE, ASOF) + f"""
SELECT count(*) AS recent_orders, count(DISTINCT customer_id) AS active_customers,
       cast(sum(quantity * price) AS double) AS recent_revenue,
       cast(sum(price) AS double) / nullif(count(price), 0) AS avg_recent_price,
       cast({int(minutes)} AS bigint) AS time_window_minutes,
       (SELECT t FROM anchor) AS calculated_at
FROM live WHERE order_date >= {_minutes_ago(minutes)}"""


def recent_metrics_multi(windows=(5, 15, 60)) -> str:
    parts = []
    for w in sorted(windows):
        parts.append(f"""
SELECT cast({w} AS bigint) AS time_window_minutes, count(*) AS recent_orders,
       count(DISTINCT customer_id) AS active_customers,
       cast(sum(quantity * price) AS double) AS recent_revenue,
       cast(sum(price) AS double) / nullif(count(price), 0) AS avg_recent_price
FROM live WHERE order_date >= {_minutes_ago(w)}""")
    return _with(ORDER_LINES, LIVE, ASOF) + "\nUNION ALL".join(parts)


def detect_anomalies(k: float = 2.0, stats_days: int = 7, candidate_days: int = 1) -> str:
    """Each recent order is labelled once against scalar bounds; labelled rows are kept."""
    def bound(x: str, sign: str) -> str:
        mean = f"cast(sum({x}) AS double) / nullif(count({x}), 0)"
        return f"(SELECT {mean} {sign} {k} * stddev_samp(cast({x} AS double)) FROM history)"
    value = "quantity * price"
    return _with(ORDER_LINES, LIVE, ASOF,
                 f"history AS (SELECT * FROM live WHERE order_date >= {_day_start(stats_days)})",
                 f"""labelled AS (
  SELECT *, CASE WHEN {value} > {bound(value, "+")} THEN 'High Value' WHEN quantity > {bound("quantity", "+")} THEN 'High Quantity'
                 WHEN {value} < {bound(value, "-")} THEN 'Low Value' END AS anomaly_type
  FROM live WHERE order_date >= {_day_start(candidate_days)})""") + f"""
SELECT id, customer_id, product_id, quantity, cast(price AS double) AS price, cast({value} AS double) AS order_value,
       order_date, anomaly_type
FROM labelled WHERE anomaly_type IS NOT NULL"""


def anomaly_counts(k: float = 1.0, stats_days: int = 90, candidate_days: int = 30) -> str:
    return f"SELECT anomaly_type, count(*) AS count FROM ({detect_anomalies(k, stats_days, candidate_days)}) a GROUP BY 1"


def _daily_rows(days: int) -> str:
    return f"""d AS (
  SELECT cast(order_date AS date) AS order_day, count(*) AS daily_orders, sum(quantity * price) AS rev
  FROM live WHERE order_date >= {_day_start(days)} GROUP BY 1)"""


def recent_trend(days: int = 7) -> str:
    return _with(ORDER_LINES, LIVE, ASOF, _daily_rows(days)) + """
SELECT cast(sum(daily_orders) AS double) / nullif(count(*), 0) AS daily_avg_orders,
       cast(sum(rev) AS double) / nullif(count(*), 0) AS daily_avg_revenue,
       CASE WHEN count(*) >= 2 AND arg_min(rev, order_day) > 0
            THEN (cast(arg_max(rev, order_day) AS double) - cast(arg_min(rev, order_day) AS double))
                 / cast(arg_min(rev, order_day) AS double) * 100.0
            ELSE 0.0 END AS growth_rate,
       count(*) AS days_present
FROM d"""


def growth_rate(days: int = 30) -> str:
    return f"SELECT growth_rate FROM ({recent_trend(days)}) t"


def customer_ltv() -> str:
    return f"""SELECT total_revenue, unique_customers,
       total_revenue / cast(greatest(unique_customers, 1) AS double) AS customer_ltv
FROM ({order_summary()}) s"""


def recent_trend_head(n: int = 7, days: int = 30) -> str:
    return f"""SELECT order_day, daily_orders, daily_customers, daily_quantity,
       round(daily_revenue, 2) AS daily_revenue, round(avg_daily_price, 2) AS avg_daily_price
FROM ({daily_trends(days)}) t ORDER BY order_day DESC LIMIT {int(n)}"""


def daily_order_summary() -> str:
    return _with(ORDER_LINES, LIVE) + """
SELECT cast(order_date AS date) AS summary_date, count(*) AS total_orders,
       cast(sum(quantity * price) AS double) AS total_revenue,
       cast(sum(quantity * price) AS double) / cast(count(*) AS double) AS avg_order_value,
       count(DISTINCT customer_id) AS unique_customers
FROM live GROUP BY 1"""


def orders_count() -> str:
    return _with(ORDER_LINES) + "SELECT count(*) AS orders_count FROM order_lines"


def growth_rate_reference_order(days: int = 30) -> str:
    """Growth computed on the newest-first series, as the reference did."""
    return _with(ORDER_LINES, LIVE, ASOF, _daily_rows(days)) + """
SELECT CASE WHEN count(*) >= 2 AND arg_max(rev, order_day) > 0
            THEN (cast(arg_min(rev, order_day) AS double) - cast(arg_max(rev, order_day) AS double))
                 / cast(arg_max(rev, order_day) AS double) * 100.0
            ELSE 0.0 END AS growth_rate
FROM d"""
