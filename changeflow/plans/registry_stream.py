"""Batch twins of the streaming operators (the streams themselves are checked
by tests that compare stream output with these)."""

from __future__ import annotations

from changeflow.plans.registry import register
from changeflow.sources.fixtures import events, events_wide
from changeflow.streaming import windows as WN

_DEC = ("cast(sum(try_cast(value AS decimal(28,2))) AS double) AS total_value, "
        "count(*) FILTER (value IS NOT NULL AND try_cast(value AS decimal(28,2)) IS NULL) AS unfit_values")

TUMBLING_SQL = f"""
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
       event_type, count(*) AS events, {_DEC}, count(DISTINCT user_id) AS unique_users
FROM events GROUP BY 1, 2, 3"""

SLIDING_SQL = f"""
WITH b AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) AS b5 FROM events),
x AS (SELECT b5 AS window_start, event_type, user_id, value FROM b
      UNION ALL SELECT b5 - INTERVAL 5 MINUTE, event_type, user_id, value FROM b)
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, event_type,
       count(*) AS events, {_DEC}, count(DISTINCT user_id) AS unique_users
FROM x GROUP BY 1, 2, 3"""

SESSION_SQL = f"""
WITH s AS (
  SELECT user_id, ts, value,
         CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                OR ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE
              THEN 1 ELSE 0 END AS nw
  FROM events),
g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM s)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end,
       count(*) AS events, {_DEC}
FROM g GROUP BY user_id, sid"""


@register("tumbling_metrics", TUMBLING_SQL)
def _tumbling(spark, d):
    return WN.tumbling_metrics(events(spark, d), "5 minutes")


@register("sliding_metrics", SLIDING_SQL)
def _sliding(spark, d):
    return WN.sliding_metrics(events(spark, d), "10 minutes", "5 minutes")


@register("session_metrics", SESSION_SQL)
def _session(spark, d):
    return WN.session_metrics(events(spark, d), "30 minutes")


# The same statements over values that a narrow decimal does not hold.
_WIDE = """WITH events_wide AS (SELECT * REPLACE (CASE WHEN event_id % 103 = 0 THEN 5e10 WHEN event_id % 107 = 0 THEN 1e30
                                        ELSE value END AS value) FROM events)"""


def _wide(sql: str) -> str:
    sql = sql.strip().replace("FROM events", "FROM events_wide")
    return _WIDE + (", " + sql.removeprefix("WITH ") if sql.startswith("WITH ") else "\n" + sql)


@register("tumbling_metrics_wide", _wide(TUMBLING_SQL))
def _tumbling_wide(spark, d):
    return WN.tumbling_metrics(events_wide(spark, d), "5 minutes")


@register("sliding_metrics_wide", _wide(SLIDING_SQL))
def _sliding_wide(spark, d):
    return WN.sliding_metrics(events_wide(spark, d), "10 minutes", "5 minutes")


@register("session_metrics_wide", _wide(SESSION_SQL))
def _session_wide(spark, d):
    return WN.session_metrics(events_wide(spark, d), "30 minutes")


ORDER_WINDOWS_SQL = """
WITH order_lines AS (
  SELECT o_custkey AS customer_id, cast(l_quantity AS integer) AS quantity,
         cast(l_extendedprice AS decimal(12,2)) AS price,
         o_orderdate + to_seconds(cast((l_orderkey * 7919 + l_linenumber * 131 + l_partkey * 17) % 86400 AS integer)) AS order_date,
         CASE WHEN l_returnflag = 'R' THEN 'cancelled' WHEN o_orderstatus = 'P' THEN 'pending'
              WHEN o_orderstatus = 'O' THEN 'confirmed' WHEN l_linestatus = 'F' THEN 'delivered'
              ELSE 'shipped' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT time_bucket(INTERVAL 1 DAY, order_date) AS window_start,
       time_bucket(INTERVAL 1 DAY, order_date) + INTERVAL 1 DAY AS window_end,
       count(*) AS total_orders, cast(sum(quantity * price) AS double) AS total_revenue,
       cast(sum(quantity * price) AS double) / cast(count(*) AS double) AS avg_order_value,
       count(DISTINCT customer_id) AS unique_customers
FROM order_lines WHERE status <> 'cancelled' GROUP BY 1, 2"""


@register("order_window_metrics", ORDER_WINDOWS_SQL)
def _order_windows(spark, d):
    from changeflow.sources.fixtures import order_lines
    return WN.order_window_metrics(order_lines(spark, d), "1 day")
