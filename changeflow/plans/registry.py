"""The registry of queries checked against the DuckDB oracle.

Every query reads the given test tables (or views Spark derives from them)
in full; parameters are the operators' own defaults unless a branch would
otherwise go untested (e.g. anomalies at k=1 over wider windows).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from changeflow.operators import analytics as A
from changeflow.plans import oracle_sql as O
from changeflow.sources.fixtures import latest_order_time, order_lines

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Query) -> Query:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, base_dir: str) -> DataFrame:
            # Timestamps are UTC wall-clock values throughout the library.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, base_dir)
        run.__name__ = run.__qualname__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = (run, oracle)
        return fn
    return deco


# ---------------------------------------------------------------- analytics
@register("top_customers", O.top_customers(10))
def _top_customers(spark, d):
    return A.top_customers(order_lines(spark, d), limit=10)


@register("order_summary", O.order_summary())
def _order_summary(spark, d):
    return A.order_summary(order_lines(spark, d))


@register("product_performance", O.product_performance(20))
def _product_performance(spark, d):
    return A.product_performance(order_lines(spark, d), limit=20)


@register("daily_trends", O.daily_trends(30))
def _daily_trends(spark, d):
    return A.daily_trends(order_lines(spark, d), days=30, as_of=latest_order_time(spark, d))


@register("status_distribution", O.status_distribution())
def _status_distribution(spark, d):
    return A.status_distribution(order_lines(spark, d))


@register("hourly_pattern", O.hourly_pattern())
def _hourly_pattern(spark, d):
    return A.hourly_pattern(order_lines(spark, d))


@register("recent_metrics", O.recent_metrics(60))
def _recent_metrics(spark, d):
    return A.recent_metrics(order_lines(spark, d), minutes=60, as_of=latest_order_time(spark, d))


@register("recent_metrics_multi", O.recent_metrics_multi((5, 15, 60)))
def _recent_metrics_multi(spark, d):
    return A.recent_metrics_multi(order_lines(spark, d), windows=(5, 15, 60), as_of=latest_order_time(spark, d))


@register("detect_anomalies", O.detect_anomalies(2.0, 7, 1))
def _detect_anomalies(spark, d):
    return A.detect_anomalies(order_lines(spark, d), 2.0, stats_days=7, candidate_days=1, as_of=latest_order_time(spark, d))


@register("detect_anomalies_k1", O.detect_anomalies(1.0, 7, 1))
def _detect_anomalies_k1(spark, d):
    return A.detect_anomalies(order_lines(spark, d), 1.0, stats_days=7, candidate_days=1, as_of=latest_order_time(spark, d))


@register("detect_anomalies_wide", O.detect_anomalies(1.0, 90, 30))
def _detect_anomalies_wide(spark, d):
    return A.detect_anomalies(order_lines(spark, d), 1.0, stats_days=90, candidate_days=30, as_of=latest_order_time(spark, d))


@register("anomaly_counts", O.anomaly_counts(1.0, 90, 30))
def _anomaly_counts(spark, d):
    return A.anomaly_counts(A.detect_anomalies(order_lines(spark, d), 1.0, stats_days=90,
                                               candidate_days=30, as_of=latest_order_time(spark, d)))


@register("recent_trend", O.recent_trend(7))
def _recent_trend(spark, d):
    return A.recent_trend(order_lines(spark, d), days=7, as_of=latest_order_time(spark, d))


@register("growth_rate", O.growth_rate(30))
def _growth_rate(spark, d):
    return A.growth_rate(order_lines(spark, d), days=30, as_of=latest_order_time(spark, d))


@register("growth_rate_reference_order", O.growth_rate_reference_order(30))
def _growth_rate_reference_order(spark, d):
    return A.growth_rate(order_lines(spark, d), days=30, as_of=latest_order_time(spark, d), reference_order=True)


@register("customer_ltv", O.customer_ltv())
def _customer_ltv(spark, d):
    return A.customer_ltv(order_lines(spark, d))


@register("recent_trend_head", O.recent_trend_head(7, 30))
def _recent_trend_head(spark, d):
    return A.recent_trend_head(order_lines(spark, d), n=7, days=30, as_of=latest_order_time(spark, d))


@register("daily_order_summary", O.daily_order_summary())
def _daily_order_summary(spark, d):
    return A.daily_order_summary(order_lines(spark, d))


@register("orders_count", O.orders_count())
def _orders_count(spark, d):
    return A.orders_count(order_lines(spark, d))


# ------------------------------------------------------------------ registry
def _load_more() -> None:
    # Later sections register themselves on import.
    from changeflow.plans import registry_cdc, registry_stream, registry_upkeep  # noqa: F401


_load_more()


def queries() -> dict[str, Query]:
    return {name: fn for name, (fn, _) in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _REGISTRY.items() if sql is not None}


def flagship(spark: SparkSession, base_dir: str) -> DataFrame:
    return A.top_customers(order_lines(spark, base_dir), limit=10)
