"""Every report on an empty input, and with the wall-clock anchor (as_of=None)."""

import pytest

from changeflow.operators import analytics as A
from changeflow.operators import insights as I
from changeflow.operators import metrics as M
from changeflow.schemas import ORDER
from changeflow.sources import fixtures as X
from conftest import SF0001

ONE_ROW = [A.order_summary, A.customer_ltv, A.orders_count, A.recent_metrics, A.recent_trend, A.growth_rate,
           M.data_freshness, M.throughput, M.pipeline_health]
GROUPED = [A.top_customers, A.product_performance, A.daily_trends, A.status_distribution, A.hourly_pattern,
           A.detect_anomalies, A.daily_order_summary, A.recent_trend_head,
           lambda o: A.anomaly_counts(A.detect_anomalies(o, 1.0))]


@pytest.mark.parametrize("fn", ONE_ROW)
def test_one_row_reports_on_empty_input(spark, fn):
    assert len(fn(spark.createDataFrame([], ORDER)).collect()) == 1


@pytest.mark.parametrize("fn", GROUPED)
def test_grouped_reports_on_empty_input(spark, fn):
    assert fn(spark.createDataFrame([], ORDER)).collect() == []


def test_multi_window_on_empty_input(spark):
    rows = A.recent_metrics_multi(spark.createDataFrame([], ORDER)).collect()
    assert [r.recent_orders for r in rows] == [0, 0, 0]


def test_wall_clock_anchor(spark):
    o = X.order_lines(spark, SF0001)                    # 2001 data: nothing is recent today
    assert A.recent_metrics(o, 60).collect()[0].recent_orders == 0
    assert A.daily_trends(o, 30).count() == 0
    assert M.data_freshness(o).collect()[0].status == "stale"
    bundle = I.insights_bundle(o).collect()[0]
    assert bundle.summary.total_orders == 4032 and bundle.recent_anomalies == 0
