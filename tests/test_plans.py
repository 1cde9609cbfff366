"""Plan-shape checks: no Python in the hot path, pushdown and pruning reach the
scan, top-k stays a TakeOrdered, statistics are subqueries rather than joins."""

import os

import pytest

import __spark_entry__ as E
from changeflow.plans import registry
from changeflow.operators import analytics as A
from changeflow.sources import fixtures as X
from conftest import SF0001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_python_udf_and_no_cartesian(spark, name):
    plan = _plan(E.queries()[name](spark, SF0001))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                 "CartesianProduct"):
        assert node not in plan, f"{name}: {node}"


def test_status_filter_and_projection_reach_the_scan(spark, scratch):
    path = os.path.join(scratch, "orders")
    X.order_lines(spark, SF0001).write.parquet(path)
    plan = _plan(A.top_customers(spark.read.parquet(path), 10))
    assert "PushedFilters: [IsNotNull(status), Not(EqualTo(status,cancelled))]" in plan
    assert "ReadSchema: struct<customer_id:bigint,quantity:int,price:decimal(12,2),order_date:timestamp_ntz," \
           "status:string>" in plan
    assert "TakeOrderedAndProject" in plan


def test_anomalies_use_a_scalar_subquery_not_a_join(spark):
    plan = _plan(A.detect_anomalies(X.order_lines(spark, SF0001), 2.0, as_of="latest"))
    assert "BroadcastNestedLoopJoin" not in plan and "Subquery" in plan


WINDOWED = ["daily_trends", "detect_anomalies", "anomaly_counts", "recent_metrics", "recent_metrics_multi", "recent_trend",
            "growth_rate", "recent_trend_head", "throughput"]


@pytest.mark.parametrize("name", WINDOWED)
def test_registered_window_reports_bound_the_orders_scan(spark, name):
    """The date bound is in the scan of ``orders`` itself, not above the join."""
    plan = _plan(registry.queries()[name](spark, SF0001))
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x and "o_orderdate" in x]
    assert any("o_orderdate" in x.split("DataFilters:")[1].split("]")[0] and ">=" in x.split("DataFilters:")[1].split("Format")[0]
               for x in scans), plan


def test_sessions_merge_once(spark):
    plan = _plan(registry.queries()["session_metrics"](spark, SF0001))
    assert plan.count("MergingSessions") <= 2 and "Union" not in plan


def test_no_plan_depends_on_the_number_of_splits(spark):
    for name, fn in registry.queries().items():
        assert "REPARTITION_BY_NUM" not in _plan(fn(spark, SF0001)), name


def test_day_partitioned_orders_are_pruned(spark, scratch):
    from changeflow.operators import warehouse as W
    path = os.path.join(scratch, "orders_by_day")
    base = X.order_lines(spark, SF0001).where("order_date >= timestamp_ntz'2001-01-01 00:00:00'")
    W.write_orders_by_day(base, path)
    stored = spark.read.parquet(path)
    for as_of in ("2001-08-01 07:03:46", "latest"):
        q = A.daily_trends(stored, days=30, as_of=as_of)
        rows = q.collect()
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(order_day" in plan and "order_day#" in plan
        if as_of == "latest":       # the anchor's own scan is pruned to the newest day as well
            assert plan.count("PartitionFilters: [isnotnull(order_day") >= 2
        ref = A.daily_trends(base, days=30, as_of=as_of).collect()
        assert sorted(rows) == sorted(ref)
    lit = A.recent_metrics(stored, 60, as_of="2001-08-01 07:03:46")
    plan = lit._jdf.queryExecution().executedPlan().toString()
    assert "(order_day#" in plan and ">= 2001-08-01)" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert lit.collect()[0].recent_orders == A.recent_metrics(base, 60, as_of="2001-08-01 07:03:46").collect()[0].recent_orders
