import datetime as dt

from pyspark.sql import functions as F

from changeflow.operators import analytics as A
from changeflow.operators import metrics as M
from changeflow.schemas import ORDER

NOW = dt.datetime(2024, 5, 1, 12, 0, 0)


def _orders(spark, times, status="pending"):
    rows = [(i, 1, "P", 1, None, t, status) for i, t in enumerate(times)]
    return (spark.createDataFrame(rows, "id long, customer_id long, product_id string, quantity int, "
                                         "price decimal(12,2), order_date timestamp_ntz, status string"))


def test_freshness_fresh_and_stale(spark):
    fresh = M.data_freshness(_orders(spark, [NOW - dt.timedelta(seconds=60)]), as_of=NOW).collect()[0]
    stale = M.data_freshness(_orders(spark, [NOW - dt.timedelta(seconds=600)]), as_of=NOW).collect()[0]
    assert (fresh.status, fresh.seconds_since_last) == ("fresh", 60.0)
    assert (stale.status, stale.seconds_since_last) == ("stale", 600.0)
    empty = M.data_freshness(spark.createDataFrame([], ORDER), as_of=NOW).collect()[0]
    assert empty.status == "unknown"


def test_throughput_estimates(spark):
    times = [NOW - dt.timedelta(seconds=10 * i) for i in range(15)] + [NOW - dt.timedelta(hours=2)]
    r = M.throughput(_orders(spark, times, status="cancelled"), 5, as_of=NOW).collect()[0]
    assert (r.orders_in_window, r.orders_per_hour_estimate, r.orders_per_day_estimate) == (15, 180.0, 4320.0)


def test_summary_on_empty_input_is_one_row(spark):
    r = A.order_summary(spark.createDataFrame([], ORDER)).collect()
    assert len(r) == 1 and r[0].total_orders == 0 and r[0].avg_price is None


def test_anomalies_need_two_rows_of_history(spark):
    df = _orders(spark, [NOW]).withColumn("price", F.lit(10).cast("decimal(12,2)"))
    assert A.detect_anomalies(df, 0.0, as_of=NOW).count() == 0       # σ is NULL


def test_growth_rate_order(spark):
    rows = [(1, 1, "P", 1, 100, NOW - dt.timedelta(days=2), "pending"),
            (2, 1, "P", 1, 150, NOW - dt.timedelta(days=1), "pending")]
    df = spark.createDataFrame(rows, "id long, customer_id long, product_id string, quantity int, "
                                     "price int, order_date timestamp_ntz, status string")
    df = df.withColumn("price", F.col("price").cast("decimal(12,2)"))
    assert A.growth_rate(df, 7, as_of=NOW).collect()[0].growth_rate == 50.0
    ref = A.growth_rate(df, 7, as_of=NOW, reference_order=True).collect()[0].growth_rate
    assert abs(ref - (100 - 150) / 150 * 100) < 1e-9


def test_alert_rules(spark):
    m = spark.createDataFrame([("cdc_lag_seconds", 45.0), ("query_response_seconds", 1.0), ("other", 9.0)],
                              "metric string, value double")
    out = {r.metric: r.breached for r in M.alert_rules(m).collect()}
    assert out == {"cdc_lag_seconds": True, "query_response_seconds": False}
