"""Moments, sketches, late rows, progress tables and alert metrics, out of streams that ran."""

import datetime as dt
import json
import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from changeflow.operators import analytics as A
from changeflow.operators import metrics as M
from changeflow.operators import moments as MO
from changeflow.operators import sketches as SK
from changeflow.operators.quality import dead_letter
from changeflow.sources import fixtures as X
from changeflow.sources.streams import file_stream
from changeflow.streaming import (
    LateSplitter, ProgressLog, observe_events, progress_frame, run_available, stream_metrics, timed_reports, tumbling_metrics,
)
from changeflow.streaming.progress import progress_reports, response_metric
from conftest import SF0001

ORDERS = ("id long, customer_id long, product_id string, quantity int, price decimal(12,2), order_date timestamp_ntz, "
          "status string")


def some_orders(n, seed=1):
    r, start = random.Random(seed), dt.datetime(2024, 5, 1)
    return [(k, r.randint(1, 40), "p", r.choice([1, 2, 3, 30]), round(r.choice([10, 12, 11, 400]) + r.random(), 2),
             start + dt.timedelta(minutes=15 * k), r.choice(["pending", "shipped", "cancelled"])) for k in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r[:4], str(r[4]), *r[5:]) for r in rows], ORDERS.replace("price decimal(12,2)", "price string")) \
        .withColumn("price", F.col("price").cast("decimal(12,2)"))


# ---------------------------------------------------------------- A8
def test_merged_moments_are_the_statistics_of_the_orders(spark):
    orders = frame(spark, some_orders(500))
    live = [(r[3] * r[4], r[3]) for r in some_orders(500) if r[6] != "cancelled"]
    parts = [MO.daily_moments(orders.where(F.col("id") % 3 == k)) for k in range(3)]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])                    # several rows of each day
    s = spark.range(1).select(MO.merged_stats(rows).alias("s")).first().s
    assert s.avg_value == pytest.approx(statistics.mean(v for v, _ in live), rel=1e-12)
    assert s.sd_value == pytest.approx(statistics.stdev(v for v, _ in live), rel=1e-12)
    assert s.sd_qty == pytest.approx(statistics.stdev(q for _, q in live), rel=1e-12)
    one = spark.range(1).select(MO.merged_stats(MO.daily_moments(orders.where("id = 1 or status = 'cancelled'"))).alias("s")).first().s
    assert one.sd_value is None
    none = spark.range(1).select(MO.merged_stats(MO.daily_moments(orders.limit(0))).alias("s")).first().s
    assert none.avg_value is None and none.sd_value is None


def test_large_values_do_not_cancel(spark):
    rows = [(k, 1, "p", 1, 9_999_999_990 + k % 3, dt.datetime(2024, 5, 1 + k % 4), "pending") for k in range(300)]
    s = spark.range(1).select(MO.merged_stats(MO.daily_moments(frame(spark, rows))).alias("s")).first().s
    assert s.sd_value == pytest.approx(statistics.stdev(r[4] for r in rows), rel=1e-6)


def test_detection_from_stored_moments_equals_the_rescan_and_reads_few_days(spark, scratch):
    orders = X.order_lines(spark, SF0001)
    path = os.path.join(scratch, "moments")
    MO.daily_moments(orders).write.parquet(path)
    for k, days, back in ((1.0, 90, 30), (2.0, 7, 1), (0.5, 20, 20)):
        as_of = "2001-08-01 07:03:46"
        got = MO.detect_anomalies_from(spark.read.parquet(path), orders, k, stats_days=days, candidate_days=back, as_of=as_of)
        want = A.detect_anomalies(orders, k, stats_days=days, candidate_days=back, as_of=as_of)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_day" in plan


def test_anomaly_stream_flags_each_batch_against_what_came_before(spark, scratch):
    orders = some_orders(1200, seed=4)
    src = os.path.join(scratch, "in")
    for lo in range(0, 1200, 300):
        frame(spark, orders[lo:lo + 300]).coalesce(1).write.mode("append").parquet(src)
    sink = MO.AnomalySink(os.path.join(scratch, "out"), threshold_multiplier=1.5, stats_days=3)
    stream = file_stream(spark, src, frame(spark, orders[:1]).schema, max_files_per_trigger=1)
    run_available(stream, checkpoint=os.path.join(scratch, "ck"), foreach_batch=sink, timeout_s=300)
    want = {}
    for lo in range(0, 1200, 300):
        live = [r for r in orders[:lo + 300] if r[6] != "cancelled"]
        since = dt.datetime.combine(max(r[5] for r in orders[lo:lo + 300] if r[6] != "cancelled").date() - dt.timedelta(days=3), dt.time())
        value, qty = [r[3] * r[4] for r in live if r[5] >= since], [r[3] for r in live if r[5] >= since]
        for r in orders[lo:lo + 300]:
            if r[6] != "cancelled":
                v = r[3] * r[4]
                kind = ("High Value" if v > statistics.mean(value) + 1.5 * statistics.stdev(value) else
                        "High Quantity" if r[3] > statistics.mean(qty) + 1.5 * statistics.stdev(qty) else
                        "Low Value" if v < statistics.mean(value) - 1.5 * statistics.stdev(value) else None)
                if kind:
                    want[r[0]] = kind
    flagged = sink.flagged(spark)
    assert {r.id: r.anomaly_type for r in flagged.collect()} == want and len(want) > 20
    stream_id = flagged.first().stream
    sink(frame(spark, orders[900:]), 3, stream_id)                                  # a replay of the last batch
    assert {r.id: r.anomaly_type for r in sink.flagged(spark).collect()} == want and sink.flagged(spark).count() == len(want)
    sink.moments(spark).compact()
    assert sink.moments(spark).read().agg(F.sum("orders")).first()[0] == sum(r[6] != "cancelled" for r in orders)


# ---------------------------------------------------------------- A16
def test_customers_of_any_range_within_the_stated_error(spark, scratch):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int"))
    orders = spark.range(400_000).select(
        F.col("id"), (F.xxhash64("id") % 70_000).alias("customer_id"), F.lit("p").alias("product_id"), F.lit(1).alias("quantity"),
        F.lit(2).cast("decimal(12,2)").alias("price"), day.cast("timestamp_ntz").alias("order_date"), F.lit("pending").alias("status"))
    path = os.path.join(scratch, "s")
    SK.write_sketches(SK.daily_sketches(orders), path)
    stored = spark.read.parquet(path)
    ranges = [("2024-01-01", "2024-01-01"), ("2024-01-03", "2024-01-20"), ("2023-01-01", "2025-01-01")]
    for r in SK.customers_by_range(stored, ranges).collect():
        own = orders.where(F.to_date("order_date").between(r.first_day, r.last_day))
        exact = own.select("customer_id").distinct().count()
        assert r.customers_low <= exact <= r.customers_high and abs(r.customers - exact) <= SK.relative_error() * exact
        assert (r.total_orders, r.total_revenue) == (own.count(), 2.0 * own.count())
    SK.write_sketches(SK.daily_sketches(orders.where("order_date = timestamp_ntz'2024-01-05' and id < 400")), path)      # one day anew
    again = spark.read.parquet(path)
    assert again.count() == 40 and again.agg(F.sum("total_orders")).first()[0] == 390_000 + 10
    q = SK.customers_by_range(spark.read.parquet(path), ranges[:2])
    assert "PartitionFilters: [isnotnull(year" in q._jdf.queryExecution().executedPlan().toString()
    assert SK.customers_by_range(stored.limit(0), ranges).count() == 0


# ---------------------------------------------------------------- T9
def arrivals(spark):
    ev = X.events(spark, SF0001).select("event_id", "ts", "user_id", "event_type", "value")
    batch = F.expr("cast(floor((dayofyear(ts) - 1) / 8) as int) + case when event_id % 13 = 0 then 2 else 0 end")
    return ev.withColumn("b", batch)


def test_rows_in_time_and_late_rows_are_the_input(spark, scratch):
    ev = arrivals(spark)
    src = os.path.join(scratch, "in")
    for k in sorted(r[0] for r in ev.select("b").distinct().collect()):
        ev.where(F.col("b") == k).drop("b").coalesce(1).write.mode("append").parquet(src)
    schema = ev.drop("b").schema
    stream = file_stream(spark, src, schema, max_files_per_trigger=1)
    splitter = LateSplitter(os.path.join(scratch, "split"), "ts", "1 hour", "1 day")
    run_available(stream, checkpoint=os.path.join(scratch, "ck"), foreach_batch=splitter, timeout_s=300)
    late, in_time = splitter.late(spark), splitter.in_time(spark)
    ids = sorted(r.event_id for r in late.collect()) + sorted(r.event_id for r in in_time.collect())
    assert sorted(ids) == sorted(r.event_id for r in ev.collect()) and late.count() > 20
    assert dead_letter(late).count() == late.count()                                # with their reason, as D1 takes them
    # Windows over the rows in time lose nothing: they are those of the batch over the same rows, as far as they are closed.
    own = splitter.in_time_stream(spark, schema, maxFilesPerTrigger=1)
    q = run_available(tumbling_metrics(own, "1 day", watermark="1 hour"), checkpoint=os.path.join(scratch, "ck3"), sink="memory",
                      query_name="in_time_w", timeout_s=300)
    dropped = [p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in q.recentProgress if p["stateOperators"]]
    assert dropped and sum(dropped) == 0
    newest = in_time.agg(F.max("ts")).first()[0]
    closed = tumbling_metrics(in_time, "1 day").where(F.col("window_end") <= F.lit(newest - dt.timedelta(hours=1)))
    key = lambda df: sorted((str(r.window_start), r.event_type, r.events, r.total_value) for r in df.collect())
    assert key(spark.table("in_time_w")) == key(closed) != []
    stream_id = late.first().stream
    last = max(r.batch_id for r in in_time.select("batch_id").distinct().collect())
    before = splitter.newest_before(spark, last, stream_id)
    splitter(ev.where(F.col("b") == last).drop("b"), last, stream_id)               # a replay decides alike
    assert splitter.newest_before(spark, last, stream_id) == before
    assert splitter.late(spark).count() + splitter.in_time(spark).count() == ev.count()


def test_without_rows_or_times_nothing_is_late(spark, scratch):
    s = LateSplitter(os.path.join(scratch, "s"), "ts", "10 minutes")
    df = lambda *rows: spark.createDataFrame(list(rows), "id long, ts timestamp_ntz")
    t = dt.datetime(2024, 5, 1, 12)
    s(df(), 0)
    s(df((1, None), (2, t)), 1)
    s(df((3, t - dt.timedelta(minutes=10)), (4, t - dt.timedelta(minutes=9)), (5, None)), 2)
    s(df(), 3)
    s(df((6, t - dt.timedelta(hours=1))), 4)
    assert sorted(r.id for r in s.late(spark).collect()) == [3, 6]
    assert sorted(r.id for r in s.in_time(spark).collect()) == [1, 2, 4, 5]


# ---------------------------------------------------------------- T7, M4
def _files(spark, src, files, rows=5):
    ts = F.timestamp_seconds(F.lit(1_714_500_000) + F.col("id")).cast("timestamp_ntz")
    for i in range(files):
        spark.range(i * rows, (i + 1) * rows).withColumn("ts", ts).coalesce(1).write.mode("append").parquet(src)
    return spark.read.parquet(src).schema


def _settled(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)


def test_a_long_run_holds_a_bounded_number_of_reports(spark, scratch):
    import time
    schema = _files(spark, os.path.join(scratch, "in"), 12)
    log = ProgressLog(os.path.join(scratch, "progress"), flush_every=4)
    most = []
    flush = log.flush
    log.flush = lambda: (most.append(len(log.reports)), flush())
    spark.streams.addListener(log)
    try:
        run_available(file_stream(spark, os.path.join(scratch, "in"), schema, max_files_per_trigger=1),
                      checkpoint=os.path.join(scratch, "ck"), foreach_batch=lambda df, _: df.count(), timeout_s=300)
        _settled(spark)
        for _ in range(100):
            if not log.reports and os.path.isdir(log.path) and spark.read.parquet(log.path).count() >= 12:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    assert log.failure is None and max(most) <= 4
    assert progress_frame(spark, log).where("num_input_rows = 5").count() == 12
    assert progress_frame(spark, log.path).where("trigger_ms > 0").count() >= 12
    short = ProgressLog(keep=2, flush_every=1)
    for k in range(4):
        short.onQueryProgress(type("E", (), {"progress": type("P", (), {"json": json.dumps({"batchId": k})})}))
    assert [r["batchId"] for r in short.reports] == [2, 3] and short.lost == 2
    with pytest.raises(ValueError):
        progress_frame(spark, short)


def test_all_documented_metrics_come_from_a_run_and_one_breaches(spark, scratch):
    from changeflow.streaming import BoundedConsumer, consume_bounded
    src = os.path.join(scratch, "in")
    schema = _files(spark, src, 6, rows=400)
    stream = observe_events(file_stream(spark, src, schema, max_files_per_trigger=1), "ts")
    consumer = BoundedConsumer(lambda df, _: df.count(), 1000)
    q = consume_bounded(stream, consumer, checkpoint=os.path.join(scratch, "ck"), timeout_s=300)
    assert consumer.processed == 1200
    topic = spark.read.parquet(src)
    as_of = F.timestamp_seconds(F.lit(1_714_500_000 + 1199 + 31))
    found = stream_metrics(progress_reports(spark, q), as_of=as_of, messages=topic).unionByName(
        response_metric(timed_reports(spark, {"rows": lambda: topic.groupBy("ts").count()})))
    out = {r.metric: r for r in M.alert_rules(found).collect()}
    assert set(out) == set(M.DEFAULT_RULES)
    assert out["consumer_lag_messages"].value == 1200.0 and out["consumer_lag_messages"].breached
    assert out["cdc_lag_seconds"].value == 31.0 and out["cdc_lag_seconds"].breached
    assert 0 < out["batch_duration_seconds"].value < 300 and 0 < out["query_response_seconds"].value < 300


def test_consumer_lag_from_offsets(spark):
    def report(batch, end, latest, ms, query="q"):
        sources = [{"description": "KafkaV2", "endOffset": end, "latestOffset": latest, "numInputRows": 5}]
        return (query, "r", batch, f"2024-05-01T00:00:0{batch}.000Z",
                json.dumps({"id": query, "batchId": batch, "numInputRows": 5, "durationMs": {"triggerExecution": ms}, "sources": sources}))
    rows = [report(0, {"a": {"0": 1}}, {"a": {"0": 900}}, 90_000), report(1, {"a": {"0": 10, "1": 7}, "b": {"0": 3}},
                                                                         {"a": {"0": 15, "1": 7, "2": 4}, "b": {"0": 2}}, 2_000),
            report(0, {"c": {"0": 5}}, {"c": {"0": 6}}, 1_000, "other"), report(0, {"logOffset": 3}, None, 500, "files")]
    reports = spark.createDataFrame(rows, "query_id string, run_id string, batch_id long, timestamp string, report string")
    got = {r.metric: r.value for r in stream_metrics(reports, last_batches=1).collect()}
    assert got == {"consumer_lag_messages": 10.0, "batch_duration_seconds": 2.0, "cdc_lag_seconds": None}
    nothing = stream_metrics(reports.limit(0)).collect()
    assert len(nothing) == 3 and all(r.value is None for r in nothing)
