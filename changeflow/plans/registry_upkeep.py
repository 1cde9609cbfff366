"""Queries over what the library keeps up to date beside the data: moments, sketches, late rows, metrics of runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeflow.operators import analytics as A
from changeflow.operators import cdc as C
from changeflow.operators import metrics as M
from changeflow.operators import moments as MO
from changeflow.operators import sketches as SK
from changeflow.plans import oracle_sql as O
from changeflow.plans import oracle_upkeep as OU
from changeflow.plans.registry import register
from changeflow.session import scratch_path
from changeflow.sources import fixtures as X
from changeflow.sources.streams import file_stream
from changeflow.streaming import BoundedConsumer, LateSplitter, consume_bounded, observe_events, progress, timed_reports


@register("anomalies_from_moments", O.detect_anomalies(1.0, 90, 30))
def _anomalies_from_moments(spark, d):
    """The statistics come from stored rows of days; the orders of those days are read once, to make them."""
    orders, path = X.order_lines(spark, d), scratch_path(spark, "moments")
    MO.daily_moments(orders).write.parquet(path)
    return MO.detect_anomalies_from(spark.read.parquet(path), orders, 1.0, stats_days=90, candidate_days=30,
                                    as_of=X.latest_order_time(spark, d))


RANGES = [("1995-01-01", "1995-01-07"), ("1995-01-01", "1995-03-31"), ("1995-06-15", "1995-06-15"), ("1994-07-01", "1997-06-30"),
          ("1900-01-01", "2100-12-31")]


@register("customers_by_range", OU.customers_by_range(RANGES))
def _customers_by_range(spark, d):
    """Estimates from stored sketches, held against the exact counts of the same ranges."""
    orders, path = X.order_lines(spark, d), scratch_path(spark, "sketches")
    SK.write_sketches(SK.daily_sketches(orders), path)
    found = SK.customers_by_range(spark.read.parquet(path), RANGES)
    exact = orders.where(F.col("status") != "cancelled")
    spans = F.array(*[F.struct(F.lit(a).cast("date").alias("first_day"), F.lit(b).cast("date").alias("last_day")) for a, b in RANGES])
    day = F.to_date("order_date")
    held = exact.select(F.inline(F.filter(spans, lambda r: (r["first_day"] <= day) & (day <= r["last_day"]))), "customer_id")
    counts = held.groupBy("first_day", "last_day").agg(F.count_distinct("customer_id").alias("exact_customers"))
    return found.join(counts, ["first_day", "last_day"]).select(
        "first_day", "last_day", "total_orders", "total_revenue", "exact_customers",
        F.col("exact_customers").between(F.col("customers_low"), F.col("customers_high")).alias("within_error"))


@register("late_rows", OU.late_rows())
def _late_rows(spark, d):
    """Events that arrive in batches of eight days, every 13th two batches late, through the splitter."""
    ev = X.events(spark, d).select("event_id", "ts", "event_type").withColumn("arrival", F.expr(OU.ARRIVAL))
    splitter = LateSplitter(scratch_path(spark, "late"), "ts", "1 hour", "1 day")
    for k in sorted(r[0] for r in ev.select("arrival").distinct().collect()):
        splitter(ev.where(F.col("arrival") == k), k)
    late = splitter.late(spark).select("event_id", "reject_reason", F.col("watermark").cast("timestamp_ntz").alias("watermark"))
    return splitter.in_time(spark).select("event_id", F.lit(None).cast("string").alias("reject_reason"),
                                          F.lit(None).cast("timestamp_ntz").alias("watermark")).unionByName(late)


@register("alert_metrics", OU.alert_metrics())
def _alert_metrics(spark, d):
    """The documented metrics out of a bounded run that leaves messages behind, and of a timed report.

    The two durations are told by whether they were measured, and judged by an hour, as their values differ from run to run.
    """
    raw, src = X.cdc_raw(spark, d), scratch_path(spark, "topic")
    for k in range(5):
        raw.where(F.col("event_id") % 5 == k).coalesce(1).write.mode("append").parquet(src)
    stream = observe_events(C.payload_records(file_stream(spark, src, raw.schema, max_files_per_trigger=1)), "ts")
    consumer = BoundedConsumer(lambda df, _: df.write.format("noop").mode("append").save() or 1, max_messages=3)
    query = consume_bounded(stream, consumer, checkpoint=scratch_path(spark, "topic-checkpoint"))
    topic = spark.read.parquet(src)
    table = scratch_path(spark, "progress")
    progress.progress_reports(spark, query).write.parquet(table)
    reports = progress.progress_reports(spark, table)
    newest = topic.select(F.max("ts")).scalar()
    measured = progress.stream_metrics(reports, as_of=newest, messages=topic).unionByName(
        progress.response_metric(timed_reports(spark, {"order_summary": lambda: A.order_summary(X.order_lines(spark, d))})))
    rules = M.DEFAULT_RULES | {"batch_duration_seconds": 3600.0, "query_response_seconds": 3600.0}
    steady = F.col("metric").isin("cdc_lag_seconds", "consumer_lag_messages")
    return M.alert_rules(measured, rules).select("metric", F.when(steady, F.col("value")).alias("value"), "threshold",
                                                 (F.col("value") > 0).alias("measured"), "breached")
