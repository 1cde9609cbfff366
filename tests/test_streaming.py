"""Streams over file sources (offline twins of topics), checked against the batch results."""

import os

import pytest
from pyspark.sql import functions as F

from changeflow.operators import cdc as C
from changeflow.sources import fixtures as X
from changeflow.sources.streams import file_stream
from changeflow.sources.tables import read_table
from changeflow.streaming import (CurrentStateWriter, SplitWriter, progress_frame, read_current_state,
                                  run_available, tumbling_metrics)
from changeflow.streaming.windows import session_metrics
from conftest import SF0001


def _as_files(df, path, n):
    # n files written one after another in event order, as a topic delivers them
    # (the file source reads files in modification-time order).
    lo_hi = df.agg(F.min("event_id"), F.max("event_id")).collect()[0]
    step = (lo_hi[1] - lo_hi[0]) // n + 1
    for i in range(n):
        lo = lo_hi[0] + i * step
        part = df.where((F.col("event_id") >= lo) & (F.col("event_id") < lo + step))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def test_payload_stream_split_equals_batch(spark, scratch):
    raw = X.cdc_raw(spark, SF0001)
    src = _as_files(raw, os.path.join(scratch, "in"), 5)
    stream = file_stream(spark, src, raw.schema, max_files_per_trigger=1)
    out = os.path.join(scratch, "out")
    q = run_available(C.payload_records(stream), checkpoint=os.path.join(scratch, "ck"),
                      foreach_batch=SplitWriter(out), timeout_s=300)
    got = spark.read.parquet(out)
    assert got.select("batch_id").distinct().count() == 5          # one file per micro-batch
    assert got.where("_outcome = 'accepted'").count() == 763
    assert got.where("_outcome = 'rejected'").count() == 237
    assert progress_frame(spark, q).count() >= 5


def test_progress_log_keeps_what_the_query_forgets(spark, scratch):
    from changeflow.streaming import ProgressLog
    src = os.path.join(scratch, "in")
    for i in range(6):
        spark.range(i, i + 1).coalesce(1).write.mode("append").parquet(src)
    log = ProgressLog()
    spark.streams.addListener(log)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        q = run_available(file_stream(spark, src, spark.range(1).schema, max_files_per_trigger=1),
                          checkpoint=os.path.join(scratch, "ck"), foreach_batch=lambda df, _: df.count(), timeout_s=300)
        with pytest.raises(ValueError):
            progress_frame(spark, q)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        import time
        for _ in range(50):
            if len(log.reports) >= 6:
                break
            time.sleep(0.2)
        assert progress_frame(spark, log).where("num_input_rows = 1").count() == 6
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        spark.streams.removeListener(log)


def test_windowed_stream_matches_closed_batch_windows(spark, scratch):
    ev = read_table(spark, SF0001, "events")
    src = _as_files(ev, os.path.join(scratch, "ev"), 6)
    stream = file_stream(spark, src, ev.schema, max_files_per_trigger=1)
    agg = tumbling_metrics(stream, "1 day", watermark="10 minutes")
    run_available(agg, checkpoint=os.path.join(scratch, "ck"), sink="memory", query_name="daily_w",
                  output_mode="append", timeout_s=300)
    streamed = spark.table("daily_w")
    max_ts = ev.agg(F.max("ts")).collect()[0][0]
    batch = tumbling_metrics(ev, "1 day").where(F.col("window_end") <= F.lit(max_ts) - F.expr("INTERVAL 10 MINUTES"))
    assert streamed.count() == 145
    s = {(r.window_start.date(), r.event_type): (r.events, r.total_value) for r in streamed.collect()}
    b = {(r.window_start.date(), r.event_type): (r.events, r.total_value) for r in batch.collect()}
    assert s == b


def test_late_rows_are_dropped_and_duplicates_removed(spark, scratch):
    ev = read_table(spark, SF0001, "events").select("event_id", "ts", "user_id", "event_type", "value")
    src = os.path.join(scratch, "ev")
    ev.where("ts < timestamp_ntz'2024-01-05 00:00:00'").write.mode("overwrite").parquet(src + "/a")
    ev.where("ts >= timestamp_ntz'2024-01-05 00:00:00'").write.mode("overwrite").parquet(src + "/b")
    # a re-delivered copy and a late copy from day 1, written after the watermark moved on
    ev.where("event_id % 10 = 0 and ts >= timestamp_ntz'2024-01-05 00:00:00'").write.mode("overwrite").parquet(src + "/c")
    ev.where("ts < timestamp_ntz'2024-01-02 00:00:00'").write.mode("overwrite").parquet(src + "/d")
    stream = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    dedup = C.dedup_events(stream, ["event_id"], ts_col="ts", watermark="1 hour")
    run_available(dedup, checkpoint=os.path.join(scratch, "ck"), sink="memory", query_name="dedup_out",
                  timeout_s=300)
    got = spark.table("dedup_out")
    assert got.count() == got.select("event_id").distinct().count() == ev.count()
    with pytest.raises(ValueError):
        C.dedup_events(stream, ["event_id"])


def test_current_state_stream_restart_and_replay(spark, scratch):
    raw = X.envelope_raw(spark, SF0001)
    src = _as_files(raw, os.path.join(scratch, "in"), 4)
    flat = C.accepted(C.flatten_envelope(C.decode_envelope(file_stream(spark, src, raw.schema,
                                                                         max_files_per_trigger=1)),
                                         keep=("event_id",))).drop("processed_at")
    state_path = os.path.join(scratch, "state")
    writer = CurrentStateWriter(state_path, key="order_id", order_by=["event_id"], op_col="operation",
                                columns=["status", "total_amount", "event_id"])
    ck = os.path.join(scratch, "ck")
    run_available(flat, checkpoint=ck, foreach_batch=writer, timeout_s=300)
    live = read_current_state(spark, state_path, op_col="operation")
    assert live.count() == 165
    # a restart from the checkpoint finds nothing new
    run_available(flat, checkpoint=ck, foreach_batch=writer, timeout_s=300)
    assert read_current_state(spark, state_path, op_col="operation").count() == 165
    # a replayed batch id is skipped
    writer(spark.createDataFrame([], flat.schema), 0)
    batch = C.current_state(C.accepted(C.flatten_envelope(C.decode_envelope(raw), keep=("event_id",))),
                            "order_id", ["event_id"], op_col="operation", columns=["status", "event_id"])
    assert {(r.order_id, r.status) for r in live.collect()} == {(r.order_id, r.status) for r in batch.collect()}


def test_session_split_is_exact(spark):
    ev = read_table(spark, SF0001, "events")
    a = session_metrics(ev, "30 minutes", split_seconds=86_400)
    b = session_metrics(ev, "30 minutes", split_seconds=600)           # many slice borders
    cols = ["user_id", "session_start", "session_end", "events", "total_value"]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())


def test_daily_order_summary_stream_matches_batch(spark, scratch):
    from changeflow.operators import analytics as A
    from changeflow.streaming.windows import order_window_metrics
    orders = X.order_lines(spark, SF0001).where("order_date >= timestamp_ntz'2001-01-01 00:00:00'")
    days = [r[0] for r in orders.select(F.to_date("order_date")).distinct().orderBy(1).collect()]
    src = os.path.join(scratch, "orders")
    k = len(days) // 3
    for lo, hi in ((0, k), (k, 2 * k), (2 * k, len(days))):     # delivered in time order
        part = orders.where(F.to_date("order_date").between(days[lo], days[hi - 1]))
        part.coalesce(1).write.mode("append").parquet(src)
    stream = file_stream(spark, src, orders.schema, max_files_per_trigger=1)
    run_available(order_window_metrics(stream, "1 day", watermark="1 hour"), checkpoint=os.path.join(scratch, "ck"),
                  sink="memory", query_name="daily_orders_s", timeout_s=300)
    streamed = {r.window_start.date(): (r.total_orders, r.total_revenue) for r in spark.table("daily_orders_s").collect()}
    batch = {r.summary_date: (r.total_orders, r.total_revenue) for r in A.daily_order_summary(orders).collect()}
    assert streamed and len(streamed) == len(batch) - 1          # the newest day is still open
    assert all(batch[d] == v for d, v in streamed.items())


def test_console_sink_bounded_run(spark, scratch):
    ev = read_table(spark, SF0001, "events").limit(5)
    ev.write.parquet(os.path.join(scratch, "in"))
    q = run_available(file_stream(spark, os.path.join(scratch, "in"), ev.schema),
                      checkpoint=os.path.join(scratch, "ck"), sink="console", timeout_s=120)
    assert not q.isActive and q.lastProgress["numInputRows"] == 5


def test_state_touch_column(spark, scratch):
    df = spark.createDataFrame([(1, 10, "c", "a"), (2, 10, "u", "b")], "seq long, id long, op string, status string")
    w = CurrentStateWriter(os.path.join(scratch, "st"), key="id", order_by=["seq"], columns=["status"],
                           touch_col="updated_at")
    w(df, 0)
    r = read_current_state(spark, os.path.join(scratch, "st")).collect()
    assert len(r) == 1 and r[0].status == "b" and r[0].updated_at is not None


def test_state_store_updates_changelog(spark, scratch):
    from changeflow.streaming import IdempotentParquetAppend, read_state_changelog, state_updates
    raw = X.envelope_raw(spark, SF0001)
    src = _as_files(raw, os.path.join(scratch, "in"), 4)
    flat = C.accepted(C.flatten_envelope(C.decode_envelope(file_stream(spark, src, raw.schema,
                                                                         max_files_per_trigger=1)),
                                         keep=("event_id",))).drop("processed_at")
    upd = state_updates(flat, "order_id", ["event_id"], op_col="operation", columns=["status", "event_id"])
    log = os.path.join(scratch, "log")
    q = run_available(upd, checkpoint=os.path.join(scratch, "ck"), output_mode="update",
                      foreach_batch=IdempotentParquetAppend(log), timeout_s=300)
    emitted = spark.read.parquet(log)
    assert emitted.select("batch_id").distinct().count() == 4
    live = read_state_changelog(spark, log, "order_id", ["event_id"], op_col="operation")
    assert live.count() == 165
    ops = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert ops and ops[-1]["numRowsTotal"] == 200          # one state row per key, tombstones included


def test_state_is_read_from_the_state_store(spark, scratch):
    """Equal to the batch state after each run, after a restart without news, and after a batch that ran twice."""
    from changeflow.streaming import maintain_state, read_state
    raw = X.envelope_log_raw(spark, SF0001)
    src, ck = os.path.join(scratch, "in"), os.path.join(scratch, "ck")
    columns = ["status", "total_amount", "change_type", "event_id"]

    def flat(df):
        return C.accepted(C.flatten_envelope(C.decode_envelope(df), keep=("event_id",), position=True)).drop("processed_at")

    def run():
        stream = flat(file_stream(spark, src, raw.schema, max_files_per_trigger=2))
        return maintain_state(stream, "order_id", list(C.LOG_ORDER), checkpoint=ck, op_col="operation", columns=columns,
                              timeout_s=300)

    def rows(df):
        return sorted(map(tuple, df.select("order_id", *columns).collect()))

    def batch(**kw):
        return C.current_state(flat(spark.read.parquet(src)), "order_id", list(C.LOG_ORDER), op_col="operation",
                               columns=columns, **kw)

    _as_files(raw.where("event_id < 600"), src, 3)
    run()
    first = rows(batch())
    assert rows(read_state(spark, ck, "order_id", op_col="operation")) == first
    _as_files(raw.where("event_id >= 600"), src, 3)
    run()
    run()                                                            # a restart finds nothing new
    assert rows(read_state(spark, ck, "order_id", op_col="operation")) == rows(batch()) != first
    commits = sorted(int(x) for x in os.listdir(os.path.join(ck, "commits")) if x.isdigit())
    for name in (str(commits[-1]), f".{commits[-1]}.crc"):           # as if the last batch had not been committed
        if os.path.exists(os.path.join(ck, "commits", name)):
            os.remove(os.path.join(ck, "commits", name))
    run()
    assert rows(read_state(spark, ck, "order_id", op_col="operation")) == rows(batch())
    everything = read_state(spark, ck, "order_id", op_col="operation", keep_tombstones=True)
    assert everything.count() == 200 and rows(read_state(spark, ck, "order_id", op_col="operation", batch_id=1)) == first
    # A snapshot row that arrives last and was read before a key's change does not win.
    late = [r for r in batch().select("order_id", "change_type", "event_id").collect() if r.change_type != "SNAPSHOT"]
    newest = dict(flat(spark.read.parquet(src)).groupBy("order_id").agg(F.max("event_id")).collect())
    assert any(newest[r.order_id] > r.event_id for r in late)
    plan = everything._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan


def test_session_stream_matches_closed_batch_sessions(spark, scratch):
    ev = read_table(spark, SF0001, "events").select("event_id", "ts", "user_id", "value")
    src = _as_files(ev, os.path.join(scratch, "ev"), 4)
    stream = file_stream(spark, src, ev.schema, max_files_per_trigger=1)
    sessions = session_metrics(stream, "30 minutes", watermark="10 minutes")
    run_available(sessions, checkpoint=os.path.join(scratch, "ck"), sink="memory", query_name="sess_s",
                  output_mode="append", timeout_s=300)
    streamed = {(r.user_id, str(r.session_start)[:26]): (r.events, r.total_value)
                for r in spark.table("sess_s").collect()}
    max_ts = ev.agg(F.max("ts")).collect()[0][0]
    closed = session_metrics(ev, "30 minutes").where(
        F.col("session_end") <= F.lit(max_ts) - F.expr("INTERVAL 10 MINUTES"))
    batch = {(r.user_id, str(r.session_start)[:26]): (r.events, r.total_value) for r in closed.collect()}
    assert streamed and set(batch) <= set(streamed)
    assert all(streamed[k] == v for k, v in batch.items())
    assert len(streamed) - len(batch) <= ev.select("user_id").distinct().count()   # only still-open tails differ


def test_sliding_stream_matches_closed_batch_windows(spark, scratch):
    from changeflow.streaming.windows import sliding_metrics
    ev = read_table(spark, SF0001, "events")
    src = _as_files(ev, os.path.join(scratch, "ev"), 4)
    stream = file_stream(spark, src, ev.schema, max_files_per_trigger=1)
    run_available(sliding_metrics(stream, "2 hours", "1 hour", watermark="10 minutes"),
                  checkpoint=os.path.join(scratch, "ck"), sink="memory", query_name="slide_s", timeout_s=300)
    streamed = {(str(r.window_start)[:19], r.event_type): (r.events, r.total_value)
                for r in spark.table("slide_s").collect()}
    max_ts = ev.agg(F.max("ts")).collect()[0][0]
    closed = sliding_metrics(ev, "2 hours", "1 hour").where(
        F.col("window_end") <= F.lit(max_ts) - F.expr("INTERVAL 10 MINUTES"))
    batch = {(str(r.window_start)[:19], r.event_type): (r.events, r.total_value) for r in closed.collect()}
    assert batch and streamed == batch


def test_flat_stream_loads_order_events_like_batch(spark, scratch):
    from changeflow.operators import warehouse as W
    raw = X.flat_raw(spark, SF0001)
    src = _as_files(raw, os.path.join(scratch, "in"), 3)
    stream = C.decode_flat(file_stream(spark, src, raw.schema, max_files_per_trigger=1))
    loaded = W.load_order_events(stream, processed_at=F.col("event_time").cast("timestamp"))
    path = os.path.join(scratch, "order_events")
    ck = os.path.join(scratch, "ck")
    run_available(loaded, checkpoint=ck, foreach_batch=lambda df, bid: W.append_order_events(df, path, bid),
                  timeout_s=300)
    run_available(loaded, checkpoint=ck, foreach_batch=lambda df, bid: W.append_order_events(df, path, bid),
                  timeout_s=300)                                   # restart: nothing is loaded twice
    stored = W.read_order_events(spark, path)
    batch = C.accepted(W.load_order_events(C.decode_flat(raw), processed_at=F.col("event_time").cast("timestamp")))
    assert stored.count() == batch.count() > 0
    cols = ["event_id", "order_id", "customer_id", "unit_price", "total_amount", "status", "event_type"]
    assert sorted(stored.select(cols).collect()) == sorted(batch.select(cols).collect())
