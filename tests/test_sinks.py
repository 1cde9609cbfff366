"""Sinks, DDL, partition layout, connector options and the bounded consumer."""

import json
import os

from pyspark.sql import functions as F

from changeflow.operators import cdc as C
from changeflow.operators import insights as I
from changeflow.operators import warehouse as W
from changeflow.sources import fixtures as X
from changeflow.sources.streams import file_stream, kafka_options
from changeflow.streaming import BoundedConsumer, IdempotentParquetAppend, SplitWriter, consume_bounded, run_available
from changeflow.streaming.sinks import kafka_write_options
from conftest import SF0001


def test_idempotent_append_replay(spark, scratch):
    sink = IdempotentParquetAppend(os.path.join(scratch, "wh"))
    batch = spark.range(5).withColumn("x", F.col("id") * 2)
    sink(batch, 0)
    sink(batch, 1)
    sink(batch, 1)                                  # replay after a failure
    got = spark.read.parquet(os.path.join(scratch, "wh"))
    assert got.count() == 10 and got.select("batch_id").distinct().count() == 2


def test_warehouse_append_stream(spark, scratch):
    raw = X.envelope_raw(spark, SF0001)
    raw.write.parquet(os.path.join(scratch, "in"))
    stream = file_stream(spark, os.path.join(scratch, "in"), raw.schema)
    flat = C.accepted(C.flatten_envelope(C.decode_envelope(stream), keep=("event_id",)))
    run_available(flat, checkpoint=os.path.join(scratch, "ck"),
                  foreach_batch=IdempotentParquetAppend(os.path.join(scratch, "wh")), timeout_s=300)
    assert spark.read.parquet(os.path.join(scratch, "wh")).count() == 936


def test_create_tables_and_partitioned_write_prunes(spark, scratch):
    names = W.create_tables(spark, os.path.join(scratch, "tables"))
    assert set(names) == {"order_events", "dim_customers", "daily_order_summary", "orders"}
    assert "processed_date" in spark.table("order_events").columns
    W.create_tables(spark, os.path.join(scratch, "tables"))            # idempotent
    tiers = W.lifecycle_tiers(X.order_lines(spark, SF0001), as_of="latest")
    path = os.path.join(scratch, "orders_by_month")
    W.write_partitioned(tiers, path)
    q = spark.read.parquet(path).where("year = 2001 AND month = 7")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert q.count() == tiers.where("year = 2001 AND month = 7").count() > 0
    for sfx in spark.read.parquet(path).select("tier").distinct().collect():
        assert sfx.tier in ("hot", "warm", "cold")


def test_connector_options():
    o = kafka_options("b:9092", "orders", starting_offsets="earliest", max_offsets_per_trigger=100, group_id="g")
    assert o["startingOffsets"] == "earliest" and o["maxOffsetsPerTrigger"] == "100" and o["kafka.group.id"] == "g"
    w = kafka_write_options("b:9092", "cdc-events")
    assert w["kafka.acks"] == "all" and w["kafka.retries"] == "3"


def test_insights_export(spark, scratch):
    bundle = I.insights_bundle(X.order_lines(spark, SF0001), as_of="latest")
    I.export_insights(bundle, os.path.join(scratch, "insights"))
    doc = json.loads(spark.read.text(os.path.join(scratch, "insights")).collect()[0].value)
    assert set(doc) == {"summary", "top_customers", "top_products", "recent_trend", "status_distribution",
                        "real_time", "recent_anomalies", "generated_at"}
    assert len(doc["top_customers"]) == 5 and doc["summary"]["total_orders"] == 4032
    assert doc["top_customers"][0]["customer_id"] == 10
    vals = [c["total_value"] for c in doc["top_customers"]]
    assert vals == sorted(vals, reverse=True)
    counts = [x["count"] for x in doc["status_distribution"]]
    assert counts == sorted(counts, reverse=True) and len(counts) == 5


def test_bounded_consumer_stops_after_n(spark, scratch):
    raw = X.cdc_raw(spark, SF0001)
    for i in range(5):
        raw.where(F.col("event_id") % 5 == i).coalesce(1).write.mode("append").parquet(os.path.join(scratch, "in"))
    stream = C.accepted(C.payload_records(file_stream(spark, os.path.join(scratch, "in"), raw.schema,
                                                      max_files_per_trigger=1)))
    seen = []

    def handler(df, batch_id):
        n = df.count()
        seen.append(n)
        return n
    consumer = BoundedConsumer(handler, max_messages=200)
    consume_bounded(stream, consumer, checkpoint=os.path.join(scratch, "ck"), timeout_s=300)
    assert consumer.done and 200 <= consumer.processed < 200 + max(seen)
    assert len(seen) < 5


def _numbered_files(spark, path, files, rows):
    for i in range(files):
        spark.range(i * rows, (i + 1) * rows).coalesce(1).write.mode("append").parquet(path)


def test_bounded_consumer_restarted_until_empty_hands_every_row_over_once(spark, scratch):
    src = os.path.join(scratch, "in")
    _numbered_files(spark, src, 12, 10)
    seen, runs = [], 0
    while True:
        stream = file_stream(spark, src, spark.range(1).schema, max_files_per_trigger=1)
        consumer = BoundedConsumer(lambda df, _: (seen.extend(r.id for r in df.collect()), df.count())[1], 25)
        consume_bounded(stream, consumer, checkpoint=os.path.join(scratch, "ck"), timeout_s=300)
        runs += 1
        if not consumer.processed:
            break
        assert consumer.processed <= 30
    assert sorted(seen) == list(range(120)) and runs >= 4


def test_bounded_consumer_stops_at_the_message(spark, scratch):
    """Runs of exactly 25 successes hand every row over once and in order; what fails does not count."""
    import pytest
    src, ledger = os.path.join(scratch, "in"), os.path.join(scratch, "ledger")
    _numbered_files(spark, src, 8, 10)
    seen, runs = [], []

    def handler(df, _):
        rows = [r.id for r in df.collect()]
        seen.extend(rows)
        return sum(x % 7 != 0 for x in rows)
    while True:
        consumer = BoundedConsumer(handler, 25, order_by=["id"], ledger=ledger)
        stream = file_stream(spark, src, spark.range(1).schema, max_files_per_trigger=3)
        consume_bounded(stream, consumer, checkpoint=os.path.join(scratch, "ck"), timeout_s=300)
        runs.append(consumer.processed)
        if not consumer.processed:
            break
    assert seen == list(range(80))
    assert runs == [25, 25, 18, 0]                                   # 68 of 80 succeed
    with pytest.raises(ValueError):
        BoundedConsumer(handler, 1, order_by=["id"])


def test_bounded_consumer_raises_a_failing_handler_and_retries_its_batch(spark, scratch):
    import pytest
    from pyspark.errors import StreamingQueryException
    src = os.path.join(scratch, "in")
    _numbered_files(spark, src, 2, 5)
    stream = file_stream(spark, src, spark.range(1).schema, max_files_per_trigger=1)

    def fails(df, _):
        raise KeyError("no")
    with pytest.raises(StreamingQueryException):
        consume_bounded(stream, BoundedConsumer(fails, 100), checkpoint=os.path.join(scratch, "ck"))
    good = BoundedConsumer(lambda df, _: df.count(), 100)
    consume_bounded(stream, good, checkpoint=os.path.join(scratch, "ck"))
    assert good.processed == 10


def test_running_out_of_time_is_an_error(spark, scratch):
    import time

    import pytest
    src = os.path.join(scratch, "in")
    _numbered_files(spark, src, 1, 5)
    stream = file_stream(spark, src, spark.range(1).schema)
    slow = lambda df, _: time.sleep(8)
    with pytest.raises(TimeoutError):
        run_available(stream, checkpoint=os.path.join(scratch, "ck"), foreach_batch=slow, timeout_s=2)


def test_a_fresh_checkpoint_appends_beside_what_is_stored(spark, scratch):
    schema = spark.range(1).schema
    for k, sink in enumerate((IdempotentParquetAppend(os.path.join(scratch, "a")), )):
        for ck, lo in (("c1", 0), ("c2", 5)):
            src = os.path.join(scratch, f"in{lo}")
            spark.range(lo, lo + 5).write.mode("overwrite").parquet(src)
            for _ in range(2):                         # the second run finds nothing new
                run_available(file_stream(spark, src, schema), checkpoint=os.path.join(scratch, ck), foreach_batch=sink,
                              timeout_s=300)
    assert sorted(r.id for r in spark.read.parquet(os.path.join(scratch, "a")).collect()) == list(range(10))
    split = SplitWriter(os.path.join(scratch, "s"))
    rows = spark.range(3).withColumn("reject_reason", F.when(F.col("id") == 0, "bad"))
    for stream in ("one", "two", "two"):
        split(rows, 0, stream)
    assert spark.read.parquet(os.path.join(scratch, "s")).groupBy("_outcome").count().count() == 2
    assert spark.read.parquet(os.path.join(scratch, "s")).count() == 6


def test_state_keeps_rows_over_a_fresh_checkpoint_and_refuses_unreadable_commits(spark, scratch):
    import pytest
    from changeflow.streaming import CurrentStateWriter, read_current_state
    path = os.path.join(scratch, "st")
    w = CurrentStateWriter(path, key="id", order_by=["seq"], columns=["v"])
    df = lambda *rows: spark.createDataFrame(list(rows), "seq long, id long, op string, v string")
    w(df((1, 1, "c", "a"), (2, 2, "c", "b")), 0, "first")
    w(df((3, 3, "c", "c")), 0, "second")               # batch 0 of another query is not a replay
    w(df((9, 3, "c", "z")), 0, "second")               # this one is
    w(df((4, 2, "d", "b")), 1, "second")
    assert {(r.id, r.v) for r in read_current_state(spark, path).collect()} == {(1, "a"), (3, "c")}
    assert sorted(x for x in os.listdir(path) if x != "_commits") == ["slot=0", "slot=1"]      # old versions make room
    for folder, _, names in os.walk(f"{path}/_commits"):
        for name in names:
            if name.endswith(".parquet"):
                with open(f"{folder}/{name}", "wb") as f:
                    f.write(b"broken")
    with pytest.raises(Exception, match="(?i)parquet|footer|magic"):
        w(df((5, 7, "c", "n")), 2, "second")


def test_changelog_compaction_keeps_the_state(spark, scratch):
    from changeflow.streaming import read_state_changelog
    from changeflow.streaming.state import compact_state_changelog
    log, base = os.path.join(scratch, "log"), os.path.join(scratch, "base")
    sink = IdempotentParquetAppend(log)
    df = lambda *rows: spark.createDataFrame(list(rows), "id long, seq long, op string, v string")
    sink(df((1, 1, "c", "a"), (2, 2, "c", "b")), 0)
    sink(df((1, 3, "d", "a"), (2, 4, "u", "B")), 1)
    compact_state_changelog(spark, log, base, "id", ["seq"])
    assert spark.read.parquet(base).count() == 2                    # the tombstone stays
    sink(df((1, 2, "u", "late"), (3, 5, "c", "n")), 2)
    state = {(r.id, r.v) for r in read_state_changelog(spark, [base, log], "id", ["seq"]).collect()}
    assert state == {(2, "B"), (3, "n")}
    plan = read_state_changelog(spark, [base, log], "id", ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "batch_id" in plan.split("PartitionFilters: [", 2)[2].split("Location")[0]    # compacted batches are not read
    newer = os.path.join(scratch, "newer")
    compact_state_changelog(spark, [base, log], newer, "id", ["seq"])
    sink(df((1, 1, "c", "a"), (2, 2, "c", "b")), 0)                 # an old batch that is no longer what it was
    got = read_state_changelog(spark, [newer, log], "id", ["seq"]).collect()
    assert {(r.id, r.v) for r in got} == {(2, "B"), (3, "n")}
    import shutil
    shutil.rmtree(os.path.join(log, "stream=manual", "batch_id=0"))
    assert {(r.id, r.v) for r in read_state_changelog(spark, [newer, log], "id", ["seq"]).collect()} == {(2, "B"), (3, "n")}


def test_snapshot_writer_keeps_a_bounded_number_of_files(spark, scratch):
    from changeflow.streaming import CurrentStateWriter, read_current_state
    path = os.path.join(scratch, "st")
    w = CurrentStateWriter(path, key="id", order_by=["seq"], columns=["v"])
    sizes = []
    for k in range(9):
        w(spark.createDataFrame([(k, k % 3, "c", f"v{k}")], "seq long, id long, op string, v string").coalesce(1), k, f"q{k // 5}")
        sizes.append(sum(len([x for x in names if x.endswith(".parquet")]) for _, _, names in os.walk(f"{path}/_commits")))
    assert sizes == [1] + [2] * 8
    assert {(r.id, r.v) for r in read_current_state(spark, path).collect()} == {(0, "v6"), (1, "v7"), (2, "v8")}


def test_order_events_replay_over_midnight_and_catalog(spark, scratch):
    path = os.path.join(scratch, "tables")
    spark.sql("CREATE DATABASE IF NOT EXISTS wh_test")
    for t in W.create_tables(spark, path, "wh_test"):
        spark.sql(f"DROP TABLE {t}")
    W.create_tables(spark, path, "wh_test")
    flat = C.decode_flat(X.flat_raw(spark, SF0001))
    sink = W.OrderEventsSink(os.path.join(path, "order_events"), "wh_test.order_events")
    n = C.accepted(W.load_order_events(flat)).count()
    for day in ("2024-03-01 23:59:59", "2024-03-02 00:00:01"):       # the replay runs on the next day
        sink(W.load_order_events(flat, F.lit(day).cast("timestamp")), 0, "q")
    facts = os.path.join(path, "order_events")
    table = W.read_order_events(spark, facts)
    assert table.count() == n > 0
    assert [str(r[0]) for r in table.select("processed_date").distinct().collect()] == ["2024-03-02"]
    sink(W.load_order_events(flat, F.lit("2024-03-02 01:00:00").cast("timestamp")), 0, "another")
    assert W.read_order_events(spark, facts).count() == 2 * n
    plan = W.daily_stats(W.read_order_events(spark, facts), day="latest")._jdf.queryExecution().executedPlan().toString()
    assert any("processed_date" in x.split("]")[0] for x in plan.split("PartitionFilters: [")[1:])
    assert W.daily_stats(W.read_order_events(spark, facts), day="latest").first().total_events == 2 * n
    assert W.compact_order_events(spark, facts, "wh_test.order_events") == {}          # both may still be replayed
    for q in ("q", "another"):
        sink(W.load_order_events(flat, F.lit("2024-03-03 01:00:00").cast("timestamp")), 1, q)
    assert W.compact_order_events(spark, facts, "wh_test.order_events") == {"q": 0, "another": 0}
    assert spark.table("wh_test.order_events").count() == 2 * n and W.read_order_events(spark, facts).count() == 4 * n
    assert [r[0] for r in spark.sql("SHOW PARTITIONS wh_test.order_events").collect()] == ["processed_date=2024-03-02"]
    plan = W.daily_stats(spark.table("wh_test.order_events"), day="latest")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "processed_date" in plan.split("PartitionFilters")[1].split("]")[0]
    assert W.daily_stats(spark.table("wh_test.order_events"), day="latest").first().total_events == 2 * n


def test_export_insights_records_and_raises_a_failure(spark, scratch):
    import pytest
    path = os.path.join(scratch, "doc")
    bad = spark.range(1).select(F.raise_error(F.lit("boom " * 600)).alias("summary"))
    with pytest.raises(Exception, match="boom"):
        I.export_insights(bad, path)
    assert json.loads(spark.read.text(path).first().value)["error"].count("boom") >= 600


def test_daily_stats_pushes_down_on_stored_events(spark, scratch):
    from changeflow.sources.fixtures import flat_raw
    loaded = C.accepted(W.load_order_events(C.decode_flat(flat_raw(spark, SF0001)),
                                            processed_at=F.col("event_time").cast("timestamp")))
    path = os.path.join(scratch, "order_events")
    (loaded.withColumn("processed_date", F.to_date("processed_at"))
     .write.partitionBy("processed_date").parquet(path))
    stored = spark.read.parquet(path)
    q = W.daily_stats(stored, day="2024-01-30")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(processed_date" in plan
    assert "GreaterThanOrEqual(processed_at," in plan          # bare column reaches the reader
    got = q.collect()[0]
    ref = W.daily_stats(loaded, day="2024-01-30").collect()[0]
    assert (got.total_events, got.unique_orders, got.total_revenue) == (ref.total_events, ref.unique_orders,
                                                                         ref.total_revenue) and got.total_events > 0


def test_order_events_append_replay_and_daily_summary_overwrite(spark, scratch):
    from changeflow.operators import analytics as A
    from changeflow.sources.fixtures import flat_raw
    loaded = W.load_order_events(C.decode_flat(flat_raw(spark, SF0001)),
                                 processed_at=F.col("event_time").cast("timestamp"))
    path = os.path.join(scratch, "order_events")
    W.append_order_events(loaded, path, batch_id=7)
    W.append_order_events(loaded, path, batch_id=7)              # replay
    stored = W.read_order_events(spark, path)
    assert stored.count() == C.accepted(loaded).count()
    assert {"processed_date", "batch_id"} <= set(stored.columns)
    orders = X.order_lines(spark, SF0001).where("order_date >= timestamp_ntz'2001-01-01 00:00:00'")
    spath = os.path.join(scratch, "summary")
    W.write_daily_summary(A.daily_order_summary(orders), spath)
    before = spark.read.parquet(spath).count()
    last_day = A.daily_order_summary(orders).where("summary_date = date'2001-08-01'")
    W.write_daily_summary(last_day, spath)                         # recompute one day only
    after = spark.read.parquet(spath)
    assert after.count() == before and after.where("summary_date = date'2001-08-01'").count() == 1


def test_json_lines_writer_counts(spark, scratch):
    from changeflow.operators.quality import json_lines
    from changeflow.streaming.sinks import write_json_lines
    good = C.accepted(C.payload_records(X.cdc_raw(spark, SF0001)))
    n = write_json_lines(good.select("event_id", "id", "price"), os.path.join(scratch, "jl"))
    assert n == 763 == spark.read.json(os.path.join(scratch, "jl")).count()
    docs = json_lines(good).select("json").collect()
    assert len(docs) == 763 and all(json.loads(r.json)["_pipeline_version"] == "1.0.0" for r in docs)
