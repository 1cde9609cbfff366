"""Values beyond a column's type become rejects or counts; neither a batch nor a stream stops at them."""

import json
import os

import pytest
from pyspark.sql import functions as F

from changeflow.functions.cdc import parse_event_time
from changeflow.operators import cdc as C
from changeflow.operators import warehouse as W
from changeflow.sources.streams import file_stream
from changeflow.streaming import SplitWriter, run_available
from changeflow.streaming.windows import session_metrics, sliding_metrics, tumbling_metrics

RECORD = {"order_id": 1, "customer_id": 2, "product_name": "p", "quantity": 2, "unit_price": 2.5,
          "order_date": "2024-01-01", "status": "s"}
FLAT = [RECORD, RECORD | {"quantity": 2_000_000_000, "unit_price": 99_999_999.99},
        RECORD | {"quantity": 100, "unit_price": 99_999_999.99}, RECORD | {"quantity": 101, "unit_price": 99_999_999.99},
        RECORD | {"quantity": 3_000_000_000}, RECORD | {"unit_price": 1e30}, RECORD | {"order_date": "9" * 19},
        RECORD | {"timestamp": "8" * 18}]
REASONS = [None, "out_of_range:total_amount", None, "out_of_range:total_amount", "null:quantity", "null:unit_price",
           "null:order_date", "null:source_timestamp"]


def raw(spark, records):
    rows = [(k, "2024-01-01 00:00:00", json.dumps(r)) for k, r in enumerate(records)]
    return spark.createDataFrame(rows, "event_id long, ts string, value string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_large_amounts_are_rejects(spark):
    out = W.load_order_events(C.decode_flat(raw(spark, FLAT))).orderBy("event_id").collect()
    assert [r.reject_reason for r in out] == REASONS
    assert str(out[2].total_amount) == "9999999999.00" and out[1].total_amount is None


def test_a_stream_goes_on_after_large_amounts(spark, scratch):
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    for k in range(len(FLAT)):
        raw(spark, FLAT).where(F.col("event_id") == k).coalesce(1).write.mode("append").parquet(src)
    stream = C.decode_flat(file_stream(spark, src, raw(spark, FLAT).schema, max_files_per_trigger=2))
    run_available(W.load_order_events(stream), checkpoint=os.path.join(scratch, "ck"), foreach_batch=SplitWriter(out), timeout_s=300)
    got = {r.event_id: r.reject_reason for r in spark.read.parquet(out).collect()}
    assert got == dict(enumerate(REASONS))


@pytest.mark.parametrize("unit,last", [("seconds", 253402300799), ("millis", 253402300799999), ("micros", 253402300799999999)])
def test_epoch_numbers_have_a_range(spark, unit, last):
    texts = [str(last), str(last + 1), "9" * 16, "-" + "9" * 18, "9" * 19, "9" * 30, "12345", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.t is not None for r in df.select(parse_event_time(F.col("s"), unit).alias("t")).collect()]
    assert got == [True, False, unit == "micros", False, False, False, True, False]


@pytest.mark.parametrize("unit", ["seconds", "millis", "micros"])
def test_epoch_numbers_beyond_it_are_rejects(spark, unit):
    def event(created):
        image = {"id": 1, "customer_name": "n", "total_amount": "Jw8=", "status": "s", "created_at": created, "updated_at": "2024-01-01"}
        return {"after": image, "op": "c", "ts_ms": "1", "source": {"lsn": 1}}
    events = [event("1" * 5), event("9" * 18), event("9" * 25), event("soon"), event(None)]
    out = C.flatten_envelope(C.decode_envelope(raw(spark, events)), keep=("event_id",), epoch_unit=unit)
    got = [r.reject_reason for r in out.orderBy("event_id").collect()]
    assert got == [None, "out_of_range:created_at", "out_of_range:created_at", None, None]


def test_loader_reads_epoch_numbers_in_the_records_unit(spark):
    flat = C.decode_flat(raw(spark, [RECORD | {"order_date": "1704067200000"}]))
    assert str(W.load_order_events(flat, epoch_unit="millis").first().order_date) == "2024-01-01 00:00:00"


def test_windows_count_what_does_not_fit(spark, scratch):
    rows = [(0, 1, "a", 1.5), (1, 1, "a", 5e10), (2, 1, "a", 1e30), (3, 1, "a", float("nan")), (4, 1, "a", None), (5, 1, "a", -1e300)]
    ev = spark.createDataFrame(rows, "s long, user_id long, event_type string, value double").withColumn(
        "ts", F.timestamp_seconds(F.col("s") + 1_700_000_000).cast("timestamp_ntz")).drop("s")
    for out in (tumbling_metrics(ev, "1 hour"), session_metrics(ev, "30 minutes"), sliding_metrics(ev, "1 hour", "1 hour")):
        r = out.collect()
        assert [(x.events, x.total_value, x.unfit_values) for x in r] == [(6, 5e10 + 1.5, 3)]
    ev.coalesce(1).write.parquet(os.path.join(scratch, "in"))
    stream = file_stream(spark, os.path.join(scratch, "in"), ev.schema)
    run_available(tumbling_metrics(stream, "1 hour", watermark="1 minute"), checkpoint=os.path.join(scratch, "ck"),
                  sink="memory", query_name="unfit_w", output_mode="complete", timeout_s=300)
    assert [(r.total_value, r.unfit_values) for r in spark.table("unfit_w").collect()] == [(5e10 + 1.5, 3)]
