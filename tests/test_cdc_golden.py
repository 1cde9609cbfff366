"""Golden values of the reference's unit tests, re-checked on the Spark operators."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from changeflow.functions.cdc import decode_decimal_base64
from changeflow.operators import cdc as C


def _raw(spark, values):
    rows = [(i, v if v is None or isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "event_id long, value string").withColumn("ts", F.localtimestamp())


def _one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


ORDER = {"id": 1001, "customer_id": 1, "product_id": "PROD001", "quantity": 2, "price": 99.99,
         "order_date": "2024-01-15", "status": "pending"}


def test_parse_create_update_delete(spark):
    evs = [{"payload": {"op": "c", "after": ORDER}},
           {"payload": {"op": "u", "after": dict(ORDER, status="confirmed")}},
           {"payload": {"op": "d", "before": {"id": 1001, "customer_id": 1, "product_id": "PROD001"}}}]
    out = C.payload_records(_raw(spark, evs)).orderBy("event_id").collect()
    assert [r.reject_reason for r in out] == [None, None, None]
    assert [r._cdc_operation for r in out] == ["c", "u", "d"]
    assert [r._deleted for r in out] == [False, False, True]
    assert out[1].status == "confirmed"
    assert out[0].total_amount == 199.98          # 2 × 99.99
    assert out[2].total_amount is None            # no price / quantity keys on the delete
    assert out[0]._pipeline_version == "1.0.0" and out[0]._processed is True


def test_invalid_and_unsupported_are_rejected_not_lost(spark):
    evs = ["invalid json", {"op": "c"}, {"payload": {"op": "r", "after": ORDER}},
           {"payload": {"op": "c", "after": {}}}, None, {"payload": None}]
    out = C.payload_records(_raw(spark, evs)).orderBy("event_id").collect()
    assert [r.reject_reason for r in out] == ["malformed_json", "no_payload", "unsupported_op",
                                              "empty_image", "null_value", "no_payload"]


def test_required_fields(spark):
    no_id = {k: v for k, v in ORDER.items() if k != "id"}
    null_cust = dict(ORDER, customer_id=None)
    out = C.payload_records(_raw(spark, [{"payload": {"op": "c", "after": no_id}},
                                         {"payload": {"op": "c", "after": null_cust}}])).orderBy("event_id")
    assert [r.reject_reason for r in out.collect()] == ["missing_field:id", "missing_field:customer_id"]


def test_coercion_defaults(spark):
    cases = [dict(ORDER, price="invalid"), dict(ORDER, price=None), dict(ORDER, quantity="x"),
             dict(ORDER, quantity=2.7), dict(ORDER, quantity="5"), dict(ORDER, quantity="2.7"),
             {k: v for k, v in ORDER.items() if k != "price"}, dict(ORDER, price="12.5")]
    out = C.payload_records(_raw(spark, [{"payload": {"op": "c", "after": a}} for a in cases]))
    rows = out.orderBy("event_id").collect()
    assert rows[0].price == 0.0 and rows[1].price == 0.0
    assert rows[2].quantity == 1 and rows[3].quantity == 2 and rows[4].quantity == 5 and rows[5].quantity == 1
    assert rows[6].price is None and rows[6].total_amount is None   # absent stays absent
    assert rows[7].price == 12.5


def test_single_item_total(spark):
    a = dict(ORDER, quantity=1, price=25.50)
    r = _one(C.payload_records(_raw(spark, [{"payload": {"op": "c", "after": a}}])))
    assert r.total_amount == 25.50


def test_unknown_keys_stay_reachable(spark):
    a = dict(ORDER, coupon="SPRING")
    r = _one(C.payload_records(_raw(spark, [{"payload": {"op": "c", "after": a}}]))
             .select(F.try_variant_get("image", "$.coupon", "string").alias("coupon")))
    assert r.coupon == "SPRING"


def test_base64_decimal(spark):
    df = spark.createDataFrame([("Jw8=",), ("2PE=",), ("AA==",), (None,)], "s string")
    vals = [r.v for r in df.select(decode_decimal_base64(F.col("s")).alias("v")).collect()]
    assert vals == [Decimal("99.99"), Decimal("-99.99"), Decimal("0.00"), None]


def test_envelope_edge_rows(spark):
    img = {"id": 7, "customer_name": "A", "customer_email": "a@x", "total_amount": "Jw8=", "status": "pending",
           "created_at": "1704067200000000", "updated_at": "2024-01-01T00:00:00.000000"}
    src = {"table": "orders", "db": "orders_db", "lsn": 2 ** 40, "txId": 2 ** 33}
    evs = [None, {}, {"op": "c", "after": img, "source": src, "ts_ms": "1"},
           {"op": "r", "after": img, "source": src, "ts_ms": "2"},
           {"op": "d", "before": img, "source": src, "ts_ms": "3"}, "nope"]
    env = C.decode_envelope(_raw(spark, evs))
    flat = C.flatten_envelope(env, keep=("event_id",)).orderBy("event_id").collect()
    assert [r.change_type for r in flat] == ["UNKNOWN", "UNKNOWN", "INSERT", "SNAPSHOT", "DELETE", "UNKNOWN"]
    assert [r.reject_reason for r in flat] == ["null_value", "unreadable", None, None, None, "unreadable"]
    assert flat[2].total_amount == Decimal("99.99")
    assert str(flat[2].order_created_at) == "2024-01-01 00:00:00"      # epoch micros
    assert flat[3].order_id == 7                                        # snapshot keeps its image
    lsn = env.where("event_id = 2").select("source.lsn", "source.txId").collect()[0]
    assert lsn[0] == 2 ** 40 and lsn[1] == 2 ** 33                       # 64-bit, no overflow to NULL
    ref = C.flatten_envelope(env, snapshot_uses_after=False, keep=("event_id",)).where("event_id = 3")
    assert _one(ref).order_id is None                                   # reference behaviour on request


def test_flat_tombstones_and_deletes(spark):
    evs = [None, {"order_id": 1, "__op": "u"}, {"order_id": 2, "__deleted": "true", "__op": "u"},
           {"order_id": 3}]
    out = C.decode_flat(_raw(spark, evs)).orderBy("event_id").collect()
    assert [r.op for r in out] == ["u", "d", "c"]              # tombstone skipped


def test_etl_message(spark):
    evs = [{"order_id": 5, "customer_id": 2, "__op": "u"}, {"customer_id": 3, "__op": "x"}]
    msgs = C.etl_messages(C.decode_flat(_raw(spark, evs)), keep=("event_id",)).orderBy("event_id").collect()
    assert [m.operation for m in msgs] == ["UPDATE", "INSERT"]
    assert [m.key for m in msgs] == ["5", None]                 # no id: no key, any partition
    body = json.loads(msgs[0].value)
    assert set(body) == {"topic", "key", "value", "timestamp", "source", "operation"}
    assert body["value"] == evs[0]                              # the record as it came
    assert json.loads(msgs[1].value)["key"] == ""
    assert body["source"] == "orders-db" and msgs[0].topic == body["topic"] == "cdc-events"


def test_messages_keep_unknown_keys_and_nulls_and_skip_rejects(spark):
    evs = [{"order_id": 5, "note": {"a": [1, None]}, "status": None}, "invalid json"]
    msgs = C.etl_messages(C.decode_flat(_raw(spark, evs))).collect()
    assert [json.loads(m.value)["value"] for m in msgs] == [evs[0]]


def test_json_lines_keep_the_whole_record(spark):
    from changeflow.operators.quality import json_lines
    rec = dict(ORDER, status=None, note="k", price="12.5")
    del rec["quantity"]
    out = json_lines(C.payload_records(_raw(spark, [{"payload": {"op": "c", "after": rec}}]))).collect()
    doc = json.loads(out[0].json)
    assert doc["status"] is None and doc["note"] == "k" and doc["price"] == 12.5
    assert not {"quantity", "total_amount"} & set(doc) and doc["_deleted"] is False


def test_large_quantity_is_kept_and_an_unholdable_one_rejected(spark):
    evs = [{"payload": {"op": "c", "after": dict(ORDER, quantity=q)}} for q in (3_000_000_000, 10 ** 25)]
    out = C.payload_records(_raw(spark, evs)).orderBy("event_id").collect()
    assert out[0].quantity == 3_000_000_000 and out[0].total_amount == 3_000_000_000 * 99.99
    assert [r.reject_reason for r in out] == [None, "out_of_range:quantity"]


def test_envelope_without_image_or_id_is_rejected(spark):
    evs = [{"op": "u"}, {"op": "c", "after": {"id": "x", "status": "s"}}, {"op": "d", "before": {"id": 4}},
           {"op": "c", "after": {"id": 5, "total_amount": "!!"}}, {"op": "c", "after": {"id": 6, "total_amount": "AQAAAAAAAAAA"}}]
    f = C.flatten_envelope(C.decode_envelope(_raw(spark, evs)), keep=("event_id",)).orderBy("event_id").collect()
    assert [r.reject_reason for r in f] == ["empty_image", "null_key", None, "invalid_amount", None]
    assert f[4].total_amount == Decimal(2 ** 64) / 100


def test_null_keys_and_null_ops_in_current_state(spark):
    rows = [(1, None, "c", "a"), (2, 10, None, "b"), (3, 11, "d", "c")]
    df = spark.createDataFrame(rows, "seq long, id long, op string, status string")
    assert [(r.id, r.status) for r in C.current_state(df, "id", ["seq"], columns=["status"]).collect()] == [(10, "b")]


def test_event_time_unit_is_a_parameter(spark):
    from changeflow.functions.cdc import parse_event_time
    df = spark.createDataFrame([("1705314600000",)], "s string")
    got = [str(df.select(parse_event_time(F.col("s"), u).cast("timestamp_ntz")).first()[0]) for u in ("millis", "micros")]
    assert got == ["2024-01-15 10:30:00", "1970-01-20 17:41:54.600000"]


def test_loader_defaults_are_for_missing_keys_only(spark):
    from changeflow.operators.warehouse import load_order_events
    base = {"order_id": 1, "customer_id": 2, "product_name": "p", "quantity": 1, "unit_price": 2.5,
            "order_date": "2024-01-01", "status": "s"}
    evs = [base, dict(base, operation=None), dict(base, timestamp="2024-01-02T03:04:05"), dict(base, timestamp=None)]
    out = load_order_events(C.decode_flat(_raw(spark, evs))).orderBy("event_id").collect()
    assert [r.reject_reason for r in out] == [None, "null:event_type", None, "null:source_timestamp"]
    assert out[0].event_type == "INSERT" and out[0].source_timestamp is not None
    assert str(out[2].source_timestamp) == "2024-01-02 03:04:05"


def test_current_state_latest_wins_and_deletes_drop(spark):
    rows = [(1, 10, "c", "a"), (2, 10, "u", "b"), (3, 11, "c", "x"), (4, 11, "d", "x"), (5, 12, "r", "s")]
    df = spark.createDataFrame(rows, "seq long, id long, op string, status string")
    st = {r.id: r.status for r in C.current_state(df, "id", ["seq"], columns=["status"]).collect()}
    assert st == {10: "b", 12: "s"}


def test_event_time_formats(spark):
    from changeflow.functions.cdc import parse_event_time
    vals = ["2024-01-15T10:30:00Z", "2024-01-15T10:30:00.123456Z", "2024-01-15T10:30:00.123+02:00",
            "2024-01-15 10:30:00.5", "2024-01-15", "1705314600000000", "garbage"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [str(r.t) for r in df.select(parse_event_time(F.col("s")).cast("timestamp_ntz").alias("t")).collect()]
    assert got == ["2024-01-15 10:30:00", "2024-01-15 10:30:00.123456", "2024-01-15 08:30:00.123000",
                   "2024-01-15 10:30:00.500000", "2024-01-15 00:00:00", "2024-01-15 10:30:00", "None"]
