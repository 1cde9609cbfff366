"""Change-event queries: decode, validate, load, apply, publish."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeflow.operators import cdc as C
from changeflow.operators import quality as Q
from changeflow.operators import warehouse as W
from changeflow.plans import oracle_cdc as OC
from changeflow.plans.registry import register
from changeflow.session import scratch_path
from changeflow.sources import fixtures as X
from changeflow.streaming.sinks import IdempotentParquetAppend


# ------------------------------------------------------------ payload shape
@register("cdc_payload_parse", OC.payload_parse())
def _payload_parse(spark, d):
    return C.accepted(C.decode_payload(X.cdc_raw(spark, d))).select(
        "event_id", "_cdc_operation", "_deleted", "_cdc_timestamp")


@register("cdc_payload_rejects", OC.payload_rejects())
def _payload_rejects(spark, d):
    return C.rejected(C.decode_payload(X.cdc_raw(spark, d))).select("event_id", "reject_reason")


@register("cdc_required_fields", OC.required_fields())
def _required_fields(spark, d):
    v = C.validate_required(C.decode_payload(X.cdc_raw(spark, d)))
    return C.accepted(C.coerce_and_enrich(v)).select("event_id", "id", "customer_id", "product_id")


@register("cdc_coerce", OC.coerce())
def _coerce(spark, d):
    return C.accepted(C.payload_records(X.cdc_raw(spark, d))).select("event_id", "price", "quantity")


@register("cdc_enrich", OC.enrich())
def _enrich(spark, d):
    return C.accepted(C.payload_records(X.cdc_raw(spark, d))).select(
        "event_id", "id", "customer_id", "product_id", "quantity", "price", "order_date", "status",
        "total_amount", "_deleted", "_cdc_operation", "_processed", "_pipeline_version")


@register("cdc_dead_letter", OC.dead_letter())
def _dead_letter(spark, d):
    return Q.dead_letter(C.payload_records(X.cdc_raw(spark, d))).select("event_id", "reject_reason", "value")


@register("cdc_quality_report", OC.quality_report())
def _quality_report(spark, d):
    return Q.quality_report(C.payload_records(X.cdc_raw(spark, d)))


@register("cdc_json_out", OC.json_out())
def _json_out(spark, d):
    return Q.json_lines(C.accepted(C.payload_records(X.cdc_raw(spark, d))))


@register("consume_bounded", OC.consume_bounded(100))
def _consume_bounded(spark, d):
    good = C.accepted(C.payload_records(X.cdc_raw(spark, d)))
    return Q.first_n(good, 100, "event_id").select(
        "event_id", "id", "customer_id", "product_id", "quantity", "price", "total_amount")


# ----------------------------------------------------------- envelope shape
def _envelope(spark, d):
    return C.decode_envelope(X.envelope_raw(spark, d))


@register("cdc_envelope_parse", OC.envelope_parse())
def _envelope_parse(spark, d):
    return _envelope(spark, d).select(
        "event_id", "op", "ts_ms", F.col("source.table").alias("source_table"),
        F.col("source.db").alias("source_db"), F.col("source.lsn").alias("source_lsn"),
        F.col("source.txId").alias("source_txid"), F.col("before.id").alias("before_id"),
        F.col("after.id").alias("after_id"), "reject_reason")


@register("cdc_change_type", OC.change_type())
def _change_type(spark, d):
    return C.flatten_envelope(_envelope(spark, d), keep=("event_id",)).select("event_id", "change_type")


@register("cdc_record_image", OC.record_image())
def _record_image(spark, d):
    return C.flatten_envelope(_envelope(spark, d), keep=("event_id",)).select(
        "event_id", "change_type", "order_id", "status")


@register("cdc_record_image_reference", OC.record_image_reference())
def _record_image_reference(spark, d):
    f = C.flatten_envelope(_envelope(spark, d), snapshot_uses_after=False, keep=("event_id",))
    return f.select("event_id", "change_type", "order_id")


@register("cdc_flatten", OC.flatten())
def _flatten(spark, d):
    # processed_at is the wall clock and is left out of the comparison.
    return C.flatten_envelope(_envelope(spark, d), keep=("event_id",)).drop("processed_at")


@register("cdc_decode_amount", OC.decode_amount())
def _decode_amount(spark, d):
    f = C.flatten_envelope(_envelope(spark, d), keep=("event_id",))
    return f.where(F.col("total_amount_encoded").isNotNull()).select(
        "event_id", "total_amount_encoded", "total_amount")


@register("cdc_snapshot_rows", OC.snapshot_rows())
def _snapshot_rows(spark, d):
    f = C.flatten_envelope(_envelope(spark, d), keep=("event_id",))
    return f.where(F.col("change_type") == "SNAPSHOT").select("event_id", "order_id", "status", "total_amount")


@register("warehouse_append", OC.warehouse_append())
def _warehouse_append(spark, d):
    # What the sink wrote, read back; the batch is delivered twice, as after a failure.
    f = C.accepted(C.flatten_envelope(_envelope(spark, d), keep=("event_id",)))
    f = f.select("event_id", "operation", "change_type", "order_id", "status", "total_amount", "order_updated_at")
    path = scratch_path(spark, "warehouse")
    sink = IdempotentParquetAppend(path)
    for _ in range(2):
        sink(f, 0, "registry")
    return spark.read.parquet(path).select("event_id", "operation", "change_type", "order_id", "status", "total_amount",
                                           "order_updated_at")


@register("cdc_current_state", OC.current_state())
def _current_state(spark, d):
    f = C.accepted(C.flatten_envelope(_envelope(spark, d), keep=("event_id",)))
    state = C.current_state(f, key="order_id", order_by=["event_id"], op_col="operation",
                            columns=["customer_name", "status", "total_amount", "order_updated_at", "event_id"])
    return state.withColumnRenamed("event_id", "last_event_id")


@register("cdc_state_by_position", OC.state_by_position())
def _state_by_position(spark, d):
    # Ordered by the source's log alone: a snapshot row that arrives late loses to the changes made since it was read.
    f = C.accepted(C.flatten_envelope(C.decode_envelope(X.envelope_log_raw(spark, d)), keep=("event_id",), position=True))
    return C.current_state(f, key="order_id", order_by=list(C.LOG_ORDER), op_col="operation",
                           columns=["customer_name", "status", "total_amount", "change_type", "log_lsn", "event_id"])


@register("cdc_dedup", OC.dedup())
def _dedup(spark, d):
    raw = X.cdc_raw(spark, d)
    # at-least-once delivery: the whole topic is delivered twice
    return C.dedup_events(raw.unionByName(raw), ["event_id"]).select("event_id", "ts")


# --------------------------------------------------------------- flat shape
def _flat(spark, d):
    return C.decode_flat(X.flat_raw(spark, d))


@register("cdc_flat_parse", OC.flat_parse())
def _flat_parse(spark, d):
    return _flat(spark, d).select("event_id", "order_id", "customer_id", "product_name", "quantity", "unit_price",
                                  "order_date", "status", "operation", "op", "change_type", "reject_reason")


def _loaded(spark, d):
    # A backfill: processed_at is the event time so the report is reproducible.
    return W.load_order_events(_flat(spark, d), processed_at=F.col("event_time").cast("timestamp_ntz"))


@register("load_order_events", OC.load_order_events())
def _load_order_events(spark, d):
    return C.accepted(_loaded(spark, d)).drop("reject_reason")


@register("load_rejects", OC.load_rejects())
def _load_rejects(spark, d):
    return C.rejected(_loaded(spark, d)).select("event_id", "reject_reason")


@register("warehouse_compacted", OC.warehouse_compacted())
def _warehouse_compacted(spark, d):
    # The loader's rows through the fact table: three batches, one of them twice, moved to their days but for the newest.
    loaded, path = _loaded(spark, d).repartition(F.to_date("processed_at")), scratch_path(spark, "order-events")
    batch = F.col("event_id") % 3
    for k in (0, 1, 1, 2):
        W.append_order_events(loaded.where(batch == k), path, k, "registry")
    W.compact_order_events(spark, path)
    return W.read_order_events(spark, path).select("event_id", "order_id", "quantity", "total_amount", "status", "event_type",
                                                   "batch_id", "processed_date")


@register("daily_stats", OC.daily_stats())
def _daily_stats(spark, d):
    return W.daily_stats(C.accepted(_loaded(spark, d)), day="latest")


@register("etl_message_format", OC.etl_message_format())
def _etl_message_format(spark, d):
    return C.etl_messages(_flat(spark, d), ts_col="event_time", keep=("event_id",))


# ------------------------------------------------------------ metrics & misc
from changeflow.functions.time import resolve_as_of  # noqa: E402
from changeflow.operators import analytics as A  # noqa: E402
from changeflow.operators import insights as I  # noqa: E402
from changeflow.operators import metrics as M  # noqa: E402
from changeflow.plans import oracle_misc as OM  # noqa: E402
from changeflow.sources.tables import read_table  # noqa: E402


@register("data_freshness", OM.data_freshness())
def _data_freshness(spark, d):
    return M.data_freshness(X.order_lines(spark, d), as_of="latest")


def _later(orders, minutes: int):
    """An anchor some minutes after the newest order."""
    return resolve_as_of(orders, "latest") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))


@register("data_freshness_stale", OM.data_freshness(10))
def _data_freshness_stale(spark, d):
    orders = X.order_lines(spark, d)
    return M.data_freshness(orders, as_of=_later(orders, 10))


@register("throughput", OM.throughput(60))
def _throughput(spark, d):
    return M.throughput(X.order_lines(spark, d), window_minutes=60, as_of=X.latest_order_time(spark, d))


def _processed(spark, d):
    """Decoded events with a processing time that does not depend on the clock: 0 to 6 s after the event."""
    delay = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("event_id") % 7).cast("decimal(18,6)"))
    return C.payload_records(X.cdc_raw(spark, d)).withColumn("_processed_at", F.col("_cdc_timestamp") + delay)


@register("pipeline_health", OM.pipeline_health(60))
def _pipeline_health(spark, d):
    return M.pipeline_health(X.order_lines(spark, d), _processed(spark, d), as_of="latest", window_minutes=60,
                             max_error_rate=0.5)


@register("pipeline_health_degraded", OM.pipeline_health(60, 10))
def _pipeline_health_degraded(spark, d):
    orders = X.order_lines(spark, d)
    return M.pipeline_health(orders, _processed(spark, d), as_of=_later(orders, 10), window_minutes=60,
                             max_error_rate=0.5)


@register("alert_rules", OM.alert_rules())
def _alert_rules(spark, d):
    orders = X.order_lines(spark, d)
    last = X.latest_order_time(spark, d)
    health = M.pipeline_health(orders, C.payload_records(X.cdc_raw(spark, d)), as_of=last, window_minutes=60)
    anomalies = A.detect_anomalies(orders, 1.0, stats_days=90, candidate_days=30, as_of=last)
    one = health.select("seconds_since_last", "error_rate",
                        F.lit(anomalies.agg(F.count(F.lit(1))).scalar()).alias("anomalies"))
    rules = {"seconds_since_last": 300.0, "error_rate": 0.05, "anomalies": 100.0}
    return M.alert_rules(M.metrics_long(one, ["seconds_since_last", "error_rate", "anomalies"]), rules)


@register("param_sql", OM.param_sql())
def _param_sql(spark, d):
    sql = ("SELECT customer_id, count(*) AS order_count, sum(quantity * price) AS total_value "
           "FROM {orders} WHERE status <> :skip GROUP BY customer_id "
           "ORDER BY total_value DESC, customer_id LIMIT :n")
    out = I.execute_query(spark, sql, {"skip": "cancelled", "n": 5}, orders=X.order_lines(spark, d))
    return out.select("customer_id", "order_count", F.col("total_value").cast("double").alias("total_value"))


@register("insights_bundle", OM.insights_bundle(5, 7, 15))
def _insights_bundle(spark, d):
    return I.insights_rows(I.insights_bundle(X.stored_order_lines(spark, d), as_of="latest"))


def _dim(spark, d):
    cust = read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"))
    return W.dim_customers(cust)


@register("dim_customers", OM.dim_customers())
def _dim_customers(spark, d):
    return _dim(spark, d).select("customer_id", "customer_name", "customer_email")


@register("orders_with_customer", OM.orders_with_customer())
def _orders_with_customer(spark, d):
    return W.orders_with_customer(X.order_lines(spark, d), _dim(spark, d)).select(
        "id", "customer_id", "customer_name", "product_id", "status", F.col("price").cast("double").alias("price"))


@register("lifecycle_tiers", OM.lifecycle_tiers())
def _lifecycle_tiers(spark, d):
    t = W.lifecycle_tiers(X.order_lines(spark, d), as_of="latest")
    return t.groupBy("tier", "year", "month").agg(F.count(F.lit(1)).alias("orders"))
