"""Change-data-capture decoders and change application.

Three wire shapes, chosen explicitly by the caller:

* **payload-wrapped** ``{"payload": {"op", "before", "after"}}`` — parsed to a
  ``VARIANT`` once (``try_parse_json``); unknown keys stay reachable through the
  ``image`` column, and key presence (absent vs JSON null) is visible;
* **envelope** ``{"before", "after", "source", "op", "ts_ms"}`` — ``from_json``
  with a fixed schema, as a streaming source would;
* **flat / unwrapped** records with ``__op`` / ``__deleted`` — ``VARIANT`` again
  because the loader defaults depend on key presence.

Every decoder keeps every input row and adds ``reject_reason`` (NULL when the
row is usable) instead of dropping silently; :func:`accepted` /
:func:`rejected` split the two sides lazily. All of it is row-local
(narrow): no shuffle until the caller aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.cdc import change_label, decode_decimal_base64, epoch_number, message_operation, parse_event_time
from changeflow.functions.coerce import vpresent
from changeflow.schemas import ENVELOPE

# Fixed values of the payload path.
PIPELINE_VERSION = "1.0.0"
REQUIRED_FIELDS = ("id", "customer_id", "product_id")


def settle(df: DataFrame) -> DataFrame:
    """Evaluate the columns of ``df`` once per row before any later filter.

    Catalyst pushes a filter below projections by substituting each column
    with its defining expression; for a reject reason built from the parsed
    JSON that inlines the parse dozens of times. A one-row ``inline``
    (Generate) is a boundary filters are not pushed through, so downstream
    ``accepted`` / ``rejected`` filters read the computed columns instead.
    Row-local: no shuffle, no materialization.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def _event_time(ts_col: str | None) -> Column:
    return F.col(ts_col) if ts_col else F.current_timestamp()


# --------------------------------------------------------------- payload shape
def decode_payload(raw: DataFrame, value_col: str = "value", ts_col: str | None = "ts") -> DataFrame:
    """Parse payload-wrapped events (P5).

    c/u take ``after``, d takes ``before`` and sets ``_deleted``; anything else
    (``r`` included, as in the reference) is rejected with a reason. Adds
    ``image`` (VARIANT of the chosen record), ``_fields`` (its keys as a
    ``map<string, variant>``: presence and JSON null stay distinguishable),
    ``_cdc_operation``, ``_cdc_timestamp`` (the event's own time when
    ``ts_col`` is given, else processing time), ``_processed_at`` and
    ``reject_reason``. The text is parsed once; the envelope is read with one
    variant→struct cast, the image with one variant→map cast.
    """
    parsed = raw.select("*", F.try_parse_json(F.col(value_col)).alias("_v"))
    env = parsed.select("*", F.try_variant_get(
        "_v", "$.payload", "struct<op string, before variant, after variant>").alias("_p"))
    op = F.col("_p.op")
    image = env.select("*", F.when(op.isin("c", "u"), F.col("_p.after"))
                       .when(op == "d", F.col("_p.before")).alias("image"))
    image = image.select("*", F.try_variant_get("image", "$", "map<string,variant>").alias("_fields"))
    reason = (F.when(F.col(value_col).isNull(), "null_value")
              .when(F.col("_v").isNull(), "malformed_json")
              .when(F.col("_p").isNull(), "no_payload")
              .when(~F.coalesce(op.isin("c", "u", "d"), F.lit(False)), "unsupported_op")
              .when(~F.coalesce(F.size("_fields") > 0, F.lit(False)), "empty_image"))
    return settle(image.select(
        *raw.columns, "image", "_fields",
        op.alias("_cdc_operation"),
        (op == "d").alias("_deleted"),
        _event_time(ts_col).alias("_cdc_timestamp"),
        F.current_timestamp().alias("_processed_at"),
        reason.alias("reject_reason"),
    ))


def _present(key: str) -> Column:
    return F.coalesce(F.map_contains_key(F.col("_fields"), key), F.lit(False))


def _non_null(key: str) -> Column:
    val = F.col("_fields")[key]
    return val.isNotNull() & ~F.is_variant_null(val)


def validate_required(decoded: DataFrame, fields=REQUIRED_FIELDS) -> DataFrame:
    """Required-field check (P6): present, not JSON null, and of a usable type.

    Rows already rejected keep their first reason.
    """
    check = None
    for f in fields:
        cond, label = ~_non_null(f), f"missing_field:{f}"
        check = F.when(cond, label) if check is None else check.when(cond, label)
    for f in ("id", "customer_id"):
        if f in fields:
            check = check.when(F.try_variant_get(F.col("_fields")[f], "$", "bigint").isNull(),
                               f"invalid_type:{f}")
    # A number that no 64-bit integer holds is neither kept nor replaced by the default.
    size = F.abs(F.try_variant_get(F.col("_fields")["quantity"], "$", "double"))
    check = check.when(size >= F.lit(2.0 ** 63), "out_of_range:quantity")
    return settle(decoded.withColumn("reject_reason", F.coalesce(F.col("reject_reason"), check)))


# Typed view of the record image (fixed field list of the order shape).
_IMAGE_TYPE = ("struct<id bigint, customer_id bigint, product_id string, quantity bigint, "
               "price double, order_date string, status string>")


def coerce_and_enrich(validated: DataFrame) -> DataFrame:
    """Typed projection, tolerant coercion and enrichment.

    price: present → float or 0.0; quantity: present → int or 1; absent keys stay
    NULL; ``total_amount = price × quantity`` only when both keys are present.
    """
    typed = validated.select("*", F.try_variant_get("image", "$", _IMAGE_TYPE).alias("_t"))
    price = F.when(_present("price"), F.coalesce(F.col("_t.price"), F.lit(0.0)))
    qty = F.when(_present("quantity"), F.coalesce(F.col("_t.quantity"), F.lit(1).cast("bigint")))
    step = typed.select("*", price.alias("price"), qty.alias("quantity"))
    return step.select(
        *[c for c in validated.columns if c != "_fields"],
        F.col("_t.id").alias("id"),
        F.col("_t.customer_id").alias("customer_id"),
        F.col("_t.product_id").alias("product_id"),
        "quantity", "price",
        F.col("_t.order_date").alias("order_date"),
        F.col("_t.status").alias("status"),
        (F.col("price") * F.col("quantity")).alias("total_amount"),
        F.lit(True).alias("_processed"),
        F.lit(PIPELINE_VERSION).alias("_pipeline_version"),
    )


def payload_records(raw: DataFrame, value_col: str = "value", ts_col: str | None = "ts") -> DataFrame:
    """decode → validate → coerce/enrich; all rows, ``reject_reason`` set on the bad ones."""
    return coerce_and_enrich(validate_required(decode_payload(raw, value_col, ts_col)))


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col("reject_reason").isNull())


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col("reject_reason").isNotNull())


# -------------------------------------------------------------- envelope shape
def decode_envelope(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """``from_json`` with the envelope schema, then ``cdc_event.*``.

    Malformed text, ``{}`` and NULL values become all-NULL rows (labelled
    UNKNOWN later); ``reject_reason`` tells them apart, and names events
    without a record image (``empty_image``) or a readable id (``null_key``).
    """
    parsed = F.from_json(F.col(value_col), ENVELOPE)
    out = raw.select("*", parsed.alias("_e")).select(
        *[c for c in raw.columns], "_e.*", F.current_timestamp().alias("processed_at"))
    empty = (F.col("op").isNull() & F.col("before").isNull() & F.col("after").isNull()
             & F.col("source").isNull())
    image = record_image(F.col("op"), F.col("before"), F.col("after"))
    return settle(out.withColumn("reject_reason",
                                 F.when(F.col(value_col).isNull(), "null_value")
                                 .when(empty, "unreadable")
                                 .when(~F.coalesce(F.col("op").isin("c", "u", "d", "r"), F.lit(False)),
                                       "unsupported_op")
                                 .when(image.isNull(), "empty_image")
                                 .when(image["id"].isNull(), "null_key")))


def record_image(op: Column, before: Column, after: Column, snapshot_uses_after: bool = True) -> Column:
    """Record image (P3): ``after`` for c/u (and r), ``before`` otherwise.

    The reference picks ``before`` for snapshots, which is NULL, so snapshot
    rows lose their data; ``snapshot_uses_after=False`` reproduces that.
    """
    ops = ["c", "u", "r"] if snapshot_uses_after else ["c", "u"]
    return F.when(op.isin(*ops), after).otherwise(before)


# Columns that order the changes of a key as the source's log does; NULL comes first.
LOG_ORDER = ("log_lsn", "log_change", "log_tx")


def log_position(source: Column, op: Column) -> list[Column]:
    """A change's place in the log: its sequence number, whether it is a change, its transaction.

    A snapshot row shows what was there when the snapshot was read, at the number it carries: it goes
    before a change of the same number, whenever it arrives. Without a number a row goes before all others.
    """
    snapshot = (op == "r") | ~F.lower(F.coalesce(source["snapshot"], F.lit("false"))).isin("false", "")
    return [source["lsn"].alias("log_lsn"), (~F.coalesce(snapshot, F.lit(False))).alias("log_change"),
            source["txId"].alias("log_tx")]


def flatten_envelope(decoded: DataFrame, snapshot_uses_after: bool = True, keep: tuple = (),
                     epoch_unit: str = "micros", position: bool = False) -> DataFrame:
    """The 13-column flat change record (P4) plus the decoded amount.

    ``keep`` names input columns to carry along (e.g. an event id), ``epoch_unit``
    is the unit of numeric event times. An amount that cannot be decoded
    is a reject (``invalid_amount``), not a silent NULL, and so is an epoch
    number beyond the years 1 to 9999 (``out_of_range:<field>``).

    ``position=True`` adds the change's place in the source's log, the columns of :data:`LOG_ORDER`.
    """
    rec = record_image(F.col("op"), F.col("before"), F.col("after"), snapshot_uses_after)
    times = {c: parse_event_time(rec[c], epoch_unit) for c in ("created_at", "updated_at")}
    decoded = settle(decoded.select("*", decode_decimal_base64(rec["total_amount"], 2).alias("_amount"),
                                    *[t.alias(f"_{c}") for c, t in times.items()]))
    bad_value = F.when(rec["total_amount"].isNotNull() & F.col("_amount").isNull(), "invalid_amount")
    for c in times:
        bad_value = bad_value.when(epoch_number(rec[c]) & F.col(f"_{c}").isNull(), f"out_of_range:{c}")
    place = log_position(F.col("source"), F.col("op")) if position else []
    return decoded.select(
        *keep,
        F.col("op").alias("operation"),
        F.col("source.table").alias("source_table"),
        F.col("source.db").alias("source_database"),
        F.col("ts_ms").alias("event_timestamp"),
        "processed_at",
        change_label(F.col("op")).alias("change_type"),
        rec["id"].alias("order_id"),
        rec["customer_name"].alias("customer_name"),
        rec["customer_email"].alias("customer_email"),
        rec["total_amount"].alias("total_amount_encoded"),
        rec["status"].alias("status"),
        F.col("_created_at").cast("timestamp_ntz").alias("order_created_at"),
        F.col("_updated_at").cast("timestamp_ntz").alias("order_updated_at"),
        F.col("_amount").alias("total_amount"),
        *place,
        F.coalesce("reject_reason", bad_value).alias("reject_reason"),
    )


# ------------------------------------------------------------------ flat shape
def decode_flat(raw: DataFrame, value_col: str = "value", ts_col: str | None = "ts") -> DataFrame:
    """Unwrapped change records.

    A NULL value is a tombstone and is skipped; ``__deleted = 'true'`` means a
    delete; otherwise ``__op``, and without it an upsert (``c``). Key presence
    is kept for the loader's defaults (``<key>_present``), the record's own
    ``timestamp`` as text, and the whole record as ``record`` (VARIANT).
    """
    live = raw.where(F.col(value_col).isNotNull()).select("*", F.try_parse_json(F.col(value_col)).alias("_v"))
    v = F.col("_v")
    typed = live.select("*", F.try_variant_get(v, "$", _FLAT_TYPE).alias("_t"),
                        *[vpresent(v, f"$.{k}").alias(f"{k}_present") for k in _DEFAULTED])
    t = F.col("_t")
    op = F.when(t["__deleted"] == "true", "d").otherwise(F.coalesce(t["__op"], F.lit("c")))
    return settle(typed.select(
        *raw.columns,
        *[t[c].alias(c) for c in ("order_id", "customer_id", "product_name", "quantity", "unit_price")],
        *[f"{k}_present" for k in _DEFAULTED],
        *[t[c].alias(c) for c in ("order_date", "status", "operation", "timestamp")],
        v.alias("record"),
        op.alias("op"),
        change_label(op).alias("change_type"),
        _event_time(ts_col).alias("event_time"),
        F.current_timestamp().alias("processed_at"),
        F.when(v.isNull(), "malformed_json").alias("reject_reason"),
    ))


# Typed view of a flat change record (fixed field list of the unwrapped shape).
_FLAT_TYPE = ("struct<order_id int, customer_id int, product_name string, quantity int, "
              "unit_price decimal(10,2), order_date string, status string, operation string, "
              "timestamp string, __op string, __deleted string>")
# Keys whose absence has another meaning than a JSON null (loader defaults).
_DEFAULTED = ("unit_price", "operation", "timestamp")


def etl_messages(flat: DataFrame, ts_col: str | None = "event_time", topic: str = "cdc-events",
                 source: str = "orders-db", keep: tuple = ()) -> DataFrame:
    """Standard ETL message per usable change.

    ``value`` = JSON of {topic, key, value, timestamp, source, operation}: the whole
    record with its unknown keys and nulls, and the order id as text ('' when
    missing) as key. The Kafka key is NULL without an order id, so such
    messages spread over the partitions. Rejected events are not published.
    """
    good = accepted(flat)
    order_id = F.col("order_id").cast("string")
    ts = F.date_format(_event_time(ts_col), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    operation = message_operation(F.col("op"))
    body = F.struct(F.lit(topic).alias("topic"), F.coalesce(order_id, F.lit("")).alias("key"),
                    F.col("record").alias("value"), ts.alias("timestamp"), F.lit(source).alias("source"),
                    operation.alias("operation"))
    return good.select(
        *keep, F.lit(topic).alias("topic"), order_id.alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
        ts.alias("timestamp"), F.lit(source).alias("source"), operation.alias("operation"))


# ------------------------------------------------------------- change apply
def is_delete(op_col: str, delete_ops=("d",)) -> Column:
    """Whether a change deletes its key; a change without an op code does not."""
    return F.coalesce(F.col(op_col).isin(*delete_ops), F.lit(False))


def current_state(changes: DataFrame, key: str, order_by: list[str], *, op_col: str = "op",
                  delete_ops=("d",), columns: list[str] | None = None,
                  keep_tombstones: bool = False) -> DataFrame:
    """Latest row per key; keys whose latest change is a delete disappear.

    ``max_by`` combines map-side: a key holding a third of all changes is
    reduced per partition before the shuffle, never gathered into one task.
    Its struct buffer makes Spark aggregate by sorting inside each task; a
    hash aggregate of the order alone with a join back would decode every
    change twice, which costs more. Rows without a key are no state.
    """
    cols = columns or [c for c in changes.columns if c != key]
    carried = list(dict.fromkeys(cols + [op_col]))
    keyed = changes.where(F.col(key).isNotNull())
    ordering = F.struct(*[F.col(c) for c in order_by])
    latest = keyed.groupBy(key).agg(F.max_by(F.struct(*carried), ordering).alias("_l")).select(
        key, *[F.col(f"_l.{c}").alias(c) for c in carried])
    if keep_tombstones:
        return latest
    return latest.where(~is_delete(op_col, delete_ops)).select(key, *cols)


def dedup_events(df: DataFrame, keys: list[str], *, ts_col: str | None = None,
                 watermark: str | None = None) -> DataFrame:
    """Idempotent consumption (T10): one row per event key.

    Batch: ``dropDuplicates`` (an aggregate on the key, collapsed map-side
    before the shuffle). Stream: ``dropDuplicatesWithinWatermark`` — state is
    kept only until the watermark passes, so it stays bounded.
    """
    if df.isStreaming:
        if not (ts_col and watermark):
            raise ValueError("a streaming dedup needs ts_col and watermark")
        wm = df.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, watermark)
        return wm.dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)
