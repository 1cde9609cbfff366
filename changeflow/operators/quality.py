"""Data-quality outputs over decoded change events: dead letters, the
quality report, JSON-lines output and the bounded first-N consumer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dead_letter(decoded: DataFrame, value_col: str = "value") -> DataFrame:
    """Rejected events with their reason and the raw text."""
    keep = [c for c in decoded.columns if c in ("event_id", "ts", "key", "partition", "offset")]
    return decoded.where(F.col("reject_reason").isNotNull()).select(*keep, "reject_reason", value_col)


def quality_report(decoded: DataFrame) -> DataFrame:
    """Count and share of each outcome ('accepted' or a reject reason).

    One aggregate; the share is a window over the handful of outcome rows.
    """
    per = decoded.groupBy(F.coalesce(F.col("reject_reason"), F.lit("accepted")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("events"))
    return per.select("outcome", "events",
                      (F.col("events").cast("double") / F.sum("events").over(Window.partitionBy()).cast("double"))
                      .alias("share"))


# Keys that processing sets on a record, in the order they are written.
PROCESSED_KEYS = ("price", "quantity", "total_amount", "_cdc_operation", "_cdc_timestamp", "_deleted", "_processed",
                  "_pipeline_version")

# Timestamps are written as ISO-8601 with microseconds (fixed format).
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def json_lines(records: DataFrame, processed=PROCESSED_KEYS) -> DataFrame:
    """One JSON document per record (K7); write with ``.write.text``.

    The whole record as it came, unknown keys and explicit nulls included, with
    the coerced and added keys in place of its own. A processed key that is NULL was
    absent and stays absent. ``records`` comes from ``coerce_and_enrich``.
    """
    keep = [c for c in ("event_id",) if c in records.columns]
    times = {f.name for f in records.schema.fields if f.dataType.typeName() in ("timestamp", "timestamp_ntz")}
    text = {c: F.date_format(c, ISO_MICROS) if c in times else F.col(c) for c in processed}
    added = F.map_from_entries(F.filter(
        F.array(*[F.struct(F.lit(c).alias("key"), text[c].cast("variant").alias("value")) for c in processed]),
        lambda e: e["value"].isNotNull()))
    own = F.map_filter(F.try_variant_get("image", "$", "map<string,variant>"),
                       lambda k, v: ~F.array_contains(F.map_keys(added), k))
    return records.select(*keep, F.to_json(F.map_concat(own, added)).alias("json"))


def first_n(records: DataFrame, n: int, order_col: str) -> DataFrame:
    """The first ``n`` usable records in stream order (batch twin of the
    bounded consumer): per-partition top-n, then an n-row merge."""
    return records.orderBy(F.col(order_col)).limit(int(n))
