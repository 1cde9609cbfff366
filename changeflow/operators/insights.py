"""The composite business-insights bundle (A12) and its JSON export (K8).

One row: each section is a scalar subquery over an already-small result
(one-row aggregates, top-5 lists, the status breakdown — bounded by the status
domain), so the bundle is assembled without joins or collects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.time import resolve_as_of
from changeflow.operators import analytics as A


def _row(df: DataFrame):
    return df.select(F.struct(*df.columns)).scalar()



def _rows(df: DataFrame, *order):
    """The (small, bounded) rows of ``df`` as an array in the given order.

    ``collect_list`` keeps no order, so each element carries its sort key and
    the array is sorted before the key is dropped.
    """
    key = F.struct(*[c.alias(f"_k{i}") for i, c in enumerate(order)])
    items = F.collect_list(F.struct(key.alias("_k"), F.struct(*df.columns).alias("_v")))
    return df.agg(F.transform(F.array_sort(items), lambda x: x["_v"])).scalar()


def insights_bundle(orders: DataFrame, as_of=None, top_n: int = 5, trend_days: int = 7,
                    realtime_minutes: int = 15, threshold_multiplier: float = 2.0) -> DataFrame:
    anchor = resolve_as_of(orders, as_of)
    anomalies = A.detect_anomalies(orders, threshold_multiplier, as_of=anchor)
    summary = A.order_summary(orders)          # the one-row base: a pass over the orders themselves
    return summary.select(
        F.struct(*summary.columns).alias("summary"),
        _rows(A.top_customers(orders, top_n), -F.col("total_value"), F.col("customer_id")).alias("top_customers"),
        _rows(A.product_performance(orders, top_n), -F.col("total_revenue"), F.col("product_id"))
        .alias("top_products"),
        _row(A.recent_trend(orders, trend_days, as_of=anchor)).alias("recent_trend"),
        _rows(A.status_distribution(orders), -F.col("count"), F.col("status")).alias("status_distribution"),
        _row(A.recent_metrics(orders, realtime_minutes, as_of=anchor)).alias("real_time"),
        anomalies.agg(F.count(F.lit(1))).scalar().alias("recent_anomalies"),
        anchor.alias("generated_at"),
    )


def insights_json(bundle: DataFrame) -> DataFrame:
    """The bundle as one JSON document (NULLs written out)."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    opts = {"ignoreNullFields": "false", "timestampNTZFormat": iso, "timestampFormat": iso}
    return bundle.select(F.to_json(F.struct(*bundle.columns), opts).alias("json"))


def export_insights(bundle: DataFrame, path: str) -> None:
    """Write the bundle JSON as a text file under ``path`` (one small file by nature).

    A failure while computing the bundle is written as the document
    (``{"error": ...}``), as in the reference, and raised.
    """
    try:
        insights_json(bundle).write.mode("overwrite").text(path)
    except Exception as exc:  # noqa: BLE001 — recorded in the exported document, then raised
        spark = bundle.sparkSession
        spark.range(1).select(F.to_json(F.struct(F.lit(str(exc)).alias("error"))).alias("json")) \
            .write.mode("overwrite").text(path)
        raise


def insights_rows(bundle: DataFrame) -> DataFrame:
    """The bundle as long rows (section, rank, item, measure, value): one per number in the document.

    ``rank`` is the position in a list section (from 1, else 0), ``item`` its key as text.
    """
    kinds = bundle.schema
    parts = []

    def numbers(section: str, struct, fields, rank, item) -> list:
        return [F.struct(F.lit(section).alias("section"), rank.cast("int").alias("rank"), item.cast("string").alias("item"),
                         F.lit(f.name).alias("measure"), struct[f.name].cast("double").alias("value"))
                for f in fields if f.dataType.typeName() in ("long", "integer", "double")]

    def lines(section: str, key: str, fields):
        return lambda z: F.array(*numbers(section, z["x"], fields, z["i"], z["x"][key]))

    none = F.lit("")
    for section in ("summary", "recent_trend", "real_time"):
        parts.append(F.array(*numbers(section, F.col(section), kinds[section].dataType.fields, F.lit(0), none)))
    for section, key in (("top_customers", "customer_id"), ("top_products", "product_id"), ("status_distribution", "status")):
        fields = [f for f in kinds[section].dataType.elementType.fields if f.name != key]
        ranks = F.sequence(F.lit(1), F.size(section))
        parts.append(F.flatten(F.transform(F.arrays_zip(ranks.alias("i"), F.col(section).alias("x")),
                                           lines(section, key, fields))))
    parts.append(F.array(F.struct(F.lit("recent_anomalies").alias("section"), F.lit(0).alias("rank"), none.alias("item"),
                                  F.lit("count").alias("measure"), F.col("recent_anomalies").cast("double").alias("value"))))
    return bundle.select(F.inline(F.concat(*parts)))


def execute_query(spark: SparkSession, sql: str, params: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Named-parameter SQL (S5): ``:name`` markers bound from ``params``;
    DataFrames passed as keywords are referenced as ``{name}`` in the text."""
    return spark.sql(sql, args=params or {}, **frames)
