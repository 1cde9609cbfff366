"""Distinct customers of any range of days from stored sketches.

An exact distinct count can't be added up over days. :func:`daily_sketches` stores a HyperLogLog sketch of each day's
customers beside the summary; the sketches of a range merge in the time it takes to read them, one small
row per day. The estimate's standard error is 1.04 / sqrt(2^lg_k) of the count.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.operators.analytics import not_cancelled, order_value
from changeflow.session import folder_names, scratch_path

LG_K = 14
DAY = "summary_date"


def relative_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """The estimate's relative error at so many standard deviations."""
    return deviations * 1.04 / math.sqrt(1 << lg_k)


def daily_sketches(orders: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """Per day of non-cancelled orders: how many, their value, and a sketch of their customers."""
    return not_cancelled(orders).groupBy(F.to_date("order_date").alias(DAY)).agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum(order_value()).alias("total_revenue"),
        F.hll_sketch_agg("customer_id", lg_k).alias("customers"))


def write_sketches(sketches: DataFrame, path: str) -> None:
    """Store sketches, replacing only the days that are there.

    A day is one small row, so rows are kept by year: the touched years' other days are read, and these years
    written anew, some megabytes each.
    """
    spark = sketches.sparkSession
    rows = sketches.withColumn("year", F.year(DAY))
    if folder_names(spark, path):
        stored, new, merged = spark.read.parquet(path), scratch_path(spark, "sketches-new"), scratch_path(spark, "sketches-merged")
        rows.write.parquet(new)
        rows = spark.read.parquet(new)
        years = [r[0] for r in rows.select("year").distinct().collect()]
        kept = stored.where(F.col("year").isin(years)).join(rows.select(DAY), DAY, "left_anti").select(*rows.columns)
        rows.unionByName(kept).write.parquet(merged)                   # a path can't be read and replaced at once
        rows = spark.read.parquet(merged)
    (rows.repartition("year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year")
     .parquet(path))


def customers_by_range(sketches: DataFrame, ranges: list[tuple], lg_k: int = LG_K) -> DataFrame:
    """Per range of days (first, last), both included: orders, revenue and the estimated distinct customers with its bounds.

    One pass over the days' rows, whatever the number of ranges: a day's row goes to each range that holds it.
    """
    spans = F.array(*[F.struct(F.lit(a).cast("date").alias("first_day"), F.lit(b).cast("date").alias("last_day")) for a, b in ranges])
    day = F.col(DAY)
    held = F.filter(spans, lambda r: (r["first_day"] <= day) & (day <= r["last_day"]))
    low, high = min(str(a) for a, _ in ranges), max(str(b) for _, b in ranges)
    inside = sketches.where((day >= F.lit(low).cast("date")) & (day <= F.lit(high).cast("date")))
    if "year" in sketches.columns:
        inside = inside.where(F.col("year").between(F.year(F.lit(low).cast("date")), F.year(F.lit(high).cast("date"))))
    rows = inside.select(F.inline(held), "total_orders", "total_revenue", "customers")
    error = relative_error(lg_k)
    merged = rows.groupBy("first_day", "last_day").agg(
        F.sum("total_orders").alias("total_orders"), F.sum("total_revenue").cast("double").alias("total_revenue"),
        F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("customers"))
    return merged.select("*", F.floor(F.col("customers") / (1 + error)).alias("customers_low"),
                         F.ceil(F.col("customers") / (1 - error)).alias("customers_high"))
