"""Anomaly statistics from stored per-day moments.

:func:`daily_moments` keeps, per day of non-cancelled orders, the count, the exact sum and the squared deviations
from the day's own mean of order value and quantity. Such rows merge without the orders
behind them: several rows of a day (one per micro-batch) and several days. So a detection reads some rows per day instead
of all orders of the statistics' days, and the orders it judges are the only ones it scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.time import last_days, resolve_as_of
from changeflow.operators.analytics import flag_anomalies, not_cancelled, order_value
from changeflow.schemas import MOMENTS
from changeflow.streaming.facts import DayTable
from changeflow.streaming.sinks import MANUAL, BatchSink

DAY = "order_day"


def daily_moments(orders: DataFrame) -> DataFrame:
    """Per day: orders, Σ value, Σ (value - mean)², and both for the quantity. Combined map-side."""
    def m2(c: Column) -> Column:
        return F.var_pop(c.cast("double")) * F.count(c)

    value, quantity = order_value(), F.col("quantity")
    return not_cancelled(orders).groupBy(F.to_date("order_date").alias(DAY)).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(value).cast("decimal(38,2)").alias("value_sum"), m2(value).alias("value_m2"),
        F.sum(quantity.cast("bigint")).alias("quantity_sum"), m2(quantity).alias("quantity_m2"))


def merged_stats(moments: DataFrame) -> Column:
    """Means and sample deviations of all orders behind some rows of moments, as a scalar struct.

    Squared deviations add up, with those of each row's mean from the common one on top. No difference of large
    sums is taken, so nothing cancels.
    """
    means = moments.agg(F.struct(
        F.try_divide(F.sum("value_sum").cast("double"), F.sum("orders").cast("double")).alias("value"),
        F.try_divide(F.sum("quantity_sum").cast("double"), F.sum("orders").cast("double")).alias("quantity"))).scalar()
    n = F.col("orders").cast("double")

    def deviation(name: str) -> Column:
        apart = F.col(f"{name}_sum").cast("double") / n - means[name]
        total = F.sum(F.col(f"{name}_m2") + n * apart * apart)
        return F.when(F.sum("orders") > 1, F.sqrt(total / (F.sum("orders") - 1)))

    return moments.agg(F.struct(means["value"].alias("avg_value"), deviation("value").alias("sd_value"),
                                means["quantity"].alias("avg_qty"), deviation("quantity").alias("sd_qty"))).scalar()


def detect_anomalies_from(moments: DataFrame, orders: DataFrame, threshold_multiplier: float = 2.0, *, stats_days: int = 7,
                          candidate_days: int = 1, as_of=None) -> DataFrame:
    """As ``analytics.detect_anomalies``, its statistics merged from ``moments`` of the last ``stats_days`` days."""
    anchor = resolve_as_of(orders, as_of)
    history = moments.where(F.col(DAY) >= F.date_sub(F.to_date(anchor), int(stats_days)))
    candidates = last_days(not_cancelled(orders), anchor, candidate_days)
    return flag_anomalies(candidates, merged_stats(history), threshold_multiplier).orderBy(F.col("order_date").desc())


class AnomalySink(BatchSink):
    """``foreachBatch`` handler that flags the orders of each batch and keeps the moments up to date.

    A batch is judged by the moments of the ``stats_days`` days before its newest order: those stored by earlier batches, and its own.
    Moments go to a :class:`DayTable` at ``<path>/moments``, flagged orders to ``<path>/flagged/stream=<id>/batch_id=<n>``; a
    replay replaces both. Other queries that feed the same moments count with what they have written.
    """

    def __init__(self, path: str, threshold_multiplier: float = 2.0, stats_days: int = 7):
        self.path, self.k, self.stats_days = path.rstrip("/"), float(threshold_multiplier), int(stats_days)

    def moments(self, spark: SparkSession) -> DayTable:
        return DayTable(spark, f"{self.path}/moments", MOMENTS, DAY)

    def flagged(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/flagged")

    def __call__(self, batch: DataFrame, batch_id: int, stream: str = MANUAL) -> None:
        store, orders = self.moments(batch.sparkSession), not_cancelled(batch).persist()       # read three times
        try:
            store.put(daily_moments(orders), batch_id, stream)
            newest = F.to_date(orders.select(F.max("order_date")).scalar())
            history = store.read().where(F.col(DAY) >= F.date_sub(newest, self.stats_days))
            flags = flag_anomalies(orders, merged_stats(history), self.k)
            flags.write.mode("overwrite").parquet(f"{self.path}/flagged/stream={stream}/batch_id={int(batch_id)}")
        finally:
            orders.unpersist()
