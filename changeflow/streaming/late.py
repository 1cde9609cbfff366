"""Late rows kept instead of lost.

Spark drops a row behind the watermark without a trace. :class:`LateSplitter` takes the same decision in front of
a windowed query and writes both sides: rows in time, which a windowed query then reads as its source,
and late rows with a reason, which join the dead letters. Every row of the input is in one of the two.

The watermark of a batch is the newest event time of all earlier batches less the delay, to the millisecond, and a row
is late when its window (or, without windows, the row itself) lies at or behind it. A windowed query with the same delay that
reads the rows in time has seen no newer ones before a batch, so it drops nothing, however its own batches are cut. (Spark by itself may
let a row through one batch longer, while its window is still open.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from changeflow.session import folder_names, publish_folder
from changeflow.streaming.sinks import MANUAL, BatchSink

_SEEN = "batch_id long, newest_ms long"
IN_TIME, LATE = "in_time", "late"


class LateSplitter(BatchSink):
    """``foreachBatch`` handler that writes rows in time and late rows apart, in one pass.

    ``delay`` and ``window`` are intervals such as "10 minutes"; a batch's rows land in
    ``<path>/rows/stream=<id>/batch_id=<n>/_outcome=<in_time|late>``. They appear at once, by a rename, and then stay: a stream that reads them
    never sees a batch twice. A replay has the same rows and decides as the first attempt did, as the newest event time
    is kept per batch, in two slots that take turns; what the first attempt has published is left in place.
    """

    def __init__(self, path: str, ts_col: str, delay: str, window: str | None = None):
        self.path, self.ts_col, self.delay, self.window = path.rstrip("/"), ts_col, delay, window

    def _seen(self, stream: str) -> str:
        return f"{self.path}/_seen/stream={stream}"

    def newest_before(self, spark: SparkSession, batch_id: int, stream: str = MANUAL) -> int | None:
        """The newest event time, in milliseconds, of the query's batches before ``batch_id``."""
        if not folder_names(spark, self._seen(stream)):
            return None
        seen = spark.read.schema(_SEEN).option("recursiveFileLookup", "true").parquet(self._seen(stream))
        earlier = [r["newest_ms"] for r in seen.where(F.col("batch_id") < int(batch_id)).collect()]    # at most two rows
        return max((x for x in earlier if x is not None), default=None)

    def _end(self) -> Column:
        ts = F.col(self.ts_col).cast("timestamp")
        return ts if self.window is None else F.window(ts, self.window)["end"]

    def split(self, batch: DataFrame, newest_ms: int | None) -> DataFrame:
        """The batch with ``reject_reason`` (``late``) and the ``watermark`` it was judged by."""
        if newest_ms is None:
            mark = F.lit(None).cast("timestamp")
        else:
            # As Spark's: the delay is taken off the newest time, in milliseconds.
            mark = F.timestamp_millis(F.lit(newest_ms)) - F.expr(f"INTERVAL {self.delay}")
        late = F.coalesce(self._end() <= mark, F.lit(False))
        return batch.select("*", F.when(late, "late").alias("reject_reason"), mark.alias("watermark"))

    def __call__(self, batch: DataFrame, batch_id: int, stream: str = MANUAL) -> None:
        spark = batch.sparkSession
        before, seen = self.newest_before(spark, batch_id, stream), Observation(f"late_{int(batch_id)}")
        rows = self.split(batch, before).observe(seen, F.max(F.unix_millis(F.col(self.ts_col).cast("timestamp"))).alias("newest"))
        out = rows.withColumn("_outcome", F.when(F.col("reject_reason").isNull(), IN_TIME).otherwise(LATE))
        folder = f"stream={stream}/batch_id={int(batch_id)}"
        out.write.mode("overwrite").partitionBy("_outcome").parquet(f"{self.path}/_pending/{folder}")
        own = seen.get["newest"]
        newest = max((x for x in (before, own) if x is not None), default=None)
        (spark.createDataFrame([(int(batch_id), newest)], _SEEN).coalesce(1).write.mode("overwrite")
         .parquet(f"{self._seen(stream)}/slot={int(batch_id) % 2}"))
        publish_folder(spark, f"{self.path}/_pending/{folder}", f"{self.path}/rows/{folder}")

    def _side(self, spark: SparkSession, outcome: str) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows").where(F.col("_outcome") == outcome).drop("_outcome")

    def in_time(self, spark: SparkSession) -> DataFrame:
        return self._side(spark, IN_TIME).drop("reject_reason", "watermark")

    def late(self, spark: SparkSession) -> DataFrame:
        """Late rows with their reason, the watermark, and the batch they came in."""
        return self._side(spark, LATE)

    def in_time_stream(self, spark: SparkSession, schema, **options) -> DataFrame:
        """Rows in time as a stream, for windowed queries behind the splitter."""
        reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
        for k, v in options.items():
            reader = reader.option(k, v)
        return reader.parquet(f"{self.path}/rows/*/*/_outcome={IN_TIME}")
