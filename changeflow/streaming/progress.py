"""Progress reports of streaming queries, kept in a table, and the metrics they give.

A query keeps its newest reports only. :class:`ProgressLog` listens to all of them and appends them to a
table, so the driver holds a bounded number however long the queries run.

The documented alert metrics come out of runs: :func:`stream_metrics` takes batch duration, consumer lag and the lag
behind the source's changes from the reports, :func:`timed_reports` the response time of analytics queries.
:func:`changeflow.operators.metrics.alert_rules` judges them.
"""

from __future__ import annotations

import json
import time
from collections import deque
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

_REPORT = "query_id string, run_id string, batch_id long, timestamp string, report string"
# The name under which a stream's own events are observed.
EVENTS = "events_seen"


def _row(report: dict) -> tuple:
    return report.get("id"), report.get("runId"), report.get("batchId"), report.get("timestamp"), json.dumps(report)


class ProgressLog(StreamingQueryListener):
    """Appends the progress reports of all queries to the table at ``path``, ``flush_every`` at a time.

    Register with ``spark.streams.addListener``. The driver holds at most ``keep`` reports: those that wait to be written or,
    without a ``path``, the newest ones. ``lost`` counts reports that had to be let go because there is no
    path or writing failed; :func:`progress_frame` then refuses to give a history with a hole. A query's end writes what is held.
    """

    def __init__(self, path: str | None = None, flush_every: int = 100, keep: int = 1000):
        self.path, self.flush_every, self.lost, self.failure = path, max(1, int(flush_every)), 0, None
        self.reports: deque[dict] = deque(maxlen=max(int(keep), self.flush_every))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.lost += len(self.reports) == self.reports.maxlen
        self.reports.append(json.loads(event.progress.json))
        if len(self.reports) >= self.flush_every:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        """Write the held reports. What can't be written stays held, and the reason in ``failure``."""
        if not self.path or not self.reports:
            return
        spark, rows = SparkSession.active(), [_row(r) for r in self.reports]
        try:
            spark.createDataFrame(rows, _REPORT).coalesce(1).write.mode("append").parquet(self.path)
        except Exception as exc:
            self.failure = exc
            return
        for _ in rows:
            self.reports.popleft()


def progress_reports(spark: SparkSession, source: StreamingQuery | ProgressLog | str) -> DataFrame:
    """Reports as JSON, one row per micro-batch: of a query, a log, or the table that a log wrote.

    A source that has let reports go is refused: a query that ran longer than Spark keeps reports for, a log
    without a table that ran longer than it keeps them.
    """
    if isinstance(source, str):
        return spark.read.schema(_REPORT).parquet(source)
    if isinstance(source, ProgressLog):
        if source.lost:
            raise ValueError(f"{source.lost} reports were let go; give the log a path ({source.failure})")
        held = spark.createDataFrame([_row(r) for r in source.reports], _REPORT)
        stored = source.path and _stored(spark, source.path)
        return stored.unionByName(held) if stored else held
    reports = [json.loads(p.json) for p in source.recentProgress]
    kept = int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    if len(reports) >= kept - 1:               # Spark drops the oldest as soon as it has that many
        raise ValueError("the query keeps its newest reports only; use a ProgressLog")
    return spark.createDataFrame([_row(r) for r in reports], _REPORT)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    from changeflow.session import folder_names
    return spark.read.schema(_REPORT).parquet(path) if folder_names(spark, path) else None


_FIELDS = ("struct<numInputRows bigint, inputRowsPerSecond double, processedRowsPerSecond double, "
           "durationMs map<string,bigint>, observedMetrics map<string,map<string,variant>>, "
           "sources array<struct<numInputRows bigint, endOffset variant, latestOffset variant>>>")


def _parsed(reports: DataFrame) -> DataFrame:
    return reports.withColumn("p", F.try_variant_get(F.try_parse_json("report"), "$", _FIELDS))


def progress_frame(spark: SparkSession, source: StreamingQuery | ProgressLog | str) -> DataFrame:
    """Progress, one row per micro-batch, of a query, a :class:`ProgressLog` or its table."""
    p = _parsed(progress_reports(spark, source))
    return p.select("batch_id", "timestamp", F.col("p.numInputRows").alias("num_input_rows"),
                    F.coalesce("p.inputRowsPerSecond", F.lit(0.0)).alias("input_rows_per_second"),
                    F.coalesce("p.processedRowsPerSecond", F.lit(0.0)).alias("processed_rows_per_second"),
                    F.col("p.durationMs")["triggerExecution"].alias("trigger_ms"))


# ----------------------------------------------------------------- metrics
def observe_events(stream: DataFrame, ts_col: str) -> DataFrame:
    """The stream with its newest event time and its rows observed; they appear in its reports."""
    newest = F.max(F.unix_micros(F.col(ts_col).cast("timestamp")))
    return stream.observe(EVENTS, F.count(F.lit(1)).alias("rows"), newest.alias("newest_micros"))


def _offset_lag(source: Column) -> Column:
    """Messages between a source's processed and its newest offsets; NULL if it does not report both as
    topics of partitions."""
    kind = "map<string,map<string,bigint>>"
    end, latest = (F.try_variant_get(source[c], "$", kind) for c in ("endOffset", "latestOffset"))

    def behind(topic: Column, partitions: Column) -> Column:
        done = F.coalesce(F.try_element_at(end, topic), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>")))
        lags = F.transform(F.map_entries(partitions), lambda e: e["value"] - F.coalesce(F.try_element_at(done, e["key"]), F.lit(0)))
        return F.aggregate(lags, F.lit(0).cast("bigint"), lambda a, x: a + F.greatest(x, F.lit(0)))

    topics = F.transform(F.map_entries(latest), lambda e: behind(e["key"], e["value"]))
    return F.when(end.isNotNull() & latest.isNotNull(), F.aggregate(topics, F.lit(0).cast("bigint"), lambda a, x: a + x))


def stream_metrics(reports: DataFrame, *, as_of: Column | None = None, messages: DataFrame | None = None,
                   last_batches: int = 10) -> DataFrame:
    """The alert metrics of the reported queries, long format (metric, value); one that nothing reports is NULL.

    * ``batch_duration_seconds``: the longest of each query's ``last_batches`` batches.
    * ``consumer_lag_messages``: newest minus processed offsets in each query's newest report, where the source
      reports both (Kafka). For a source without such offsets, ``messages`` is what the topic holds, and the
      lag its rows less those that the reports say were read.
    * ``cdc_lag_seconds``: from the newest event that any query has observed
      (:func:`observe_events`) to ``as_of``, the wall clock unless given.
    """
    p = _parsed(reports.dropDuplicates(["query_id", "run_id", "batch_id", "timestamp"]))
    place = F.struct("batch_id", "timestamp")
    # A row per query: a history of any length is combined map-side, never sorted in one place.
    newest = p.groupBy(F.col("query_id").alias("_query")).agg(F.max(place).alias("_newest"))
    placed = p.join(newest, F.col("query_id").eqNullSafe(F.col("_query")))
    one = placed.select(
        (place == F.col("_newest")).alias("last"), (F.col("batch_id") > F.col("_newest.batch_id") - int(last_batches)).alias("recent"),
        F.col("p.numInputRows").alias("rows"), F.col("p.durationMs")["triggerExecution"].alias("ms"),
        F.expr(f"try_variant_get(p.observedMetrics['{EVENTS}']['newest_micros'], '$', 'bigint')").alias("micros"),
        F.aggregate(F.transform("p.sources", _offset_lag), F.lit(None).cast("bigint"),
                    lambda a, x: F.when(x.isNull(), a).otherwise(F.coalesce(a, F.lit(0)) + x)).alias("lag"))
    now = F.current_timestamp() if as_of is None else as_of.cast("timestamp")
    behind = F.sum(F.when(F.col("last"), F.col("lag")))
    if messages is not None:
        held = messages.agg(F.count(F.lit(1)).alias("n")).scalar()
        behind = F.coalesce(behind, F.greatest(held - F.coalesce(F.sum("rows"), F.lit(0)), F.lit(0)))
    row = one.agg((F.max(F.when(F.col("recent"), F.col("ms"))) / 1000.0).alias("batch_duration_seconds"),
                  behind.cast("double").alias("consumer_lag_messages"),
                  F.max("micros").alias("_micros"))
    wide = row.select("batch_duration_seconds", "consumer_lag_messages",
                      ((F.unix_micros(now) - F.col("_micros")) / 1_000_000.0).alias("cdc_lag_seconds"))
    return wide.unpivot([], wide.columns, "metric", "value")


def timed_reports(spark: SparkSession, reports: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """Run analytics reports and time them: (report, rows, seconds), planning included.

    Rows are observed while the report runs; nothing of it is collected.
    """
    found = []
    for name, make in reports.items():
        seen, began = Observation(f"report_{name}"), time.perf_counter()
        make().observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
        found.append((name, int(seen.get["rows"]), time.perf_counter() - began))
    return spark.createDataFrame(found, "report string, rows long, seconds double")


def response_metric(timed: DataFrame) -> DataFrame:
    """``query_response_seconds``, the slowest of the timed reports, long format."""
    return timed.agg(F.max("seconds").alias("value")).select(F.lit("query_response_seconds").alias("metric"), "value")
