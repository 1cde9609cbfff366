"""Starting and driving streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from changeflow.session import folder_names
from changeflow.streaming.sinks import BatchSink, checkpoint_query_id


def start_query(df: DataFrame, *, checkpoint: str, sink: str = "console", output_mode: str = "append",
                processing_time: str | None = "10 seconds", available_now: bool = False,
                foreach_batch: Callable | None = None, path: str | None = None,
                query_name: str | None = None, options: dict | None = None) -> StreamingQuery:
    """Start ``df`` on a sink with a per-query checkpoint (required).

    ``available_now=True`` processes what is there in bounded micro-batches
    and stops (the bounded run); otherwise a ``processing_time`` trigger.
    ``sink`` is any Spark sink name (console, parquet, memory, kafka, ...);
    ``foreach_batch`` takes ``(batch_df, batch_id)`` instead.
    """
    if not checkpoint:
        raise ValueError("a checkpoint location is required")
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    if isinstance(foreach_batch, BatchSink):
        def deliver(batch: DataFrame, batch_id: int) -> None:
            foreach_batch(batch, batch_id, checkpoint_query_id(batch.sparkSession, checkpoint))
        w = w.foreachBatch(deliver)
    elif foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(sink)
        if sink == "console":
            w = w.option("truncate", "false")
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return w.start(path) if path else w.start()


def _wait(q: StreamingQuery, timeout_s: float | None) -> None:
    """Wait for the end of a bounded query; its failure is raised, and so is running out of time."""
    ended = q.awaitTermination(timeout_s) if timeout_s is not None else (q.awaitTermination(), True)[1]
    if not ended:
        q.stop()
        raise TimeoutError(f"the query did not end in {timeout_s} s; its checkpoint keeps what it committed")


def run_available(df: DataFrame, *, checkpoint: str, timeout_s: float | None = None, **kwargs) -> StreamingQuery:
    """Run to the end of the currently available input and wait for it.

    Raises ``TimeoutError`` when ``timeout_s`` is not enough: the run is then
    incomplete, and the next one goes on from the checkpoint.
    """
    q = start_query(df, checkpoint=checkpoint, available_now=True, **kwargs)
    _wait(q, timeout_s)
    return q


class _Enough(Exception):
    """Ends a bounded run before a batch is handled, so that batch stays uncommitted."""


_HANDED = "batch_id long, handed long"


class BoundedConsumer:
    """``foreachBatch`` handler for the bounded consumer.

    Hands each micro-batch to ``handler(df, batch_id)``, which returns how many
    messages it processed. Once ``max_messages`` have succeeded the next batch
    is refused: it fails inside the query before anything is committed, so a
    later run with the same checkpoint starts with exactly that batch. A batch
    whose handler fails is not committed either.

    With ``order_by`` (such as topic partition and offset) and a ``ledger`` folder the bound is met to the message: a batch is
    handed over in that order, no more messages at a time than may still succeed. Where the bound is reached inside a batch, the
    ledger says how many of its messages were handed over, and the run that repeats the batch goes on behind them.
    """

    def __init__(self, handler: Callable, max_messages: int, *, order_by: list[str] | None = None, ledger: str | None = None):
        if bool(order_by) != bool(ledger):
            raise ValueError("a bound to the message needs both order_by and ledger")
        self.handler, self.max_messages, self.processed, self.refused = handler, int(max_messages), 0, False
        self.order_by, self.ledger = order_by, ledger and ledger.rstrip("/")

    @property
    def done(self) -> bool:
        return self.processed >= self.max_messages

    def _refuse(self, batch_id: int) -> None:
        self.refused = True
        raise _Enough(f"{self.processed} messages processed; batch {batch_id} is left for the next run")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.done:
            self._refuse(batch_id)
        if not self.order_by:
            self.processed += int(self.handler(batch, batch_id))
            return
        spark, held = batch.sparkSession, batch.count()
        turn, handed = self._handed(spark, batch_id)
        while handed < held:
            if self.done:
                self._refuse(batch_id)
            n = min(self.max_messages - self.processed, held - handed)
            self.processed += int(self.handler(batch.orderBy(*self.order_by).offset(handed).limit(n), batch_id))
            turn, handed = turn + 1, handed + n
            # Two slots take turns, so the last record stays while the next is written.
            (spark.createDataFrame([(batch_id, handed)], _HANDED).coalesce(1).write.mode("overwrite")
             .parquet(f"{self.ledger}/slot={turn % 2}"))

    def _handed(self, spark: SparkSession, batch_id: int) -> tuple[int, int]:
        """(slot of the newest record, messages of this batch that earlier runs handed over)."""
        if not folder_names(spark, self.ledger):
            return 0, 0
        rows = spark.read.schema(f"{_HANDED}, slot int").parquet(self.ledger).collect()
        newest = max(rows, key=lambda r: (r["batch_id"], r["handed"]), default=None)
        if newest is None:
            return 0, 0
        return newest["slot"], newest["handed"] if newest["batch_id"] == batch_id else 0


def consume_bounded(df: DataFrame, consumer: BoundedConsumer, *, checkpoint: str,
                    timeout_s: float | None = 600) -> StreamingQuery:
    """Run ``df`` through ``consumer`` until it has processed enough or the available input ends.

    Input is taken in micro-batches (``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``); the
    bound is met to the batch, or to the message if the consumer is told their order. Failures of the handler and running out of time are raised.
    """
    q = start_query(df, checkpoint=checkpoint, foreach_batch=consumer, available_now=True)
    try:
        _wait(q, timeout_s)
    except StreamingQueryException:
        if not consumer.refused:
            raise
    return q
