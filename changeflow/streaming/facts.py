"""A fact table by day, fed by micro-batches (K3, K4, K9).

Batches arrive in an inbox, ``inbox/stream=<query id>/batch_id=<n>``, written with overwrite: a replay replaces its own
first attempt, whatever day it runs on. :meth:`DayTable.compact` moves them to ``days/<day>``, whose
folders are the partitions of the catalog table: as many as there are days, however many batches came. The
ledger, one row per query, says up to which batch a query's rows have been moved.

:meth:`DayTable.read` gives every row exactly once at any moment: the days, and those batches of the
inbox that the ledger does not cover yet. A filter on the day prunes both.

A compaction stages the new content of the days it touches, records that in the ledger, and renames the staged
days into their place. Until a day is renamed it is read from the stage. A compaction that dies before its
record has changed nothing; one that dies later is finished by the next one. The newest batch of a query may
still be replayed, so it stays in the inbox until the query has gone on.

Each run rewrites the days it touches. Run it when days are closed, as from a daily job, and every row is
written twice in all. One compaction may run at a time; queries may go on writing beside it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from changeflow.session import folder_names, remove_folder, replace_folder
from changeflow.streaming.sinks import MANUAL, BatchSink, not_covered

# Which batch a row came in.
ORIGIN = StructType([StructField("stream", StringType()), StructField("batch_id", LongType())])
_LEDGER = "generation long, staged boolean, stream string, batch_id long"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class DayTable:
    """Rows of ``columns``, each on the day ``day_col``; ``table`` names the catalog table over the days."""

    def __init__(self, spark: SparkSession, path: str, columns: StructType, day_col: str = "processed_date",
                 table: str | None = None):
        self.spark, self.path, self.day_col, self.table = spark, path.rstrip("/"), day_col, table
        self.columns = columns
        self.schema = StructType([*columns.fields, *ORIGIN.fields, StructField(day_col, DateType())])
        self.inbox, self.days, self.stage = (f"{self.path}/{x}" for x in ("inbox", "days", "stage"))

    def put(self, rows: DataFrame, batch_id: int, stream: str = MANUAL) -> None:
        """Write a batch, or replace its earlier attempt."""
        (rows.select(*self.columns.names, self.day_col).write.mode("overwrite").partitionBy(self.day_col)
         .parquet(f"{self.inbox}/stream={stream}/batch_id={int(batch_id)}"))

    def _scan(self, path: str) -> DataFrame:
        if not folder_names(self.spark, path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(path).select(*self.schema.names)

    def ledger(self) -> tuple[int, bool, dict[str, int]]:
        """(generation, whether a stage waits to be put in place, newest moved batch of each query)."""
        try:
            rows = self.spark.read.schema(_LEDGER).option("recursiveFileLookup", "true").parquet(f"{self.path}/_ledger").collect()
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        newest = max((r["generation"] for r in rows), default=0)
        rows = [r for r in rows if r["generation"] == newest]
        return newest, any(r["staged"] for r in rows), {r["stream"]: r["batch_id"] for r in rows if r["stream"] is not None}

    def _record(self, generation: int, staged: bool, done: dict[str, int]) -> None:
        rows = [(generation, staged, s, b) for s, b in [(None, None), *sorted(done.items())]]
        (self.spark.createDataFrame(rows, _LEDGER).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.path}/_ledger/slot={generation % 2}"))

    def _day_folders(self, path: str) -> list[str]:
        return [x for x in folder_names(self.spark, path) if x.startswith(f"{self.day_col}=")]

    def _on(self, folders: list[str]) -> Column:
        """Whether a row's day is one of these folders."""
        names = [f.partition("=")[2] for f in folders]
        found = F.col(self.day_col).isin([dt.date.fromisoformat(n) for n in names if n != _NO_DAY])
        return F.coalesce(found, F.lit(_NO_DAY in names))

    def read(self) -> DataFrame:
        """Every row once: columns, the batch it came in, and the day."""
        _, staged, done = self.ledger()
        moved = self._scan(self.days)
        if staged:
            moved = moved.where(~self._on(self._day_folders(self.stage))).unionByName(self._scan(self.stage))
        return moved.unionByName(not_covered(self._scan(self.inbox), done))

    def batches(self) -> dict[str, list[int]]:
        """The batches in the inbox, by query."""
        found = {}
        for stream in folder_names(self.spark, self.inbox):
            ids = [int(x.partition("=")[2]) for x in folder_names(self.spark, f"{self.inbox}/{stream}") if x.startswith("batch_id=")]
            if stream.startswith("stream=") and ids:
                found[stream.partition("=")[2]] = sorted(ids)
        return found

    def compact(self) -> dict[str, int]:
        """Move all batches but each query's newest one to their days; the newest moved batch of each query."""
        generation, staged, done = self.ledger()
        if staged:
            self._finish(generation, done)
            generation, _, done = self.ledger()
        through = {s: ids[-2] for s, ids in self.batches().items() if len(ids) > 1 and ids[-2] > done.get(s, -1)}
        if not through:
            self._empty_inbox(done)
            return done
        upto = F.create_map(*[F.lit(x) for pair in sorted(through.items()) for x in pair])
        moved = not_covered(self._scan(self.inbox), done).where(F.col("batch_id") <= F.try_element_at(upto, F.col("stream")))
        days = [r[0] for r in moved.select(self.day_col).distinct().collect()]
        old = self._scan(self.days).where(self._on([f"{self.day_col}={d or _NO_DAY}" for d in days]))
        # Rebalanced by day: a big day is split into files of the advisory size, small ones are put together.
        (old.unionByName(moved).hint("rebalance", self.day_col).write.mode("overwrite").partitionBy(self.day_col)
         .parquet(self.stage))
        self._record(generation + 1, True, done | through)
        self._finish(generation + 1, done | through)
        return done | through

    def _finish(self, generation: int, done: dict[str, int]) -> None:
        folders = self._day_folders(self.stage)
        for folder in folders:
            replace_folder(self.spark, f"{self.stage}/{folder}", f"{self.days}/{folder}")
        if self.table:
            known = {r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()}       # one row per day
            for folder in sorted(set(self._day_folders(self.days)) - known):
                day = folder.partition("=")[2]
                value = "NULL" if day == _NO_DAY else f"DATE '{day}'"
                self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS PARTITION ({self.day_col} = {value}) "
                               f"LOCATION '{self.days}/{folder}'")
            self.spark.catalog.refreshTable(self.table)
        self._record(generation + 1, False, done)
        remove_folder(self.spark, self.stage)
        self._empty_inbox(done)

    def _empty_inbox(self, done: dict[str, int]) -> None:
        for stream, ids in self.batches().items():
            for batch in ids:
                if batch <= done.get(stream, -1):
                    remove_folder(self.spark, f"{self.inbox}/stream={stream}/batch_id={batch}")


class DayTableSink(BatchSink):
    """``foreachBatch`` handler that puts each batch into a :class:`DayTable`, its day the date of ``time_col``."""

    def __init__(self, path: str, columns: StructType, time_col: str, day_col: str = "processed_date", table: str | None = None):
        self.path, self.columns, self.time_col, self.day_col, self.table = path, columns, time_col, day_col, table

    def on(self, spark: SparkSession) -> DayTable:
        return DayTable(spark, self.path, self.columns, self.day_col, self.table)

    def __call__(self, batch: DataFrame, batch_id: int, stream: str = MANUAL) -> None:
        self.on(batch.sparkSession).put(batch.withColumn(self.day_col, F.to_date(self.time_col)), batch_id, stream)
