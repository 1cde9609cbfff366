"""Current-state upkeep for a change stream (R1, streaming form).

Two forms:

* :func:`state_updates` — the scalable one: the latest row per key lives in
  Spark's state store (RocksDB, incremental checkpoints), and each micro-batch touches
  only its own keys. :func:`maintain_state` runs it without any output, and
  :func:`read_state` reads the newest committed state out of the query's checkpoint: one
  row per key, no log to fold, cost following the state and not its history. Where changes are
  wanted downstream too, an idempotent sink appends the updates to a changelog;
  :func:`read_state_changelog` folds one, and :func:`compact_state_changelog` writes that fold
  as a base, after which readers leave the batches it covers out.
* :class:`CurrentStateWriter` — a ready-to-query snapshot per batch, for
  small states (it rewrites the state each batch).

A snapshot writer's version is the latest row per key over (previous version ∪ batch).
Deletes are kept as tombstones inside the state so an older change arriving later cannot
resurrect a deleted key; readers hide them. Versions go round ``keep_versions`` slots, each
overwritten when its turn comes, and so do their commits: a commit holds the newest batch of each query that
writes the state, one row per query, and counts once its file is there. So the
folder never has more files than slots, however many batches are written. A replayed batch finds its own commit
and skips; a query with a fresh checkpoint has another id, so its batch 0 is a new batch.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from changeflow.operators.cdc import current_state, is_delete
from changeflow.streaming.runner import run_available
from changeflow.streaming.sinks import MANUAL, BatchSink, not_covered


def state_updates(changes: DataFrame, key: str, order_by: list[str], *, op_col: str = "op",
                  columns: list[str] | None = None) -> DataFrame:
    """Latest row per key as a streaming aggregate (run with output mode
    ``update``). Deletes are emitted as tombstone rows; a late, older change
    never replaces a newer one because the state keeps the max by ordering."""
    return current_state(changes, key, order_by, op_col=op_col, columns=columns, keep_tombstones=True)


def maintain_state(changes: DataFrame, key: str, order_by: list[str], *, checkpoint: str, op_col: str = "op",
                   columns: list[str] | None = None, **run) -> StreamingQuery:
    """Apply what is available of a change stream to the state under ``checkpoint``; nothing else is written."""
    updates = state_updates(changes, key, order_by, op_col=op_col, columns=columns)
    return run_available(updates, checkpoint=checkpoint, sink="noop", output_mode="update", **run)


def read_state(spark: SparkSession, checkpoint: str, key: str, *, op_col: str = "op", delete_ops=("d",),
               keep_tombstones: bool = False, batch_id: int | None = None) -> DataFrame:
    """The state of a :func:`state_updates` query, read from its state store with Spark's reader.

    ``batch_id`` reads the state as it was after that batch, as long as the checkpoint still has it.
    """
    reader = spark.read.format("statestore").option("path", checkpoint)
    if batch_id is not None:
        reader = reader.option("batchId", int(batch_id))
    store = reader.load()
    # The aggregate keeps the newest row and its place in the order, both as structs.
    rows = next(f.name for f in store.schema["value"].dataType.fields
                if isinstance(f.dataType, StructType) and op_col in f.dataType.names)
    state = store.select(F.col(f"key.{key}").alias(key), F.col(f"value.{rows}.*"))
    return state if keep_tombstones else state.where(~is_delete(op_col, delete_ops))


def _covered(spark: SparkSession, path: str) -> dict[str, int]:
    """Batches of a changelog that a base already holds: the newest one per query."""
    try:
        rows = spark.read.schema("stream string, batch_id long").parquet(f"{path.rstrip('/')}/_covered").collect()
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    return {r["stream"]: r["batch_id"] for r in rows}


def _changelog(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    done: dict[str, int] = {}
    for path in paths:
        for stream, batch in _covered(spark, path).items():
            done[stream] = max(batch, done.get(stream, -1))
    log = None
    for path in paths:
        part = spark.read.parquet(path)
        if "batch_id" in part.columns:
            part = not_covered(part, done).drop("stream", "batch_id")
        log = part if log is None else log.unionByName(part)
    return log


def read_state_changelog(spark: SparkSession, path: str | list[str], key: str, order_by: list[str], *,
                         op_col: str = "op", delete_ops=("d",), keep_tombstones: bool = False) -> DataFrame:
    """Fold one or more update changelogs into the current state."""
    log = _changelog(spark, path)
    cols = [c for c in log.columns if c not in (key, op_col)]
    return current_state(log, key, order_by, op_col=op_col, delete_ops=delete_ops, columns=cols,
                         keep_tombstones=keep_tombstones)


def compact_state_changelog(spark: SparkSession, path: str | list[str], base: str, key: str, order_by: list[str], *,
                            op_col: str = "op") -> None:
    """Write the fold of a changelog to ``base``, one row per key, tombstones included.

    The base records the newest batch per query that it holds. A reader of ``[base, log]`` reads later
    batches of the log only, so the older ones are no longer read and may be removed; compacting ``[base, log]`` to a
    new base goes on from there.
    """
    paths = [path] if isinstance(path, str) else list(path)
    held: dict[str, int] = {}
    for p in paths:
        log = spark.read.parquet(p)
        newest = dict(log.groupBy("stream").agg(F.max("batch_id")).collect()) if "batch_id" in log.columns else {}
        for stream, batch in [*_covered(spark, p).items(), *newest.items()]:
            held[stream] = max(batch, held.get(stream, -1))
    fold = _changelog(spark, paths)
    cols = [c for c in fold.columns if c not in (key, op_col)]
    folded = current_state(fold, key, order_by, op_col=op_col, columns=cols, keep_tombstones=True)
    folded.write.mode("errorifexists").parquet(base)
    rows = spark.createDataFrame(sorted(held.items()), "stream string, batch_id long")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{base.rstrip('/')}/_covered")


_COMMIT = "version long, slot int, stream string, batch_id long"


def _commits(spark: SparkSession, path: str) -> DataFrame | None:
    """The commits of the newest versions, or None if nothing was ever committed. Any other failure to read them is
    raised: an unreadable table is not an empty one."""
    try:
        return spark.read.schema(_COMMIT).option("recursiveFileLookup", "true").parquet(f"{path.rstrip('/')}/_commits")
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def newest_commit(spark: SparkSession, path: str) -> tuple[int, int, dict[str, int]]:
    """(newest committed version, its slot, newest committed batch of each query); -1, -1 and nothing before the first."""
    commits = _commits(spark, path)
    rows = [] if commits is None else commits.collect()          # one row per query and slot
    version = max((r["version"] for r in rows), default=-1)
    newest = [r for r in rows if r["version"] == version]
    return version, (newest[0]["slot"] if newest else -1), {r["stream"]: r["batch_id"] for r in newest}


class CurrentStateWriter(BatchSink):
    """``foreachBatch`` handler maintaining the latest row per key."""

    def __init__(self, path: str, key: str, order_by: list[str], op_col: str = "op",
                 delete_ops=("d",), columns: list[str] | None = None, touch_col: str | None = None,
                 keep_versions: int = 2):
        """``touch_col`` (e.g. ``updated_at``) is set to the apply time on every
        key the batch changes — the source table's update trigger (P22)."""
        self.path = path.rstrip("/")
        self.key, self.order_by, self.op_col = key, list(order_by), op_col
        self.delete_ops, self.columns, self.touch_col = tuple(delete_ops), columns, touch_col
        self.keep_versions = max(2, int(keep_versions))       # the one read and the one written

    def _latest(self, df: DataFrame) -> DataFrame:
        cols = self.columns or [c for c in df.columns if c != self.key]
        carried = list(dict.fromkeys([c for c in cols if c in df.columns] + [self.op_col] + self.order_by))
        return current_state(df, self.key, self.order_by, op_col=self.op_col, columns=carried, keep_tombstones=True)

    def __call__(self, batch: DataFrame, batch_id: int, stream: str = MANUAL) -> None:
        spark = batch.sparkSession
        version, slot, done = newest_commit(spark, self.path)
        if batch_id <= done.get(stream, -1):
            return                                   # replay of a committed batch
        changes = self._latest(batch)
        if self.touch_col:
            changes = changes.withColumn(self.touch_col, F.current_timestamp())
        if version >= 0:
            prev = spark.read.parquet(f"{self.path}/slot={slot}")
            latest = current_state(prev.unionByName(changes.select(*prev.columns)), self.key, self.order_by,
                                   op_col=self.op_col, columns=[c for c in prev.columns if c != self.key],
                                   keep_tombstones=True)
            changes = latest.select(*prev.columns)
        slot = (slot + 1) % self.keep_versions
        changes.write.mode("overwrite").parquet(f"{self.path}/slot={slot}")
        rows = [(version + 1, slot, s, b) for s, b in sorted((done | {stream: int(batch_id)}).items())]
        (spark.createDataFrame(rows, _COMMIT).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.path}/_commits/slot={slot}"))


def read_current_state(spark: SparkSession, path: str, op_col: str = "op", delete_ops=("d",)) -> DataFrame:
    """The newest committed version without tombstones."""
    version, slot, _ = newest_commit(spark, path)
    if version < 0:
        raise FileNotFoundError(f"no committed state under {path}")
    state = spark.read.parquet(f"{path.rstrip('/')}/slot={slot}")
    return state.where(~is_delete(op_col, delete_ops))
