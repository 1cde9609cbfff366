"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its shuffled documents, repeated for up to
``max_epochs`` passes. A queued document finishes at the virtual time
``words of its source up to and including it / target of its source``. The
queues are merged by finish time and the merged order is cut where the total
budget is spent, so at any cut the sources stand in the ratio of their targets.

Scale: a source may hold any share of the rows. Its shuffled order is cut into
``16 ** slice_digits`` slices by hash; running sums are taken over slice totals
first and then inside each slice, so no task ever sees a whole source. The
global cut is found the same way, over a histogram of finish times first and
then inside the one bin that holds the cut.

Defined cases: a null text has no words; documents of size 0 are never taken; a
null source is a source of its own, last in order; equal or repeated rows are
separate documents; an empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import carry as pack
from changeflow.llm.common import materialize, unpack, word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
FINISH_BINS = 4096


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source (``source``, ``source_size``) -> the same with ``target`` (double).

    Weights repeat over the sources in code-point order, null last. Targets share
    the total of all sizes by weight; none exceeds ``max_epochs`` times its
    source's size, and what is cut off goes to the others by weight. Sorted by
    size over weight, the capped sources come first, so one pass of running sums
    finds the common level of the rest. The windows run over one row per source.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = sizes.withColumn(
        "weight", F.element_at(cycle, ((F.row_number().over(everything) - 1) % len(weights)).cast("int") + 1))
    ranked = ranked.withColumn("cap", F.col("source_size") * max_epochs)
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = Window.partitionBy()
    ranked = ranked.withColumn("level", (
        (F.sum("source_size").over(total) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
        / F.sum("weight").over(after).cast("double")))
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    level = F.min_by(F.col("level"), F.when(fits, F.col("cap") / F.col("weight"))).over(total)
    target = F.least(level * F.col("weight"), F.col("cap").cast("double"))
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def shuffle_key(id_col: Column, seed: int) -> Column:
    """The pseudo-random place of a document in its source's queue."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.lit("null"))))


def weighted_fair_mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                      weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 7,
                      slice_digits: int = 3, carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: ``id_col``, ``source_col``, ``size``, ``source_size``, ``target``, ``copies``,
    ``taken``, ``first_finish`` and the ``carry`` columns of the input.

    ``copies`` is how often the mix repeats the document (0 to ``max_epochs``), ``taken`` its words
    with repeats. ``first_finish`` is the virtual time of its first copy.
    """
    key = shuffle_key(F.col(f"`{id_col}`"), seed)
    queued = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"),
        word_count(F.col(f"`{text_col}`")).alias("size"), key.alias("key"),
        F.substring(key, 1, slice_digits).alias("slice"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("tie"),
        pack(carry))
    if not carry:              # narrow rows are kept; with carried texts, counting words twice is cheaper than a copy
        queued = materialize(queued, "mix-queue")

    slices = queued.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    run = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.coalesce(F.sum("slice_size").over(run), F.lit(0)))
    sizes = slices.groupBy("source").agg(F.sum("slice_size").alias("source_size"))
    targets = source_targets(sizes, weights, max_epochs)
    slices = slices.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        "s.source", "s.slice", "before", "source_size", "target")

    inside = Window.partitionBy("q.source", "q.slice").orderBy("key", "id", "tie", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = queued.alias("q").join(
        slices.alias("s"), (F.col("q.slice") == F.col("s.slice")) & F.col("q.source").eqNullSafe(F.col("s.source")))
    placed = materialize(placed.select(
        "id", F.col("q.source").alias("source"), "size", "key", "tie", "carried", "source_size", "target",
        (F.col("before") + F.sum("size").over(inside)).alias("served")), "mix-placed")

    passes = [_item(F.lit(e)) for e in range(max_epochs)]
    cut = _cut(placed, max_epochs)
    live = (F.col("size") > 0) & (F.col("target") > 0)
    if cut is None:
        copies = F.when(live, F.lit(max_epochs)).otherwise(0)
    else:
        copies = F.when(live, sum((F.when(p <= cut, 1).otherwise(0) for p in passes), F.lit(0))).otherwise(0)
    return unpack(placed.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        copies.cast("int").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"),
        passes[0]["finish"].alias("first_finish"), "carried"), carry)


def _item(epoch: Column) -> Column:
    """A queued copy of a document, as the tuple by which all copies are ordered."""
    finish = F.try_divide((F.col("source_size") * epoch + F.col("served")).cast("double"), F.col("target"))
    return F.struct(finish.alias("finish"), F.coalesce(F.col("source"), F.lit("")).alias("source"),
                    F.col("source").isNull().alias("no_source"), epoch.cast("int").alias("epoch"),
                    F.col("key").alias("key"), F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"),
                    F.col("tie").alias("tie"), F.col("served").alias("served"))


def _cut(placed: DataFrame, max_epochs: int) -> Column | None:
    """The last copy that the budget (the total size) still covers, as a literal; None if all fit.

    Two bounded reads on the driver: the bin of the cut (one row) and the cut itself (one row).
    """
    items = placed.where((F.col("size") > 0) & (F.col("target") > 0)).select(
        "size", F.explode(F.array(*[_item(F.lit(e)) for e in range(max_epochs)])).alias("item"))
    # Times of 2 and more share the last bin: all targets are spent at about 1.
    items = items.withColumn("bin", F.least(F.floor(F.col("item.finish") * FINISH_BINS), F.lit(2 * FINISH_BINS)))
    bins = items.groupBy("bin").agg(F.sum("size").alias("bin_size"))
    run = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    budget = placed.agg(F.sum("size").alias("budget")).first()["budget"] or 0
    over = bins.withColumn("spent", F.sum("bin_size").over(run)).where(F.col("spent") > budget).orderBy("bin").first()
    if over is None:
        return None
    left = budget - (over["spent"] - over["bin_size"])
    inside = Window.orderBy("item").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (items.where(F.col("bin") == over["bin"]).withColumn("spent", F.sum("size").over(inside))
            .where(F.col("spent") <= left).agg(F.max("item").alias("item")).first()["item"])
    if last is None:           # nothing of this bin fits: the cut is the bin's lower edge
        edge = over["bin"] / FINISH_BINS
        last = {"finish": edge, "source": "", "no_source": False, "epoch": -1, "key": "", "id": "", "tie": -2 ** 63,
                "served": -1}
    kinds = {"finish": "double", "source": "string", "no_source": "boolean", "epoch": "int", "key": "string",
             "id": "string", "tie": "long", "served": "long"}
    return F.struct(*[F.lit(last[n]).cast(k).alias(n) for n, k in kinds.items()])
