"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.session import scratch_path

# Characters that separate words in every operator but the benchmark one.
BLANKS = "[ \\t-\\r]"
NOT_BLANK = "[^ \\t-\\r]"
WORD = "[^ \\t-\\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan ``<sf_dir>/<name>.parquet`` through Spark's reader."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts the lineage: later jobs read files that every executor sees, so a lost
    executor costs only its running tasks, and a result that is used several
    times is computed once.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns behind a one-row generator.

    Catalyst merges neighbouring projections and would copy an expensive
    expression into every place that reads it, also inside a lambda, where it
    would run once per element. A generator stops that.
    """
    packed = F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))
    keep = [F.col(f"`{c}`") for c in df.columns]
    return df.select(*keep, F.inline(packed).alias(*cols))


def carry(cols: Sequence[str]) -> Column:
    """Input columns packed as one opaque column ``carried``, so their names clash with nothing on the way."""
    packed = F.struct(F.lit(1).alias("_"), *[F.col(f"`{c}`") for c in cols])
    return F.array(packed).alias("carried")


def unpack(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` with the packed columns last. A generator, as Catalyst loses fields that it prunes through one."""
    own = [F.col(f"`{c}`") for c in df.columns if c != "carried"]
    if not cols:
        return df.select(*own)
    wide = df.select(*own, F.inline("carried").alias("_", *[f"_carried_{k}" for k in range(len(cols))]))
    return wide.select(*own, *[F.col(f"_carried_{k}").alias(c) for k, c in enumerate(cols)])


def ascii_lower(word: Column) -> Column:
    """Lower-case A-Z alone; other letters stay."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(
        F.translate(word, upper, upper.lower()))


def word_count(text: Column) -> Column:
    """Number of words (runs of non-blank characters); null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def arrow_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of record batches, one at a time."""
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def arrow_batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Record batches of a bounded number of text characters and bytes."""
    held: list[tuple] = []
    waiting = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        waiting += 100 + sum(len(x) for x in row if isinstance(x, (str, bytes)))
        if waiting >= size:
            yield batch()
            held, waiting = [], 0
    if held:
        yield batch()
