"""Batch table scans (parquet, JDBC)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, base_dir: str, name: str, schema: StructType | str | None = None) -> DataFrame:
    """Scan ``<base_dir>/<name>.parquet`` (a file or a folder of part files).

    Nothing is selected here: Catalyst prunes columns and pushes filters into
    the parquet reader from whatever the caller does next. The schema is
    ``schema`` if given (no footer is read for it), else read from the files,
    each time: a table that was rewritten reads as it is now.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(os.path.join(base_dir, f"{name}.parquet"))


def jdbc_table(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
               lower_bound: int | None = None, upper_bound: int | None = None,
               num_partitions: int | None = None, fetch_size: int = 10_000,
               properties: dict | None = None) -> DataFrame:
    """Parallel JDBC scan of an operational table.

    With ``partition_column`` and bounds the read is split into
    ``num_partitions`` range queries, one per task; without them the whole table
    comes through one task, which is only acceptable for small tables.
    Credentials come from the caller's ``properties``, never from defaults.
    """
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", str(fetch_size)))
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    return reader.load()
