"""Streaming sources: Kafka topics and an offline file twin with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def kafka_options(bootstrap_servers: str, topic: str, *, starting_offsets: str = "latest",
                  max_offsets_per_trigger: int | None = None, group_id: str | None = None,
                  fail_on_data_loss: bool = True, extra: dict | None = None) -> dict:
    """Reader options for a Kafka topic.

    ``starting_offsets`` is ``latest`` for the live change stream and
    ``earliest`` for a bounded re-read; ``max_offsets_per_trigger`` bounds each
    micro-batch (the bounded consumer).
    """
    if starting_offsets not in ("latest", "earliest") and not starting_offsets.startswith("{"):
        raise ValueError(f"unsupported starting_offsets {starting_offsets!r}")
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if group_id is not None:
        opts["kafka.group.id"] = group_id
    opts.update(extra or {})
    return opts


def kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str, **kwargs) -> DataFrame:
    """Streaming DataFrame over a topic with ``value`` as string and the record timestamp.

    Output columns: ``key``, ``value`` (string), ``ts`` (Kafka timestamp),
    ``partition``, ``offset`` — the same columns :func:`file_stream` yields, so
    every decoder runs unchanged on either.
    """
    reader = spark.readStream.format("kafka")
    for key, value in kafka_options(bootstrap_servers, topic, **kwargs).items():
        reader = reader.option(key, value)
    return (reader.load()
            .select(F.col("key").cast("string").alias("key"),
                    F.col("value").cast("string").alias("value"),
                    F.col("timestamp").alias("ts"), "partition", "offset"))


def file_stream(spark: SparkSession, path: str, schema: StructType, *, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over a folder of files (offline twin of a topic)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    return reader.load(path)
