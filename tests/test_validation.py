"""Argument checks that need no external system."""

import pytest

from changeflow.functions.time import resolve_as_of
from changeflow.operators import metrics as M
from changeflow.sources import jdbc_table
from changeflow.sources.streams import kafka_options
from changeflow.streaming import start_query


def test_jdbc_partitioned_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        jdbc_table(spark, "jdbc:postgresql://db/orders", "orders", partition_column="id")


def test_stream_needs_a_checkpoint(spark):
    df = spark.readStream.format("rate").load()
    with pytest.raises(ValueError):
        start_query(df, checkpoint="")


def test_alert_rules_need_rules(spark):
    m = spark.createDataFrame([("x", 1.0)], "metric string, value double")
    with pytest.raises(ValueError):
        M.alert_rules(m, {})


def test_bad_anchor_and_offsets(spark):
    with pytest.raises(TypeError):
        resolve_as_of(spark.range(1), 12345)
    with pytest.raises(ValueError):
        kafka_options("b:9092", "t", starting_offsets="middle")
