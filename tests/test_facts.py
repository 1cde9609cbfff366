"""The fact table by day: any number of batches, replays, compactions that die, and pruning."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from changeflow.streaming import facts
from changeflow.streaming.facts import DayTable, DayTableSink

COLUMNS = StructType([StructField("id", LongType()), StructField("v", StringType()), StructField("at", TimestampNTZType())])


def rows(spark, lo, hi, day="2024-05-01", v="x"):
    at = F.lit(f"{day} 12:00:00").cast("timestamp_ntz")
    return spark.range(lo, hi).select("id", F.lit(v).alias("v"), at.alias("at"), F.lit("more").alias("other"))


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_thousand_batches_make_as_many_partitions_as_days(spark, scratch):
    path = os.path.join(scratch, "facts")
    at = F.timestamp_seconds(F.lit(1_714_521_600) + (F.col("id") % 4) * 86_400).cast("timestamp_ntz")
    batches = spark.range(4000).select("id", F.lit("x").alias("v"), at.alias("at"), F.to_date(at).alias("day"),
                                       F.lit("q").alias("stream"), (F.col("id") / 4).cast("long").alias("batch_id"))
    batches.repartition(8, "batch_id").write.partitionBy("stream", "batch_id", "day").parquet(f"{path}/inbox")
    spark.sql("CREATE DATABASE IF NOT EXISTS facts_test")
    spark.sql("DROP TABLE IF EXISTS facts_test.t")
    spark.sql("CREATE TABLE facts_test.t (id BIGINT, v STRING, at TIMESTAMP_NTZ, stream STRING, batch_id BIGINT, day DATE) "
              f"USING parquet PARTITIONED BY (day) LOCATION '{path}/days'")
    t = DayTable(spark, path, COLUMNS, "day", "facts_test.t")
    assert t.compact() == {"q": 998}
    assert len(os.listdir(f"{path}/inbox/stream=q")) == 1
    assert spark.sql("SHOW PARTITIONS facts_test.t").count() == 4 and spark.table("facts_test.t").count() == 3996
    assert ids(t.read()) == list(range(4000))
    files = [f for _, _, names in os.walk(f"{path}/days") for f in names if f.endswith(".parquet")]
    assert len(files) <= 8                                              # from 3,996
    again = spark.range(9000, 9002).select("id", F.lit("y").alias("v"), F.lit("2024-05-02 01:00:00").cast("timestamp_ntz").alias("at"))
    t.put(again.withColumn("day", F.to_date("at")), 999, "q")           # the newest batch is replayed with other rows
    assert ids(t.read()) == [*range(3996), 9000, 9001]
    t.put(again.where("id = 9000").withColumn("day", F.to_date("at")), 1000, "q")
    assert t.compact() == {"q": 999}
    assert ids(t.read()) == [*range(3996), 9000, 9000, 9001]
    plan = t.read().where("day = date'2024-05-02'")._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x]
    assert len(scans) == 2 and all("day#" in x.split("PartitionFilters:")[1].split("]")[0] for x in scans), plan


@pytest.mark.parametrize("step", ["stage", "record", "rename", "empty"])
def test_a_compaction_that_dies_is_finished_by_the_next(spark, scratch, monkeypatch, step):
    """Readers see every row once after it died, and after the next one; day folders are put in place one by one."""
    sink = DayTableSink(os.path.join(scratch, "facts"), COLUMNS, "at", "day")
    for k in range(4):
        sink(rows(spark, 10 * k, 10 * k + 10, f"2024-05-0{k % 2 + 1}"), k, "q")
    t = sink.on(spark)
    t.compact()
    sink(rows(spark, 40, 50, "2024-05-01"), 4, "q")
    sink(rows(spark, 50, 60, "2024-05-02"), 5, "q")

    class Died(Exception):
        pass

    def dies(*args, **kw):
        raise Died

    with monkeypatch.context() as m:
        if step == "stage":
            m.setattr(DayTable, "_record", dies)
        elif step == "record":
            m.setattr(DayTable, "_finish", dies)
        elif step == "rename":
            done = []

            def once(*args):
                if done:
                    raise Died
                done.append(replace(*args))
            replace = facts.replace_folder
            m.setattr(facts, "replace_folder", once)
        else:
            m.setattr(DayTable, "_empty_inbox", dies)
        with pytest.raises(Died):
            t.compact()
    assert ids(t.read()) == list(range(60))
    sink(rows(spark, 60, 70, "2024-05-03"), 6, "q")
    assert ids(t.read()) == list(range(70))
    assert t.compact() == {"q": 5}
    assert ids(t.read()) == list(range(70)) and len(os.listdir(f"{t.inbox}/stream=q")) == 1


def test_queries_are_kept_apart_and_nothing_is_a_table_too(spark, scratch):
    sink = DayTableSink(os.path.join(scratch, "facts"), COLUMNS, "at", "day")
    t = sink.on(spark)
    assert t.read().count() == 0 and t.compact() == {}
    for q in ("one", "two"):
        for k in range(3):
            sink(rows(spark, k, k + 1, "2024-05-01"), k, q)
    sink(rows(spark, 0, 0), 3, "two")                                   # an empty batch
    sink(rows(spark, 7, 8).withColumn("at", F.lit(None).cast("timestamp_ntz")), 3, "one")
    sink(rows(spark, 8, 9), 4, "one")
    assert t.compact() == {"one": 3, "two": 2}
    assert ids(t.read()) == [0, 0, 1, 1, 2, 2, 7, 8]
    assert t.read().where("day is null").count() == 1
    assert t.read().columns == ["id", "v", "at", "stream", "batch_id", "day"]
    sink(rows(spark, 9, 10).withColumn("at", F.lit(None).cast("timestamp_ntz")), 5, "one")
    sink(rows(spark, 10, 11), 6, "one")
    assert t.compact() == {"one": 5, "two": 2} and ids(t.read()) == [0, 0, 1, 1, 2, 2, 7, 8, 9, 10]
