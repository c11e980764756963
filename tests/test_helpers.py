"""Small helpers: key lists, day ranges (pushed to the scan), staging, partition sizing, checkpoint folder."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tessera.functions.expr import day_range, guarded_ratio, key_list, threshold_class
from tessera.session import ensure_checkpoint_dir, size_shuffle_partitions
from tessera.sources import writers as wr
from tessera.sources.tables import read_table, stream_glob, with_session_timestamps


def test_key_list():
    assert key_list("a") == ["a"] and key_list(("a", "b")) == ["a", "b"]


def test_day_range_inclusive_and_pushed(spark):
    e = read_table(spark, SF_SMALL, "events")
    sub = e.where(day_range(e, "ts", "2024-01-02", "2024-01-03"))
    days = {r.d for r in sub.select(F.to_date("ts").alias("d")).distinct().collect()}
    assert days == {dt.date(2024, 1, 2), dt.date(2024, 1, 3)}
    plan = sub._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan


def test_threshold_and_ratio(spark):
    df = spark.createDataFrame([(25.0, 0.0), (None, 2.0)], "v double, d double")
    out = df.select(threshold_class("v", [(20, "hi")], "lo").alias("c"), guarded_ratio("v", "d").alias("r"))
    assert rows(out) == [("hi", 25.0), ("lo", None)]


def test_stage_round_trip_under_checkpoint_dir(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    staged = wr.stage(df, "t")
    assert rows(staged) == rows(df)
    assert ensure_checkpoint_dir(spark).rstrip("/") in staged.inputFiles()[0]


def test_size_shuffle_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffle_partitions(spark, 100 * 1024 ** 4) == 409600
        assert size_shuffle_partitions(spark, 10) == 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stream_glob_and_session_timestamps(spark):
    assert stream_glob("/x/sf", "events") == "/x/sf/event[s].parquet"
    e = with_session_timestamps(read_table(spark, SF_SMALL, "events"))
    assert dict(e.dtypes)["ts"] == "timestamp"
