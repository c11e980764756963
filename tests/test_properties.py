"""Equivalences on random small inputs (hypothesis): closed forms = iterated steps, bucketed = plain windows."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tessera.functions.expr import threshold_class
from tessera.operators import cumulative as cu
from tessera.operators import scd
from tessera.operators.facts import dedup_within_window
from tessera.operators.sequence import islands

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

facts_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(2000, 2005), st.sampled_from([0.0, 5.0, 12.0, 18.0, 25.0])),
    min_size=1, max_size=14,
).map(lambda xs: list({(k, p): (k, p, v) for k, p, v in xs}.values()))  # one row per (key, period)


def _facts(spark, data):
    df = spark.createDataFrame(data, "k string, p int, v double")
    return df.withColumn("cls", threshold_class("v", [(20, "star"), (15, "good"), (10, "average")], "bad"))


@SETTINGS
@given(data=facts_strategy)
def test_backfill_equals_iterated_step(spark, data):
    facts = _facts(spark, data)
    back = cu.cumulative_backfill(facts, "k", "p", ["v"], 2005, carry=["cls"])
    snap, parts = None, []
    for p in range(2000, 2006):
        snap = cu.cumulative_step(snap, facts, "k", "p", ["v"], p, carry=["cls"])
        snap = spark.createDataFrame(snap.collect(), snap.schema)
        parts.append(snap)
    it = parts[0]
    for p in parts[1:]:
        it = it.unionByName(p)
    cols = ("k", "current_period", "history", "cls", "years_since_last", "is_active")
    assert rows(it, *cols) == rows(back, *cols)


@SETTINGS
@given(data=facts_strategy, cut=st.integers(2000, 2004))
def test_incremental_scd_equals_backfill(spark, data, cut):
    snaps = cu.cumulative_backfill(_facts(spark, data), "k", "p", ["v"], 2005, carry=["cls"])
    full = scd.scd2_backfill(snaps, "k", "current_period", ["cls", "is_active"], cut + 1)
    prev = scd.scd2_backfill(snaps, "k", "current_period", ["cls", "is_active"], cut)
    prev = spark.createDataFrame(prev.collect(), prev.schema)
    inc = scd.scd2_incremental(prev, snaps, "k", ["cls", "is_active"], cut + 1)
    cols = ("k", "cls", "is_active", "start_period", "end_period")
    assert rows(inc, *cols) == rows(full, *cols)


@SETTINGS
@given(data=facts_strategy, cut=st.integers(2000, 2003))
def test_catch_up_equals_backfill(spark, data, cut):
    snaps = cu.cumulative_backfill(_facts(spark, data), "k", "p", ["v"], 2005, carry=["cls"])
    full = scd.scd2_backfill(snaps, "k", "current_period", ["cls", "is_active"], 2005)
    prev = scd.scd2_backfill(snaps, "k", "current_period", ["cls", "is_active"], cut)
    prev = spark.createDataFrame(prev.collect(), prev.schema)
    caught = scd.scd2_catch_up(prev, snaps, "k", ["cls", "is_active"], cut + 1, 2005)
    cols = ("k", "cls", "is_active", "start_period", "end_period")
    assert rows(caught, *cols) == rows(full, *cols)


events_strategy = st.lists(
    st.tuples(st.sampled_from(["u", "v"]), st.integers(0, 600), st.sampled_from(["x", "y"])),
    min_size=1, max_size=25,
)


def _events(spark, data):
    t0 = dt.datetime(2024, 1, 1)
    rows_ = [(i, k, t0 + dt.timedelta(minutes=m), v) for i, (k, m, v) in enumerate(data)]
    return spark.createDataFrame(rows_, "id long, k string, ts timestamp_ntz, v string")


@SETTINGS
@given(data=events_strategy, bucket=st.sampled_from([60, 1800, 3600]))
def test_bucketed_dedupe_equals_plain_lag(spark, data, bucket):
    e = _events(spark, data)
    ours = dedup_within_window(e, "k", "ts", 45, ["id"], bucket_seconds=bucket)
    w = Window.partitionBy("k").orderBy("ts", "id")
    gap = F.timestamp_diff("MINUTE", F.lag("ts").over(w), F.col("ts"))
    plain = e.withColumn("_g", gap).where(F.col("_g").isNull() | (F.col("_g") > 45))
    assert rows(ours, "id") == rows(plain, "id")


@SETTINGS
@given(data=events_strategy, bucket=st.sampled_from([60, 1800]))
def test_bucketed_islands_equal_row_number_difference(spark, data, bucket):
    e = _events(spark, data)
    ours = islands(e, "k", "ts", "v", ["id"], bucket_seconds=bucket)
    w_all = Window.partitionBy("k").orderBy("ts", "id")
    w_val = Window.partitionBy("k", "v").orderBy("ts", "id")
    g = e.withColumn("_g", F.row_number().over(w_all) - F.row_number().over(w_val))
    plain = g.groupBy("k", "v", "_g").agg(F.count(F.lit(1)).alias("run_length"), F.min("ts").alias("run_start"))
    assert rows(ours, "k", "v", "run_length", "run_start") == rows(plain, "k", "v", "run_length", "run_start")
