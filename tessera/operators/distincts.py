"""Distinct counts that add up (F9, Q3, A11): stored days unite to weeks and months without the events.

``daily_sketches`` stores one theta sketch per key and day (a few KB, whatever
the day's events); unions give any period's distincts and intersections its
retention, within a stated error. ``daily_bitmaps`` stores exact sets as
bitmaps over dense ids, 32,768 ids a row, so a period's distincts are the bits
of the united rows. Both are partial aggregates: a hot key sends one sketch or
bitmap a task and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.expr import key_list as _keys
from tessera.sources.writers import stage

LOG_ENTRIES = 14  # a sketch holds 2**14 hashes: standard error 1 / sqrt(2**14) = 0.8 %


def daily_sketches(events: DataFrame, key, ts: str, who: str, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """key, day, n_events and the ``sketch`` of the distinct ``who`` (exact up to 2**log_entries of them)."""
    return events.groupBy(*_keys(key), F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n_events"), F.theta_sketch_agg(who, log_entries).alias("sketch"))


def period_distincts(days: DataFrame, key, period: Column, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """Stored days united to ``period`` (an expression of ``day``): key, period, n_events, distincts (estimated), sketch."""
    g = days.groupBy(*_keys(key), period.alias("period")).agg(
        F.sum("n_events").alias("n_events"), F.theta_union_agg("sketch", log_entries).alias("sketch"))
    return g.select(*_keys(key), "period", "n_events", F.theta_sketch_estimate("sketch").alias("distincts"), "sketch")


def period_retention(periods: DataFrame, key, step) -> DataFrame:
    """Q3: per key and period, how many of its distincts also came in the period before (``step``: its start to the next one's)."""
    keys = _keys(key)
    before = periods.select(*keys, step(F.col("period")).alias("period"), F.col("sketch").alias("_before"))
    j = periods.join(before, [*keys, "period"])
    return j.select(*keys, "period", F.theta_sketch_estimate(F.theta_intersection("sketch", "_before")).alias("returned"))


def dense_ids(df: DataFrame, who: str, name: str = "dense_id", partitions: int | None = None) -> DataFrame:
    """(who, dense_id): consecutive numbers from 0 for the distinct values, without a global sort in one task.

    Values are range-partitioned; each partition numbers its own, and starts
    at the count of the partitions before it (one row a partition).
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = stage(df.select(who).where(F.col(who).isNotNull()).distinct().repartitionByRange(n, who)
                .withColumn("_part", F.spark_partition_id()), "dense-ids")
    own = cut.withColumn("_rn", F.row_number().over(Window.partitionBy("_part").orderBy(who)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    return own.join(F.broadcast(starts), "_part").select(who, (F.col("_start") + F.col("_rn") - 1).alias(name))


def daily_bitmaps(events: DataFrame, key, ts: str, dense: str) -> DataFrame:
    """(key, day, bucket, bits): the day's distinct dense ids as bitmaps; events without a key, time or id are left out."""
    e = events.where(F.col(dense).isNotNull() & F.col(ts).isNotNull())
    for k in _keys(key):
        e = e.where(F.col(k).isNotNull())
    return e.groupBy(*_keys(key), F.to_date(ts).alias("day"), F.bitmap_bucket_number(dense).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(dense)).alias("bits"))


def exact_uniques(bitmaps: DataFrame, key, period: Column, name: str = "uniques") -> DataFrame:
    """Exact distincts per key and ``period`` (an expression of ``day``) from stored daily bitmaps."""
    united = bitmaps.groupBy(*_keys(key), period.alias("period"), "bucket").agg(F.bitmap_or_agg("bits").alias("_bits"))
    return united.groupBy(*_keys(key), "period").agg(F.sum(F.bitmap_count("_bits")).alias(name))


def retained(bitmaps: DataFrame, key, period: Column, step, name: str = "returned") -> DataFrame:
    """Per key and period, the exact number of ids that were there in the period before, too (0 if none)."""
    keys = _keys(key)
    united = bitmaps.groupBy(*keys, period.alias("period"), "bucket").agg(F.bitmap_or_agg("bits").alias("_bits"))
    both = united.withColumn("_own", F.lit(1)).unionByName(
        united.withColumn("period", step(F.col("period"))).withColumn("_own", F.lit(0)))
    met = both.groupBy(*keys, "period", "bucket").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_own").alias("_own"), F.bitmap_and_agg("_bits").alias("_bits"))
    return met.groupBy(*keys, "period").agg(
        F.sum(F.when(F.col("_n") == 2, F.bitmap_count("_bits")).otherwise(F.lit(0))).alias(name),
        F.max("_own").alias("_own")).where("_own = 1").drop("_own")


def quantile_sketches(gaps: DataFrame, key, day: Column, value: str, k: int = 400) -> DataFrame:
    """D3: one KLL sketch of ``value`` (long) per key and day (rank error about 1.7 / k), to be united over days."""
    return gaps.groupBy(*_keys(key), day.alias("day")).agg(F.kll_sketch_agg_bigint(F.col(value).cast("long"), k).alias("sketch"))


def quantiles(sketches: DataFrame, key, ranks: Sequence[float], k: int = 400) -> DataFrame:
    """Per key, the values at ``ranks`` of all stored days: (key, rank, value, n)."""
    united = sketches.groupBy(*_keys(key)).agg(F.kll_merge_agg_bigint("sketch", k).alias("_s"))
    at = [F.struct(F.lit(float(r)).alias("rank"), F.kll_sketch_get_quantile_bigint("_s", F.lit(float(r))).alias("value"),
                   F.kll_sketch_get_n_bigint("_s").alias("n")) for r in ranks]
    return united.select(*_keys(key), F.inline(F.array(*at)))
