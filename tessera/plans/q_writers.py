"""Registered queries: writers (W1, W2, W4) and streaming / micro-batch dedupe.

Queries that write go to fresh folders under the session's checkpoint
folder (shared storage on a cluster) and return the table read back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.functions.expr import day_range
from tessera.operators import cumulative as cu
from tessera.operators.sequence import with_previous
from tessera.plans import sql_views as V
from tessera.plans import standins as S
from tessera.plans.q_cumulative import flat_players, players
from tessera.plans.registry import register
from tessera.session import ensure_checkpoint_dir
from tessera.sources import writers as wr
from tessera.sources.tables import read_table
from tessera.streaming import dedup as sd


def _scratch(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _cust_state(o):
    return o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"),
                                      F.max(F.to_date("o_orderdate")).alias("last_order"))


@register("upsert", oracle="""
 WITH t AS (SELECT o_custkey, count(*) AS n_orders, max(CAST(o_orderdate AS DATE)) AS last_order
            FROM orders WHERE year(o_orderdate) <= 1999 GROUP BY 1),
 s AS (SELECT o_custkey, count(*) AS n_orders, max(CAST(o_orderdate AS DATE)) AS last_order
       FROM orders WHERE year(o_orderdate) >= 2000 GROUP BY 1)
 SELECT * FROM s UNION ALL SELECT * FROM t WHERE o_custkey NOT IN (SELECT o_custkey FROM s)""")
def q_upsert(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    target = _cust_state(o.where(day_range(o, "o_orderdate", end="1999-12-31")))
    source = _cust_state(o.where(day_range(o, "o_orderdate", start="2000-01-01")))
    return wr.upsert(target, source, "o_custkey")


_DAILY_SQL = """
 SELECT event_type AS host, CAST(ts AS DATE) AS day, count(*) AS hits FROM events GROUP BY 1, 2"""


def _daily(e):
    return e.groupBy(F.col("event_type").alias("host"), F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("hits"))


@register("overwrite_partition", oracle=_DAILY_SQL)
def q_overwrite_partition(spark, sf_dir):
    path = _scratch(spark, "daily")
    e = read_table(spark, sf_dir, "events")
    wr.overwrite_partitions(_daily(e), path, ["day"])
    # Re-run three days: only those partitions are replaced, the result is unchanged.
    redo = _daily(e.where(day_range(e, "ts", "2024-01-10", "2024-01-12")))
    wr.overwrite_partitions(redo, path, ["day"])
    return spark.read.parquet(path).select("host", "day", "hits")


@register("upsert_partitions", oracle=_DAILY_SQL)
def q_upsert_partitions(spark, sf_dir):
    path = _scratch(spark, "daily-merge")
    e = read_table(spark, sf_dir, "events")
    wr.overwrite_partitions(_daily(e.where(day_range(e, "ts", end="2024-01-19"))), path, ["day"])
    wr.upsert_partitions(spark, path, _daily(e.where(day_range(e, "ts", start="2024-01-15"))), ["host", "day"], ["day"])
    return spark.read.parquet(path).select("host", "day", "hits")


@register("append", oracle=_DAILY_SQL + " UNION ALL " + _DAILY_SQL)
def q_append(spark, sf_dir):
    """The contrast case -- a plain INSERT run twice holds every row twice."""
    path = _scratch(spark, "daily-append")
    daily = _daily(read_table(spark, sf_dir, "events"))
    for _ in range(2):
        wr.append(daily, path, ["day"])
    return spark.read.parquet(path).select("host", "day", "hits")


@register("evolve_schema", oracle="""
 SELECT event_type AS host, CAST(ts AS DATE) AS day, count(*) AS hits,
        CASE WHEN CAST(ts AS DATE) < DATE '2024-01-16' THEN -1 WHEN CAST(ts AS DATE) <> DATE '2024-01-20'
             THEN count(DISTINCT user_id) END AS unique_visitors
 FROM events GROUP BY 1, 2""")
def q_evolve_schema(spark, sf_dir):
    path = _scratch(spark, "evolve")
    e = read_table(spark, sf_dir, "events")
    old = _daily(e.where(day_range(e, "ts", end="2024-01-15")))
    wr.overwrite_partitions(old, path, ["day"])
    new = e.where(day_range(e, "ts", start="2024-01-16")).groupBy(
        F.col("event_type").alias("host"), F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("hits"), F.when(F.to_date(F.max("ts")) != F.lit("2024-01-20").cast("date"),
                                                F.count_distinct("user_id")).alias("unique_visitors"))
    wr.overwrite_partitions(wr.stamp_version(new, 1), path, ["day"])  # one day's visitors are stored as NULL: they stay so
    r = wr.read_evolved(spark, path, {"unique_visitors": -1})
    return r.select("host", "day", "hits", "unique_visitors")


@register("cumulative_incremental_load", oracle="WITH " + V.PLAYER_SNAPSHOTS.replace("{as_of}", S.PLAYER_AS_OF)
          + """ SELECT player_id, current_season, n_history, first_season, last_season, hist_pts, hist_gp,
                 scoring_class, years_since_last, is_active FROM snap""")
def q_cumulative_incremental_load(spark, sf_dir):
    """Daily operation of a cumulative table stored partitioned by period.

    Backfill up to the previous period, then run the one-period step reading
    only partition p-1 (partition pruning) and write partition p by dynamic
    overwrite -- twice, to show the load is idempotent.
    """
    path = _scratch(spark, "players")
    p = S.player_as_of(spark, sf_dir)
    wr.overwrite_partitions(players(spark, sf_dir, p - 1), path, ["current_season"])
    for _ in range(2):
        yesterday = spark.read.parquet(path).where(F.col("current_season") == p - 1)
        today = cu.cumulative_step(yesterday, S.player_seasons(spark, sf_dir, first_year=p, last_year=p),
                                   "player_id", "season", ["gp", "pts"], p,
                                   carry=["scoring_class"], history="season_stats", current="current_season")
        wr.overwrite_partitions(today, path, ["current_season"])
    return flat_players(spark.read.parquet(path))


def _arriving(spark, sf_dir, slots, name, run):
    """The events as a stream: each slot is written as Spark partitions it, then ``run(stream)`` takes what has arrived.

    ``run`` starts a query with one checkpoint and waits for it, so slots are
    taken in their order whatever the number of their files.
    """
    e = read_table(spark, sf_dir, "events")
    path = _scratch(spark, name)
    for i, cond in enumerate(slots):
        e.where(cond).write.parquet(f"{path}/{i}")
        run(sd.read_event_stream(spark, path + "/*", e.schema))


@register("stream_dedup", oracle="""
 SELECT user_id, event_type, count(*) AS n_events, true AS some_kept, true AS none_added, 0 AS n_too_close
 FROM events GROUP BY 1, 2""")
def q_stream_dedup(spark, sf_dir):
    # The events arrive in time order, five days to a run, so the watermark passes keys and
    # their state goes. Which of a key's events survives depends on the triggers; what must hold
    # does not: a key is never lost, no event appears that did not arrive, and no two survivors
    # of a key are within the delay.
    out = _scratch(spark, "stream-dedup")
    day = F.dayofmonth("ts")
    slots = [day.between(a, a + 4) & F.col("ts").isNotNull() for a in range(1, 31, 5)] + [(day > 30) | F.col("ts").isNull()]

    def run(stream):
        s = sd.stream_dedup(stream, ["user_id", "event_type"], "ts", "60 minutes")
        sd.run_available_now(s.select("event_id", "user_id", "event_type", "ts"), out + "/data", out + "/_ckpt")

    _arriving(spark, sf_dir, slots, "stream-in", run)
    kept = spark.read.parquet(out + "/data")
    gap = F.timestamp_diff("MICROSECOND", F.col("prev_ts"), F.col("ts"))
    near = with_previous(kept, ["user_id", "event_type"], "ts", ["event_id"]) \
        .groupBy("user_id", "event_type").agg(F.count_distinct("event_id").alias("n_kept"),
                                              F.count_if(gap <= 3_600_000_000).cast("int").alias("n_too_close"))
    seen = read_table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n_events"))
    return seen.join(near, ["user_id", "event_type"], "left").select(
        "user_id", "event_type", "n_events", (F.coalesce("n_kept", F.lit(0)) > 0).alias("some_kept"),
        (F.coalesce("n_kept", F.lit(0)) <= F.col("n_events")).alias("none_added"), "n_too_close")


@register("stream_dedup_day", oracle="""
 SELECT user_id, event_type, count(*) AS n_events, true AS some_kept, true AS none_added, 0 AS n_too_close
 FROM events GROUP BY 1, 2""")
def q_stream_dedup_day(spark, sf_dir):
    """D5 over a day: five days a run; no two kept events of a key are within 24 hours, and no key is lost."""
    out = _scratch(spark, "stream-dedup-day")
    day = F.dayofmonth("ts")
    slots = [day.between(a, a + 4) & F.col("ts").isNotNull() for a in range(1, 31, 5)] + [(day > 30) | F.col("ts").isNull()]

    parts = sd.state_partitions_for(read_table(spark, sf_dir, "events"))

    def run(stream):
        s = sd.long_window_dedup(stream.select("event_id", "user_id", "event_type", "ts"), ["user_id", "event_type"], "ts")
        sd.run_available_now(s, out + "/data", out + "/_ckpt", state_partitions=parts)

    _arriving(spark, sf_dir, slots, "stream-day-in", run)
    kept = spark.read.parquet(out + "/data")
    gap = F.timestamp_diff("MICROSECOND", F.col("prev_ts"), F.col("ts"))
    near = with_previous(kept, ["user_id", "event_type"], "ts", ["event_id"]) \
        .groupBy("user_id", "event_type").agg(F.count_distinct("event_id").alias("n_kept"),
                                              F.count_if(gap <= 24 * 3_600_000_000).cast("int").alias("n_too_close"))
    seen = read_table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n_events"))
    return seen.join(near, ["user_id", "event_type"], "left").select(
        "user_id", "event_type", "n_events", (F.coalesce("n_kept", F.lit(0)) > 0).alias("some_kept"),
        (F.coalesce("n_kept", F.lit(0)) <= F.col("n_events")).alias("none_added"), "n_too_close")


@register("microbatch_dedup", oracle="""
 WITH g AS (SELECT event_id, user_id, event_type, ts, value,
                   epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id)) AS gap
            FROM events)
 SELECT event_id, user_id, event_type, value FROM g WHERE gap IS NULL OR gap > 3600000000""")
def q_microbatch_dedup(spark, sf_dir):
    # Four batches: the middle, the beginning and the end of the month, then late events from all of it.
    out = _scratch(spark, "microbatch")
    late, day = F.col("event_id") % 5 == 0, F.dayofmonth("ts")
    slots = [~late & day.between(11, 20), ~late & (day <= 10), ~late & (day > 20), late | F.col("ts").isNull()]
    writer = sd.microbatch_dedup_writer(out + "/fact", ["user_id", "event_type"], "ts", 60, ["event_id"])

    def run(stream):
        s = stream.select("event_id", "user_id", "event_type", "ts", "value")
        (s.writeStream.foreachBatch(writer).option("checkpointLocation", out + "/_ckpt").trigger(availableNow=True)
         .start().awaitTermination())

    _arriving(spark, sf_dir, slots, "microbatch-in", run)
    return spark.read.parquet(out + "/fact").select("event_id", "user_id", "event_type", "value")
