"""Hot-key inputs derived from the test tables: results equal the plain formulation,
and the plans spread the hot key over several tasks."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_MID, rows
from tessera.operators import facts as fx
from tessera.operators import graph as gr
from tessera.operators.sequence import islands, with_previous
from tessera.plans import standins as S
from tessera.sources.tables import read_table


def hot_events(spark):
    # one user receives a third of all events
    e = read_table(spark, SF_MID, "events")
    return e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))


def test_dedupe_with_hot_key_equals_plain_lag(spark):
    e = hot_events(spark).select("event_id", "user_id", "event_type", "ts")
    ours = fx.dedup_within_window(e, ["user_id", "event_type"], "ts", 60, ["event_id"], bucket_seconds=600)
    w = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(w).cast("timestamp"))
    plain = e.withColumn("_g", gap).where(F.col("_g").isNull() | (F.col("_g") > 3_600_000_000)).drop("_g")
    assert rows(ours, "event_id") == rows(plain, "event_id")
    p = ours._jdf.queryExecution().executedPlan().toString()
    # events are partitioned by (key, time bucket), the key travelling as one struct column
    assert "hashpartitioning(_k#" in p and "_bkt" in p.split("hashpartitioning(_k#", 1)[1].split(")")[0]


def test_null_keys_are_one_sequence_like_a_plain_window(spark):
    e = read_table(spark, SF_MID, "events").select("event_id", "event_type", "ts").withColumn(
        "user_id", F.when(F.col("event_id") % 2 == 0, F.lit(None).cast("long")).otherwise(F.lit(7)))
    ours = fx.dedup_within_window(e, ["user_id", "event_type"], "ts", 60, ["event_id"], bucket_seconds=600)
    w = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(w).cast("timestamp"))
    plain = e.withColumn("_g", gap).where(F.col("_g").isNull() | (F.col("_g") > 3_600_000_000)).drop("_g")
    assert rows(ours, "event_id") == rows(plain, "event_id")


def test_null_timestamps_sort_last_like_sql(spark):
    e = read_table(spark, SF_MID, "events").select("event_id", "user_id", "event_type", "ts").withColumn(
        "ts", F.when(F.col("event_id") % 50 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("ts")))
    ours = fx.dedup_within_window(e, ["user_id", "event_type"], "ts", 60, ["event_id"])
    w = Window.partitionBy("user_id", "event_type").orderBy(F.col("ts").asc_nulls_last(), "event_id")
    gap = F.timestamp_diff("MICROSECOND", F.lag("ts").over(w), F.col("ts"))
    plain = e.withColumn("_g", gap).where(F.col("_g").isNull() | (F.col("_g") > 3_600_000_000)).drop("_g")
    assert rows(ours, "event_id") == rows(plain, "event_id")
    prof = dict(rows(fx.dedup_window_profile(e, ["user_id", "event_type"], "ts", ["event_id"])))
    assert sum(prof.values()) == e.count() - e.select("user_id", "event_type").distinct().count() - \
        e.where(F.col("ts").isNull()).count()


def test_row_balanced_segments_equal_time_buckets(spark):
    e = hot_events(spark).select("event_id", "user_id", "event_type", "ts")
    seg = fx.dedup_within_window(e, ["user_id", "event_type"], "ts", 60, ["event_id"], segments=7)
    hours = fx.dedup_within_window(e, ["user_id", "event_type"], "ts", 60, ["event_id"])
    assert rows(seg, "event_id") == rows(hours, "event_id")
    runs_seg = islands(e, "user_id", "ts", "event_type", ["event_id"], segments=5)
    runs_hour = islands(e, "user_id", "ts", "event_type", ["event_id"])
    assert rows(runs_seg) == rows(runs_hour)


def test_segments_give_every_previous_event(spark):
    """A million events in several files: both branches must see the same segments."""
    e = spark.range(0, 1_000_000, 1, 8).select(
        F.col("id").alias("event_id"), (F.xxhash64("id") % 3).alias("user_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(400_000))).alias("ts"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = e.select("event_id", F.lag("event_id").over(w).alias("p"))
    for n in (8, 40, 200):
        got = with_previous(e, "user_id", "ts", ["event_id"], carry=["event_id"], segments=n)
        bad = got.join(want, "event_id").where(~F.col("prev_event_id").eqNullSafe(F.col("p")))
        assert bad.count() == 0


def test_islands_with_hot_key_equals_row_number_difference(spark):
    e = hot_events(spark).select("event_id", "user_id", "event_type", "ts")
    ours = islands(e, "user_id", "ts", "event_type", ["event_id"], bucket_seconds=600)
    w_all = Window.partitionBy("user_id").orderBy("ts", "event_id")
    w_val = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    g = e.withColumn("_g", F.row_number().over(w_all) - F.row_number().over(w_val))
    plain = g.groupBy("user_id", "event_type", "_g").agg(F.count(F.lit(1)).alias("run_length"),
                                                         F.min("ts").alias("run_start"))
    assert rows(ours, "user_id", "event_type", "run_length", "run_start") == \
        rows(plain, "user_id", "event_type", "run_length", "run_start")


def test_cooccurrence_hot_game_blocked_equals_plain(spark):
    gd = S.game_details(spark, SF_MID)
    # a third of all line items land in one game
    gd = gd.withColumn("game_id", F.when(F.col("line_part") % 3 == 0, F.lit(-1)).otherwise(F.col("game_id")))
    blocked = gr.edges_cooccurrence(gd, block_rows=8)
    d = gr.player_game_rows(gd)
    a = d.select(*[F.col(c).alias("a_" + c) for c in d.columns])
    b = d.select(*[F.col(c).alias("b_" + c) for c in d.columns])
    j = a.join(b, (F.col("a_game_id") == F.col("b_game_id")) & (F.col("a_player_id") > F.col("b_player_id"))
               & (F.col("a_player_name") != F.col("b_player_name")))
    et = F.when(F.col("a_team_abbreviation") == F.col("b_team_abbreviation"), "shares_team").otherwise("plays_against")
    plain = j.groupBy(F.col("a_player_id").cast("string").alias("s"), F.col("b_player_id").cast("string").alias("o"),
                      et.alias("t")).agg(F.count(F.lit(1)).alias("n"), F.sum("a_pts").alias("sp"))
    got = blocked.select(F.col("subject_identifier").alias("s"), F.col("object_identifier").alias("o"),
                         F.col("edge_type").alias("t"),
                         F.get_json_object("properties", "$.num_games").cast("long").alias("n"),
                         F.get_json_object("properties", "$.subject_points").cast("double").alias("sp"))
    assert rows(got) == rows(plain)
