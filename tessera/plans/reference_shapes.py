"""The as-written shapes of five pipelines, for timing against the closed forms.

Not registered as queries: ``bench.py`` runs them next to the operators so
the cost of the loop / per-day calendar expansion / triple pass is measured
on the same data. Loops materialise each step with ``checkpoint()`` (into
the session's checkpoint folder), as the originals insert every step into a
table before reading it back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import activity as ac
from tessera.operators import cumulative as cu
from tessera.plans import standins as S
from tessera.sources.tables import read_table

FIRST_SEASON = 1995


def loop_cumulative(spark, sf_dir):
    """C2 as the period-by-period full outer join loop."""
    ps = S.player_seasons(spark, sf_dir).checkpoint()
    snap, parts = None, []
    for season in range(FIRST_SEASON, S.player_as_of(spark, sf_dir) + 1):
        snap = cu.cumulative_step(snap, ps, "player_id", "season", ["gp", "pts"], season,
                                  carry=["scoring_class"], history="season_stats", current="current_season").checkpoint()
        parts.append(snap)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def loop_datelist(spark, sf_dir):
    """A2 as the day-by-day loop of A1."""
    e = read_table(spark, sf_dir, "events").select("user_id", "ts").checkpoint()
    days = [f"2024-01-{d:02d}" for d in range(1, 31)]
    y = ac.datelist_backfill(e.where(F.lit(False)), "user_id", "ts", days[0], days[0])
    parts = []
    for d in days:
        y = ac.datelist_step(y, e, "user_id", "ts", d).checkpoint()
        parts.append(y)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def calendar_bitmask(spark, sf_dir):
    """A5 as a per-user expansion over the 32-day calendar with ``array_contains`` and a sum."""
    s = ac.datelist_set(read_table(spark, sf_dir, "events"), "user_id", "ts")
    as_of = F.to_date(F.lit(S.events_bounds(spark, sf_dir)[2]))
    x = s.select("user_id", "active_dates", F.explode(F.sequence(F.date_sub(as_of, 31), as_of)).alias("d"))
    v = F.when(F.array_contains("active_dates", F.col("d")),
               F.call_function("shiftleft", F.lit(1).cast("long"), 31 - F.datediff(as_of, F.col("d")))).otherwise(0)
    return x.groupBy("user_id").agg(F.sum(v).alias("mask"))


def loop_array_metrics(spark, sf_dir):
    """A9 as the day-by-day loop of A8."""
    c = ac.daily_counts(read_table(spark, sf_dir, "events"), "user_id", "ts").checkpoint()
    y = ac.array_metric_backfill(c.where(F.lit(False)), "user_id", "2024-01-01", "site_hits")
    for d in range(1, 31):
        y = ac.array_metric_step(y, c, "user_id", f"2024-01-{d:02d}", "site_hits").checkpoint()
    return y


def triple_pass_reduced(spark, sf_dir):
    """A11 as written: daily aggregate, then one zero-filled 31-day pass per array, joined."""
    e = S.web_events(spark, sf_dir)
    daily = e.groupBy("host", F.trunc(F.to_date("event_time"), "MM").alias("month"),
                      F.dayofmonth("event_time").alias("day")).agg(
        F.count(F.lit(1)).alias("hits"), F.count_distinct("user_id").alias("uv"))
    keys = daily.select("host", "month").distinct()
    slots = keys.select("host", "month", F.explode(F.sequence(F.lit(1), F.lit(31))).alias("day"))

    def one(metric):
        j = slots.join(daily, ["host", "month", "day"], "left")
        return j.groupBy("host", "month").agg(F.array_sort(F.collect_list(F.struct(
            "day", F.coalesce(F.col(metric), F.lit(0)).alias("v")))).alias(metric))

    return one("hits").join(one("uv"), ["host", "month"])


SHAPES = {
    "cumulative_backfill__loop": loop_cumulative,
    "datelist_backfill__loop": loop_datelist,
    "activity_bitmask__calendar": calendar_bitmask,
    "array_metric_backfill__loop": loop_array_metrics,
    "monthly_activity_reduced__three_pass": triple_pass_reduced,
}
