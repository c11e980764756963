"""Registered queries: date-lists, bitmasks and reduced facts."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import functions as F

from tessera.operators import activity as ac
from tessera.operators import quality as qa
from tessera.operators.sequence import islands
from tessera.plans import standins as S
from tessera.plans.q_writers import _scratch
from tessera.plans.registry import register
from tessera.sources import writers as wr
from tessera.sources.tables import read_table

AS_OF, START, MONTH = S.EVENTS_AS_OF, S.EVENTS_START, S.EVENTS_MONTH  # SQL


def all_events(spark, sf_dir):
    return read_table(spark, sf_dir, "events")


def _dates_key(c):
    return F.array_join(F.transform(F.col(c), lambda d: F.date_format(d, "MMdd")), ",")


def flat_datelist(df):
    return df.select("user_id", "date", F.size("dates_active").cast("bigint").alias("n_dates"),
                     _dates_key("dates_active").alias("dates_key"))


_DATELIST_SQL = f"""
 WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events
            WHERE user_id IS NOT NULL AND CAST(ts AS DATE) BETWEEN {START} AND {AS_OF}),
 f AS (SELECT user_id, min(day) AS first_day FROM d GROUP BY 1),
 spine AS (SELECT user_id, CAST(unnest(generate_series(first_day, {AS_OF}, INTERVAL 1 DAY)) AS DATE) AS date
           FROM f)
 SELECT s.user_id, s.date, count(*) AS n_dates, string_agg(strftime(d.day, '%m%d'), ',' ORDER BY d.day DESC) AS dates_key
 FROM spine s JOIN d ON d.user_id = s.user_id AND d.day <= s.date
 GROUP BY 1, 2"""


@register("datelist_backfill", oracle=_DATELIST_SQL)
def q_datelist_backfill(spark, sf_dir):
    start, _, end = S.events_bounds(spark, sf_dir)
    return flat_datelist(ac.datelist_backfill(all_events(spark, sf_dir), "user_id", "ts", start, end))


@register("datelist_step", oracle=f"SELECT * FROM ({_DATELIST_SQL}) WHERE date = {AS_OF}")
def q_datelist_step(spark, sf_dir):
    e = all_events(spark, sf_dir)
    start, _, end = S.events_bounds(spark, sf_dir)
    before = S.day_before(end)
    y = ac.datelist_backfill(e, "user_id", "ts", start, before, emit_from=before)  # yesterday only
    return flat_datelist(ac.datelist_step(y, e, "user_id", "ts", end))


@register("datelist_step_load", oracle=f"SELECT * FROM ({_DATELIST_SQL}) WHERE date = {AS_OF}")
def q_datelist_step_load(spark, sf_dir):
    """A1 from the stored table: the last three days, each reading only the day before's partition, the last one twice."""
    e, path = all_events(spark, sf_dir), _scratch(spark, "datelist")
    start, _, end = S.events_bounds(spark, sf_dir)
    days = [end, S.day_before(end), S.day_before(S.day_before(end))]
    first = S.day_before(days[-1])
    wr.overwrite_partitions(ac.datelist_backfill(e, "user_id", "ts", start, first, emit_from=first), path, ["date"])
    for day in [*reversed(days), end]:
        yesterday = spark.read.parquet(path).where(F.col("date") == F.lit(S.day_before(day)).cast("date"))
        wr.overwrite_partitions(ac.datelist_step(yesterday, e, "user_id", "ts", day), path, ["date"])
    return flat_datelist(spark.read.parquet(path).where(F.col("date") == F.lit(end).cast("date")))


@register("datelist_set", oracle="""
 SELECT user_id, count(DISTINCT CAST(ts AS DATE)) AS n_dates,
        string_agg(DISTINCT strftime(CAST(ts AS DATE), '%m%d'), ',' ORDER BY strftime(CAST(ts AS DATE), '%m%d')) AS dates_key
 FROM events WHERE user_id IS NOT NULL GROUP BY 1""")
def q_datelist_set(spark, sf_dir):
    s = ac.datelist_set(read_table(spark, sf_dir, "events"), "user_id", "ts")
    return s.select("user_id", F.size("active_dates").cast("bigint").alias("n_dates"),
                    _dates_key("active_dates").alias("dates_key"))


@register("host_datelist_set", oracle="""
 SELECT event_type AS host, count(DISTINCT CAST(ts AS DATE)) AS n_dates,
        string_agg(DISTINCT strftime(CAST(ts AS DATE), '%m%d'), ',' ORDER BY strftime(CAST(ts AS DATE), '%m%d')) AS dates_key
 FROM events WHERE event_type IS NOT NULL GROUP BY 1""")
def q_host_datelist_set(spark, sf_dir):
    s = ac.datelist_set(S.web_events(spark, sf_dir), "host", "event_time")
    return s.select("host", F.size("active_dates").cast("bigint").alias("n_dates"),
                    _dates_key("active_dates").alias("dates_key"))


@register("datelist_json", oracle="""
 SELECT user_id, CAST(date_trunc('month', day) AS DATE) AS month,
        CAST(bit_or(CAST(1 AS BIGINT) << (CAST(dayofmonth(day) AS BIGINT) - 1)) AS BIGINT) AS datelist_int
 FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE user_id IS NOT NULL)
 GROUP BY 1, 2""")
def q_datelist_json(spark, sf_dir):
    # Stored as a JSON array (the JSONB column of the original), read back for the day bitmap.
    s = ac.datelist_set(read_table(spark, sf_dir, "events"), "user_id", "ts")
    stored = s.select("user_id", ac.datelist_to_json("active_dates").alias("device_activity_datelist"))
    back = stored.select("user_id", ac.datelist_from_json("device_activity_datelist").alias("dates"))
    return ac.month_day_bitmap(back, "user_id", "dates")


@register("datelist_merge", oracle="""
 SELECT user_id, count(DISTINCT CAST(ts AS DATE)) AS n_dates,
        string_agg(DISTINCT strftime(CAST(ts AS DATE), '%m%d'), ',' ORDER BY strftime(CAST(ts AS DATE), '%m%d')) AS dates_key
 FROM events WHERE user_id IS NOT NULL GROUP BY 1""")
def q_datelist_merge(spark, sf_dir):
    # Stored set = first half of the month, new batch = events from day 10 on (overlapping).
    e = read_table(spark, sf_dir, "events")
    first = ac.datelist_set(e, "user_id", "ts", end="2024-01-15")
    second = ac.datelist_set(e, "user_id", "ts", start="2024-01-10")
    m = ac.datelist_merge(first, second, "user_id")
    return m.select("user_id", F.size("active_dates").cast("bigint").alias("n_dates"),
                    _dates_key("active_dates").alias("dates_key"))


@register("datelist_by_device", oracle="""
 SELECT user_id, event_type AS device, CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY day) AS INTEGER) AS pos,
        day AS active_date
 FROM (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events
       WHERE user_id IS NOT NULL AND event_type IS NOT NULL)""")
def q_datelist_by_device(spark, sf_dir):
    m = ac.datelist_by_device(read_table(spark, sf_dir, "events"), "user_id", "event_type", "ts")
    e = m.select("user_id", F.explode("device_activity").alias("device", "dates"))
    return e.select("user_id", "device", F.posexplode("dates").alias("pos", "active_date")).select(
        "user_id", "device", (F.col("pos") + 1).alias("pos"), "active_date")


_MASK_SQL = f"""
 WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE user_id IS NOT NULL),
 m AS (SELECT user_id,
              CAST(coalesce(bit_or(CASE WHEN {AS_OF} - day BETWEEN 0 AND 31
                                        THEN CAST(1 AS BIGINT) << (31 - ({AS_OF} - day)) END), 0) AS BIGINT) AS mask
       FROM d GROUP BY 1)"""


@register("activity_bitmask", oracle=_MASK_SQL + " SELECT user_id, mask FROM m")
def q_activity_bitmask(spark, sf_dir):
    return ac.activity_bitmask_of_events(all_events(spark, sf_dir), "user_id", "ts", S.events_bounds(spark, sf_dir)[2])


@register("activity_flags", oracle=_MASK_SQL + f"""
 SELECT user_id, mask, bit_count(mask & {ac.MASK_32_DAYS}) > 0 AS dim_is_monthly_active,
        bit_count(mask & {ac.MASK_28_DAYS}) > 0 AS dim_is_28d_active,
        bit_count(mask & {ac.MASK_7_DAYS}) > 0 AS dim_is_weekly_active,
        bit_count(mask & {ac.MASK_1_DAY}) > 0 AS dim_is_daily_active
 FROM m""")
def q_activity_flags(spark, sf_dir):
    s = ac.datelist_set(all_events(spark, sf_dir), "user_id", "ts")
    m = s.select("user_id", ac.activity_bitmask("active_dates", S.events_bounds(spark, sf_dir)[2]).alias("mask"))
    return m.select("user_id", "mask", *ac.activity_flags("mask"))


@register("activity_flags_as_written", oracle=f"""
 WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE user_id IS NOT NULL),
 m AS (SELECT user_id,
              CAST(coalesce(sum(CAST(pow(2, 32 - ({AS_OF} - day)) AS BIGINT))
                   FILTER (WHERE day BETWEEN {MONTH} AND {AS_OF}), 0) AS BIGINT) & 4294967295 AS mask
       FROM d GROUP BY 1)
 SELECT user_id, mask, bit_count(mask) > 0 AS dim_is_monthly_active,
        bit_count(mask & {ac.MASK_28_DAYS}) > 0 AS dim_is_28d_active,
        bit_count(mask & {ac.MASK_7_DAYS}) > 0 AS dim_is_weekly_active,
        bit_count(mask & {ac.MASK_1_DAY}) > 0 AS dim_is_daily_active
 FROM m""")
def q_activity_flags_as_written(spark, sf_dir):
    # The original 2^(32 - d) formula over the month-to-date calendar.
    end = S.events_bounds(spark, sf_dir)[2]
    s = ac.datelist_set(all_events(spark, sf_dir), "user_id", "ts")
    m = s.select("user_id", ac.activity_bitmask("active_dates", end, as_written=True, series_days=int(end[8:])).alias("mask"))
    return m.select("user_id", "mask", *ac.activity_flags("mask"))


@register("month_day_bitmap", oracle="""
 SELECT user_id, CAST(date_trunc('month', day) AS DATE) AS month,
        CAST(bit_or(CAST(1 AS BIGINT) << (CAST(day_of_month AS BIGINT) - 1)) AS BIGINT) AS datelist_int
 FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, dayofmonth(ts) AS day_of_month
       FROM events WHERE user_id IS NOT NULL)
 GROUP BY 1, 2""")
def q_month_day_bitmap(spark, sf_dir):
    s = ac.datelist_set(read_table(spark, sf_dir, "events"), "user_id", "ts")
    return ac.month_day_bitmap(s, "user_id", "active_dates")


def site_hits(spark, sf_dir, through=None):
    _, month, end = S.events_bounds(spark, sf_dir)
    through = through or end
    c = ac.daily_counts(read_table(spark, sf_dir, "events"), "user_id", "ts", start=through[:8] + "01", end=through)
    return ac.array_metric_backfill(c, "user_id", through, "site_hits")


def flat_arrays(df, col="metric_array"):
    return df.select("user_id", "month_start", "metric_name",
                     F.posexplode(col).alias("pos", "value")).select(
        "user_id", "month_start", "metric_name", (F.col("pos") + 1).alias("pos"), "value")


_ARRAY_SQL = f"""
 WITH c AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS hits FROM events
            WHERE user_id IS NOT NULL AND CAST(ts AS DATE) BETWEEN {MONTH} AND {AS_OF} GROUP BY 1, 2),
 u AS (SELECT DISTINCT user_id FROM c),
 slots AS (SELECT u.user_id, CAST(s AS INTEGER) AS pos FROM u, (SELECT unnest(range(1, ({AS_OF} - {MONTH}) + 2)) AS s)),
 arr AS (
   SELECT s.user_id, {MONTH} AS month_start, 'site_hits' AS metric_name, s.pos,
          CAST(coalesce(c.hits, 0) AS BIGINT) AS value
   FROM slots s LEFT JOIN c ON c.user_id = s.user_id AND dayofmonth(c.day) = s.pos
 )"""


@register("array_metric_backfill", oracle=_ARRAY_SQL + " SELECT * FROM arr")
def q_array_metric_backfill(spark, sf_dir):
    return flat_arrays(site_hits(spark, sf_dir))


@register("array_metric_step", oracle=_ARRAY_SQL + " SELECT * FROM arr")
def q_array_metric_step(spark, sf_dir):
    end = S.events_bounds(spark, sf_dir)[2]
    y = site_hits(spark, sf_dir, S.day_before(end))
    c = ac.daily_counts(read_table(spark, sf_dir, "events"), "user_id", "ts", start=end, end=end)
    return flat_arrays(ac.array_metric_step(y, c, "user_id", end, "site_hits"))


@register("array_metric_step_load", oracle=_ARRAY_SQL + " SELECT * FROM arr")
def q_array_metric_step_load(spark, sf_dir):
    """A8 from the stored table, partitioned by metric and month: the last three days one by one, the last one twice."""
    path, end = _scratch(spark, "arrays"), S.events_bounds(spark, sf_dir)[2]
    days = [end, S.day_before(end), S.day_before(S.day_before(end))]
    parts = ["metric_name", "month_start"]
    wr.overwrite_partitions(site_hits(spark, sf_dir, S.day_before(days[-1])), path, parts)
    events = read_table(spark, sf_dir, "events")
    for day in [*reversed(days), end]:
        counts = ac.daily_counts(events, "user_id", "ts", start=day, end=day)
        today = ac.array_metric_step(spark.read.parquet(path), counts, "user_id", day, "site_hits")
        wr.overwrite_partitions(wr.stage(today, "arrays-today"), path, parts)  # the partition read is the one replaced
    return flat_arrays(spark.read.parquet(path).where(F.col("month_start") == F.lit(end[:8] + "01").cast("date")))


@register("array_metric_totals", oracle=_ARRAY_SQL + """
 SELECT metric_name, CAST(month_start + (pos - 1) AS DATE) AS day, CAST(sum(value) AS BIGINT) AS value
 FROM arr GROUP BY metric_name, month_start, pos""")
def q_array_metric_totals(spark, sf_dir):
    return ac.array_metric_totals(site_hits(spark, sf_dir))


@register("array_length_profile", oracle=_ARRAY_SQL + """
 SELECT CAST(len AS INTEGER) AS array_length, count(*) AS n_rows
 FROM (SELECT user_id, count(*) AS len FROM arr GROUP BY user_id) GROUP BY 1""")
def q_array_length_profile(spark, sf_dir):
    return qa.array_length_profile(site_hits(spark, sf_dir), "metric_array")


@register("monthly_activity_reduced", oracle="""
 WITH d AS (SELECT event_type AS host_name, CAST(date_trunc('month', ts) AS DATE) AS month, dayofmonth(ts) AS day,
                   count(*) AS hits, count(DISTINCT user_id) AS uv
            FROM events WHERE event_type IS NOT NULL GROUP BY 1, 2, 3),
 k AS (SELECT DISTINCT month, host_name FROM d),
 s AS (SELECT month, host_name, CAST(x AS INTEGER) AS pos FROM k, range(1, 32) t(x))
 SELECT s.month, s.host_name, s.pos, CAST(coalesce(d.hits, 0) AS BIGINT) AS hits,
        CAST(coalesce(d.uv, 0) AS BIGINT) AS unique_visitors
 FROM s LEFT JOIN d ON d.month = s.month AND d.host_name = s.host_name AND d.day = s.pos""")
def q_monthly_activity_reduced(spark, sf_dir):
    r = ac.monthly_activity_reduced(S.web_events(spark, sf_dir), "host", "event_time", "user_id")
    z = r.select("month", "host_name", F.arrays_zip("hit_array", "unique_visitors_array").alias("z"))
    return z.select("month", "host_name", F.posexplode("z").alias("pos", "e")).select(
        "month", "host_name", (F.col("pos") + 1).alias("pos"), F.col("e.hit_array").alias("hits"),
        F.col("e.unique_visitors_array").alias("unique_visitors"))


@register("run_length_encode", oracle="""
 WITH o AS (SELECT user_id, event_type, ts,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
                   - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS grp
            FROM events),
 r AS (SELECT user_id, event_type, count(*) AS run_length, min(ts) AS run_start, max(ts) AS run_end
       FROM o GROUP BY user_id, event_type, grp)
 SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY run_start) AS run, event_type, run_length,
        run_start, run_end FROM r""")
def q_run_length_encode(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    return islands(e, "user_id", "ts", "event_type", ["event_id"]).select(
        "user_id", "run", "event_type", "run_length", "run_start", "run_end")


@register("event_spine", oracle="""
 SELECT CAST(d AS DATE) AS day, count(e.event_id) AS n_events
 FROM (SELECT unnest(generate_series((SELECT CAST(date_trunc('month', min(ts)) AS DATE) FROM events),
                                     (SELECT last_day(CAST(max(ts) AS DATE)) FROM events), INTERVAL 1 DAY)) AS d) t
 LEFT JOIN events e ON CAST(e.ts AS DATE) = CAST(d AS DATE) GROUP BY 1""")
def q_event_spine(spark, sf_dir):
    start, _, end = S.events_bounds(spark, sf_dir)
    last = dt.date.fromisoformat(end)
    last = last.replace(day=calendar.monthrange(last.year, last.month)[1])
    return ac.spine_counts(read_table(spark, sf_dir, "events"), "ts", start[:8] + "01", str(last))
