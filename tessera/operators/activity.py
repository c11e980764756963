"""Activity: date-lists, bitmasks and reduced (array) facts.

Arrays are bounded by the calendar (at most one element per day of the
window), so per-key state stays small even for a key that holds a large
share of the raw events: raw events are always pre-aggregated to
(key, day) with a partial aggregate before anything is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.expr import day_range
from tessera.functions.expr import key_list as _keys

# Activity windows over a 32-bit mask whose most significant
# bit is the as-of day (bit 31 - d is set when the key was active d days earlier).
MASK_32_DAYS = 0xFFFFFFFF
MASK_28_DAYS = 0xFFFFFFF0
MASK_7_DAYS = 0xFE000000
MASK_1_DAY = 0x80000000


def active_days(events: DataFrame, key, ts: str, start=None, end=None) -> DataFrame:
    """Distinct (key, day) of activity, NULL keys dropped, optional day range."""
    keys = _keys(key)
    e = events.where(day_range(events, ts, start, end))
    for k in keys:
        e = e.where(F.col(k).isNotNull())
    return e.select(*keys, F.to_date(ts).alias("day")).distinct()


def datelist_step(yesterday: DataFrame, events: DataFrame, key, ts: str, at: str,
                  dates: str = "dates_active", date: str = "date") -> DataFrame:
    """A1: one day of the date-list recurrence (newest first).

    New key -> [today]; active again -> today prepended; absent -> carried;
    ``date`` = today for every output row.
    """
    keys = _keys(key)
    at_d = F.to_date(F.lit(at))
    t = active_days(events, keys, ts, at, at).select(*keys, F.col("day").alias("_t_day"))
    y = yesterday.where(F.col(date) == F.date_sub(at_d, 1)).select(*keys, F.col(dates).alias("_y_dates"),
                                                                     F.col(date).alias("_y_date"))
    j = t.join(y, keys, "full")
    lst = (F.when(F.col("_y_dates").isNull(), F.array(F.col("_t_day")))
           .when(F.col("_t_day").isNull(), F.col("_y_dates"))
           .otherwise(F.concat(F.array(F.col("_t_day")), F.col("_y_dates"))))
    return j.select(*keys, lst.alias(dates), F.coalesce(F.col("_t_day"), F.date_add("_y_date", 1)).alias(date))


def datelist_backfill(events: DataFrame, key, ts: str, start: str, end: str,
                      dates: str = "dates_active", date: str = "date", emit_from=None) -> DataFrame:
    """A2: every daily date-list snapshot from ``start`` to ``end`` in one pass.

    Interval form: per key, the running list of active days (one window on
    the key) and the next active day; each active day is expanded to the days
    it stays the latest. Equal to iterating ``datelist_step`` day by day.
    ``emit_from`` keeps only snapshot days ``>= emit_from`` (``emit_from=end``:
    the as-of snapshot alone) without shortening the lists.
    """
    keys = _keys(key)
    d = active_days(events, keys, ts, start, end)
    w = Window.partitionBy(*keys).orderBy("day")
    until = F.coalesce(F.date_sub(F.lead("day", 1).over(w), 1), F.to_date(F.lit(end)))
    run = F.collect_list("day").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    s = d.select(*keys, F.reverse(run).alias(dates), "day", until.alias("_u"))
    first = F.col("day")
    if emit_from is not None:
        lo = F.to_date(F.lit(emit_from))
        s = s.where(F.col("_u") >= lo)
        first = F.greatest(first, lo)
    return s.select(*keys, dates, F.explode(F.sequence(first, "_u")).alias(date))


def datelist_set(events: DataFrame, key, ts: str, dates: str = "active_dates", start=None, end=None) -> DataFrame:
    """A3: per key the sorted distinct active dates (oldest first).

    ``start`` / ``end`` restrict the scan to a day range (pushed to Parquet),
    so an incremental run reads only the new days and merges them with
    ``datelist_merge`` instead of rescanning all events.
    """
    keys = _keys(key)
    d = active_days(events, keys, ts, start, end)
    return d.groupBy(*keys).agg(F.array_sort(F.collect_list("day")).alias(dates))


def datelist_merge(existing: DataFrame, new: DataFrame, key, dates: str = "active_dates") -> DataFrame:
    """A3 upsert: union of the stored and the new date sets, sorted (idempotent)."""
    keys = _keys(key)
    e = existing.select(*keys, F.col(dates).alias("_e"))
    n = new.select(*keys, F.col(dates).alias("_n"))
    empty = F.array().cast("array<date>")
    return e.join(n, keys, "full").select(
        *keys, F.array_sort(F.array_union(F.coalesce("_e", empty), F.coalesce("_n", empty))).alias(dates))


def datelist_to_json(dates) -> Column:
    """Date-list as a JSON array string (the JSONB storage form), e.g. ``["2023-01-01","2023-01-03"]``."""
    return F.to_json(F.col(dates) if isinstance(dates, str) else dates)


def datelist_from_json(text) -> Column:
    """Parse a JSON date-list back to ``array<date>``."""
    return F.from_json(F.col(text) if isinstance(text, str) else text, "array<date>")


def datelist_by_device(events: DataFrame, key, device: str, ts: str, out: str = "device_activity") -> DataFrame:
    """A4: per key a map device -> sorted active dates (two-level aggregate)."""
    keys = _keys(key)
    d = events.where(F.col(device).isNotNull()).select(*keys, device, F.to_date(ts).alias("day"))
    for k in keys:
        d = d.where(F.col(k).isNotNull())
    per_dev = d.distinct().groupBy(*keys, device).agg(F.array_sort(F.collect_list("day")).alias("_dates"))
    return per_dev.groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(device), F.col("_dates"))))).alias(out))


def activity_bitmask(dates, as_of: str, as_written: bool = False, series_days: int = 31) -> Column:
    """A5: 32-bit activity mask relative to ``as_of`` (MSB = as-of day) from a date array.

    A higher-order ``aggregate`` over the key's own array: no calendar cross join.

    ``as_written=True`` reproduces the original formula ``2^(32 - d)`` cast to
    32 bits over a ``series_days`` calendar ending at ``as_of``: the as-of day
    itself falls off the top (2^32), so the MSB is the day before and the
    "daily" flag reads yesterday.
    """
    as_of_d = F.to_date(F.lit(as_of))
    lo, hi, top = (1, series_days - 1, 32) if as_written else (0, 31, 31)

    def step(acc, d):
        diff = F.datediff(as_of_d, d)
        bit = F.when((diff >= lo) & (diff <= hi),
                     F.call_function("shiftleft", F.lit(1).cast("long"), top - diff)).otherwise(F.lit(0).cast("long"))
        return acc.bitwiseOR(bit)

    arr = F.col(dates) if isinstance(dates, str) else dates
    return F.aggregate(F.coalesce(arr, F.array().cast("array<date>")), F.lit(0).cast("long"), step)


def activity_bitmask_of_events(events: DataFrame, key: str, ts: str, as_of: str, out: str = "mask") -> DataFrame:
    """A5 straight from events: one ``bit_or`` per key, combined map-side; no distinct, no array, one exchange."""
    diff = F.datediff(F.to_date(F.lit(as_of)), F.to_date(ts))
    bit = F.when(diff.between(0, 31), F.call_function("shiftleft", F.lit(1).cast("long"), 31 - diff))
    return events.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).groupBy(key) \
        .agg(F.coalesce(F.bit_or(bit), F.lit(0)).cast("long").alias(out))


def activity_flags(mask) -> list[Column]:
    """Monthly (32-day), 28-day, weekly and daily activity flags from a mask."""
    m = F.col(mask) if isinstance(mask, str) else mask

    def any_bits(const):
        return F.bit_count(m.bitwiseAND(F.lit(const).cast("long"))) > 0

    return [any_bits(MASK_32_DAYS).alias("dim_is_monthly_active"), any_bits(MASK_28_DAYS).alias("dim_is_28d_active"),
            any_bits(MASK_7_DAYS).alias("dim_is_weekly_active"), any_bits(MASK_1_DAY).alias("dim_is_daily_active")]


def month_day_bitmap(datelists: DataFrame, key, dates: str, out: str = "datelist_int") -> DataFrame:
    """Per (key, month) ``bit_or(1 << (day_of_month - 1))`` -- LSB is day 1.

    The month is part of the key, so different months never collide.
    """
    keys = _keys(key)
    e = datelists.select(*keys, F.explode_outer(dates).alias("_d"))  # empty list -> NULL mask, key kept
    return e.groupBy(*keys, F.trunc("_d", "MM").alias("month")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.dayofmonth("_d") - 1)).alias(out))


def daily_counts(events: DataFrame, key, ts: str, count_col=None, start=None, end=None,
                 name: str = "num_site_hits") -> DataFrame:
    """Per (key, day) event count (NULL keys dropped); partial aggregation before the shuffle."""
    keys = _keys(key)
    e = events.where(day_range(events, ts, start, end))
    for k in keys:
        e = e.where(F.col(k).isNotNull())
    e = e.withColumn("_day", F.to_date(ts))
    cnt = F.count(F.lit(1)) if count_col is None else F.count(count_col)
    return e.groupBy(*keys, F.col("_day").alias("day")).agg(cnt.alias(name))


def array_metric_step(yesterday: DataFrame, counts: DataFrame, key, day: str, metric_name: str,
                      value: str = "num_site_hits", array_col: str = "metric_array") -> DataFrame:
    """Write the day's value into slot ``day - month_start`` of each key-month array.

    New keys are zero-filled up to the day; keys without activity get 0.
    Slot assignment (not append) makes re-running a day idempotent.
    """
    keys = _keys(key)
    d = F.to_date(F.lit(day))
    month = F.trunc(d, "MM")
    idx = F.datediff(d, month)  # 0-based slot
    t = counts.where(F.col("day") == d).select(*keys, F.col(value).cast("long").alias("_v"))
    y = yesterday.where((F.col("month_start") == month) & (F.col("metric_name") == metric_name)).select(
        *keys, F.col(array_col).alias("_a"))
    j = t.join(y, keys, "full")
    base = F.coalesce(F.col("_a"), F.array().cast("array<long>"))
    n = F.size(base)
    head = F.when(n >= idx, F.slice(base, 1, idx)).otherwise(
        F.concat(base, F.array_repeat(F.lit(0).cast("long"), idx - n)))
    head = F.when(idx == 0, F.array().cast("array<long>")).otherwise(head)
    tail = F.when(n > idx + 1, F.slice(base, idx + 2, n - idx - 1)).otherwise(F.array().cast("array<long>"))
    arr = F.concat(head, F.array(F.coalesce(F.col("_v"), F.lit(0).cast("long"))), tail)
    return j.select(*keys, month.alias("month_start"), F.lit(metric_name).alias("metric_name"), arr.alias(array_col))


def array_metric_backfill(counts: DataFrame, key, through_day: str, metric_name: str,
                          value: str = "num_site_hits", array_col: str = "metric_array",
                          from_month: str | None = None) -> DataFrame:
    """The array of every key-month up to ``through_day`` in one pass (= A8 iterated from day 1).

    Per key-month a day -> value map, read back through ``sequence(1, N)``:
    N = day of ``through_day`` for its month, the month's length for earlier
    months (``from_month`` .. the month before; default: ``through_day``'s month only).
    """
    keys = _keys(key)
    end = F.to_date(F.lit(through_day))
    last_month = F.trunc(end, "MM")
    first = F.trunc(F.to_date(F.lit(from_month)), "MM") if from_month else last_month
    c = counts.where((F.col("day") >= first) & (F.col("day") <= end))
    g = c.groupBy(*keys, F.trunc("day", "MM").alias("month_start")).agg(F.map_from_entries(F.collect_list(
        F.struct(F.dayofmonth("day").alias("k"), F.col(value).cast("long").alias("v")))).alias("_m"))
    n = F.when(F.col("month_start") == last_month, F.datediff(end, last_month) + 1) \
        .otherwise(F.dayofmonth(F.last_day("month_start")))
    arr = F.transform(F.sequence(F.lit(1), n), lambda i: F.coalesce(F.col("_m")[i], F.lit(0).cast("long")))
    return g.select(*keys, "month_start", F.lit(metric_name).alias("metric_name"), arr.alias(array_col))


def array_metric_totals(arrays: DataFrame, array_col: str = "metric_array") -> DataFrame:
    """A10: element-wise sum across keys, exploded to (metric_name, date, value); any array length."""
    e = arrays.select("metric_name", "month_start", F.posexplode(array_col).alias("pos", "v"))
    g = e.groupBy("metric_name", "month_start", "pos").agg(F.sum("v").alias("value"))
    return g.select("metric_name", F.date_add("month_start", F.col("pos")).alias("day"), "value")


def monthly_activity_reduced(events: DataFrame, key: str, ts: str, who: str, slots: int = 31,
                             exact_month: bool = False) -> DataFrame:
    """Per (month, key) zero-filled arrays of daily hits and distinct visitors.

    One scan: (key, month, day) aggregate, then one (month, key) aggregate
    building a day -> (hits, visitors) map read through ``sequence(1, 31)``.
    """
    # an event without a time has no day slot (and a NULL day cannot be a map key)
    e = events.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(key, who, F.to_date(ts).alias("_d"))
    daily = e.groupBy(key, F.trunc("_d", "MM").alias("month"), F.dayofmonth("_d").alias("day")).agg(
        F.count(F.lit(1)).alias("hits"), F.count_distinct(who).alias("uv"))
    g = daily.groupBy("month", key).agg(F.map_from_entries(F.collect_list(
        F.struct("day", F.struct("hits", "uv")))).alias("_m"))
    n = F.dayofmonth(F.last_day("month")) if exact_month else F.lit(slots)
    days = F.sequence(F.lit(1), n)
    return g.select(
        "month", F.col(key).alias("host_name") if key != "host_name" else F.col(key),
        F.transform(days, lambda i: F.coalesce(F.col("_m")[i]["hits"], F.lit(0).cast("long"))).alias("hit_array"),
        F.transform(days, lambda i: F.coalesce(F.col("_m")[i]["uv"], F.lit(0).cast("long"))).alias("unique_visitors_array"),
    )


def event_spine(start: Column, end: Column, name: str = "day") -> Column:
    """Calendar spine as an exploded ``sequence`` (guarded against start > end)."""
    return F.explode(F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))).alias(name)


def spine_counts(events: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """A13 use: every calendar day in [start, end] with its event count (0 when idle).

    Both sides have one row per day (a data-independent bound); the daily
    counts are a partial aggregate, so the join moves days, not events.
    """
    spark = events.sparkSession
    spine = spark.range(1).select(event_spine(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    counts = events.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n_events"))
    return spine.join(counts, "day", "left").select(
        "day", F.coalesce("n_events", F.lit(0).cast("long")).alias("n_events"))
