"""Hand fixtures FX6 (date-lists, masks), FX7 (array metrics), FX8 (run length), FX10 (reduced month)."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import activity as ac
from tessera.operators import quality as qa
from tessera.operators.sequence import islands

D = dt.date

FX6 = [  # active dates, mask, daily, weekly, 32-day, 28-day (as of 2023-01-31)
    ([D(2023, 1, 31), D(2023, 1, 30)], 3221225472, True, True, True, True),
    ([D(2023, 1, 30)], 1073741824, False, True, True, True),
    ([D(2023, 1, 25)], 33554432, False, True, True, True),
    ([D(2023, 1, 24)], 16777216, False, False, True, True),
    ([D(2022, 12, 31)], 1, False, False, True, False),
    ([D(2022, 12, 30)], 0, False, False, False, False),
]


def test_fx6_mask_and_flags(spark):
    df = spark.createDataFrame([(i, d) for i, (d, *_r) in enumerate(FX6)], "k int, dates array<date>")
    m = df.select("k", ac.activity_bitmask("dates", "2023-01-31").alias("mask"))
    out = {r.k: (r.mask, r.dim_is_daily_active, r.dim_is_weekly_active, r.dim_is_monthly_active, r.dim_is_28d_active)
           for r in m.select("k", "mask", *ac.activity_flags("mask")).collect()}
    for i, (_d, mask, daily, weekly, monthly, d28) in enumerate(FX6):
        assert out[i] == (mask, daily, weekly, monthly, d28), i


def test_t13_as_written_mask_reads_yesterday(spark):
    df = spark.createDataFrame([(1, [D(2023, 1, 31)]), (2, [D(2023, 1, 30)]), (3, [D(2023, 1, 1)])],
                               "k int, dates array<date>")
    m = df.select("k", ac.activity_bitmask("dates", "2023-01-31", as_written=True).alias("mask"))
    got = {r.k: (r.mask, r.dim_is_daily_active) for r in m.select("k", "mask", *ac.activity_flags("mask")).collect()}
    # today's bit (2^32) falls off; yesterday takes the MSB; day 1 of the month is 2^2
    assert got == {1: (0, False), 2: (2 ** 31, True), 3: (4, False)}


def test_fx6_bitmap_and_merge(spark):
    df = spark.createDataFrame([("a", [D(2023, 1, 1), D(2023, 1, 3), D(2023, 2, 1)]), ("b", [])],
                               "k string, dates array<date>")
    got = rows(ac.month_day_bitmap(df, "k", "dates"))
    assert got == [("a", D(2023, 1, 1), 5), ("a", D(2023, 2, 1), 1), ("b", None, None)]
    old = spark.createDataFrame([("a", [D(2023, 1, 3), D(2023, 1, 1)])], "k string, active_dates array<date>")
    new = spark.createDataFrame([("a", [D(2023, 1, 1), D(2023, 1, 2)])], "k string, active_dates array<date>")
    merged = ac.datelist_merge(old, new, "k")
    assert rows(merged) == [("a", [D(2023, 1, 1), D(2023, 1, 2), D(2023, 1, 3)])]
    assert rows(ac.datelist_merge(merged, new, "k")) == rows(merged)  # idempotent


def _events(spark, data):
    return spark.createDataFrame(data, "user_id string, ts string").withColumn("ts", F.to_timestamp("ts"))


def test_a2_backfill_equals_iterated_a1(spark):
    ev = _events(spark, [("u1", "2023-01-01 10:00:00"), ("u1", "2023-01-03 11:00:00"), ("u2", "2023-01-02 09:00:00"),
                         ("u1", "2023-01-03 12:00:00"), (None, "2023-01-02 01:00:00")])
    back = ac.datelist_backfill(ev, "user_id", "ts", "2023-01-01", "2023-01-04")
    y = back.where("false")
    parts = []
    for d in ["2023-01-01", "2023-01-02", "2023-01-03", "2023-01-04"]:
        y = ac.datelist_step(y, ev, "user_id", "ts", d)
        y = spark.createDataFrame(y.collect(), y.schema)
        parts.append(y)
    it = parts[0]
    for p in parts[1:]:
        it = it.unionByName(p)
    assert rows(it, "user_id", "date", "dates_active") == rows(back, "user_id", "date", "dates_active")
    last = {r.user_id: r.dates_active for r in back.where("date = '2023-01-04'").collect()}
    assert last == {"u1": [D(2023, 1, 3), D(2023, 1, 1)], "u2": [D(2023, 1, 2)]}


def test_fx7_array_metric_step_and_totals(spark):
    y = spark.createDataFrame([("u1", D(2023, 1, 1), "site_hits", [5, 0]), ("u2", D(2023, 1, 1), "site_hits", [1, 1])],
                              "user_id string, month_start date, metric_name string, metric_array array<bigint>")
    c = spark.createDataFrame([("u1", D(2023, 1, 3), 2), ("u3", D(2023, 1, 3), 4)],
                              "user_id string, day date, num_site_hits bigint")
    after = ac.array_metric_step(y, c, "user_id", "2023-01-03", "site_hits")
    expected = [("u1", [5, 0, 2]), ("u2", [1, 1, 0]), ("u3", [0, 0, 4])]
    assert rows(after, "user_id", "metric_array") == expected
    again = ac.array_metric_step(spark.createDataFrame(after.collect(), after.schema), c, "user_id", "2023-01-03",
                                 "site_hits")
    assert rows(again, "user_id", "metric_array") == expected  # re-running day 3: slot replaced, not appended
    assert rows(ac.array_metric_totals(after)) == [("site_hits", D(2023, 1, 1), 6), ("site_hits", D(2023, 1, 2), 1),
                                                   ("site_hits", D(2023, 1, 3), 6)]
    assert rows(qa.array_length_profile(after, "metric_array")) == [(3, 3)]


def test_a9_backfill_equals_iterated_a8(spark):
    c = spark.createDataFrame([("u1", D(2023, 1, 1), 5), ("u2", D(2023, 1, 2), 1), ("u1", D(2023, 1, 4), 2)],
                              "user_id string, day date, num_site_hits bigint")
    y = ac.array_metric_backfill(c.where("false"), "user_id", "2023-01-01", "site_hits")
    for d in range(1, 5):
        y = ac.array_metric_step(y, c, "user_id", f"2023-01-{d:02d}", "site_hits")
        y = spark.createDataFrame(y.collect(), y.schema)
    back = ac.array_metric_backfill(c, "user_id", "2023-01-04", "site_hits")
    assert rows(y, "user_id", "metric_array") == rows(back, "user_id", "metric_array") == [
        ("u1", [5, 0, 0, 2]), ("u2", [0, 1, 0, 0])]


def test_a9_backfill_across_months(spark):
    c = spark.createDataFrame([("u1", D(2023, 1, 30), 5), ("u1", D(2023, 2, 2), 1)],
                              "user_id string, day date, num_site_hits bigint")
    back = ac.array_metric_backfill(c, "user_id", "2023-02-03", "site_hits", from_month="2023-01-01")
    got = {str(r.month_start): r.metric_array for r in back.collect()}
    assert got["2023-01-01"] == [0] * 29 + [5, 0]  # January: 31 slots
    assert got["2023-02-01"] == [0, 1, 0]          # February up to the 3rd


def test_fx8_run_length(spark):
    def rle(values):
        data = [("k", f"2024-01-01 00:{i:02d}:00", i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(data, "k string, ts string, id int, v string").withColumn("ts", F.to_timestamp("ts"))
        out = islands(df, "k", "ts", "v", ["id"], bucket_seconds=120)  # small buckets: runs cross buckets
        return [(r.v, r.run_length) for r in out.orderBy("run").collect()]

    assert rle(["1"] * 5) == [("1", 5)]
    assert rle(["a", "a", "b", "a"]) == [("a", 2), ("b", 1), ("a", 1)]


def test_fx10_reduced_month(spark):
    data = [("h", "a", "2023-01-01 01:00:00"), ("h", "a", "2023-01-01 02:00:00"), ("h", "b", "2023-01-01 03:00:00"),
            ("h", None, "2023-01-01 04:00:00"), ("h", "a", "2023-01-31 05:00:00"), (None, "a", "2023-01-05 00:00:00"),
            ("h", "a", None)]  # no time, no day slot
    ev = spark.createDataFrame(data, "host string, user_id string, ts string").withColumn("ts", F.to_timestamp("ts"))
    r = ac.monthly_activity_reduced(ev, "host", "ts", "user_id").collect()
    assert len(r) == 1
    hits, uv = r[0].hit_array, r[0].unique_visitors_array
    assert len(hits) == 31 and hits[0] == 4 and hits[30] == 1 and sum(hits) == 5
    assert uv[0] == 2 and uv[30] == 1 and sum(uv) == 3


def test_event_spine_counts(spark):
    ev = _events(spark, [("u", "2023-01-02 10:00:00"), ("u", "2023-01-02 11:00:00")])
    assert rows(ac.spine_counts(ev, "ts", "2023-01-01", "2023-01-03")) == [
        (D(2023, 1, 1), 0), (D(2023, 1, 2), 2), (D(2023, 1, 3), 0)]
