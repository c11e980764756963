"""Sketches, bitmaps, dense ids, quantile sketches, bottom-k samples and clustered layout."""

import math
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_MID, rows
from tessera.operators import distincts as di
from tessera.operators import layout, sampling
from tessera.plans.q_distincts import _next_week, _week


def visits(spark, users=60_000):
    """Each user on three days of two weeks; one key holds a third of all rows, some rows lack a part."""
    e = spark.range(users * 3).selectExpr(
        f"CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 5) END AS k", f"id % {users} AS who",
        "timestamp'2024-01-01' + make_interval(0, 0, 0, cast(xxhash64(id) % 7 + 7 AS int)) AS ts")
    return e.unionByName(spark.createDataFrame([(None, 1, None), ("hot", None, None)], "k string, who long, ts timestamp"))


def test_sketches_of_days_add_up_to_weeks(spark):
    e = visits(spark).where("ts IS NOT NULL")
    exact = {tuple(r)[:2]: r[2] for r in e.groupBy("k", F.trunc("ts", "week")).agg(F.count_distinct("who")).collect()}
    got = di.period_distincts(di.daily_sketches(e, "k", "ts", "who"), "k", _week()).collect()
    assert {(r.k, r.period) for r in got} == set(exact)
    for r in got:
        assert abs(r.distincts - exact[r.k, r.period]) <= 3.5 / math.sqrt(2 ** di.LOG_ENTRIES) * exact[r.k, r.period] + 1
    sizes = di.daily_sketches(e, "k", "ts", "who").select(F.length("sketch")).collect()
    assert max(s[0] for s in sizes) <= 8 * 2 * 2 ** di.LOG_ENTRIES + 100  # whatever the day's events


def test_retention_by_sketch_and_by_bitmap(spark):
    e = visits(spark, 3000)
    e = e.where("k IS NOT NULL AND ts IS NOT NULL AND who IS NOT NULL")
    w = e.select("k", F.trunc("ts", "week").alias("week"), "who").distinct()
    want = rows(w.alias("a").join(w.alias("b"), F.expr("a.k = b.k AND a.who = b.who AND b.week = a.week - 7"), "left")
                .groupBy("a.k", "a.week").agg(F.count("b.who")))
    ids = di.dense_ids(e, "who")
    bitmaps = di.daily_bitmaps(e.join(ids, "who"), "k", "ts", "dense_id")
    assert rows(di.retained(bitmaps, "k", _week(), _next_week)) == want
    weeks = di.period_distincts(di.daily_sketches(e, "k", "ts", "who"), "k", _week())
    got = {(r.k, r.period): r.returned for r in di.period_retention(weeks, "k", _next_week).collect()}
    assert got and all(got[k, p] == n for k, p, n in want if (k, p) in got)  # below 2**14: exact


def test_bitmaps_equal_count_distinct(spark):
    e = visits(spark, 100_000)  # several bitmap rows a key
    ids = di.dense_ids(e, "who", partitions=7)
    n = ids.count()
    assert ids.agg(F.min("dense_id"), F.max("dense_id"), F.count_distinct("dense_id")).first() == (0, n - 1, n)
    got = di.exact_uniques(di.daily_bitmaps(e.join(ids, "who"), "k", "ts", "dense_id"), "k", F.trunc("day", "MM"))
    ok = e.where("k IS NOT NULL AND ts IS NOT NULL AND who IS NOT NULL")
    assert rows(got) == rows(ok.groupBy("k", F.trunc("ts", "MM")).agg(F.count_distinct("who")))
    none = e.limit(0)
    assert di.dense_ids(none, "who").count() == 0


def test_quantiles_over_days(spark):
    g = spark.range(50_000).selectExpr("id % 2 AS k", "date'2024-01-01' + cast(id % 9 AS int) AS day", "(id * 7919) % 50000 AS v")
    got = di.quantiles(di.quantile_sketches(g, "k", F.col("day"), "v"), "k", [0.05, 0.5, 0.95]).collect()
    for r in got:
        rank = g.where(f"k = {r.k}").agg(F.avg((F.col("v") <= r.value).cast("int"))).first()[0]
        assert abs(rank - r["rank"]) <= 0.015 and r.n == 25_000


def test_bottom_k_is_exact_and_stable(spark):
    df = spark.range(10_000).selectExpr("CASE WHEN id % 10 < 8 THEN 'hot' WHEN id < 5 THEN 'rare' ELSE NULL END AS s", "id", "id % 97 AS v")
    want = None
    for n in (1, 7, 32):  # whatever the partitions
        got = rows(sampling.bottom_k(df.repartition(n), "s", ["id"], 50))
        want = want or got
        assert got == want
    sizes = {}
    for s, _, _, w in want:
        sizes.setdefault(s, []).append(w)
    whole = {r.s: r["count"] for r in df.groupBy("s").count().collect()}
    assert {s: len(w) for s, w in sizes.items()} == {s: min(50, n) for s, n in whole.items()}
    assert all(abs(sum(w) - whole[s]) < 1e-6 for s, w in sizes.items())
    small = {r[1] for r in rows(sampling.bottom_k(df, "s", ["id"], 20))}
    assert small <= {r[1] for r in want}  # a smaller sample is a part of a larger one
    e = sampling.estimate_total(sampling.bottom_k(df, "s", ["id"], 400), "s", "v").collect()
    true = {r.s: r.t for r in df.groupBy("s").agg(F.sum("v").alias("t")).collect()}
    for r in e:
        assert abs(r.estimate - true[r.s]) <= 2 * r.bound + 1e-6
    plan = sampling.bottom_k(df, "s", ["id"], 50)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # cut before the shuffle, too


def test_clustered_files_prune_on_every_column(spark):
    df = spark.range(40_000).selectExpr("xxhash64(id, 1) % 1000 AS a", "xxhash64(id, 2) % 1000 AS b",
                                        "CASE WHEN id % 50 = 0 THEN NULL ELSE xxhash64(id, 3) % 7 END AS c", "id")
    top = tempfile.mkdtemp(prefix="layout-", dir="/tmp")
    layout.clustered(df, ["a", "b"], 16).write.parquet(top + "/z")
    df.repartitionByRange(16, "a").sortWithinPartitions("a").write.parquet(top + "/one")
    df.repartition(16).write.parquet(top + "/none")

    def share(name, column):
        r = layout.file_ranges(spark.read.parquet(f"{top}/{name}"), ["a", "b"]).collect()
        return sum(x["min_" + column] <= 331 <= x["max_" + column] for x in r) / len(r)

    def size(name):
        return sum(os.path.getsize(os.path.join(top, name, f)) for f in os.listdir(f"{top}/{name}") if f.endswith(".parquet"))

    assert share("z", "a") <= 0.5 and share("z", "b") <= 0.5
    assert share("one", "b") == 1 and share("none", "a") == 1
    assert size("z") < size("none")
    assert rows(spark.read.parquet(top + "/z"), "id", "a", "b", "c") == rows(df, "id", "a", "b", "c")
    assert layout.clustered(df.limit(0), ["a", "b"], 4).count() == 0
