"""Registered queries: distincts and quantiles that add up, exact-size samples, clustered layout, checked publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import distincts as di
from tessera.operators import layout, sampling
from tessera.operators.sequence import with_previous
from tessera.plans.q_writers import _DAILY_SQL, _daily, _scratch
from tessera.plans.registry import register
from tessera.sources.tables import read_table
from tessera.sources.versioned import CheckFailedError, VersionedTable
from tessera.sources.writers import stage

_RANKS = (0.1, 0.5, 0.9, 0.99)


def _stored_sketches(spark, sf_dir):
    """Daily sketches as a daily job would store them; what follows reads no events."""
    e = read_table(spark, sf_dir, "events").where("event_type IS NOT NULL AND ts IS NOT NULL")
    return stage(di.daily_sketches(e, "event_type", "ts", "user_id"), "sketches")


def _stored_bitmaps(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_type", "ts", "user_id")
    return stage(di.daily_bitmaps(e.join(di.dense_ids(e, "user_id"), "user_id"), "event_type", "ts", "dense_id"), "bitmaps")


def _week():
    return F.trunc("day", "week")


def _next_week(c):
    return F.date_add(c, 7)


_WEEKS_SQL = """
 WITH w AS (SELECT DISTINCT event_type, CAST(date_trunc('week', ts) AS DATE) AS week, user_id FROM events
            WHERE event_type IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL)"""


# Exact up to 2**14 distincts a group (then within 3 standard errors of 0.8 % with 99.7 %): the oracle counts exactly.
@register("weekly_distincts_sketch", oracle="""
 SELECT event_type, CAST(date_trunc('week', ts) AS DATE) AS week, count(*) AS n_events, count(DISTINCT user_id) AS distincts
 FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2""")
def q_weekly_distincts_sketch(spark, sf_dir):
    """weekly distinct users from stored daily sketches."""
    return di.period_distincts(_stored_sketches(spark, sf_dir), "event_type", _week()) \
        .select("event_type", F.col("period").alias("week"), "n_events", "distincts")


_RETURNED_SQL = _WEEKS_SQL + """
 SELECT a.event_type, a.week, count(b.user_id) AS returned
 FROM w a LEFT JOIN w b ON b.event_type = a.event_type AND b.week = a.week - 7 AND b.user_id = a.user_id"""


@register("weekly_retention_sketch", oracle=_RETURNED_SQL + """
 WHERE (a.event_type, a.week - 7) IN (SELECT (event_type, week) FROM w) GROUP BY 1, 2""")
def q_weekly_retention_sketch(spark, sf_dir):
    """Q3: users who came back in the next week, by sketch intersection."""
    weeks = di.period_distincts(_stored_sketches(spark, sf_dir), "event_type", _week())
    return di.period_retention(weeks, "event_type", _next_week) \
        .select("event_type", F.col("period").alias("week"), "returned")


@register("monthly_uniques_bitmap", oracle="""
 SELECT event_type, CAST(date_trunc('month', ts) AS DATE) AS month, count(DISTINCT user_id) AS uniques
 FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL AND user_id IS NOT NULL GROUP BY 1, 2""")
def q_monthly_uniques_bitmap(spark, sf_dir):
    """Exact monthly uniques from stored daily bitmaps."""
    return di.exact_uniques(_stored_bitmaps(spark, sf_dir), "event_type", F.trunc("day", "MM")) \
        .select("event_type", F.col("period").alias("month"), "uniques")


@register("weekly_returning_bitmap", oracle=_RETURNED_SQL + " GROUP BY 1, 2")
def q_weekly_returning_bitmap(spark, sf_dir):
    """Q3, exact: users of a week who were there in the week before."""
    return di.retained(_stored_bitmaps(spark, sf_dir), "event_type", _week(), _next_week) \
        .select("event_type", F.col("period").alias("week"), "returned")


@register("gap_quantiles", oracle=f"""
 WITH g AS (SELECT event_type, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id)) AS gap
            FROM events)
 SELECT event_type, r AS rank, count(*) AS n, true AS close
 FROM g, (SELECT unnest([{', '.join(f'{r}::DOUBLE' for r in _RANKS)}]) AS r) WHERE gap IS NOT NULL GROUP BY 1, 2""")
def q_gap_quantiles(spark, sf_dir):
    """D3: quantiles of the gap between same-key events from daily KLL sketches; ``close``: the rank error is at most 1.5 %."""
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    p = with_previous(e, ["user_id", "event_type"], "ts", ["event_id"])
    gaps = stage(p.select("event_type", F.to_date("ts").alias("day"), F.timestamp_diff("MICROSECOND", "prev_ts", "ts").alias("gap"))
                 .where("gap IS NOT NULL"), "gaps")
    stored = stage(di.quantile_sketches(gaps, "event_type", F.col("day"), "gap"), "gap-sketches")
    q = di.quantiles(stored, "event_type", _RANKS)
    at = q.groupBy("event_type").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("_v"))
    below = gaps.join(at, "event_type").groupBy("event_type").agg(  # the exact share of gaps up to each value, and below it
        *[F.avg((F.col("gap") <= F.col("_v")[F.lit(r)]).cast("int")).alias(f"_to_{i}") for i, r in enumerate(_RANKS)],
        *[F.avg((F.col("gap") < F.col("_v")[F.lit(r)]).cast("int")).alias(f"_under_{i}") for i, r in enumerate(_RANKS)])
    close = F.lit(True)
    for i, r in enumerate(_RANKS):
        close = F.when(F.col("rank") == F.lit(r), (F.col(f"_to_{i}") >= r - 0.015) & (F.col(f"_under_{i}") <= r + 0.015)).otherwise(close)
    return q.join(below, "event_type").select("event_type", "rank", "n", close.alias("close"))


_SAMPLE_SQL = """
 WITH o AS (SELECT o_orderstatus, o_orderkey, o_custkey, CAST(round(o_totalprice) AS BIGINT) AS price,
                   row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn,
                   count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders),
 s AS (SELECT *, n / least(n, 200) AS weight FROM o WHERE rn <= 200)"""


def _order_sample(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey", "o_custkey",
                                                   F.round("o_totalprice").cast("long").alias("price"))
    return sampling.bottom_k(o, "o_orderstatus", ["o_orderkey"], 200)


@register("bottom_k_sample", oracle=_SAMPLE_SQL + " SELECT o_orderstatus, o_orderkey, o_custkey, price, weight FROM s")
def q_bottom_k_sample(spark, sf_dir):
    """200 orders of each status, whatever the partitioning."""
    return _order_sample(spark, sf_dir)


@register("sample_estimate", oracle=_SAMPLE_SQL + """,
 g AS (SELECT o_orderstatus, any_value(n) AS n_rows, count(*) AS n_sampled, sum(price) AS x,
              coalesce(var_samp(price), 0) AS s2 FROM s GROUP BY 1),
 t AS (SELECT o_orderstatus, sum(price) AS total FROM o GROUP BY 1)
 SELECT o_orderstatus, n_rows, n_sampled, CAST(round(n_rows / n_sampled * x) AS BIGINT) AS estimate,
        CAST(round(1.96 * sqrt(n_rows * (n_rows - n_sampled) * s2 / n_sampled)) AS BIGINT) AS bound,
        abs(n_rows / n_sampled * x - total) <= 2 * 1.96 * sqrt(n_rows * (n_rows - n_sampled) * s2 / n_sampled) AS near
 FROM g JOIN t USING (o_orderstatus)""")
def q_sample_estimate(spark, sf_dir):
    """totals estimated from the sample with their bound, beside whether the true total is within twice the bound."""
    o = read_table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.sum(F.round("o_totalprice").cast("long")).alias("_t"))
    e = sampling.estimate_total(_order_sample(spark, sf_dir), "o_orderstatus", "price").join(o, "o_orderstatus")
    return e.select("o_orderstatus", "n_rows", "n_sampled", F.round("estimate").cast("long").alias("estimate"),
                    F.round("bound").cast("long").alias("bound"),
                    (F.abs(F.col("estimate") - F.col("_t")) <= 2 * F.col("bound")).alias("near"))


@register("clustered_layout", oracle="""
 SELECT 'l_partkey' AS scanned, count(*) AS n_rows, true AS pruned FROM lineitem
 WHERE l_partkey = (SELECT max(l_partkey) FROM lineitem) // 3
 UNION ALL SELECT 'l_suppkey', count(*), true FROM lineitem
 WHERE l_suppkey = (SELECT max(l_suppkey) FROM lineitem) // 3""")
def q_clustered_layout(spark, sf_dir):
    """Line items clustered by part and supplier in 16 files; a value of either column needs at most three quarters of the files (about a third, as a rule)."""
    li = read_table(spark, sf_dir, "lineitem")
    columns = ["l_partkey", "l_suppkey"]
    path = _scratch(spark, "clustered")
    layout.clustered(li, columns, 16).write.parquet(path)
    table = spark.read.parquet(path)
    ranges = layout.file_ranges(table, columns)
    most, out = li.agg(*[F.max(c) for c in columns]).first(), None  # one row
    for c, top in zip(columns, most):
        wanted = F.lit((top or 0) // 3)
        rows = table.where(F.col(c) == wanted).agg(F.count(F.lit(1)).alias("n_rows"))
        needed = ((F.col("min_" + c) <= wanted) & (F.col("max_" + c) >= wanted)).cast("int")
        files = ranges.agg((F.avg(needed) <= 0.75).alias("pruned"))
        one = rows.unionByName(files, allowMissingColumns=True).withColumn("scanned", F.lit(c))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("scanned").agg(F.max("n_rows").alias("n_rows"), F.max("pruned").alias("pruned"))


@register("checked_publish", oracle=_DAILY_SQL)
def q_checked_publish(spark, sf_dir):
    """Q2, Q4 before publishing: daily hits are published; a batch with repeated keys and negative hits is refused."""
    daily = _daily(read_table(spark, sf_dir, "events"))
    table = VersionedTable(spark, _scratch(spark, "published"), ["host", "day"])
    rules = {"hits": F.col("hits") > 0}
    table.publish(daily, rules)
    try:
        table.publish(daily.unionByName(daily.withColumn("hits", -F.col("hits"))), rules)
    except CheckFailedError:
        return table.read().select("host", "day", "hits")
    raise AssertionError("a batch that breaks the rules was published")
