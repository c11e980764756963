"""Slowly changing dimensions.

Change detection is NULL-safe everywhere (``<=>``): a NULL -> value step is a
change, NULL -> NULL is not. The snapshot inputs hold one row per
(key, period), so every per-key window sees at most "number of periods" rows
regardless of how many raw facts a hot key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.expr import is_date_type, null_safe_changed, period_add, period_lit
from tessera.functions.expr import key_list as _keys
from tessera.sources.writers import stage


def scd2_backfill(
    snapshots: DataFrame,
    key,
    period: str,
    tracked: Sequence[str],
    as_of,
    start: str = "start_period",
    end: str = "end_period",
    stamp: str = "current_period",
) -> DataFrame:
    """Collapse per-period snapshots into intervals of unchanged ``tracked``.

    lag -> change flag -> running sum (streak id) -> min/max period per streak.
    The window and the final aggregate share the key partitioning: one exchange.
    """
    keys = _keys(key)
    is_date = is_date_type(snapshots, period)
    w = Window.partitionBy(*keys).orderBy(period)
    s = snapshots.where(F.col(period) <= period_lit(as_of, is_date)).select(
        *keys, period, *tracked, *[F.lag(c, 1).over(w).alias("_prev_" + c) for c in tracked],
        F.row_number().over(w).alias("_rn"),
    )
    flag = F.when(F.col("_rn") == 1, F.lit(0)).when(null_safe_changed(tracked), F.lit(1)).otherwise(F.lit(0))
    s = s.withColumn("_chg", flag).withColumn(
        "_streak", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    # tracked values are constant inside a streak, so grouping by them is free and keeps the
    # aggregate buffers fixed-width (hash aggregate, no sort).
    return s.groupBy(*keys, "_streak", *tracked).agg(
        F.min(period).alias(start),
        F.max(period).alias(end),
    ).select(*keys, *tracked, start, end, period_lit(as_of, is_date).alias(stamp))


def scd2_rollback(scd: DataFrame, as_of, is_date: bool, start: str = "start_period", end: str = "end_period") -> DataFrame:
    """The SCD-2 table (closed intervals) as it was at ``as_of``: later intervals dropped, longer ones cut."""
    at = period_lit(as_of, is_date) if not hasattr(as_of, "cast") else as_of
    return scd.where(F.col(start) <= at).withColumn(end, F.least(F.col(end), at))


def scd2_incremental(
    scd: DataFrame,
    snapshot: DataFrame,
    key,
    tracked: Sequence[str],
    at,
    period: str = "current_period",
    start: str = "start_period",
    end: str = "end_period",
    stamp: str = "current_period",
) -> DataFrame:
    """Advance an SCD-2 table (closed intervals, as of ``at - 1``) by one period.

    Rows ending before ``at - 1`` pass through untouched (no shuffle). Rows
    open at ``at - 1`` meet the new snapshot in one full outer join:
    unchanged -> end extended; changed -> old row kept + new (at, at);
    new entity -> (at, at); entity missing from the snapshot keeps its closed row.

    A table that already holds ``at`` or later periods is first taken back to
    ``at - 1``, so applying a period twice equals applying it once.
    """
    keys = _keys(key)
    is_date = is_date_type(snapshot, period)
    at_l = period_lit(at, is_date)
    prev_l = period_add(at_l, -1, is_date)
    scd = scd2_rollback(scd, prev_l, is_date, start, end)
    historical = scd.where(F.col(end) < prev_l).select(*keys, *tracked, start, end)
    last = scd.where(F.col(end) == prev_l).select(
        *keys, *[F.col(c).alias("_l_" + c) for c in tracked], F.col(start).alias("_l_start"),
        F.col(end).alias("_l_end"), F.lit(True).alias("_l_present"),
    )
    today = snapshot.where(F.col(period) == at_l).select(
        *keys, *[F.col(c).alias("_t_" + c) for c in tracked], F.lit(True).alias("_t_present"),
    )
    j = last.join(today, keys, "full")
    same = None
    for c in tracked:
        e = F.col("_l_" + c).eqNullSafe(F.col("_t_" + c))
        same = e if same is None else (same & e)
    has_l = F.col("_l_present").isNotNull()
    has_t = F.col("_t_present").isNotNull()

    def rec(prefix, s, e):
        return F.struct(*[F.col(prefix + c).alias(c) for c in tracked], s.alias(start), e.alias(end))

    old = rec("_l_", F.col("_l_start"), F.col("_l_end"))
    extended = rec("_l_", F.col("_l_start"), at_l)
    fresh = rec("_t_", at_l, at_l)
    rows = (
        F.when(has_l & has_t & same, F.array(extended))
        .when(has_l & has_t, F.array(old, fresh))
        .when(has_l, F.array(old))
        .otherwise(F.array(fresh))
    )
    moved = j.select(*keys, F.inline(rows))
    return historical.unionByName(moved).withColumn(stamp, at_l)


def scd2_catch_up(
    scd: DataFrame,
    snapshots: DataFrame,
    key,
    tracked: Sequence[str],
    first,
    last,
    period: str = "current_period",
    start: str = "start_period",
    end: str = "end_period",
    stamp: str = "current_period",
) -> DataFrame:
    """S2 for several periods at once: advance an SCD-2 (as of ``first - 1``) to ``last``.

    The intervals still open at ``first - 1`` become seed rows in front of the
    snapshots of ``first..last``; one gaps-and-islands pass over seeds plus
    new snapshots (a window per key over at most ``last - first + 2`` rows)
    extends, closes and opens intervals; older history passes through. The
    same as applying ``scd2_incremental`` period by period, without the loop;
    like there, later periods already in the table are taken back first.
    """
    keys = _keys(key)
    is_date = is_date_type(snapshots, period)
    first_l, last_l = period_lit(first, is_date), period_lit(last, is_date)
    seed_end = period_add(first_l, -1, is_date)
    scd = scd2_rollback(scd, seed_end, is_date, start, end)
    historical = scd.where(F.col(end) < seed_end).select(*keys, *tracked, start, end)
    seeds = scd.where(F.col(end) == seed_end).select(
        *keys, *tracked, F.col(end).alias("_p"), F.col(start).alias("_seed_start"))
    new = snapshots.where(F.col(period).between(first_l, last_l)).select(
        *keys, *tracked, F.col(period).alias("_p"), F.lit(None).cast(seeds.schema["_seed_start"].dataType)
        .alias("_seed_start"))
    s = seeds.unionByName(new)
    w = Window.partitionBy(*keys).orderBy("_p")
    s = s.select("*", *[F.lag(c, 1).over(w).alias("_prev_" + c) for c in tracked],
                 F.row_number().over(w).alias("_rn"))
    flag = F.when(F.col("_rn") == 1, F.lit(0)).when(null_safe_changed(tracked), F.lit(1)).otherwise(F.lit(0))
    s = s.withColumn("_streak", F.sum(flag).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    moved = s.groupBy(*keys, "_streak", *tracked).agg(
        F.coalesce(F.min("_seed_start"), F.min("_p")).alias(start), F.max("_p").alias(end))
    return historical.unionByName(moved.select(*keys, *tracked, start, end)).withColumn(stamp, last_l)


def scd2_open_interval(
    snapshots: DataFrame,
    key,
    period: str,
    tracked: Sequence[str],
    open_end: int = 9999,
    start: str = "start_date",
    end: str = "end_date",
) -> DataFrame:
    """S3: per snapshot row, [period, next period - 1], open end ``open_end``.

    One row per period even when nothing changed (the collapsed form is
    S1 followed by ``scd2_close_open_end``).
    """
    keys = _keys(key)
    is_date = is_date_type(snapshots, period)
    w = Window.partitionBy(*keys).orderBy(period)
    nxt = F.lead(F.col(period), 1).over(w)
    return snapshots.select(
        *keys, *tracked, F.col(period).alias(start),
        F.coalesce(period_add(nxt, -1, is_date), period_lit(open_end, is_date)).alias(end),
        nxt.isNull().alias("is_current"),
    )


def scd2_close_open_end(scd: DataFrame, key, start: str, end: str, open_end: int = 9999) -> DataFrame:
    """Mark the latest interval of each key open (``open_end``, is_current).

    The window has no order and sees the intervals of one key (bounded by
    its number of changes, not by its raw facts).
    """
    keys = _keys(key)
    is_date = is_date_type(scd, start)
    w = Window.partitionBy(*keys)
    latest = F.col(start) == F.max(start).over(w)
    return scd.select(
        *[c for c in scd.columns if c != end],
        F.when(latest, period_lit(open_end, is_date)).otherwise(F.col(end)).alias(end),
        latest.alias("is_current"),
    )


def scd2_full_reload(snapshots: DataFrame, key, period: str, tracked: Sequence[str], as_of,
                     open_end: int = 9999, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Rebuild the whole SCD-2 (open-ended form) in one query: S1 then open the last interval."""
    s1 = scd2_backfill(snapshots, key, period, tracked, as_of, start=start, end=end).drop("current_period")
    return scd2_close_open_end(s1, key, start, end, open_end)


def scd2_merge_close(
    scd: DataFrame,
    snapshot: DataFrame,
    key,
    tracked: Sequence[str],
    at,
    period: str = "current_period",
    open_end: int = 9999,
    start: str = "start_date",
    end: str = "end_date",
) -> DataFrame:
    """MERGE a period's snapshot into an open-ended SCD-2 table.

    Changed entities: the current row closes at ``at - 1`` and a new current
    row opens at ``at``; new entities get a current row; everything else is
    unchanged. A table that already holds ``at`` or later periods is first
    taken back to ``at - 1`` (rows that later periods opened go, rows that they
    closed are open again), so a period applied twice equals once, and after a
    late re-run the later periods are applied again in order.
    Integer periods use ``open_end`` as the open end; for date periods pass a
    date string (e.g. ``'9999-12-31'``).
    """
    keys = _keys(key)
    is_date = is_date_type(snapshot, period)
    at_l = period_lit(at, is_date)
    open_l = period_lit(open_end, is_date)
    cols = [*keys, *tracked, start, end, "is_current"]
    reopened = F.col("is_current") | (F.col(end) >= period_add(at_l, -1, is_date))
    scd = scd.where(F.col(start) < at_l).withColumn("is_current", reopened) \
        .withColumn(end, F.when(F.col("is_current"), open_l).otherwise(F.col(end)))
    history = scd.where(~F.col("is_current")).select(*cols)
    cur = scd.where(F.col("is_current")).select(
        *keys, *[F.col(c).alias("_c_" + c) for c in tracked],
        F.col(start).alias("_c_start"), F.col(end).alias("_c_end"), F.lit(True).alias("_c_present"),
    )
    snap = snapshot.where(F.col(period) == at_l).select(
        *keys, *[F.col(c).alias("_t_" + c) for c in tracked], F.lit(True).alias("_t_present"),
    )
    j = cur.join(snap, keys, "full")
    same = None
    for c in tracked:
        e = F.col("_c_" + c).eqNullSafe(F.col("_t_" + c))
        same = e if same is None else (same & e)
    has_c = F.col("_c_present").isNotNull()
    has_t = F.col("_t_present").isNotNull()

    def rec(prefix, s, e, current):
        return F.struct(*[F.col(prefix + c).alias(c) for c in tracked], s.alias(start), e.alias(end),
                        F.lit(current).alias("is_current"))

    kept = rec("_c_", F.col("_c_start"), F.col("_c_end"), True)
    closed = rec("_c_", F.col("_c_start"), period_add(at_l, -1, is_date), False)
    opened = rec("_t_", at_l, open_l, True)
    rows = (
        F.when(has_c & has_t & same, F.array(kept))
        .when(has_c & has_t, F.array(closed, opened))
        .when(has_c, F.array(kept))
        .otherwise(F.array(opened))
    )
    return history.unionByName(j.select(*keys, F.inline(rows)))


def scd_type0(snapshots: DataFrame, key, attrs: Sequence[str], period: str) -> DataFrame:
    """Fixed attributes -- keep the first value, count later attempts to change it."""
    keys = _keys(key)
    w = Window.partitionBy(*keys).orderBy(period).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = snapshots.select(*keys, *attrs, *[F.first(c).over(w).alias("_f_" + c) for c in attrs])
    changed = None
    for c in attrs:
        e = ~F.col(c).eqNullSafe(F.col("_f_" + c))
        changed = e if changed is None else (changed | e)
    return s.groupBy(*keys).agg(
        *[F.first("_f_" + c).alias(c) for c in attrs],
        F.count_if(changed).alias("attempted_changes"),
    )


def scd_type1(snapshots: DataFrame, key, attrs: Sequence[str], period: str) -> DataFrame:
    """Overwrite with the latest value (``max_by``, partial + final aggregate with map-side combine)."""
    keys = _keys(key)
    return snapshots.groupBy(*keys).agg(
        F.max_by(F.struct(*attrs, F.col(period).alias("updated_period")), F.col(period)).alias("_s")
    ).select(*keys, "_s.*")


def scd_type3(snapshots: DataFrame, key, attr: str, period: str) -> DataFrame:
    """Current and previous value of ``attr`` (previous = value before the last change)."""
    keys = _keys(key)
    w = Window.partitionBy(*keys).orderBy(period)
    s = snapshots.select(*keys, attr, period, F.lag(attr, 1).over(w).alias("_p"),
                         F.row_number().over(w).alias("_rn"))
    changes = s.where((F.col("_rn") == 1) | ~F.col(attr).eqNullSafe(F.col("_p")))
    changes = changes.select(*keys, attr, period, F.lag(attr, 1).over(w).alias("_prev"))
    return changes.groupBy(*keys).agg(
        F.max_by(F.struct(F.col(attr).alias("current_" + attr), F.col("_prev").alias("previous_" + attr),
                          F.col(period).alias("changed_period")), F.col(period)).alias("_s")
    ).select(*keys, "_s.*")


def scd2_as_of(facts: DataFrame, fact_key, fact_period: str, scd: DataFrame, dim_key, start: str, end: str,
               dim_cols: Sequence[str]) -> DataFrame:
    """Attach the dimension row valid at each fact's period.

    Equi-join on the key plus a ``between`` residual: Spark plans a
    sort-merge (or, when the SCD side is small by statistics, broadcast)
    join; AQE splits a hot key's fact partition. Facts with no valid row keep
    NULL attributes (left join).
    """
    fk = _keys(fact_key)
    dk = _keys(dim_key)
    d = scd.select(*[F.col(k).alias("_d_" + k) for k in dk], F.col(start).alias("_d_start"),
                   F.col(end).alias("_d_end"), *dim_cols)
    cond = None
    for a, b in zip(fk, dk):
        e = F.col(a) == F.col("_d_" + b)
        cond = e if cond is None else (cond & e)
    cond = cond & F.col(fact_period).between(F.col("_d_start"), F.col("_d_end"))
    return facts.join(d, cond, "left").drop(*["_d_" + k for k in dk], "_d_start", "_d_end")


def scd2_as_of_scan(facts: DataFrame, fact_key, fact_period: str, scd: DataFrame, dim_key, start: str, end: str,
                    dim_cols: Sequence[str], segments: int | None = None) -> DataFrame:
    """S9 for long histories: facts and interval starts sorted together, the last interval carried along; no join of the two.

    The union is cut into ``segments`` row-balanced ranges of (key, period)
    (as many as the shuffle has partitions by default), so a key with very many
    intervals and facts is spread over many tasks, and a fact never meets the
    other intervals of its key. What a segment's first key had before comes
    from one summary row a segment. Intervals of a key must not overlap; facts
    with no valid row, or a NULL key, keep NULL attributes.
    """
    spark = facts.sparkSession
    segments = segments or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fk, dk = _keys(fact_key), _keys(dim_key)
    interval = F.struct(F.col(end).alias("_end"), *[F.col(c).alias(c) for c in dim_cols])
    fact = F.struct(*[F.col(c).alias(c) for c in facts.columns])
    starts = scd.select(F.struct(*[F.col(d).cast(facts.schema[f].dataType).alias(f) for f, d in zip(fk, dk)]).alias("_k"),
                        F.col(start).alias("_at"), F.lit(0).alias("_kind"), interval.alias("_i"))
    types = starts.schema["_i"].dataType
    both = starts.withColumn("_f", F.lit(None).cast(facts.select(fact.alias("f")).schema["f"].dataType)).unionByName(
        facts.select(F.struct(*[F.col(k) for k in fk]).alias("_k"), F.col(fact_period).alias("_at"), F.lit(1).alias("_kind"),
                     F.lit(None).cast(types).alias("_i"), fact.alias("_f")))
    cut = stage(both.repartitionByRange(segments, "_k", "_at", "_kind").withColumn("_seg", F.spark_partition_id()), "segments")
    so_far = Window.partitionBy("_seg", "_k").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = cut.withColumn("_own", F.last("_i", ignorenulls=True).over(so_far))
    last = cut.where("_kind = 0").groupBy("_seg").agg(F.max(F.struct("_k", "_at", "_i")).alias("_l"))  # one row a segment
    every = spark.range(segments).select(F.col("id").cast("int").alias("_seg"))
    earlier = Window.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.join(last, "_seg", "left").select("_seg", F.last("_l", ignorenulls=True).over(earlier).alias("_before"))
    rows = here.where("_kind = 1").join(F.broadcast(carried), "_seg", "left")
    known = F.lit(True)
    for k in fk:
        known = known & F.col("_k")[k].isNotNull()
    found = F.coalesce("_own", F.when(F.col("_before._k") == F.col("_k"), F.col("_before._i")))
    valid = F.when(known & (found["_end"] >= F.col("_at")), found)
    return rows.select("_f.*", *[valid[c].alias(c) for c in dim_cols])
