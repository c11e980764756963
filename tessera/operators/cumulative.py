"""Cumulative snapshot dimensions.

A cumulative dimension holds, per entity and period, the entity's whole
history so far. The daily/yearly recurrence ``today FULL JOIN yesterday`` is
offered as ``cumulative_step`` for incremental runs; backfills use the closed
"interval" form: one window over the facts (partitioned by the entity key)
computes the running history and the next fact's period, and each fact row
is expanded to the periods it stays current for. No join, one exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.expr import (
    guarded_ratio,
    is_date_type,
    period_add,
    period_diff,
    period_lit,
    threshold_class,
)
from tessera.functions.expr import key_list as _keys


def cumulative_backfill(
    facts: DataFrame,
    key,
    period: str,
    fields: Sequence[str],
    as_of,
    carry: Sequence[str] = (),
    history: str | None = "history",
    current: str = "current_period",
    emit_from=None,
) -> DataFrame:
    """Every snapshot row (key, current) from a key's first fact up to ``as_of``.

    ``facts`` must hold one row per (key, period). Output columns:
    keys, ``carry`` columns (taken from the latest fact, i.e. carried forward
    while inactive), ``history`` = array<struct<period, fields>> oldest first,
    ``last_period``, ``years_since_last`` (periods since the latest fact),
    ``is_active`` and ``current``. ``history=None`` leaves the array out (the
    state columns alone are what an SCD needs; the arrays of all snapshots
    together grow with periods squared). ``emit_from`` emits only snapshots
    with ``current >= emit_from`` (e.g. ``emit_from=as_of`` gives the latest
    snapshot alone) while histories still cover every earlier fact.
    """
    keys = _keys(key)
    is_date = is_date_type(facts, period)
    w = Window.partitionBy(*keys).orderBy(period)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nxt = F.lead(F.col(period), 1).over(w)
    until = F.coalesce(period_add(nxt, -1, is_date), period_lit(as_of, is_date))
    hist = ([F.collect_list(F.struct(*[F.col(period)] + [F.col(c) for c in fields])).over(running).alias(history)]
            if history else [])
    f = (
        facts.where(F.col(period) <= period_lit(as_of, is_date))
        .select(
            *keys,
            *carry,
            F.col(period).alias("last_period"),
            *hist,
            until.alias("_until"),
        )
    )
    first = F.col("last_period")
    if emit_from is not None:
        lo = period_lit(emit_from, is_date)
        f = f.where(F.col("_until") >= lo)  # intervals ending before emit_from produce nothing
        first = F.greatest(first, lo)
    f = f.withColumn(current, F.explode(F.sequence(first, F.col("_until"))))
    gap = period_diff(F.col(current), F.col("last_period"), is_date)
    return f.select(
        *keys,
        *carry,
        *([history] if history else []),
        "last_period",
        gap.alias("years_since_last"),
        (gap == 0).alias("is_active"),
        current,
    )


def cumulative_step(
    yesterday: DataFrame | None,
    today: DataFrame,
    key,
    period: str,
    fields: Sequence[str],
    at,
    carry: Sequence[str] = (),
    history: str = "history",
    current: str = "current_period",
) -> DataFrame:
    """One period of the recurrence ``today FULL OUTER JOIN yesterday``.

    ``yesterday`` is the snapshot at ``at - 1`` (schema of ``cumulative_backfill``),
    ``today`` the facts of period ``at`` (one row per key). Append today's
    struct to the history, else start it, else carry it forward; attributes
    coalesce today-first.
    """
    keys = _keys(key)
    is_date = is_date_type(today, period)
    t = today.where(F.col(period) == period_lit(at, is_date)).select(
        *keys, *[F.col(c).alias("_t_" + c) for c in carry],
        F.struct(*[F.col(period)] + [F.col(c) for c in fields]).alias("_t_fact"),
        F.col(period).alias("_t_period"),
    )
    if yesterday is None:  # first period: an empty snapshot of the right shape
        y = t.where(F.lit(False)).select(
            *keys, *[F.col("_t_" + c).alias("_y_" + c) for c in carry],
            F.array(F.col("_t_fact")).alias("_y_hist"), F.col("_t_period").alias("_y_last"),
            F.lit(0).alias("_y_gap"),
        )
    else:
        y = yesterday.where(F.col(current) == period_add(period_lit(at, is_date), -1, is_date)).select(
            *keys, *[F.col(c).alias("_y_" + c) for c in carry],
            F.col(history).alias("_y_hist"), F.col("last_period").alias("_y_last"),
            F.col("years_since_last").alias("_y_gap"),
        )
    j = t.join(y, keys, "full")
    active = F.col("_t_period").isNotNull()
    hist = (
        F.when(F.col("_y_hist").isNull(), F.array(F.col("_t_fact")))
        .when(active, F.concat(F.col("_y_hist"), F.array(F.col("_t_fact"))))
        .otherwise(F.col("_y_hist"))
    )
    return j.select(
        *keys,
        *[F.coalesce(F.col("_t_" + c), F.col("_y_" + c)).alias(c) for c in carry],
        hist.alias(history),
        F.coalesce(F.col("_t_period"), F.col("_y_last")).alias("last_period"),
        F.when(active, F.lit(0)).otherwise(F.col("_y_gap") + 1).alias("years_since_last"),
        active.alias("is_active"),
        period_lit(at, is_date).alias(current),
    )


def history_improvement(
    snapshots: DataFrame, key, history: str, measure: str, current: str, at, where=None,
    name: str = "improvement",
    report: bool = False,
) -> DataFrame:
    """Last / first element of ``history.measure`` (zero denominator -> 1).

    No aggregation and no shuffle: both ends are read from the array.
    ``report=True`` adds the final ordering of the report (ratio descending,
    NULLs first as in the original); only a final report should sort.
    """
    keys = _keys(key)
    s = snapshots.where(F.col(current) == F.lit(at))
    if where is not None:
        s = s.where(where)
    last = F.try_element_at(F.col(history), F.lit(-1))[measure]
    first = F.try_element_at(F.col(history), F.lit(1))[measure]
    out = s.select(*keys, last.alias("last_value"), first.alias("first_value"),
                   guarded_ratio(last, first).alias(name))
    return out.orderBy(F.col(name).desc_nulls_first()) if report else out


def history_unnest(snapshots: DataFrame, key, history: str, extra: Sequence[str] = ()) -> DataFrame:
    """One row per history element, struct fields as columns (1-based position)."""
    keys = _keys(key)
    return snapshots.select(*keys, *extra, F.posexplode(history).alias("pos", "_e")).select(
        *keys, *extra, (F.col("pos") + 1).alias("pos"), "_e.*"
    )


def cumulative_collection(
    facts: DataFrame,
    key,
    period: str,
    item_fields: Sequence[str],
    measure: str,
    as_of,
    thresholds: Sequence[tuple[float, str]],
    else_label: str,
    carry: Sequence[str] = (),
    items: str | None = None,
    class_col: str = "quality_class",
    current: str = "current_period",
    avg_digits: int | None = None,
    emit_from=None,
) -> DataFrame:
    """Variable-size batch per (key, period) concatenated over periods.

    The class comes from the running average of ``measure`` over every item
    so far (running sum / running count, never re-unnesting the history).
    Rows are pre-aggregated to (key, period) with a partial aggregate before
    the window, so a hot key contributes one row per period to the window.

    ``n_items`` (running item count) is always produced. The item array
    itself (``items='films'``) is the model's optional payload: it holds every
    item of the entity so far in one row, so only request it where the items
    per entity are bounded; without it no per-entity collection is built.
    """
    keys = _keys(key)
    is_date = is_date_type(facts, period)
    aggs = [*[F.max(c).alias(c) for c in carry], F.sum(measure).alias("_sum"), F.count(measure).alias("_cnt"),
            F.count(F.lit(1)).alias("_n")]
    if items:
        aggs.append(F.array_sort(F.collect_list(F.struct(*item_fields))).alias("_batch"))
    batch = facts.where(F.col(period) <= period_lit(as_of, is_date)).groupBy(*keys, period).agg(*aggs)
    w = Window.partitionBy(*keys).orderBy(period)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(period_add(F.lead(F.col(period), 1).over(w), -1, is_date), period_lit(as_of, is_date))
    avg = F.sum("_sum").over(running) / F.sum("_cnt").over(running)
    if avg_digits is not None:
        avg = F.round(avg, avg_digits)
    payload = [F.flatten(F.collect_list("_batch").over(running)).alias(items)] if items else []
    s = batch.select(
        *keys, *carry,
        F.col(period).alias("last_period"),
        *payload,
        F.sum("_n").over(running).alias("n_items"),
        avg.alias("avg_" + measure),
        until.alias("_until"),
    )
    begin = F.col("last_period")
    if emit_from is not None:
        begin = F.greatest(begin, period_lit(emit_from, is_date))
        s = s.where(F.col("_until") >= period_lit(emit_from, is_date))
    s = s.withColumn(current, F.explode(F.sequence(begin, F.col("_until"))))
    return s.select(
        *keys, *carry, *([items] if items else []), "n_items", "avg_" + measure,
        threshold_class(F.col("avg_" + measure), thresholds, else_label).alias(class_col),
        (F.col(current) == F.col("last_period")).alias("is_active"),
        current,
    )


def latest_snapshot(snapshots: DataFrame, key, current: str) -> DataFrame:
    """One row per entity, last period wins.

    ``max_by`` as a partial + final aggregate (map-side combine: one row per
    entity and map task crosses the shuffle). The struct buffer makes Spark
    plan it sort-based rather than hash-based.
    """
    keys = _keys(key)
    others = [c for c in snapshots.columns if c not in keys]
    return (
        snapshots.groupBy(*keys)
        .agg(F.max_by(F.struct(*others), F.col(current)).alias("_s"))
        .select(*keys, "_s.*")
    )


def entity_metric(facts: DataFrame, key, measure: str, name: str | None = None, where=None,
                  extra: Sequence = ()) -> DataFrame:
    """Average of a measure per entity (partial + final hash aggregate)."""
    keys = _keys(key)
    f = facts if where is None else facts.where(where)
    return f.groupBy(*keys).agg(F.avg(measure).alias(name or f"avg_{measure}"), *extra)
