"""Skew-safe "previous event of the same key" and gaps-and-islands.

A plain ``lag(...) OVER (PARTITION BY key ORDER BY ts)`` sends every event of
a key to one task; a key holding a third of all rows would then be one
giant, single-threaded sort. Here events are partitioned by
(key, time bucket): the in-bucket ``lag`` runs in parallel across buckets,
and the previous event of a bucket's first row comes from the last row of
the previous non-empty bucket (one summary row per key and bucket, so a hot
key contributes at most "time span / bucket width" summary rows to the only
per-key window).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.expr import key_list as _keys
from tessera.sources.writers import stage


# The key travels as one struct column ``_k``: windows partition on it and the bucket joins use
# plain equality on it, so the join reuses the windows' partitioning (no second shuffle of the
# events), and a key with NULL parts still matches itself (struct equality compares fields
# with NULL = NULL, the way a window groups NULL keys together).
_K = "_k"


def _asc(cols):
    """Ascending with NULLs last (SQL's default order; an event without a time sorts after the rest)."""
    return [F.col(c).asc_nulls_last() for c in cols]


def time_bucket(ts: str, bucket_seconds: int) -> Column:
    """Monotone bucket number of a timestamp (ntz or session-zone)."""
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(bucket_seconds * 1_000_000)).cast("long")


def with_previous(
    df: DataFrame,
    key,
    ts: str,
    tiebreak: Sequence[str] = (),
    carry: Sequence[str] = (),
    bucket_seconds: int = 3600,
    prefix: str = "prev_",
    keep_bucket: bool = False,
    segments: int | None = None,
) -> DataFrame:
    """Add ``prev_<ts>`` and ``prev_<c>`` for ``c`` in ``carry``: the previous event of the same key.

    Order is (ts, *tiebreak); the first event of a key gets NULLs. With
    ``keep_bucket`` the helper column ``_bkt`` is kept for further
    bucket-level work.

    The bucket summaries (last event per key and bucket) come from an
    aggregate with map-side partial aggregation, so the events themselves are
    shuffled once, for the in-bucket window.

    Buckets are hours (``bucket_seconds``) by default. With ``segments=N`` they
    are the N row-balanced ranges of a ``repartitionByRange(key, ts, ...)``
    instead (boundaries from a sample): a key whose events also crowd into one
    hour is still cut into pieces of about ``rows / N`` rows. The numbered rows
    are written once and read by both branches: two range exchanges would each
    sample boundaries of their own.
    """
    keys = _keys(key)
    order = [ts, *tiebreak]
    payload = list(dict.fromkeys([*order, *carry]))
    rec = F.struct(*[F.col(c) for c in payload])
    w_in = Window.partitionBy(_K, "_bkt").orderBy(*_asc(order))
    if segments:
        # range segments are contiguous in (key, ts, tiebreak) order, so the segment id is
        # monotone in time within a key, exactly like a time bucket
        based = stage(df.repartitionByRange(segments, *keys, *_asc(order)).withColumn(
            "_bkt", F.spark_partition_id().cast("long")), "segments")
    else:
        based = df.withColumn("_bkt", time_bucket(ts, bucket_seconds))
    based = based.withColumn(_K, F.struct(*keys))
    b = based.withColumn("_prev_in", F.lag(rec, 1).over(w_in))
    # Last event of every (key, bucket): the struct max orders by (ts, *tiebreak) first.
    last = based.groupBy(_K, "_bkt").agg(F.max(rec).alias("_last"))
    # ... and for each bucket, the last event of the previous non-empty bucket.
    w_b = Window.partitionBy(_K).orderBy(F.col("_bkt").asc_nulls_last())
    summ = last.select(_K, "_bkt", F.lag("_last", 1).over(w_b).alias("_prev_bkt"))
    j = b.join(summ, [_K, "_bkt"], "left")
    prev = F.coalesce(F.col("_prev_in"), F.col("_prev_bkt"))
    extra = [_K, "_bkt"] if keep_bucket else []
    return j.select(*df.columns, *extra, *[prev[c].alias(prefix + c) for c in list(dict.fromkeys([ts, *carry]))])


def islands(
    df: DataFrame,
    key,
    ts: str,
    value: str,
    tiebreak: Sequence[str] = (),
    bucket_seconds: int = 3600,
    segments: int | None = None,
) -> DataFrame:
    """Run-length encode ``value`` per key in (ts, tiebreak) order.

    Output: keys, ``run`` (1-based), ``value``, ``run_length``, ``run_start``, ``run_end``.
    The run id is a global running count of value changes per key, built
    from in-bucket running sums plus per-bucket offsets (running sum over the
    bucket summaries), so no single task sees a whole key.
    """
    keys = _keys(key)
    order = [ts, *tiebreak]
    p = with_previous(df.select(*keys, *list(dict.fromkeys([*order, value]))), keys, ts, tiebreak,
                      carry=[value], bucket_seconds=bucket_seconds, prefix="_p_", keep_bucket=True,
                      segments=segments)
    p = p.withColumn(
        "_chg",
        F.when(F.col("_p_" + ts).isNull(), F.lit(1))
        .when(~F.col(value).eqNullSafe(F.col("_p_" + value)), F.lit(1))
        .otherwise(F.lit(0)),
    )
    running = (Window.unboundedPreceding, Window.currentRow)
    w_in = Window.partitionBy(_K, "_bkt").orderBy(*_asc(order)).rowsBetween(*running)
    p = p.withColumn("_run_in", F.sum("_chg").over(w_in))
    # changes per bucket (p is already partitioned by key and bucket: no shuffle), then the
    # changes in all earlier buckets of the key as the bucket's offset
    w_b = Window.partitionBy(_K).orderBy(F.col("_bkt").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per_b = p.groupBy(_K, "_bkt").agg(F.sum("_chg").alias("_n")).select(
        _K, "_bkt", F.coalesce(F.sum("_n").over(w_b), F.lit(0)).alias("_off"))
    r = p.join(per_b, [_K, "_bkt"], "left").withColumn("run", F.col("_off") + F.col("_run_in"))
    return r.groupBy(*keys, "run").agg(
        F.first(value).alias(value),
        F.count(F.lit(1)).alias("run_length"),
        F.min(ts).alias("run_start"),
        F.max(ts).alias("run_end"),
    )
