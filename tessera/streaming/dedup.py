"""Streaming and micro-batch dedupe.

The stream rule keeps an event unless an event with the same key was
*kept* within the watermark delay; state per key is dropped once the
watermark passes, so memory is bounded by keys x delay (the reason the
window is kept at 15-60 minutes). Its results depend on batch boundaries, so
tests check properties, not exact rows. The micro-batch writer gives the exact
rows of ``operators.facts.dedup_within_window`` whatever the batches.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.facts import dedup_within_window
from tessera.session import input_bytes
from tessera.sources.tables import with_session_timestamps
from tessera.sources.writers import overwrite_partitions, remove, stage, table_exists


def stream_dedup(stream: DataFrame, keys: Sequence[str], ts: str, delay: str = "60 minutes") -> DataFrame:
    """Watermark + ``dropDuplicatesWithinWatermark`` on a streaming DataFrame."""
    s = with_session_timestamps(stream)
    return s.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


_WINDOW_STATE = "fingerprints binary, kept binary"
_NO_TIME = -(1 << 63)


def long_window_dedup(stream: DataFrame, keys: Sequence[str], ts: str, hours: int = 24, buckets: int = 256,
                      slice_minutes: int = 60) -> DataFrame:
    """D5 for windows of a day and more: an event is dropped if one of its key was kept within ``hours`` of it.

    One state row a bucket of key hashes instead of one a key: the kept events
    of the window as sorted arrays of 64-bit key fingerprints and times (16
    bytes a kept event, where a row a key takes ten times that), cut into time
    slices. A slice goes as a whole once the watermark has passed its end by the
    window, so the state is bounded by the keys of one window and a slice.
    Events are judged in the order of (time, fingerprint) of their micro-batch;
    copies of a key within a batch are dropped by the same rule. An event
    without a time is kept. Equal fingerprints are taken for equal keys.
    """
    import numpy as np
    import pandas as pd

    window, slice_us = hours * 3_600_000_000, slice_minutes * 60_000_000
    s = with_session_timestamps(stream)
    columns = s.columns
    s = s.withWatermark(ts, f"{hours} hours").withColumn("_fp", F.xxhash64(F.lit(5), *keys)) \
        .withColumn("_bucket", F.pmod("_fp", F.lit(buckets))) \
        .withColumn("_us", F.coalesce(F.unix_micros(ts), F.lit(_NO_TIME)))

    def judge(key, batches, state):
        fps, kept = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if state.exists:
            a, b = state.get
            fps, kept = [np.frombuffer(a, np.int64)], [np.frombuffer(b, np.int64)]
        rows = pd.concat(list(batches), ignore_index=True)
        new, at = rows["_fp"].to_numpy(), rows["_us"].to_numpy()
        timed = np.flatnonzero(at != _NO_TIME)
        # state and batch by key and time; events of keys that stand alone are kept without a look
        all_fp = np.concatenate([*fps, new[timed]])
        all_at = np.concatenate([*kept, at[timed]])
        source = np.concatenate([np.full(len(all_fp) - len(timed), -1), timed])
        order = np.lexsort((source, all_at, all_fp))
        all_fp, all_at, source = all_fp[order], all_at[order], source[order]
        stays = np.ones(len(all_fp), bool)
        near = np.flatnonzero((all_fp[1:] == all_fp[:-1]) & (all_at[1:] - all_at[:-1] <= window)) + 1
        for i in near.tolist():
            if source[i] < 0:  # kept before: what came too near to it in this batch goes
                j = i - 1
                while j >= 0 and all_fp[j] == all_fp[i] and all_at[i] - all_at[j] <= window:
                    stays[j] &= source[j] < 0
                    j -= 1
                continue
            j = i - 1
            while j >= 0 and all_fp[j] == all_fp[i] and not stays[j]:
                j -= 1
            stays[i] = not (j >= 0 and all_fp[j] == all_fp[i] and all_at[i] - all_at[j] <= window)
        out = np.concatenate([np.flatnonzero(at == _NO_TIME), source[stays & (source >= 0)]])
        ends = (all_at // slice_us + 1) * slice_us
        live = stays & (ends + window > state.getCurrentWatermarkMs() * 1000)
        state.update((all_fp[live].tobytes(), all_at[live].tobytes()))
        yield rows.iloc[np.sort(out)][columns]

    return s.groupBy("_bucket").applyInPandasWithState(judge, s.select(*columns).schema, _WINDOW_STATE, "append", "NoTimeout")


def read_event_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """File-source stream of Parquet event files (new files are picked up per trigger)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


STATE_BYTES = 16 << 20  # of the input's files, for each state partition of a stream over them at most


def state_partitions_for(table: DataFrame) -> int:
    """A state partition for each core, or as many as keep one at ``STATE_BYTES`` of the table the stream comes from."""
    return max(table.sparkSession.sparkContext.defaultParallelism, -(-input_bytes(table) // STATE_BYTES))


def run_available_now(df: DataFrame, sink_path: str, checkpoint: str, mode: str = "append",
                      state_partitions: int | None = None) -> None:
    """Process everything available now into a Parquet sink, then stop (exactly-once file sink).

    Every trigger loads and commits every state partition, whatever arrives, so
    ``state_partitions`` sets their number by the size of the stream (else it is
    the session's shuffle partitions). A checkpoint keeps the number that it
    began with.
    """
    conf, key = df.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    if state_partitions:
        conf.set(key, str(state_partitions))
    try:  # a query takes its settings when it starts
        q = (df.writeStream.format("parquet").outputMode(mode).option("path", sink_path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        if state_partitions:
            conf.set(key, before)
    q.awaitTermination()


def microbatch_dedup_writer(target_path: str, keys: Sequence[str], ts: str, window_minutes: float,
                            tiebreak: Sequence[str] = (), partition_col: str = "day"):
    """A ``foreachBatch`` function that keeps the fact equal to the batch rule (D4) over all events so far.

    Events are logged beside the fact, partitioned by day and batch, so a
    replayed batch replaces its own rows. The survivors of every day that the
    batch can change -- its days, and the window's length after them, since a
    late event can remove a stored later one -- are then recomputed from the
    logged days around them and overwrite the fact's partitions. Keys match
    NULL with NULL; events without a time have a partition of their own and all
    stay. The log grows with the events; days that no late event can reach any
    more may be removed from it.
    """
    reach = 1 + int(window_minutes // 1440)
    log_path = target_path.rstrip("/") + "_events"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        b = with_session_timestamps(batch).withColumn(partition_col, F.to_date(ts)).withColumn("_batch", F.lit(batch_id))
        overwrite_partitions(b, log_path, [partition_col, "_batch"])
        if not table_exists(spark, log_path):
            return
        log = spark.read.parquet(log_path)
        mine = [r[0] for r in log.where(F.col("_batch") == batch_id).select(partition_col).distinct().collect()]
        if not mine:
            return
        day = datetime.timedelta(days=1)
        changed = sorted({d + i * day for d in mine if d is not None for i in range(reach + 1)})
        around = sorted({d - i * day for d in changed for i in range(reach + 1)})
        columns = [c for c in log.columns if c != "_batch"]
        # a day's events are compared with those up to a window before them
        kept = dedup_within_window(log.where(F.col(partition_col).isin(around)).select(*columns), list(keys), ts,
                                   window_minutes, list(tiebreak)).where(F.col(partition_col).isin(changed))
        if None in mine:
            kept = kept.unionByName(log.where(F.col(partition_col).isNull()).select(*columns))
        kept = stage(kept, "survivors")
        left = {r[0] for r in kept.select(partition_col).distinct().collect()}
        if left:
            overwrite_partitions(kept, target_path, [partition_col])
        for d in changed:  # a late event may leave a day without survivors
            if d not in left and table_exists(spark, f"{target_path.rstrip('/')}/{partition_col}={d}"):
                remove(spark, f"{target_path.rstrip('/')}/{partition_col}={d}")

    return write_batch
