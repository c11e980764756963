"""Packed exchange: hash-keyed columns move between tasks as binary runs instead of rows.

A task cuts its arrays by the key's bucket and emits one row per bucket, each
column as the bytes of a numpy array. Spark shuffles those rows by bucket and
hands each bucket to one call of the reducer. Keys are hashes, so buckets are
even; a task sends each key once (or as often as its reducer needs), so a key
that many documents share reaches its bucket once per task, not once per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.frames import parts_for, shuffle_partitions

U64 = np.uint64


BUCKET_BYTES = 16 << 20  # of the input's files, for each bucket at most


def buckets_for(df: DataFrame) -> int:
    """Two buckets a shuffle partition, and more when the input grows: a bucket is one call's work, whole in memory."""
    return parts_for(df, BUCKET_BYTES, 2 * max(32, shuffle_partitions(df.sparkSession)))


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> U64(40)) % U64(n)).astype(np.int32)


def pack(keys: np.ndarray, columns: dict[str, np.ndarray], n: int) -> Iterator[pa.RecordBatch]:
    """One row per bucket: bucket, keys (uint64) and the columns, all as array bytes, sorted by key."""
    if not len(keys):
        return
    b = bucket_of(keys, n)
    order = np.lexsort((keys, b))
    b, keys = b[order], keys[order]
    cols = {k: v[order] for k, v in columns.items()}
    cut = np.concatenate([[0], np.flatnonzero(b[1:] != b[:-1]) + 1, [len(b)]])
    spans = list(zip(cut[:-1], cut[1:]))
    yield pa.RecordBatch.from_arrays(
        [pa.array(b[cut[:-1]]), pa.array([keys[i:j].tobytes() for i, j in spans], pa.binary())]
        + [pa.array([v[i:j].tobytes() for i, j in spans], pa.binary()) for v in cols.values()],
        ["bucket", "keys", *cols])


def packed_schema(*columns: str) -> str:
    return ", ".join(["bucket int", "keys binary"] + [f"{c} binary" for c in columns])


def unpack(table: pa.Table, **types) -> dict[str, np.ndarray]:
    """All rows of a bucket joined into one array per column."""
    return {c: np.concatenate([np.frombuffer(v, t) for v in table.column(c).to_pylist()]) for c, t in types.items()}


def reduce_buckets(packed: DataFrame, fn: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    return packed.groupBy("bucket").applyInArrow(fn, schema)


def gather_runs(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Binary runs of one document joined into a list (as many entries as buckets at most)."""
    return rows.groupBy(*by).agg(F.collect_list(value).alias(value))


def group_edges(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of each group of equal sorted keys."""
    start = np.concatenate([[0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1]) if len(sorted_keys) else np.zeros(0, np.int64)
    return start.astype(np.int64), np.diff(np.concatenate([start, [len(sorted_keys)]])).astype(np.int64)
