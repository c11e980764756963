"""Writers: upsert, idempotent partition overwrite, append, schema evolution.

Parquet tables accept neither MERGE nor UPDATE, so an upsert is expressed as
``target ANTI JOIN source UNION source`` and written either by dynamic
partition overwrite (only the partitions the source touches are replaced)
or, for an unpartitioned target, into a new version directory. A static
overwrite of a path that the same job reads is never issued: it deletes the
input before reading it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.expr import key_list as _keys
from tessera.session import ensure_checkpoint_dir


MAX_LITERAL_PARTITIONS = 1000  # touched partitions named one by one in the scan's filter; more are matched by a semi join


class DuplicateKeyError(ValueError):
    pass


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds anything but hidden files. Asks the file system, so a listing that fails raises."""
    fs, p = _file_system(spark, path)
    return fs.exists(p) and any(not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(p))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder (scratch of a finished write, or a partition that has become empty)."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def match_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on equal keys, NULL matching NULL."""
    r = right.select(*[F.col(k).alias("_k_" + k) for k in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col("_k_" + k))
    return left.join(r, cond, how)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail when a key occurs twice (distributed aggregate; only a count reaches the driver)."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).limit(1).count()
    if dup:
        raise DuplicateKeyError(f"duplicate key in upsert source on {list(keys)}")


def upsert(target: DataFrame, source: DataFrame, key, check_unique: bool = True) -> DataFrame:
    """Insert or replace by key -> the merged table as a DataFrame.

    Rows of ``target`` whose key appears in ``source`` are replaced; the
    anti join shuffles both sides by key once (AQE may broadcast a small
    source by its runtime size). Running it twice gives the same result.
    """
    keys = _keys(key)
    if check_unique:
        assert_unique(source, keys)
    kept = match_null_safe(target, source, keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], rebalance: bool = True) -> None:
    """Idempotent INSERT OVERWRITE of exactly the partitions present in ``df``.

    Rows are rebalanced on the partition columns first: a partition is written
    by one task or, if it is large, by a few, not by every task that holds a row of it.
    With few partitions (a handful of types) pass ``rebalance=False``: each task
    writes the ones it holds and the rows are not shuffled again.
    """
    out = df.hint("rebalance", *partition_by) if rebalance else df
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def upsert_partitions(spark: SparkSession, path: str, source: DataFrame, key, partition_by: Sequence[str]) -> None:
    """W1 on a partitioned Parquet path: merge the source into the partitions it touches.

    The partition columns must be part of the key. Only touched partitions
    are read and rewritten (dynamic overwrite): their values -- one row per
    partition, metadata-sized -- become literal predicates, so the scan is
    pruned to those folders. The merged rows are first written to a staging
    copy under the checkpoint folder so the overwrite never reads the files
    it replaces, and a lost executor only re-runs its own tasks.
    """
    keys = _keys(key)
    outside = [c for c in partition_by if c not in keys]
    if outside:  # a row that moves to another partition would stay in the old one as well
        raise ValueError(f"partition columns {outside} are not part of the key {list(keys)}")
    assert_unique(source, keys)
    if not table_exists(spark, path):
        overwrite_partitions(source, path, partition_by)
        return
    current = spark.read.parquet(path)  # a table that cannot be read is an error, never an empty table
    values = source.select(*partition_by).distinct()
    touched = [tuple(r) for r in values.limit(MAX_LITERAL_PARTITIONS + 1).collect()]
    if len(touched) <= MAX_LITERAL_PARTITIONS:
        pruned = F.lit(False)
        for row in touched:
            c = F.lit(True)
            for col, v in zip(partition_by, row):
                c = c & (F.col(col).isNull() if v is None else F.col(col) == F.lit(v))
            pruned = pruned | c
        cur = current.where(pruned)
    else:
        cur = match_null_safe(current, values, partition_by, "left_semi")
    merged = upsert(cur, source.select(*current.columns), keys, check_unique=False)
    staging = f"{ensure_checkpoint_dir(spark).rstrip('/')}/upsert-{uuid.uuid4().hex}"
    merged.write.mode("overwrite").parquet(staging)
    overwrite_partitions(spark.read.parquet(staging), path, partition_by)
    remove(spark, staging)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write an intermediate once to a fresh folder under ``spark.checkpoint.dir`` and read it back.

    For a result that several branches of a plan consume: they then scan
    Parquet instead of each recomputing (and re-shuffling) its lineage, and a
    lost executor after the write does not send the job back to the sources.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Plain INSERT (not idempotent: a re-run duplicates rows). Contrast case only."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def add_column(df: DataFrame, name: str, default, dtype: str) -> DataFrame:
    """ALTER TABLE ADD COLUMN ... DEFAULT as a projection."""
    return df.withColumn(name, F.lit(default).cast(dtype))


VERSION = "_schema_version"


def stamp_version(df: DataFrame, version: int) -> DataFrame:
    """Rows written after the table's columns changed carry the number of the schema they were written under."""
    return df.withColumn(VERSION, F.lit(version))


def read_evolved(spark: SparkSession, path: str, defaults: dict | None = None) -> DataFrame:
    """Read files written with different schemas (Parquet ``mergeSchema``), filling defaults.

    ``defaults`` maps a column to its default, or to (default, version) for a
    column added by that schema version (1 if not given). As with ``ADD COLUMN
    ... DEFAULT``, only rows older than the column get it; a NULL stored since
    then stays NULL. Rows without a version are the oldest.
    """
    df = spark.read.option("mergeSchema", "true").parquet(path)
    version = F.coalesce(F.col(VERSION), F.lit(0)) if VERSION in df.columns else F.lit(0)
    for c, v in (defaults or {}).items():
        value, since = v if isinstance(v, tuple) else (v, 1)
        filled = F.when(version < since, F.coalesce(F.col(c), F.lit(value).cast(df.schema[c].dataType)))
        df = df.withColumn(c, filled.otherwise(F.col(c)))
    return df.drop(VERSION)
