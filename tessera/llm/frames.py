"""Small frame helpers of the corpus operators."""

from __future__ import annotations

import contextlib
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import read_table
from tessera.sources.writers import remove, stage

ROW = "_row"


_shipped: set[str] = set()
BATCH_BYTES = 16 << 20  # of rows that Spark hands to Python at a time, whatever their number

def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package (once per application), wherever it was imported from."""
    sc = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-"), "tessera_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("tessera", os.path.relpath(full, top)))
    sc.addPyFile(path)  # Spark's own file server hands it to every executor
    _shipped.add(sc.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id, text and a row key.

    A row is known by (doc_id, ``_row``); rows that share both are copies with
    equal results, so rows with one doc_id but other texts are kept apart.
    Other columns, whatever their names, do not reach the operator.
    """
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumn(ROW, F.xxhash64("text"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def plan_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` reads, by Spark's statistics; data without any, as rows made by a program, count 0."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(n for n in sizes if n < 1 << 60)  # Spark gives unknown sizes as 2**63 - 1


def parts_for(df: DataFrame, part_bytes: int, least: int) -> int:
    """``least`` parts, or as many as keep one at ``part_bytes`` of the input."""
    return max(least, -(-plan_bytes(df) // part_bytes))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder and read back: later jobs and retries start from the files."""
    return stage(df, name)


def unstaged(df: DataFrame) -> None:
    """Delete what ``staged`` has written for ``df``, which nothing reads any more."""
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        remove(df.sparkSession, folder)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """Spark removes the shuffle files of a query when it ends, instead of when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def sent_to_all(small: DataFrame, row_bytes: int, limit: int = 64 << 20) -> DataFrame:
    """``small`` marked for broadcast if its counted rows take at most ``limit`` bytes, else as it is (a shuffle join)."""
    return F.broadcast(small) if small.count() * row_bytes <= limit else small


__all__ = ["ROW", "documents", "id_and_text", "parts_for", "plan_bytes", "sent_to_all", "ship", "shuffle_partitions",
           "shuffles_removed", "staged", "unstaged"]
