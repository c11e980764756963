"""W1 for keyed tables that are not laid out by their key: versions of a Parquet table and a key-to-file index.

Layout under the table's folder::

    data/w=<write id>/[partition=value/]part-*.parquet   written once, never changed
    files/<write id>/part-*.parquet                      the live files of one version: file, rows, key range
    versions/<number>                                    names the ``files`` folder; its creation is the commit

A write puts new data files and the list of the version's live files in place
first; nothing refers to them until ``versions/<n + 1>`` is created, which
fails if another writer created it before. So a write that dies leaves the old
version as it was, a reader sees a whole version, and of two writers that
started from one version the second gets ``ConcurrentWriteError`` and changes
nothing. The file system's create-if-absent must be atomic (HDFS and local
disks; object stores with conditional puts).

A replace rewrites only files that hold a key in question. They are found in
two steps: the list of live files has each file's range of the first key
column, which is matched with at most ``RANGES`` ranges of the source's keys;
of the files left, the key columns alone are read and semi-joined with the
source's keys. Files are written sorted by key with Parquet's own Bloom filters
on the key columns, for point reads.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.expr import key_list as _keys
from tessera.sources.writers import _file_system, assert_unique, match_null_safe

RANGES = 64  # of the source's keys; this many rows reach the driver
_FILE = "_file"


class ConcurrentWriteError(RuntimeError):
    """Another writer committed the version that this write would have become."""


class CheckFailedError(ValueError):
    """Rows that were to be published break a rule; ``counts`` has the number of such rows for each rule."""

    def __init__(self, counts: dict[str, int]):
        super().__init__(f"not published: {counts}")
        self.counts = counts


class VersionedTable:
    """A Parquet table in versions, with one row for each ``key`` (which need not hold the partition columns)."""

    def __init__(self, spark: SparkSession, path: str, key, partition_by: Sequence[str] = ()):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.partition_by = _keys(key), list(partition_by)

    # ---- versions

    def versions(self) -> list[int]:
        """Numbers of the committed versions that have not expired, oldest first."""
        fs, p = _file_system(self.spark, f"{self.path}/versions")
        names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n) for n in names if n.isdigit())

    def _folder(self, version: int) -> str:
        fs, p = _file_system(self.spark, f"{self.path}/versions/{version:020d}")
        stream = fs.open(p)
        try:
            return stream.readUTF()
        finally:
            stream.close()

    def files(self, version: int | None = None) -> DataFrame:
        """Live files of a version (the latest by default): file, rows, low and high of the first key column, NULL keys."""
        version = self.versions()[-1] if version is None else version
        return self.spark.read.parquet(f"{self.path}/files/{self._folder(version)}")

    def _commit(self, live: DataFrame, write: str, before: int) -> int:
        live.write.parquet(f"{self.path}/files/{write}")
        fs, p = _file_system(self.spark, f"{self.path}/versions/{before + 1:020d}")
        try:
            stream = fs.create(p, False)  # fails if it is there
        except Exception as e:
            if fs.exists(p):
                raise ConcurrentWriteError(f"version {before + 1} of {self.path} was committed by another writer") from e
            raise
        stream.writeUTF(write)
        stream.close()
        return before + 1

    # ---- reads

    def _scan(self, names: list[str]) -> DataFrame:
        """The rows of the named files, with the partition columns."""
        base = f"{self.path}/data"
        return self.spark.read.option("basePath", base).parquet(*[f"{base}/{n}" for n in names]).drop("w")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version. Its file names pass the driver, as they do in any Parquet read."""
        names = [r[0] for r in self.files(version).select("file").toLocalIterator()]
        if not names:
            return self._scan([r[0] for r in self.files(self.versions()[0]).select("file").limit(1).collect()]).limit(0)
        return self._scan(names)

    # ---- writes

    def _written(self, rows: DataFrame, write: str) -> DataFrame:
        """Write ``rows`` to files of their own and return their entries for the list of live files."""
        order = [*self.partition_by, *[k for k in self.key if k not in self.partition_by]]
        return self._stored(rows.repartitionByRange(*order).sortWithinPartitions(*order), write)

    def _stored(self, rows: DataFrame, write: str) -> DataFrame:
        w = rows.withColumn("w", F.lit(write)).write
        for k in self.key:
            if k not in self.partition_by:
                w = w.option(f"parquet.bloom.filter.enabled#{k}", "true")
        w.mode("append").partitionBy("w", *self.partition_by).parquet(f"{self.path}/data")
        first = F.col(self.key[0])
        base = f"{self.path}/data"
        fs, p = _file_system(self.spark, f"{base}/w={write}")
        if not fs.exists(p):  # no rows
            return self.spark.createDataFrame([], f"file string, rows long, low {self._type(rows)}, high {self._type(rows)}, "
                                                  "nulls long")
        stored = self.spark.read.option("basePath", base).parquet(f"{base}/w={write}")
        name = F.regexp_extract(F.col("_metadata.file_path"), r"/data/(w=.*)$", 1)
        return stored.groupBy(name.alias("file")).agg(
            F.count(F.lit(1)).alias("rows"), F.min(first).alias("low"), F.max(first).alias("high"),
            F.count_if(first.isNull()).alias("nulls"))

    def _type(self, rows: DataFrame) -> str:
        return rows.schema[self.key[0]].dataType.simpleString()

    def overwrite(self, rows: DataFrame) -> int:
        """A new version that holds ``rows`` alone."""
        assert_unique(rows, self.key)
        before, write = (self.versions() or [0])[-1], uuid.uuid4().hex
        return self._commit(self._written(rows, write), write, before)

    def publish(self, rows: DataFrame, rules: dict | None = None) -> int:
        """Q2, Q4 before publishing: a new version of ``rows`` alone, unless a key occurs twice or a row breaks a rule.

        ``rules`` maps names to conditions that every row must meet (NULL
        breaks them). Rows are shuffled once, by key; repeated keys and broken
        rules are counted by observed metrics while the files are written, and
        the version is committed only if all counts are 0. Else
        ``CheckFailedError`` tells the counts, the written files are removed
        and the table is unchanged.
        """
        if "duplicate_keys" in (rules or {}):
            raise ValueError("duplicate_keys is the name of the key's own rule")
        before, write = (self.versions() or [0])[-1], uuid.uuid4().hex
        seen = Observation()
        repeated = F.row_number().over(Window.partitionBy(*self.key).orderBy(F.lit(1)))
        broken = [F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in (rules or {}).items()]
        checked = rows.withColumn("_copy", repeated).observe(
            seen, F.count_if(F.col("_copy") > 1).alias("duplicate_keys"), *broken).drop("_copy")
        live = self._stored(checked, write)
        counts = {n: c for n, c in seen.get.items() if c}
        if counts:
            fs, p = _file_system(self.spark, f"{self.path}/data/w={write}")
            fs.delete(p, True)
            raise CheckFailedError(counts)
        return self._commit(live, write, before)

    def _holding(self, live: DataFrame, keys: DataFrame, on: list[str]) -> list[str]:
        """Names of the live files that hold one of the keys."""
        first = self.key[0]
        if first in on:
            cut = keys.select(first).repartitionByRange(RANGES, first).groupBy(F.spark_partition_id()).agg(
                F.min(first), F.max(first), F.count_if(F.col(first).isNull())).collect()
            near = F.lit(False)
            for _, low, high, nulls in cut:
                if low is not None:
                    near = near | ((F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low)))
                if nulls:
                    near = near | (F.col("nulls") > 0)
            live = live.where(near)
        names = [r[0] for r in live.select("file").toLocalIterator()]
        if not names:
            return []
        held = self._scan(names).select(*on, F.regexp_extract("_metadata.file_path", r"/data/(w=.*)$", 1).alias(_FILE))
        return [r[0] for r in match_null_safe(held, keys, on, "left_semi").select(_FILE).distinct().toLocalIterator()]

    def replace(self, scope: DataFrame, rows: DataFrame | None = None, on=None) -> int:
        """Delete every row whose ``on`` columns (the key by default) match a row of ``scope``, insert ``rows``: a new version.

        Only files that hold such a row are rewritten; without any change the version stays.
        """
        on = _keys(on or self.key)
        if rows is not None:
            assert_unique(rows, self.key)
        before, write = self.versions()[-1], uuid.uuid4().hex
        live, keys = self.files(before), scope.select(*on).distinct()
        old = self._holding(live, keys, on)
        columns = self.read(before).columns
        kept = match_null_safe(self._scan(old), keys, on, "left_anti") if old else None
        new = rows.select(*columns) if rows is not None else None
        if kept is None and new is None:
            return before
        written = self._written(kept if new is None else new if kept is None else kept.unionByName(new), write)
        gone = self.spark.createDataFrame([(n,) for n in old], "file string")
        return self._commit(live.join(gone, "file", "left_anti").unionByName(written), write, before)

    def upsert(self, source: DataFrame) -> int:
        """Insert or replace by key. A row may change its partition: its old file loses it."""
        return self.overwrite(source) if not self.versions() else self.replace(source, source)

    def expire(self, keep: int = 2, grace_hours: float = 24.0) -> list[str]:
        """Drop all but the latest ``keep`` versions and the files that only they had; returns the files' names.

        Files of no version at all (of writes that died) go once they are older than ``grace_hours``.
        """
        numbers = self.versions()
        old, kept = numbers[:-keep], numbers[-keep:]
        needed = self.files(kept[0]).select("file")
        for v in kept[1:]:
            needed = needed.unionByName(self.files(v).select("file"))
        needed = {r[0] for r in needed.distinct().toLocalIterator()}  # file names, as in a read
        folders = {self._folder(v) for v in kept}
        fs, base = _file_system(self.spark, f"{self.path}/data")
        known = set()
        for v in old:
            known |= {r[0] for r in self.files(v).select("file").toLocalIterator()}
        limit = (time.time() - grace_hours * 3600) * 1000
        dead, found = [], fs.listFiles(base, True)
        while found.hasNext():
            f = found.next()
            name = f.getPath().toString().rsplit("/data/", 1)[1]
            if name.startswith("w=") and name.endswith(".parquet") and name not in needed \
                    and (name in known or f.getModificationTime() < limit):
                dead.append(name)
        for v in old:  # first the versions, then what they name: no reader is left with half a version
            number = _file_system(self.spark, f"{self.path}/versions/{v:020d}")[1]
            folder = self._folder(v)
            fs.delete(number, False)
            if folder not in folders:
                fs.delete(_file_system(self.spark, f"{self.path}/files/{folder}")[1], True)
        for name in dead:
            fs.delete(_file_system(self.spark, f"{self.path}/data/{name}")[1], False)
        return dead
