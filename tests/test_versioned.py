"""Versioned tables: keyed upsert without key partitions, atomic commits, expiry, files rewritten."""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.sources import versioned
from tessera.sources.writers import DuplicateKeyError


def table(spark, key="k", partition_by=()):
    return versioned.VersionedTable(spark, tempfile.mkdtemp(prefix="versions-", dir="/tmp") + "/t", key, partition_by)


def ordered(data):
    return sorted(data, key=lambda t: tuple(str(x) for x in t))


def names(t, version=None):
    return {r.file for r in t.files(version).collect()}


def test_upsert_of_an_unpartitioned_table(spark):
    t = table(spark)
    t.upsert(spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int"))
    s = spark.createDataFrame([("b", 9), ("c", 4), (None, 5)], "k string, v int")
    assert t.upsert(s) == 2
    want = [("a", 1), ("b", 9), ("c", 4), (None, 5)]
    assert rows(t.read()) == ordered(want)
    t.upsert(s)
    assert rows(t.read()) == ordered(want)
    assert rows(t.read(1)) == ordered([("a", 1), ("b", 2), (None, 3)])
    with pytest.raises(DuplicateKeyError):
        t.upsert(spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"))


def test_one_file_of_many_is_rewritten(spark):
    t = table(spark, "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        t.overwrite(spark.range(20_000).selectExpr("id", "id * 2 AS v"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    before = names(t)
    assert len(before) > 150
    t.upsert(spark.createDataFrame([(7777, -1)], "id long, v long"))
    assert len(before - names(t)) == 1
    assert t.read().where("id = 7777").first().v == -1 and t.read().count() == 20_000
    before = names(t)
    t.upsert(spark.createDataFrame([(50_000, 1)], "id long, v long"))  # a new key rewrites no file
    assert before < names(t) and t.read().count() == 20_001
    t.replace(spark.createDataFrame([(3,), (19_000,)], "id long"))  # a delete
    assert len(before - names(t)) == 2 and t.read().count() == 19_999


def test_a_row_changes_its_partition(spark):
    t = table(spark, "k", ["p"])
    t.overwrite(spark.createDataFrame([("a", 1, "p1"), ("b", 2, "p1"), ("c", 3, "p2"), ("d", 4, None)], "k string, v int, p string"))
    p2 = {f for f in names(t) if "p=p2" in f}
    t.upsert(spark.createDataFrame([("a", 9, "p3"), ("d", 5, "p1")], "k string, v int, p string"))
    assert rows(t.read(), "k", "v", "p") == [("a", 9, "p3"), ("b", 2, "p1"), ("c", 3, "p2"), ("d", 5, "p1")]
    assert p2 <= names(t)  # untouched
    t.replace(spark.createDataFrame([("p1",)], "p string"), on="p")
    assert rows(t.read(), "k") == [("a",), ("c",)]


def test_a_killed_write_leaves_the_old_version(spark, monkeypatch):
    t = table(spark)
    t.overwrite(spark.createDataFrame([("a", 1)], "k string, v int"))
    s = spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int")

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:  # the data files are there, the version is not
        m.setattr(versioned.VersionedTable, "_commit", die)
        with pytest.raises(KeyboardInterrupt):
            t.upsert(s)
    assert rows(t.read()) == [("a", 1)] and t.versions() == [1]
    assert t.upsert(s) == 2 and rows(t.read()) == [("a", 2), ("b", 3)]
    left = [n for n in t.expire(keep=2, grace_hours=24)]
    assert left == []  # a write may still be under way
    assert t.expire(keep=2, grace_hours=-1) and rows(t.read(1)) == [("a", 1)]


def test_of_two_writers_one_fails(spark, monkeypatch):
    t = table(spark)
    t.overwrite(spark.createDataFrame([("a", 1)], "k string, v int"))
    other = versioned.VersionedTable(spark, t.path, "k")
    write = versioned.VersionedTable._written

    def overtaken(self, df, name):
        monkeypatch.setattr(versioned.VersionedTable, "_written", write)
        other.upsert(spark.createDataFrame([("b", 2)], "k string, v int"))  # commits while we write
        return write(self, df, name)

    monkeypatch.setattr(versioned.VersionedTable, "_written", overtaken)
    with pytest.raises(versioned.ConcurrentWriteError):
        t.upsert(spark.createDataFrame([("c", 3)], "k string, v int"))
    assert rows(t.read()) == [("a", 1), ("b", 2)]
    t.upsert(spark.createDataFrame([("c", 3)], "k string, v int"))
    assert rows(t.read()) == [("a", 1), ("b", 2), ("c", 3)]


def test_expiry_keeps_what_live_versions_need(spark):
    t = table(spark)
    for i in range(5):
        t.upsert(spark.createDataFrame([("a", i), (f"k{i}", i)], "k string, v int"))
    want = rows(t.read())
    assert t.expire(keep=1) and t.versions() == [5]
    assert rows(t.read()) == want == sorted([("a", 4)] + [(f"k{i}", i) for i in range(5)])


def test_empty_tables(spark):
    t = table(spark)
    t.overwrite(spark.createDataFrame([("a", 1)], "k string, v int"))
    t.replace(spark.createDataFrame([("a",)], "k string"))
    assert t.read().count() == 0 and t.read().columns == ["k", "v"]
    assert t.replace(spark.createDataFrame([("x",)], "k string")) == t.versions()[-1]
    t.upsert(spark.createDataFrame([("b", 1)], "k string, v int"))
    assert rows(t.read()) == [("b", 1)]


def test_publish_only_what_holds(spark):
    t = table(spark)
    good = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    assert t.publish(good, {"positive": F.col("v") > 0}) == 1
    with pytest.raises(versioned.CheckFailedError) as e:
        t.publish(spark.createDataFrame([("a", 1), ("a", 2), ("b", -1), ("c", None)], "k string, v int"), {"positive": F.col("v") > 0})
    assert e.value.counts == {"duplicate_keys": 1, "positive": 2}
    assert t.versions() == [1] and rows(t.read()) == ordered([("a", 1), ("b", 2), (None, 3)])
    assert t.expire(keep=1, grace_hours=-1) == []  # nothing was left behind
    assert t.publish(good.where("k = 'a'")) == 2 and rows(t.read()) == [("a", 1)]
