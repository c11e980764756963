"""FX11 writers (upsert, partition overwrite, schema evolution) and streaming dedupe properties."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.sources import writers as wr
from tessera.streaming import dedup as sd


def test_fx11_upsert(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    s = spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int")
    once = wr.upsert(t, s, "k")
    assert rows(once) == [("a", 1), ("b", 9), ("c", 3)]
    twice = wr.upsert(spark.createDataFrame(once.collect(), once.schema), s, "k")
    assert rows(twice) == rows(once)
    with pytest.raises(wr.DuplicateKeyError):
        wr.upsert(t, spark.createDataFrame([("b", 1), ("b", 2)], "k string, v int"), "k")


def test_w2_partition_overwrite_idempotent_and_w1_partitions(spark):
    path = tempfile.mkdtemp(prefix="w2-", dir="/tmp") + "/t"
    df = spark.createDataFrame([("a", 1, "p1"), ("b", 2, "p2")], "k string, v int, p string")
    wr.overwrite_partitions(df, path, ["p"])
    wr.overwrite_partitions(df.where("p = 'p2'"), path, ["p"])
    wr.overwrite_partitions(df.where("p = 'p2'"), path, ["p"])
    assert rows(spark.read.parquet(path), "k", "v", "p") == [("a", 1, "p1"), ("b", 2, "p2")]
    # merge into p2 only: p1 untouched
    src = spark.createDataFrame([("b", 9, "p2"), ("c", 3, "p2")], "k string, v int, p string")
    wr.upsert_partitions(spark, path, src, ["k", "p"], ["p"])
    wr.upsert_partitions(spark, path, src, ["k", "p"], ["p"])
    assert rows(spark.read.parquet(path), "k", "v", "p") == [("a", 1, "p1"), ("b", 9, "p2"), ("c", 3, "p2")]


def test_w3_append_is_not_idempotent(spark):
    path = tempfile.mkdtemp(prefix="w3-", dir="/tmp") + "/t"
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    wr.append(df, path)
    wr.append(df, path)
    assert spark.read.parquet(path).count() == 2


def test_w4_schema_evolution(spark):
    path = tempfile.mkdtemp(prefix="w4-", dir="/tmp") + "/t"
    wr.overwrite_partitions(spark.createDataFrame([("a", "d1")], "k string, day string"), path, ["day"])
    new = wr.add_column(spark.createDataFrame([("b", "d2")], "k string, day string"), "score", 7, "int")
    new = new.unionByName(spark.createDataFrame([("c", "d2", None)], "k string, day string, score int"))
    wr.overwrite_partitions(wr.stamp_version(new, 1), path, ["day"])
    out = wr.read_evolved(spark, path, {"score": 0})
    assert rows(out, "k", "score") == [("a", 0), ("b", 7), ("c", None)]  # a stored NULL is no missing column


def test_w1_unreadable_target_raises_and_keeps_its_rows(spark):
    path = tempfile.mkdtemp(prefix="w1-", dir="/tmp") + "/t"
    df = spark.createDataFrame([("a", 1, "p1"), ("b", 2, "p1")], "k string, v int, p string")
    wr.overwrite_partitions(df, path, ["p"])
    df.select("k").write.parquet(path + "/stray")  # a folder that is no partition
    src = spark.createDataFrame([("c", 3, "p1")], "k string, v int, p string")
    with pytest.raises(Exception):
        wr.upsert_partitions(spark, path, src, ["k", "p"], ["p"])
    assert rows(spark.read.parquet(path + "/p=p1"), "k", "v") == [("a", 1), ("b", 2)]


def test_w1_null_keys_match_and_partitions_belong_to_the_key(spark):
    t = spark.createDataFrame([(None, 1), ("b", 2)], "k string, v int")
    s = spark.createDataFrame([(None, 9)], "k string, v int")
    assert rows(wr.upsert(t, s, "k")) == [(None, 9), ("b", 2)]
    path = tempfile.mkdtemp(prefix="w1-", dir="/tmp") + "/t"
    src = spark.createDataFrame([("a", 1, "p1"), (None, 2, "p1")], "k string, v int, p string")
    for _ in range(2):
        wr.upsert_partitions(spark, path, src, ["k", "p"], ["p"])
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        wr.upsert_partitions(spark, path, src, ["k"], ["p"])


def test_d5_stream_dedup_properties(spark):
    """Time-ordered small files: survivors are a subset, no key lost, no two survivors within W."""
    base = tempfile.mkdtemp(prefix="d5-", dir="/tmp")
    src = os.path.join(base, "in")
    t0 = dt.datetime(2024, 1, 1)
    # FX9 chain in time-ordered batches. The stream rule drops *at least* the duplicates within W:
    # a key's state is evicted only after the watermark passes it, so 200 may be dropped too;
    # by 300 the state of 0 is gone and the event is kept.
    minutes = [[0, 50], [100, 130], [200], [300]]
    eid = 0
    for i, batch in enumerate(minutes):
        data = []
        for m in batch:
            data += [(eid, "k", t0 + dt.timedelta(minutes=m)), (eid + 1, "j", t0 + dt.timedelta(minutes=m))]
            eid += 2
        spark.createDataFrame(data, "event_id long, user_id string, ts timestamp_ntz") \
            .coalesce(1).write.mode("overwrite").parquet(os.path.join(src, f"part{i}"))
    schema = "event_id long, user_id string, ts timestamp_ntz"
    stream = sd.read_event_stream(spark, src + "/*", schema, max_files_per_trigger=1)
    out = sd.stream_dedup(stream, ["user_id"], "ts", "60 minutes")
    sd.run_available_now(out, os.path.join(base, "out"), os.path.join(base, "ckpt"))
    got = spark.read.parquet(os.path.join(base, "out"))
    kept = {(r.user_id, r.ts.replace(tzinfo=None)) for r in got.collect()}
    all_rows = {(u, t0 + dt.timedelta(minutes=m)) for b in minutes for m in b for u in ("k", "j")}
    assert kept <= all_rows
    assert {u for u, _ in kept} == {"k", "j"}
    for u in ("k", "j"):
        ts = sorted(t for k, t in kept if k == u)
        assert all((b - a) > dt.timedelta(minutes=60) for a, b in zip(ts, ts[1:]))
        assert t0 in ts and t0 + dt.timedelta(minutes=300) in ts


def _arrive(spark, src, batches, schema="event_id long, user_id string, event_type string, ts timestamp_ntz"):
    for i, data in enumerate(batches):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(os.path.join(src, f"part{i}"))
    return sd.read_event_stream(spark, src + "/*", schema, max_files_per_trigger=1)


def _run(stream, writer, checkpoint):
    q = stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0], [1, 2, 0]])
def test_d6_microbatch_dedup_equals_the_batch_rule_in_any_order(spark, order):
    base = tempfile.mkdtemp(prefix="d6-", dir="/tmp")
    t0 = dt.datetime(2024, 1, 1)
    batches = [[(i, "k", "click", t0 + dt.timedelta(minutes=m)) for i, m in b]
               for b in ([(0, 0), (1, 50)], [(2, 100), (5, 1500)], [(3, 300), (4, 320)])]
    stream = _arrive(spark, os.path.join(base, "in"), [batches[i] for i in order])
    _run(stream, sd.microbatch_dedup_writer(os.path.join(base, "fact"), ["user_id", "event_type"], "ts", 60, ["event_id"]),
         os.path.join(base, "ckpt"))
    got = sorted(r.event_id for r in spark.read.parquet(os.path.join(base, "fact")).collect())
    assert got == [0, 3, 5]  # 50 and 100 follow another event within the hour, 320 as well


def test_d6_late_event_empties_a_stored_day(spark):
    base = tempfile.mkdtemp(prefix="d6-", dir="/tmp")
    t = dt.datetime(2024, 1, 2, 0, 10)
    batches = [[(0, "k", "click", t)], [(1, "k", "click", t - dt.timedelta(minutes=20))]]
    stream = _arrive(spark, os.path.join(base, "in"), batches)
    _run(stream, sd.microbatch_dedup_writer(os.path.join(base, "fact"), ["user_id"], "ts", 60, ["event_id"]),
         os.path.join(base, "ckpt"))
    assert [r.event_id for r in spark.read.parquet(os.path.join(base, "fact")).collect()] == [1]


def test_d6_replay_with_null_key_and_null_time(spark):
    base = tempfile.mkdtemp(prefix="d6-", dir="/tmp")
    t = dt.datetime(2024, 1, 2)
    schema = "event_id long, user_id string, ts timestamp"
    first = spark.createDataFrame([(0, None, t), (1, "k", None), (2, "k", t)], schema)
    second = spark.createDataFrame([(3, None, None), (4, None, t + dt.timedelta(minutes=5))], schema)
    write = sd.microbatch_dedup_writer(os.path.join(base, "fact"), ["user_id"], "ts", 60, ["event_id"])
    for batch, number in ((first, 0), (second, 1), (second, 1), (first, 0)):
        write(batch, number)
    assert sorted(r.event_id for r in spark.read.parquet(os.path.join(base, "fact")).collect()) == [0, 1, 2, 3]


def test_long_window_state_is_bounded(spark):
    """A day's window over thirty triggers of four hours: state rows are buckets, and state does not grow with the days."""
    base = tempfile.mkdtemp(prefix="d5day-", dir="/tmp")
    schema = "k string, ts timestamp, n long"
    start, buckets = dt.datetime(2024, 1, 1), 8
    rows_, sizes = [], []
    for t in range(30):
        batch = [(f"k{(i * 7 + t) % 61}" if i % 3 else "hot", start + dt.timedelta(hours=4 * t, minutes=(i * 37) % 240), t * 1000 + i)
                 for i in range(120)]
        if t == 7:
            batch.append(("hot", None, -1))
        rows_ += batch
        spark.createDataFrame(batch, schema).write.parquet(f"{base}/in/{t}")
        s = sd.long_window_dedup(sd.read_event_stream(spark, base + "/in/*", schema), ["k"], "ts", 24, buckets)
        q = (s.writeStream.format("parquet").option("path", base + "/out").option("checkpointLocation", base + "/ckpt")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        sizes.append(max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]))
    assert max(sizes) <= buckets  # a row a bucket, not a row a key
    kept = {}
    for r in spark.read.parquet(base + "/out").collect():
        kept.setdefault(r.k, []).append(r.ts)
    day = dt.timedelta(hours=24)
    assert kept["hot"].count(None) == 1
    for k in kept:
        times = sorted(t for t in kept[k] if t is not None)
        assert all(b - a > day for a, b in zip(times, times[1:]))
    for k, t, _ in rows_:
        if t is not None:  # each event was kept or is within a day of one that was
            assert any(abs(t - x) <= day for x in kept[k] if x is not None)


def test_stream_state_partitions_follow_the_input(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="d5parts-", dir="/tmp")
    spark.createDataFrame([(f"k{i % 5}", dt.datetime(2024, 1, 1, 0, i)) for i in range(20)], "k string, ts timestamp") \
        .write.parquet(base + "/in/0")
    table = spark.read.parquet(base + "/in/0")
    assert sd.state_partitions_for(table) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(sd, "STATE_BYTES", 64)
    assert sd.state_partitions_for(table) > spark.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.shuffle.partitions")
    s = sd.long_window_dedup(sd.read_event_stream(spark, base + "/in/*", table.schema), ["k"], "ts", 24, 8)
    sd.run_available_now(s, base + "/out", base + "/ckpt", state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with open(base + "/ckpt/offsets/0") as f:
        assert '"spark.sql.shuffle.partitions":"3"' in f.read()
    assert sorted(r.k for r in spark.read.parquet(base + "/out").collect()) == [f"k{i}" for i in range(5)]


def test_few_partitions_are_written_without_a_shuffle(spark):
    base = tempfile.mkdtemp(prefix="w2types-", dir="/tmp")
    df = spark.range(0, 300, 1, 3).select("id", (F.col("id") % 2).alias("type"))
    wr.overwrite_partitions(df, base + "/a", ["type"], rebalance=False)
    assert len(spark.read.parquet(base + "/a").inputFiles()) == 6  # each task its own file of each type
    assert rows(spark.read.parquet(base + "/a"), "id") == rows(df, "id")
