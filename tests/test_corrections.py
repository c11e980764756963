"""Late corrections equal a full rebuild and leave other keys' files alone."""

import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from tessera.operators import corrections as co
from tessera.operators import cumulative as cu
from tessera.operators import scd
from tessera.sources.versioned import VersionedTable


def facts(spark, values):
    data = [(k, p, v) for k, series in enumerate(values) for p, v in enumerate(series, 1995) if v is not None]
    return spark.createDataFrame(data, "id long, p int, v string")


def snapshots(f):
    return cu.cumulative_backfill(f, "id", "p", ["v"], 1998, carry=["v"], history="h", current="c")


def intervals(s):
    return scd.scd2_backfill(s, "id", "c", ["v", "is_active"], 1998)


value = st.sampled_from(["a", "b", None])
series = st.lists(value, min_size=4, max_size=4)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(series, series), min_size=2, max_size=4))
def test_correction_equals_rebuild(spark, cases):
    """Facts added, changed and removed."""
    old, new = [c[0] for c in cases], [c[1] for c in cases]
    changed = [(k, p) for k, (a, b) in enumerate(cases) for p, (x, y) in enumerate(zip(a, b), 1995) if x != y]
    corrections = spark.createDataFrame(changed, "id long, p int")
    path = tempfile.mkdtemp(prefix="corrections-", dir="/tmp")
    table = VersionedTable(spark, path + "/snapshots", ["id", "c"], ["c"])
    before, after = snapshots(facts(spark, old)), snapshots(facts(spark, new))
    if before.count():
        table.overwrite(before)
        co.correct_snapshots(table, facts(spark, new), corrections, "id", "p", ["v"], 1998, ["v"], "h", "c")
        cols = ["id", "c", "v", "last_period", "years_since_last", "is_active", "h"]
        assert rows(table.read(), *cols) == rows(after, *cols)
        table = VersionedTable(spark, path + "/intervals", ["id", "start_period"])
        table.overwrite(intervals(before))
        co.correct_intervals(table, after, corrections, "id", "c", "p", ["v", "is_active"], 1998)
        cols = ["id", "v", "is_active", "start_period", "end_period"]
        assert rows(table.read(), *cols) == rows(intervals(after), *cols)


def test_other_files_stay(spark):
    values = [["a", "b", "a", "b"] for _ in range(400)]
    table = VersionedTable(spark, tempfile.mkdtemp(prefix="corrections-", dir="/tmp") + "/t", ["id", "c"], ["c"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        table.overwrite(snapshots(facts(spark, values)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    before = {r.file for r in table.files().collect()}
    values[7][2] = "c"
    co.correct_snapshots(table, facts(spark, values), spark.createDataFrame([(7, 1997)], "id long, p int"), "id", "p", ["v"],
                         1998, ["v"], "h", "c")
    gone = before - {r.file for r in table.files().collect()}
    assert len(before) >= 16 and 1 <= len(gone) <= 2 and all("c=1997" in f or "c=1998" in f for f in gone)
    assert rows(table.read(), "id", "c", "v") == rows(snapshots(facts(spark, values)), "id", "c", "v")
    version = table.versions()[-1]
    none = spark.createDataFrame([], "id long, p int")
    assert co.correct_snapshots(table, facts(spark, values), none, "id", "p", ["v"], 1998, ["v"], "h", "c") == version
