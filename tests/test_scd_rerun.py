"""Re-running an SCD-2 increment or catch-up equals running it once."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import scd


def _snapshots(spark, values):
    data = [(k, p, v) for k, series in enumerate(values) for p, v in enumerate(series, 1995) if v is not None]
    return spark.createDataFrame(data, "id long, p int, v string")


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "b"]), min_size=4, max_size=4), min_size=1, max_size=4))
def test_applying_a_period_twice_equals_once(spark, values):
    snaps = _snapshots(spark, values)
    cols = ["id", "v", "start_period", "end_period", "current_period"]
    full = scd.scd2_backfill(snaps, "id", "p", ["v"], 1998).select(*cols)
    before = scd.scd2_backfill(snaps, "id", "p", ["v"], 1997)
    once = scd.scd2_incremental(before, snaps, "id", ["v"], 1998, period="p").select(*cols)
    twice = scd.scd2_incremental(once, snaps, "id", ["v"], 1998, period="p").select(*cols)
    assert rows(once) == rows(twice) == rows(full)
    again = scd.scd2_catch_up(full, snaps, "id", ["v"], 1996, 1998, period="p").select(*cols)
    assert rows(again) == rows(full)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "b"]), min_size=5, max_size=5), min_size=1, max_size=4),
       st.integers(1996, 1999))
def test_merge_re_run_late_and_out_of_order(spark, values, late):
    """Applying an earlier period again, then the later ones, equals applying each once; so does a period applied twice."""
    snaps = _snapshots(spark, values).cache()

    def merged(table, at):
        out = scd.scd2_merge_close(table, snaps, "id", ["v"], at, period="p")
        return spark.createDataFrame(out.collect(), out.schema)

    def full(at):
        return scd.scd2_full_reload(snaps.where(F.col("p") <= at), "id", "p", ["v"], at).select(*cols)

    cols = ["id", "v", "start_date", "end_date", "is_current"]
    table = full(1995)
    for at in range(1996, 2000):
        table = merged(table, at)
    assert rows(table, *cols) == rows(full(1999))
    table = merged(table, late)  # a late re-run: no two intervals of a key overlap
    assert rows(table, *cols) == rows(full(late))
    for at in range(late, 2000):
        table = merged(table, at)
    assert rows(table, *cols) == rows(full(1999))


def test_as_of_scan_equals_the_join(spark):
    facts = [(k, p, i) for i, (k, p) in enumerate((k, p) for k in (1, 2, 3, None) for p in range(1, 40, 3))]
    intervals = [(1, s, s + 1, f"v{s}") for s in range(2, 36, 4)] + [(2, 1, 99, "all"), (None, 1, 99, "none"), (4, 1, 99, "other")]
    f = spark.createDataFrame(facts, "k long, p int, fact int")
    d = spark.createDataFrame(intervals, "id long, s int, e int, v string")
    want = rows(scd.scd2_as_of(f, "k", "p", d, "id", "s", "e", ["v"]))
    for n in (1, 3, 16):
        assert rows(scd.scd2_as_of_scan(f, "k", "p", d, "id", "s", "e", ["v"], segments=n)) == want
    assert scd.scd2_as_of_scan(f.limit(0), "k", "p", d, "id", "s", "e", ["v"]).count() == 0
    assert {r.v for r in scd.scd2_as_of_scan(f, "k", "p", d.limit(0), "id", "s", "e", ["v"]).collect()} == {None}


def test_as_of_scan_spreads_a_long_history(spark):
    """One key with 100,000 intervals and as many facts: no segment holds more than its share."""
    n = 100_000
    d = spark.range(n).selectExpr("1L AS id", "id * 2 AS s", "id * 2 + 1 AS e", "id AS v")
    f = spark.range(n).selectExpr("1L AS k", "id * 2 + id % 2 AS p")
    out = scd.scd2_as_of_scan(f, "k", "p", d, "id", "s", "e", ["v"], segments=8)
    assert out.where("v = p div 2").count() == n
    cut = f.selectExpr("k", "p").unionByName(d.selectExpr("id AS k", "s AS p")).repartitionByRange(8, "k", "p")
    sizes = [r[1] for r in cut.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * 2 * n / 8
