"""Hand fixtures FX1-FX3 (FIXTURES.md section 2): cumulative snapshots and SCDs."""

from pyspark.sql import functions as F

from conftest import rows
from tessera.functions.expr import threshold_class
from tessera.operators import cumulative as cu
from tessera.operators import scd

TH = [(20, "star"), (15, "good"), (10, "average")]


def seasons(spark):
    data = [("Ann", 2000, 21.0), ("Ann", 2001, 18.0), ("Ann", 2003, 5.0), ("Bob", 2001, 0.0), ("Bob", 2002, 12.0),
            ("Cat", 2002, 30.0), ("Cat", 2003, 25.0), ("Dan", 2003, 11.0)]
    df = spark.createDataFrame(data, "name string, season int, pts double")
    return df.withColumn("scoring_class", threshold_class("pts", TH, "bad"))


def snapshots(spark, as_of=2003):
    return cu.cumulative_backfill(seasons(spark), "name", "season", ["pts"], as_of, carry=["scoring_class"],
                                  history="stats", current="current_season")


EXPECTED_FX1 = [
    ("Ann", 2000, [2000], "star", 0, True), ("Ann", 2001, [2000, 2001], "good", 0, True),
    ("Ann", 2002, [2000, 2001], "good", 1, False), ("Ann", 2003, [2000, 2001, 2003], "bad", 0, True),
    ("Bob", 2001, [2001], "bad", 0, True), ("Bob", 2002, [2001, 2002], "average", 0, True),
    ("Bob", 2003, [2001, 2002], "average", 1, False), ("Cat", 2002, [2002], "star", 0, True),
    ("Cat", 2003, [2002, 2003], "star", 0, True), ("Dan", 2003, [2003], "average", 0, True),
]


def _flat(df):
    return rows(df.select("name", "current_season", F.transform("stats", lambda s: s["season"]).alias("h"),
                          "scoring_class", "years_since_last", "is_active"))


def test_c2_backfill_fx1(spark):
    assert _flat(snapshots(spark)) == sorted(EXPECTED_FX1, key=lambda t: tuple(str(x) for x in t))


def test_c2_emit_from_keeps_whole_history(spark):
    latest = cu.cumulative_backfill(seasons(spark), "name", "season", ["pts"], 2003, carry=["scoring_class"],
                                    history="stats", current="current_season", emit_from=2003)
    assert _flat(latest) == [r for r in sorted(EXPECTED_FX1, key=lambda t: tuple(str(x) for x in t)) if r[1] == 2003]
    mid = cu.cumulative_backfill(seasons(spark), "name", "season", ["pts"], 2003, carry=["scoring_class"],
                                 history="stats", current="current_season", emit_from=2002)
    assert {r[1] for r in _flat(mid)} == {2002, 2003} and len(_flat(mid)) == 7


def test_c1_step_iterated_equals_backfill(spark):
    facts = seasons(spark)
    snap, parts = None, []
    for p in range(2000, 2004):
        snap = cu.cumulative_step(snap, facts, "name", "season", ["pts"], p, carry=["scoring_class"],
                                  history="stats", current="current_season")
        snap = spark.createDataFrame(snap.collect(), snap.schema)  # materialise the step
        parts.append(snap)
    it = parts[0]
    for p in parts[1:]:
        it = it.unionByName(p)
    assert _flat(it) == _flat(snapshots(spark))


S1_EXPECTED = [
    ("Ann", "star", True, 2000, 2000), ("Ann", "good", True, 2001, 2001), ("Ann", "good", False, 2002, 2002),
    ("Ann", "bad", True, 2003, 2003), ("Bob", "bad", True, 2001, 2001), ("Bob", "average", True, 2002, 2002),
    ("Bob", "average", False, 2003, 2003), ("Cat", "star", True, 2002, 2003), ("Dan", "average", True, 2003, 2003),
]
COLS = ("name", "scoring_class", "is_active", "start_period", "end_period")


def test_s1_backfill_fx1(spark):
    s1 = scd.scd2_backfill(snapshots(spark), "name", "current_season", ["scoring_class", "is_active"], 2003)
    assert rows(s1, *COLS) == sorted(S1_EXPECTED, key=lambda t: tuple(str(x) for x in t))
    assert {r.current_period for r in s1.collect()} == {2003}


def test_s2_incremental_equals_backfill(spark):
    snap = snapshots(spark)
    prev = scd.scd2_backfill(snap, "name", "current_season", ["scoring_class", "is_active"], 2002)
    inc = scd.scd2_incremental(prev, snap, "name", ["scoring_class", "is_active"], 2003, period="current_season")
    assert rows(inc, *COLS) == sorted(S1_EXPECTED, key=lambda t: tuple(str(x) for x in t))


def test_catch_up_two_periods_fx1(spark):
    snap = snapshots(spark)
    prev = scd.scd2_backfill(snap, "name", "current_season", ["scoring_class", "is_active"], 2001)
    caught = scd.scd2_catch_up(prev, snap, "name", ["scoring_class", "is_active"], 2002, 2003,
                               period="current_season")
    assert rows(caught, *COLS) == sorted(S1_EXPECTED, key=lambda t: tuple(str(x) for x in t))
    assert {r.current_period for r in caught.collect()} == {2003}


def test_s2_missing_entity_keeps_closed_row_and_new_entity_opens(spark):
    prev = spark.createDataFrame([("a", "x", 1, 2), ("b", "y", 1, 2), ("c", "z", 1, 1)],
                                 "k string, v string, start_period int, end_period int")
    snap = spark.createDataFrame([("a", "x", 3), ("d", "w", 3)], "k string, v string, current_period int")
    out = scd.scd2_incremental(prev, snap, "k", ["v"], 3)
    assert rows(out, "k", "v", "start_period", "end_period") == [
        ("a", "x", 1, 3),   # unchanged: extended
        ("b", "y", 1, 2),   # missing from the snapshot: keeps its closed interval (T5)
        ("c", "z", 1, 1),   # historical: untouched
        ("d", "w", 3, 3),   # new entity
    ]


def test_s4_new_entity_and_missing_entity(spark):
    cur = spark.createDataFrame([("a", "x", 1, 9999, True), ("b", "y", 1, 9999, True)],
                                "k string, v string, start_date int, end_date int, is_current boolean")
    snap = spark.createDataFrame([("a", "x", 2), ("c", "z", 2)], "k string, v string, current_period int")
    out = scd.scd2_merge_close(cur, snap, "k", ["v"], 2)
    assert rows(out) == [("a", "x", 1, 9999, True), ("b", "y", 1, 9999, True), ("c", "z", 2, 9999, True)]


def test_c5_improvement_fx1(spark):
    snap = snapshots(spark)
    star = cu.history_improvement(snap, "name", "stats", "pts", "current_season", 2003,
                                  where=F.col("scoring_class") == "star")
    assert rows(star, "name", "improvement") == [("Cat", 25 / 30)]
    avg = cu.history_improvement(snap, "name", "stats", "pts", "current_season", 2003,
                                 where=F.col("scoring_class") == "average")
    assert rows(avg, "name", "improvement") == [("Bob", 12.0), ("Dan", 1.0)]
    rep = cu.history_improvement(snap, "name", "stats", "pts", "current_season", 2003, report=True)
    assert [r.name for r in rep.collect()] == ["Bob", "Dan", "Cat", "Ann"]  # 12, 1, 25/30, 5/21


def test_c6_unnest_fx1(spark):
    snap = snapshots(spark).where("current_season = 2003 and name = 'Ann'")
    assert rows(cu.history_unnest(snap, "name", "stats"), "pos", "season", "pts") == [
        (1, 2000, 21.0), (2, 2001, 18.0), (3, 2003, 5.0)]


def test_fx2_null_is_a_change(spark):
    df = spark.createDataFrame([("K", 1, "A"), ("K", 2, None), ("K", 3, "A")], "k string, p int, c string")
    s1 = scd.scd2_backfill(df, "k", "p", ["c"], 3)
    assert rows(s1, "c", "start_period", "end_period") == [("A", 1, 1), ("A", 3, 3), (None, 2, 2)]


def films(spark):
    data = [("A1", 2000, "f1", 8.5), ("A1", 2000, "f2", 7.5), ("A1", 2002, "f3", 5.0)]
    return spark.createDataFrame(data, "actor_id string, year int, film string, rating double")


def actors(spark):
    return cu.cumulative_collection(films(spark), "actor_id", "year", ["film", "rating"], "rating", 2002,
                                    [(8, "star"), (7, "good"), (6, "average")], "bad", items="films",
                                    current="current_year")


def test_c7_collection_fx3(spark):
    a = actors(spark).select("current_year", F.transform("films", lambda f: f["film"]).alias("f"), "n_items",
                             "avg_rating", "quality_class", "is_active")
    assert rows(a) == [(2000, ["f1", "f2"], 2, 8.0, "good", True), (2001, ["f1", "f2"], 2, 8.0, "good", False),
                       (2002, ["f1", "f2", "f3"], 3, 7.0, "average", True)]
    lean = cu.cumulative_collection(films(spark), "actor_id", "year", ["film", "rating"], "rating", 2002,
                                    [(8, "star"), (7, "good"), (6, "average")], "bad", current="current_year")
    assert "films" not in lean.columns
    assert rows(lean, "current_year", "n_items", "quality_class") == [(2000, 2, "good"), (2001, 2, "good"),
                                                                      (2002, 3, "average")]


def test_c8_latest_fx3(spark):
    latest = cu.latest_snapshot(actors(spark), "actor_id", "current_year")
    assert rows(latest, "actor_id", "current_year", "quality_class") == [("A1", 2002, "average")]


def test_s3_open_interval_fx3(spark):
    s3 = scd.scd2_open_interval(actors(spark), "actor_id", "current_year", ["quality_class", "is_active"])
    assert rows(s3, "start_date", "end_date", "is_current") == [(2000, 2000, False), (2001, 2001, False),
                                                                 (2002, 9999, True)]


def test_s4_merge_close_fx3_and_rerun(spark):
    cur = spark.createDataFrame([("A1", "good", False, 2001, 9999, True)],
                                "actor_id string, quality_class string, is_active boolean, start_date int, "
                                "end_date int, is_current boolean")
    snap = actors(spark)
    once = scd.scd2_merge_close(cur, snap, "actor_id", ["quality_class", "is_active"], 2002, period="current_year")
    expected = [("A1", "average", True, 2002, 9999, True), ("A1", "good", False, 2001, 2001, False)]
    assert rows(once) == sorted(expected, key=lambda t: tuple(str(x) for x in t))
    once = spark.createDataFrame(once.collect(), once.schema)
    twice = scd.scd2_merge_close(once, snap, "actor_id", ["quality_class", "is_active"], 2002, period="current_year")
    assert rows(twice) == rows(once)


def test_s5_full_reload_matches_s4(spark):
    full = scd.scd2_full_reload(actors(spark), "actor_id", "current_year", ["quality_class", "is_active"], 2002)
    assert rows(full, "quality_class", "is_active", "start_date", "end_date", "is_current") == [
        ("average", True, 2002, 9999, True), ("good", False, 2001, 2001, False), ("good", True, 2000, 2000, False)]


def test_cumulative_backfill_with_date_periods(spark):
    import datetime as dt
    D = dt.date
    facts = spark.createDataFrame([("u", D(2024, 1, 1), 1.0), ("u", D(2024, 1, 3), 2.0)], "k string, day date, v double")
    snap = cu.cumulative_backfill(facts, "k", "day", ["v"], "2024-01-04", current="as_of_day")
    got = rows(snap.select("as_of_day", F.size("history").alias("n"), "years_since_last", "is_active"))
    assert got == [(D(2024, 1, 1), 1, 0, True), (D(2024, 1, 2), 1, 1, False), (D(2024, 1, 3), 2, 0, True),
                   (D(2024, 1, 4), 2, 1, False)]


def test_scd2_with_date_periods(spark):
    import datetime as dt
    D = dt.date
    snap = spark.createDataFrame([("k", D(2024, 1, 1), "a"), ("k", D(2024, 1, 2), "a"), ("k", D(2024, 1, 3), "b")],
                                 "k string, day date, v string")
    full = scd.scd2_full_reload(snap, "k", "day", ["v"], "2024-01-03", open_end="9999-12-31")
    assert rows(full, "v", "start_date", "end_date", "is_current") == [
        ("a", D(2024, 1, 1), D(2024, 1, 2), False), ("b", D(2024, 1, 3), D(9999, 12, 31), True)]
    s3 = scd.scd2_open_interval(snap, "k", "day", ["v"], open_end="9999-12-31")
    assert rows(s3, "start_date", "end_date") == [(D(2024, 1, 1), D(2024, 1, 1)), (D(2024, 1, 2), D(2024, 1, 2)),
                                                  (D(2024, 1, 3), D(9999, 12, 31))]
    before = scd.scd2_full_reload(snap.where("day <= '2024-01-02'"), "k", "day", ["v"], "2024-01-02",
                                  open_end="9999-12-31")
    merged = scd.scd2_merge_close(before, snap, "k", ["v"], "2024-01-03", period="day", open_end="9999-12-31")
    assert rows(merged, "v", "start_date", "end_date", "is_current") == rows(full, "v", "start_date", "end_date",
                                                                              "is_current")


def test_scd_types_0_1_3(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("k", 3, "b"), ("k", 4, "c")], "k string, p int, v string")
    assert rows(scd.scd_type0(df, "k", ["v"], "p")) == [("k", "a", 3)]
    assert rows(scd.scd_type1(df, "k", ["v"], "p")) == [("k", "c", 4)]
    assert rows(scd.scd_type3(df, "k", "v", "p")) == [("k", "c", "b", 4)]


def test_s9_as_of_join(spark):
    dim = spark.createDataFrame([("k", "a", 1, 2), ("k", "b", 3, 9999)], "k string, v string, s int, e int")
    fact = spark.createDataFrame([("k", 1), ("k", 2), ("k", 5), ("z", 1)], "fk string, t int")
    out = scd.scd2_as_of(fact, "fk", "t", dim, "k", "s", "e", ["v"])
    assert rows(out) == [("k", 1, "a"), ("k", 2, "a"), ("k", 5, "b"), ("z", 1, None)]
