"""Hand fixtures FX4 (graph), FX5 (fact build), FX9 (dedupe) and quality checks."""

import json
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.functions.expr import clock_to_minutes, text_flag
from tessera.operators import facts as fx
from tessera.operators import graph as gr
from tessera.operators import quality as qa


def details(spark):
    data = [("g1", "p1", "X", 10.0), ("g1", "p1", "X", 10.0), ("g1", "p2", "X", 5.0), ("g1", "p3", "Y", 7.0),
            ("g2", "p1", "X", 3.0), ("g2", "p2", "Y", 4.0), ("g2", "p4", "Y", None)]
    df = spark.createDataFrame(data, "game_id string, player_id string, team_id string, pts double")
    return df.select("game_id", "player_id", F.col("player_id").alias("player_name"), "team_id",
                     F.col("team_id").alias("team_abbreviation"), "pts", F.lit("F").alias("start_position"))


EXPECTED_PAIRS = [("p2", "p1", "plays_against", 1, 4.0, 3.0), ("p2", "p1", "shares_team", 1, 5.0, 10.0),
                  ("p3", "p1", "plays_against", 1, 7.0, 10.0), ("p3", "p2", "plays_against", 1, 7.0, 5.0),
                  ("p4", "p1", "plays_against", 1, None, 3.0), ("p4", "p2", "shares_team", 1, None, 4.0)]


def _pairs(e):
    out = []
    for r in e.collect():
        p = json.loads(r.properties)
        out.append((r.subject_identifier, r.object_identifier, r.edge_type, p["num_games"], p["subject_points"],
                    p["object_points"]))
    return sorted(out, key=lambda t: tuple(str(x) for x in t))


@pytest.mark.parametrize("block_rows", [2048, 1])
def test_g6_cooccurrence_fx4(spark, block_rows):
    # block_rows=1 splits every game into one block per member: same answer.
    e = gr.edges_cooccurrence(details(spark), block_rows=block_rows)
    assert _pairs(e) == sorted(EXPECTED_PAIRS, key=lambda t: tuple(str(x) for x in t))


def test_g2_vertices_dedup_vs_raw(spark):
    v = {r.identifier: json.loads(r.properties) for r in gr.vertices_aggregate(details(spark)).collect()}
    assert (v["p1"]["number_of_games"], v["p1"]["total_points"], v["p1"]["teams"]) == (2, 13.0, ["X"])
    raw = {r.identifier: json.loads(r.properties) for r in gr.vertices_aggregate(details(spark), dedup=False).collect()}
    assert (raw["p1"]["number_of_games"], raw["p1"]["total_points"]) == (3, 23.0)
    assert "player_name" in v["p4"] and v["p4"]["total_points"] is None  # NULL kept in JSON


def test_g7_max_property_fx4(spark):
    d = details(spark)
    out = gr.graph_max_property(gr.vertices_aggregate(d), gr.edges_bipartite(d), "player_name", "pts")
    assert rows(out) == [("p1", 10.0), ("p2", 5.0), ("p3", 7.0), ("p4", None)]
    ordered = [r.player_name for r in out.orderBy(F.col("max_pts").desc_nulls_first()).collect()]
    assert ordered == ["p4", "p1", "p3", "p2"]


def test_g8_g9_report_and_degree(spark):
    d = details(spark)
    rep = gr.graph_edge_report(gr.vertices_aggregate(d), gr.edges_cooccurrence(d))
    assert {(r.player_name, r.object_identifier, r.edge_type): r.avg_pts_per_game for r in rep.collect()}[
        ("p2", "p1", "shares_team")] == pytest.approx(9.0 / 2)
    deg = {r.vertex: (r.degree, r.n_neighbours) for r in gr.vertex_degree(gr.edges_cooccurrence(d)).collect()}
    assert deg["p1"] == (4, 3) and deg["p4"] == (2, 2)


def test_g3_g4_team_vertices(spark):
    t = spark.createDataFrame([(1, "A", "n", "c", 1900)] * 3 + [(2, "B", "m", "d", 1901)] * 3,
                              "team_id int, abbreviation string, nickname string, city string, yearfounded int")
    v = gr.vertices_dedup(t)
    assert v.count() == 2
    assert rows(gr.vertex_type_counts(gr.vertices_union(v, v.withColumn("type", F.lit("x"))))) == [("team", 2), ("x", 2)]


def test_fx5_minutes_and_flags(spark):
    df = spark.createDataFrame([("34:30", "DNP - Coach"), ("12", None), (None, "NWT - Personal"), ("x", None)],
                               "min string, comment string")
    out = df.select("min", clock_to_minutes("min").alias("m"), text_flag("comment", "DNP").alias("dnp"),
                    text_flag("comment", "DND").alias("dnd"), text_flag("comment", "NWT").alias("nwt"))
    got = {r["min"]: (r.m, r.dnp, r.dnd, r.nwt) for r in out.collect()}
    assert got["34:30"] == (34.5, True, False, False)
    assert got["12"] == (12.0, False, False, False)
    assert got[None] == (None, False, False, True)
    assert got["x"] == (None, False, False, False)


def test_fx5_conditional_rate(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("a", False), ("a", False), (None, True)],
                               "name string, nwt boolean")
    got = {r.name: r.flag_rate for r in fx.conditional_rate(df, "name", "nwt").collect()}
    assert got == {"a": 0.25, None: None}


def test_fx9_batch_dedupe_and_audit(spark):
    ev = spark.createDataFrame([("k", 0, 1), ("k", 50, 2), ("k", 100, 3), ("k", 300, 4)], "k string, m int, id int")
    ev = ev.select("k", "id", F.timestamp_seconds(F.col("m") * 60).alias("ts"))
    kept = fx.dedup_within_window(ev, "k", "ts", 60, ["id"], bucket_seconds=3600)
    assert rows(kept, "id") == [(1,), (4,)]
    # tiny buckets: previous events come from earlier buckets -- same answer
    assert rows(fx.dedup_within_window(ev, "k", "ts", 60, ["id"], bucket_seconds=60), "id") == [(1,), (4,)]
    prof = fx.dedup_window_profile(ev, "k", "ts", ["id"])
    assert dict(rows(prof)) == {"<=60 min": 2, "<=1440 min": 1}


def test_d1_d2_dedup_ties(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a"), ("j", 2, "z")], "k string, o int, v string")
    assert rows(fx.duplicate_audit(df, ["k"])) == [("k", 2)]
    assert rows(fx.dedup_first(df, ["k"], ["o"])) == [("j", 2, "z"), ("k", 1, "a")]


def test_sampling_variants(spark):
    df = spark.range(2000).withColumn("g", (F.col("id") % 2).cast("string"))
    whole = fx.sample_fact(df, "id", 10, 3, method="modulo")
    assert whole.count() == 600
    h = fx.sample_fact(df, "id", 10, 3)
    assert 450 < h.count() < 750 and h.count() == fx.sample_fact(df, "id", 10, 3).count()  # deterministic
    b = fx.sample_rows(df, 0.3)
    assert 450 < b.count() < 750
    s = fx.stratified_sample(df, "g", {"0": 0.5, "1": 0.0})
    assert set(r.g for r in s.collect()) == {"0"}


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (2, None, "z")], "id int, c string, e string")
    kc = qa.key_check(df, ["id"]).collect()[0]
    assert (kc.n_rows, kc.n_null_key_rows, kc.n_duplicate_keys, kc.n_extra_rows, kc.is_valid) == (3, 0, 1, 1, False)
    prof = {r.column_name: r.cardinality for r in qa.cardinality_profile(df, ["id", "c", "e"]).collect()}
    assert prof == {"id": "low", "c": "low", "e": "unique"}
    dc = {r.e: r.in_domain for r in qa.domain_check(df, "e", ["x", "y"]).collect()}
    assert dc == {"x": True, "y": True, "z": False}
    ok, bad = qa.domain_quarantine(df, "e", ["x", "y"])
    assert ok.count() == 2 and bad.count() == 1
    add = qa.additivity_check(df, "c", "id").collect()[0]
    assert (add.sum_of_slices, add.overall, add.is_additive) == (3, 2, False)


def test_fact_kinds(spark):
    ev = spark.createDataFrame(
        [(1, "2024-01-01 10:00:00", "signup", 1.0), (1, "2024-01-01 12:00:00", "view", 2.0),
         (1, "2024-01-03 09:00:00", "purchase", 5.0), (2, "2024-01-02 08:00:00", "signup", 7.0)],
        "u int, ts string, stage string, v double").withColumn("ts", F.to_timestamp("ts"))
    snap = fx.snapshot_fact(ev, "u", "ts", "v", "2024-01-04")
    assert [(str(r.snapshot_date), r.v) for r in snap.where("u = 1").orderBy("snapshot_date").collect()] == [
        ("2024-01-01", 2.0), ("2024-01-02", 2.0), ("2024-01-03", 5.0), ("2024-01-04", 5.0)]
    acc = fx.accumulating_snapshot(ev, "u", "stage", "ts", ["signup", "view", "click", "purchase"])
    r1 = acc.where("u = 1").collect()[0]
    assert r1.click_at is None and str(r1.purchase_at) == "2024-01-03 09:00:00"
    assert fx.factless_fact(ev, "u", "ts").count() == 3


@pytest.mark.parametrize("game_rows", [100_000, 2])
def test_f1_wide_rows_are_shuffled_once(spark, game_rows):
    # g1 has a repeated key, g3 no header, the last row no game; game_rows=2 makes g1 a large game: same answer
    data = [("g1", "X", "p1", "F", None, "10:30", 4), ("g1", "X", "p1", "F", None, "10:30", 3), ("g1", "Y", "p1", "F", None, "x", 5),
            ("g2", "X", "p2", None, "NWT - Personal", None, 6), ("g3", "X", "p2", "F", None, "1:00", 7),
            (None, "X", "p2", "F", None, "1:00", 8)]
    d = spark.createDataFrame(data, "game_id string, team_id string, player_id string, start_position string, comment string, "
                                    "min string, pts long")
    g = spark.createDataFrame([("g1", "2024-01-01", 2024, "X"), ("g2", "2024-01-02", 2024, "Y")],
                              "game_id string, game_date_est string, season int, home_team_id string")
    n = spark.createDataFrame([("p1", "one")], "player_id string, player_name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        f = fx.fact_build(d, g, names=F.broadcast(n), game_rows=game_rows)
        assert rows(f, "dim_game_id", "dim_team_id", "dim_player_name", "m_pts", "m_minutes", "dim_is_playing_at_home") == [
            ("g1", "X", "one", 3, 10.5, True), ("g1", "Y", "one", 5, None, False), ("g2", "X", None, 6, None, False)]
        if game_rows > 2:
            # the details by game, and the header by game
            assert f._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_g6_details_are_shuffled_once_for_dedupe_and_pairs(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        e = gr.edges_cooccurrence(details(spark))
        p = e._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the details by game, the pairs by their key; no join of the rows with themselves
    assert p.count("Exchange hashpartitioning") == 2 and "Join" not in p


@pytest.mark.parametrize("block_rows", [2048, 2, 1])
def test_g6_repeated_rows_and_nulls(spark, block_rows):
    d = details(spark)
    odd = spark.createDataFrame([(None, "p1", "X", 1.0), (None, "p2", "X", 1.0), ("g1", None, "X", 1.0), ("g2", "p5", None, 2.0)],
                                "game_id string, player_id string, team_id string, pts double")
    d = d.unionByName(odd.select("game_id", "player_id", F.col("player_id").alias("player_name"), "team_id",
                                 F.col("team_id").alias("team_abbreviation"), "pts", F.lit("F").alias("start_position")))
    want = EXPECTED_PAIRS + [("p5", p, "plays_against", 1, 2.0, x) for p, x in (("p1", 3.0), ("p2", 4.0), ("p4", None))]
    assert _pairs(gr.edges_cooccurrence(d, block_rows=block_rows)) == sorted(want, key=lambda t: tuple(str(x) for x in t))


def test_g9_degree_parts_grow_with_the_input(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="degree-", dir="/tmp") + "/e"
    e = [("1", "2", "a"), ("1", "2", "b"), ("2", "1", "a"), ("1", "3", "a"), ("4", None, "a")]
    spark.createDataFrame(e, "s string, o string, edge_type string").select(
        F.col("s").alias("subject_identifier"), F.lit("player").alias("subject_type"), F.col("o").alias("object_identifier"),
        F.lit("player").alias("object_type"), "edge_type").write.parquet(path)
    monkeypatch.setattr(gr, "PART_BYTES", 16)
    deg = gr.vertex_degree(spark.read.parquet(path))
    parts = re.findall(r"Exchange hashpartitioning\(vertex#\d+, neighbour#\d+, (\d+)\)", deg._jdf.queryExecution().executedPlan().toString())
    assert parts and int(parts[0]) > 4  # the session's shuffle partitions
    assert rows(deg, "vertex", "degree", "n_neighbours") == [("1", 4, 2), ("2", 3, 1), ("3", 1, 1), ("4", 1, 0), (None, 1, 1)]


def test_g8_report_joins_parsed_numbers(spark):
    d = details(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rep = gr.graph_edge_report(gr.vertices_aggregate(d), gr.edges_cooccurrence(d))
        p = rep._jdf.queryExecution().executedPlan().toString()
        got = rows(rep, "player_name", "object_identifier", "edge_type", "total_points", "total_games")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the edges' JSON text is not read above the join
    assert "json" not in p.split("SortMergeJoin", 1)[0]
    assert got == sorted([(s, o, t, x, n) for s, o, t, n, x, _ in EXPECTED_PAIRS], key=lambda t: tuple(str(x) for x in t))
