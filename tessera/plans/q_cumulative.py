"""Registered queries: cumulative snapshot dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.expr import threshold_class
from tessera.operators import cumulative as cu
from tessera.plans import sql_views as V
from tessera.plans import standins as S
from tessera.plans.registry import register

PA = S.PLAYER_AS_OF
AA = S.ACTOR_AS_OF


def players(spark, sf_dir, as_of=None, with_history=True, emit_from=None):
    as_of = as_of or S.player_as_of(spark, sf_dir)
    ps = S.player_seasons(spark, sf_dir, last_year=as_of)  # the as-of bound reaches the scan
    return cu.cumulative_backfill(ps, "player_id", "season", ["gp", "pts"], as_of, carry=["scoring_class"],
                                  history="season_stats" if with_history else None, current="current_season",
                                  emit_from=emit_from)


def flat_players(snap):
    """Flatten a player snapshot for comparison: history summarised by aggregates."""
    h = F.col("season_stats")
    return snap.select(
        "player_id", "current_season",
        F.size(h).cast("bigint").alias("n_history"),
        h[0]["season"].alias("first_season"),
        F.col("last_period").alias("last_season"),
        F.round(F.aggregate(h, F.lit(0.0), lambda a, x: a + x["pts"]), 2).alias("hist_pts"),
        F.aggregate(h, F.lit(0).cast("bigint"), lambda a, x: a + x["gp"]).alias("hist_gp"),
        "scoring_class", "years_since_last", "is_active",
    )


_SNAP_COLS = ("player_id, current_season, n_history, first_season, last_season, hist_pts, hist_gp, "
              "scoring_class, years_since_last, is_active")


@register("cumulative_backfill", oracle="WITH " + V.PLAYER_SNAPSHOTS.replace("{as_of}", PA)
          + f" SELECT {_SNAP_COLS} FROM snap")
def q_cumulative_backfill(spark, sf_dir):
    return flat_players(players(spark, sf_dir))


@register("cumulative_step", oracle="WITH " + V.PLAYER_SNAPSHOTS.replace("{as_of}", PA)
          + f" SELECT {_SNAP_COLS} FROM snap WHERE current_season = {PA}")
def q_cumulative_step(spark, sf_dir):
    pa = S.player_as_of(spark, sf_dir)
    # Yesterday = snapshot at pa-1 (backfilled), today = facts of pa.
    y = players(spark, sf_dir, pa - 1, emit_from=pa - 1)  # only yesterday's snapshot is read
    ps = S.player_seasons(spark, sf_dir, first_year=pa, last_year=pa)  # today's facts: one year of orders
    t = cu.cumulative_step(y, ps, "player_id", "season", ["gp", "pts"], pa, carry=["scoring_class"],
                           history="season_stats", current="current_season")
    return flat_players(t)


@register("threshold_class", oracle="WITH " + V.PLAYER_SEASONS
          + " SELECT player_id, season, pts, scoring_class FROM ps")
def q_threshold_class(spark, sf_dir):
    o = S.player_seasons(spark, sf_dir)
    return o.select("player_id", "season", "pts",
                    threshold_class("pts", S.SCORING_THRESHOLDS, S.SCORING_ELSE).alias("scoring_class"))


@register("recency_state", oracle="WITH " + V.PLAYER_SNAPSHOTS.replace("{as_of}", PA) + """
 SELECT current_season, years_since_last, is_active, scoring_class, count(*) AS n_players
 FROM snap GROUP BY ALL""")
def q_recency_state(spark, sf_dir):
    return players(spark, sf_dir, with_history=False).groupBy("current_season", "years_since_last", "is_active",
                                                              "scoring_class") \
        .agg(F.count(F.lit(1)).alias("n_players"))


@register("history_improvement", oracle="WITH " + V.PLAYER_SEASONS + f""",
 lastf AS (SELECT player_id, arg_max(pts, season) AS last_value, arg_min(pts, season) AS first_value,
                  arg_max(scoring_class, season) AS cls
           FROM ps WHERE season <= {PA} GROUP BY 1)
 SELECT player_id, last_value, first_value,
        round(last_value / CASE WHEN first_value = 0 THEN 1 ELSE first_value END, 6) AS improvement
 FROM lastf WHERE cls = 'star'""")
def q_history_improvement(spark, sf_dir):
    pa = S.player_as_of(spark, sf_dir)
    r = cu.history_improvement(players(spark, sf_dir, emit_from=pa), "player_id", "season_stats", "pts",
                               "current_season", pa,
                               where=F.col("scoring_class") == "star")
    return r.withColumn("improvement", F.round("improvement", 6))


@register("history_unnest", oracle="WITH " + V.PLAYER_SEASONS + f"""
 SELECT player_id, CAST(row_number() OVER (PARTITION BY player_id ORDER BY season) AS INTEGER) AS pos,
        season, gp, pts
 FROM ps WHERE season <= {PA}""")
def q_history_unnest(spark, sf_dir):
    pa = S.player_as_of(spark, sf_dir)
    snap = players(spark, sf_dir, emit_from=pa)  # the as-of snapshot only
    return cu.history_unnest(snap, "player_id", "season_stats")


def actors(spark, sf_dir, as_of=None, emit_from=None, items=None):
    as_of = as_of or S.actor_as_of(spark, sf_dir)
    af = S.actor_films(spark, sf_dir, last_year=as_of)
    return cu.cumulative_collection(
        af, "actor_id", "year", ["film", "votes", "rating", "filmid"], "rating", as_of,
        S.QUALITY_THRESHOLDS, S.QUALITY_ELSE, carry=["actor"],
        current="current_year", avg_digits=9, emit_from=emit_from, items=items,
    )


_ACTOR_SQL = "WITH " + V.ACTOR_SNAPSHOTS.replace("{as_of}", AA)


@register("cumulative_collection", oracle=_ACTOR_SQL + """
 SELECT actor_id, current_year, n_films, avg_rating, quality_class, is_active FROM actors_c""")
def q_cumulative_collection(spark, sf_dir):
    a = actors(spark, sf_dir)
    return a.select("actor_id", "current_year", F.col("n_items").alias("n_films"),
                    F.col("avg_rating"), "quality_class", "is_active")


@register("cumulative_collection_items", oracle=_ACTOR_SQL + f"""
 SELECT actor_id, {AA} AS current_year, filmid, votes, rating FROM af WHERE year <= {AA}""")
def q_cumulative_collection_items(spark, sf_dir):
    aa = S.actor_as_of(spark, sf_dir)
    # the concatenated item array of the latest snapshot, one row per element
    a = actors(spark, sf_dir, emit_from=aa, items="films")
    return a.select("actor_id", "current_year", F.inline("films")).select("actor_id", "current_year", "filmid", "votes",
                                                                          "rating")


@register("latest_snapshot", oracle=_ACTOR_SQL + f"""
 SELECT actor_id, current_year, n_films, quality_class, is_active FROM actors_c WHERE current_year = {AA}""")
def q_latest_snapshot(spark, sf_dir):
    aa = S.actor_as_of(spark, sf_dir)
    a = cu.latest_snapshot(actors(spark, sf_dir, emit_from=aa), "actor_id", "current_year")
    return a.select("actor_id", "current_year", F.col("n_items").alias("n_films"),
                    "quality_class", "is_active")


@register("entity_metric", oracle="WITH " + V.PLAYER_SEASONS + """
 SELECT player_id, round(avg(pts), 6) AS avg_pts, count(*) AS seasons FROM ps GROUP BY 1""")
def q_entity_metric(spark, sf_dir):
    ps = S.player_seasons(spark, sf_dir)
    m = cu.entity_metric(ps, "player_id", "pts", "avg_pts", extra=[F.count(F.lit(1)).alias("seasons")])
    return m.withColumn("avg_pts", F.round("avg_pts", 6))
