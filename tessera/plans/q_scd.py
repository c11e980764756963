"""Registered queries: slowly changing dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import scd
from tessera.plans import sql_views as V
from tessera.plans import standins as S
from tessera.plans.q_cumulative import actors, players
from tessera.plans.registry import register
from tessera.sources import writers as wr
from tessera.sources.tables import read_table

PA = S.PLAYER_AS_OF
AA = S.ACTOR_AS_OF
TRACKED = ["scoring_class", "is_active"]
_SCD_COLS = "player_id, scoring_class, is_active, start_period, end_period, current_period"


def players_scd(spark, sf_dir, as_of=None):
    as_of = as_of or S.player_as_of(spark, sf_dir)
    snaps = players(spark, sf_dir, as_of, with_history=False)  # the SCD reads state columns only
    return scd.scd2_backfill(snaps, "player_id", "current_season", TRACKED, as_of)


@register("scd2_backfill", oracle="WITH " + V.PLAYER_SCD.replace("{as_of}", PA) + f" SELECT {_SCD_COLS} FROM scd")
def q_scd2_backfill(spark, sf_dir):
    return players_scd(spark, sf_dir)


@register("scd2_incremental", oracle="WITH " + V.PLAYER_SCD.replace("{as_of}", PA) + f" SELECT {_SCD_COLS} FROM scd")
def q_scd2_incremental(spark, sf_dir):
    pa = S.player_as_of(spark, sf_dir)
    prev = players_scd(spark, sf_dir, pa - 1)
    snap = players(spark, sf_dir, pa, with_history=False)
    return scd.scd2_incremental(prev, snap, "player_id", TRACKED, pa, period="current_season") \
        .select(*_SCD_COLS.split(", "))


@register("scd2_incremental_load",
          oracle="WITH " + V.PLAYER_SCD.replace("{as_of}", PA) + f" SELECT {_SCD_COLS} FROM scd")
def q_scd2_incremental_load(spark, sf_dir):
    """The stored form: write the SCD table as of the period before, then apply the period from the stored table, twice."""
    pa = S.player_as_of(spark, sf_dir)
    table = wr.stage(players_scd(spark, sf_dir, pa - 1), "scd")
    snap = wr.stage(players(spark, sf_dir, pa, with_history=False, emit_from=pa), "snapshot")
    for _ in range(2):
        table = wr.stage(scd.scd2_incremental(table, snap, "player_id", TRACKED, pa, period="current_season"), "scd")
    return table.select(*_SCD_COLS.split(", "))


@register("scd2_catch_up", oracle="WITH " + V.PLAYER_SCD.replace("{as_of}", PA) + f" SELECT {_SCD_COLS} FROM scd")
def q_scd2_catch_up(spark, sf_dir):
    pa = S.player_as_of(spark, sf_dir)
    # three missed periods applied in one pass to the SCD as of pa-3
    prev = players_scd(spark, sf_dir, pa - 3)
    snap = players(spark, sf_dir, pa, with_history=False, emit_from=pa - 2)
    return scd.scd2_catch_up(prev, snap, "player_id", TRACKED, pa - 2, pa, period="current_season") \
        .select(*_SCD_COLS.split(", "))


_ACTOR_SQL = "WITH " + V.ACTOR_SNAPSHOTS.replace("{as_of}", AA)
_ACTOR_SCD = _ACTOR_SQL + """,
a_flag AS (
  SELECT actor_id, current_year, quality_class, is_active,
         CASE WHEN lag(quality_class) OVER w IS DISTINCT FROM quality_class
                OR lag(is_active) OVER w IS DISTINCT FROM is_active THEN 1 ELSE 0 END AS chg
  FROM actors_c WINDOW w AS (PARTITION BY actor_id ORDER BY current_year)
),
a_streak AS (SELECT *, sum(chg) OVER (PARTITION BY actor_id ORDER BY current_year) AS streak FROM a_flag),
a_int AS (
  SELECT actor_id, quality_class, is_active, min(current_year) AS start_date, max(current_year) AS end_date
  FROM a_streak GROUP BY actor_id, streak, quality_class, is_active
),
a_scd AS (
  SELECT actor_id, quality_class, is_active, start_date,
         CASE WHEN start_date = max(start_date) OVER (PARTITION BY actor_id) THEN 9999 ELSE end_date END AS end_date,
         start_date = max(start_date) OVER (PARTITION BY actor_id) AS is_current
  FROM a_int
)"""
_A_COLS = ["actor_id", "quality_class", "is_active", "start_date", "end_date", "is_current"]


@register("scd2_open_interval", oracle=_ACTOR_SQL + """
 SELECT actor_id, quality_class, is_active, current_year AS start_date,
        CASE WHEN current_year = max(current_year) OVER (PARTITION BY actor_id) THEN 9999
             ELSE current_year END AS end_date,
        current_year = max(current_year) OVER (PARTITION BY actor_id) AS is_current
 FROM actors_c""")
def q_scd2_open_interval(spark, sf_dir):
    return scd.scd2_open_interval(actors(spark, sf_dir), "actor_id", "current_year",
                                  ["quality_class", "is_active"]).select(*_A_COLS)


@register("scd2_full_reload", oracle=_ACTOR_SCD + " SELECT * FROM a_scd")
def q_scd2_full_reload(spark, sf_dir):
    aa = S.actor_as_of(spark, sf_dir)
    return scd.scd2_full_reload(actors(spark, sf_dir), "actor_id", "current_year",
                                ["quality_class", "is_active"], aa).select(*_A_COLS)


@register("scd2_merge_close", oracle=_ACTOR_SCD + " SELECT * FROM a_scd")
def q_scd2_merge_close(spark, sf_dir):
    aa = S.actor_as_of(spark, sf_dir)
    a = actors(spark, sf_dir)
    before = scd.scd2_full_reload(a.where(F.col("current_year") <= aa - 1), "actor_id", "current_year",
                                  ["quality_class", "is_active"], aa - 1)
    return scd.scd2_merge_close(before, a, "actor_id", ["quality_class", "is_active"], aa,
                                period="current_year").select(*_A_COLS)


@register("scd2_merge_close_load", oracle=_ACTOR_SCD + " SELECT * FROM a_scd")
def q_scd2_merge_close_load(spark, sf_dir):
    """The stored form: the last three years merged into the stored table, then the first of them once more (late), and the rest."""
    aa = S.actor_as_of(spark, sf_dir)
    a = wr.stage(actors(spark, sf_dir), "actors")
    tracked = ["quality_class", "is_active"]
    table = wr.stage(scd.scd2_full_reload(a.where(F.col("current_year") <= aa - 3), "actor_id", "current_year", tracked,
                                          aa - 3), "scd")
    for year in (aa - 2, aa - 1, aa, aa - 2, aa - 1, aa, aa):
        table = wr.stage(scd.scd2_merge_close(table, a, "actor_id", tracked, year, period="current_year"), "scd")
    return table.select(*_A_COLS)


@register("scd_type0", oracle="WITH " + V.PLAYER_SEASONS + """,
 f AS (SELECT player_id, arg_min(scoring_class, season) AS first_class FROM ps GROUP BY 1)
 SELECT f.player_id, f.first_class AS scoring_class,
        count(*) FILTER (WHERE p.scoring_class <> f.first_class) AS attempted_changes
 FROM f JOIN ps p USING (player_id) GROUP BY f.player_id, f.first_class""")
def q_scd_type0(spark, sf_dir):
    return scd.scd_type0(S.player_seasons(spark, sf_dir), "player_id", ["scoring_class"], "season")


@register("scd_type1", oracle="WITH " + V.PLAYER_SEASONS + """
 SELECT player_id, arg_max(scoring_class, season) AS scoring_class, max(season) AS updated_period
 FROM ps GROUP BY 1""")
def q_scd_type1(spark, sf_dir):
    return scd.scd_type1(S.player_seasons(spark, sf_dir), "player_id", ["scoring_class"], "season")


@register("scd_type3", oracle="WITH " + V.PLAYER_SEASONS + """,
 ch AS (
   SELECT player_id, season, scoring_class,
          lag(scoring_class) OVER (PARTITION BY player_id ORDER BY season) AS prev_class
   FROM ps
 ),
 changes AS (
   SELECT player_id, season, scoring_class FROM ch
   WHERE prev_class IS NULL OR prev_class <> scoring_class
 ),
 ranked AS (
   SELECT *, lag(scoring_class) OVER (PARTITION BY player_id ORDER BY season) AS previous_scoring_class,
          row_number() OVER (PARTITION BY player_id ORDER BY season DESC) AS rn
   FROM changes
 )
 SELECT player_id, scoring_class AS current_scoring_class, previous_scoring_class, season AS changed_period
 FROM ranked WHERE rn = 1""")
def q_scd_type3(spark, sf_dir):
    return scd.scd_type3(S.player_seasons(spark, sf_dir), "player_id", "scoring_class", "season")


_AS_OF_SQL = "WITH " + V.PLAYER_SCD.replace("{as_of}", PA) + """
 SELECT o.o_orderkey, o.o_custkey, CAST(year(o.o_orderdate) AS INTEGER) AS order_year,
        s.scoring_class, s.is_active
 FROM orders o LEFT JOIN scd s
   ON s.player_id = o.o_custkey AND year(o.o_orderdate) BETWEEN s.start_period AND s.end_period"""


@register("scd2_as_of_scan", oracle=_AS_OF_SQL)
def q_scd2_as_of_scan(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey",
                                                   F.year("o_orderdate").alias("order_year"))
    return scd.scd2_as_of_scan(o, "o_custkey", "order_year", players_scd(spark, sf_dir), "player_id",
                               "start_period", "end_period", ["scoring_class", "is_active"])


@register("scd2_as_of", oracle=_AS_OF_SQL)
def q_scd2_as_of(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey",
                                                   F.year("o_orderdate").alias("order_year"))
    return scd.scd2_as_of(o, "o_custkey", "order_year", players_scd(spark, sf_dir), "player_id",
                          "start_period", "end_period", ["scoring_class", "is_active"])
