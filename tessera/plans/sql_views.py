"""DuckDB CTE fragments for the stand-in views, used by the oracle SQL.

They restate ``standins.py`` in SQL over the raw tables so the oracles do not
depend on any Spark code.
"""

from tessera.plans.standins import BOX_MEASURES

PLAYER_SEASONS = """
ps0 AS (
  SELECT o_custkey AS player_id, CAST(year(o_orderdate) AS INTEGER) AS season, count(*) AS gp,
         (sum(CAST(round(o_totalprice * 100) AS BIGINT)) // count(*)) / 100 AS pts
  FROM orders GROUP BY 1, 2
),
ps AS (
  SELECT player_id, season, gp, pts,
         CASE WHEN pts > 300000 THEN 'star' WHEN pts > 250000 THEN 'good'
              WHEN pts > 200000 THEN 'average' ELSE 'bad' END AS scoring_class
  FROM ps0
)"""

# Per-period snapshot status of every player (spine form, independent of the
# window/interval form used on the Spark side).
PLAYER_SNAPSHOTS = PLAYER_SEASONS + """,
ps_first AS (SELECT player_id, min(season) AS first_season FROM ps GROUP BY 1),
ps_spine AS (
  SELECT player_id, CAST(unnest(generate_series(first_season, {as_of})) AS INTEGER) AS current_season
  FROM ps_first
),
ps_hist AS (
  SELECT s.player_id, s.current_season, count(*) AS n_history, min(p.season) AS first_season,
         max(p.season) AS last_season, round(sum(p.pts), 2) AS hist_pts, CAST(sum(p.gp) AS BIGINT) AS hist_gp
  FROM ps_spine s JOIN ps p ON p.player_id = s.player_id AND p.season <= s.current_season
  GROUP BY 1, 2
),
snap AS (
  SELECT h.player_id, h.current_season, h.n_history, h.first_season, h.last_season, h.hist_pts, h.hist_gp,
         p.scoring_class, h.current_season - h.last_season AS years_since_last,
         h.last_season = h.current_season AS is_active
  FROM ps_hist h JOIN ps p ON p.player_id = h.player_id AND p.season = h.last_season
)"""

# SCD-2 intervals over the player snapshots (gaps and islands in SQL).
PLAYER_SCD = PLAYER_SNAPSHOTS + """,
snap_flag AS (
  SELECT player_id, current_season, scoring_class, is_active,
         CASE WHEN lag(scoring_class) OVER w IS DISTINCT FROM scoring_class
                OR lag(is_active) OVER w IS DISTINCT FROM is_active THEN 1 ELSE 0 END AS chg
  FROM snap WINDOW w AS (PARTITION BY player_id ORDER BY current_season)
),
snap_streak AS (
  SELECT *, sum(chg) OVER (PARTITION BY player_id ORDER BY current_season) AS streak FROM snap_flag
),
scd AS (
  SELECT player_id, scoring_class, is_active, min(current_season) AS start_period,
         max(current_season) AS end_period, CAST({as_of} AS INTEGER) AS current_period
  FROM snap_streak GROUP BY player_id, streak, scoring_class, is_active
)"""

ACTOR_FILMS = """
af AS (
  SELECT l_partkey AS actor_id, CAST(year(l_shipdate) AS INTEGER) AS year,
         l_quantity / 5 AS rating, CAST(l_quantity AS INTEGER) AS votes,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS filmid
  FROM lineitem
)"""

# Actor snapshots per year: films so far, running average rating, class.
ACTOR_SNAPSHOTS = ACTOR_FILMS + """,
af_first AS (SELECT actor_id, min(year) AS first_year FROM af GROUP BY 1),
af_spine AS (
  SELECT actor_id, CAST(unnest(generate_series(first_year, {as_of})) AS INTEGER) AS current_year FROM af_first
),
af_years AS (SELECT DISTINCT actor_id, year FROM af),
actors AS (
  SELECT s.actor_id, s.current_year, count(*) AS n_films, round(avg(f.rating), 9) AS avg_rating,
         max(f.year) = s.current_year AS is_active
  FROM af_spine s JOIN af f ON f.actor_id = s.actor_id AND f.year <= s.current_year
  GROUP BY 1, 2
),
actors_c AS (
  SELECT *, CASE WHEN avg_rating > 8 THEN 'star' WHEN avg_rating > 7 THEN 'good'
                 WHEN avg_rating > 6 THEN 'average' ELSE 'bad' END AS quality_class
  FROM actors
)"""

GAME_DETAILS = """
gd AS (
  SELECT l.l_orderkey AS game_id, l.l_linestatus AS team_id, l.l_linestatus AS team_abbreviation,
         l.l_suppkey AS player_id, s.s_name AS player_name, l.l_returnflag AS start_position,
         CASE WHEN l.l_returnflag = 'R' THEN 'DNP - Coach''s Decision'
              WHEN l.l_returnflag = 'A' THEN 'NWT - Personal' END AS comment,
         CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) || ':' ||
           lpad(CAST(CAST(round(l.l_discount * 100) AS INTEGER) AS VARCHAR), 2, '0') AS min,
         l.l_linenumber AS fgm, l.l_quantity AS pts, l.l_partkey AS line_part, l.l_extendedprice AS line_price
  FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

# The details without names, with all measures: what the fact is built from.
GAME_BOX = """
gd AS (
  SELECT l_orderkey AS game_id, l_linestatus AS team_id, l_linestatus AS team_abbreviation,
         l_suppkey AS player_id, l_returnflag AS start_position,
         CASE WHEN l_returnflag = 'R' THEN 'DNP - Coach''s Decision'
              WHEN l_returnflag = 'A' THEN 'NWT - Personal' END AS comment,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ':' ||
           lpad(CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR), 2, '0') AS min,
         l_linenumber AS fgm, l_quantity AS pts, l_partkey AS line_part, l_extendedprice AS line_price,
         """ + ",\n         ".join(f"CAST({e} AS BIGINT) AS {c}" for c, e in BOX_MEASURES.items()) + """
  FROM lineitem
)"""

GAMES = """
g AS (
  SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date_est,
         CAST(year(o_orderdate) AS INTEGER) AS season,
         CASE WHEN o_orderkey % 2 = 0 THEN 'F' ELSE 'O' END AS home_team_id,
         CASE WHEN o_orderkey % 2 = 0 THEN 'O' ELSE 'F' END AS visitor_team_id,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS home_team_wins,
         CAST(round(o_totalprice / 1000, 0) AS INTEGER) AS pts_home,
         CAST(o_custkey % 120 AS INTEGER) AS pts_away
  FROM orders
)"""

WEB_EVENTS = """
we AS (SELECT event_id, user_id, ts AS event_time, event_type AS host, value FROM events)"""
