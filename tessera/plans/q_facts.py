"""Registered queries: dedupe and fact tables."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import functions as F

from tessera.functions.expr import clock_to_minutes, text_flag
from tessera.operators import facts as fx
from tessera.plans import sql_views as V
from tessera.plans import standins as S
from tessera.plans.registry import register
from tessera.session import ensure_checkpoint_dir
from tessera.sources.tables import read_table

_LI_OTHER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]


@register("duplicate_audit", oracle="""
 SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
 GROUP BY 1, 2 HAVING count(*) > 1""")
def q_duplicate_audit(spark, sf_dir):
    return fx.duplicate_audit(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("duplicate_audit_details", oracle="WITH " + V.GAME_DETAILS + """
 SELECT game_id, team_id, player_id, count(*) AS n_rows FROM gd GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def q_duplicate_audit_details(spark, sf_dir):
    # the fact lab's check: (game, team, player) keys that occur more than once in the details
    return fx.duplicate_audit(S.game_details(spark, sf_dir, names=False), ["game_id", "team_id", "player_id"])


@register("dedup_first", oracle=f"""
 SELECT * EXCLUDE (rn) FROM (
   SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
     ORDER BY l_shipdate, {", ".join(c + " ASC NULLS LAST" for c in _LI_OTHER)}) AS rn
   FROM lineitem) WHERE rn = 1""")
def q_dedup_first(spark, sf_dir):
    return fx.dedup_first(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


_GAPS = """
 gaps AS (
   SELECT (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id))) / 6e7 AS gap,
          event_id, user_id, event_type, ts
   FROM events
 )"""


@register("dedup_window_profile", oracle="WITH " + _GAPS + """
 SELECT CASE WHEN gap <= 1 THEN '<=1 min' WHEN gap <= 5 THEN '<=5 min' WHEN gap <= 15 THEN '<=15 min'
             WHEN gap <= 60 THEN '<=60 min' WHEN gap <= 1440 THEN '<=1440 min' ELSE '>1440 min' END AS gap_bucket,
        count(*) AS n_events
 FROM gaps WHERE gap IS NOT NULL GROUP BY 1""")
def q_dedup_window_profile(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return fx.dedup_window_profile(e, ["user_id", "event_type"], "ts", ["event_id"])


@register("dedup_within_window", oracle="WITH " + _GAPS + """
 SELECT event_id, user_id, event_type, ts FROM gaps WHERE gap IS NULL OR gap > 60""")
def q_dedup_within_window(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return fx.dedup_within_window(e, ["user_id", "event_type"], "ts", 60, ["event_id"])


_FACT_SQL = "WITH " + V.GAME_BOX + "," + V.GAMES + f""",
 j AS (SELECT gd.*, g.game_date_est, g.season, g.home_team_id FROM gd JOIN g USING (game_id)),
 d AS (
   SELECT *, row_number() OVER (PARTITION BY game_id, team_id, player_id ORDER BY game_date_est,
     team_abbreviation ASC NULLS LAST, start_position ASC NULLS LAST,
     comment ASC NULLS LAST, min ASC NULLS LAST, fgm ASC NULLS LAST, pts ASC NULLS LAST,
     line_part ASC NULLS LAST, line_price ASC NULLS LAST,
     {", ".join(c + " ASC NULLS LAST" for c in S.BOX_MEASURES)}, game_date_est ASC NULLS LAST,
     season ASC NULLS LAST, home_team_id ASC NULLS LAST) AS rn
   FROM j
 ),
 fct AS (
   SELECT game_date_est AS dim_game_date, season AS dim_season, team_id AS dim_team_id,
          player_id AS dim_player_id, s_name AS dim_player_name, start_position AS dim_start_position,
          team_id = home_team_id AS dim_is_playing_at_home,
          coalesce(start_position = 'R', false) AS dim_did_not_play,
          false AS dim_did_not_dress,
          coalesce(start_position = 'A', false) AS dim_not_with_team,
          round(pts + CAST(regexp_extract(min, ':([0-9]+)$', 1) AS INTEGER) / 60.0, 6) AS m_minutes,
          fgm AS m_fgm, pts AS m_pts, {", ".join(f"{c} AS m_{c}" for c in S.BOX_MEASURES)}, game_id AS dim_game_id
   FROM d LEFT JOIN supplier ON s_suppkey = player_id WHERE rn = 1
 )"""


def fct_game_details(spark, sf_dir):
    f = fx.fact_build(S.game_details(spark, sf_dir, names=False), S.games(spark, sf_dir),
                      names=S.player_names(spark, sf_dir))
    return f.withColumn("m_minutes", F.round("m_minutes", 6))


@register("fact_build", oracle=_FACT_SQL + " SELECT * FROM fct")
def q_fact_build(spark, sf_dir):
    return fct_game_details(spark, sf_dir)


@register("text_flags", oracle="WITH " + V.GAME_DETAILS + """
 SELECT comment, count(*) AS n_rows,
        coalesce(position('DNP' IN comment), 0) > 0 AS did_not_play,
        coalesce(position('DND' IN comment), 0) > 0 AS did_not_dress,
        coalesce(position('NWT' IN comment), 0) > 0 AS not_with_team
 FROM gd GROUP BY comment""")
def q_text_flags(spark, sf_dir):
    gd = S.game_details(spark, sf_dir, names=False)
    return gd.groupBy("comment").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "comment", "n_rows", text_flag("comment", "DNP").alias("did_not_play"),
        text_flag("comment", "DND").alias("did_not_dress"), text_flag("comment", "NWT").alias("not_with_team"))


@register("clock_to_minutes", oracle="WITH " + V.GAME_DETAILS + """
 SELECT min, count(*) AS n_rows,
        round(TRY_CAST(split_part(min, ':', 1) AS DOUBLE)
          + CASE WHEN split_part(min, ':', 2) = '' THEN 0.0
                 ELSE TRY_CAST(split_part(min, ':', 2) AS DOUBLE) END / 60, 6) AS minutes
 FROM gd GROUP BY min""")
def q_clock_to_minutes(spark, sf_dir):
    gd = S.game_details(spark, sf_dir, names=False)
    return gd.groupBy("min").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "min", "n_rows", F.round(clock_to_minutes("min"), 6).alias("minutes"))


@register("conditional_rate", oracle=_FACT_SQL + """
 SELECT dim_player_name, count(dim_player_name) AS num_games,
        count(*) FILTER (WHERE dim_not_with_team) AS num_flagged,
        round(CAST(count(*) FILTER (WHERE dim_not_with_team) AS DOUBLE) / nullif(count(dim_player_name), 0), 6) AS flag_rate
 FROM fct GROUP BY 1""")
def q_conditional_rate(spark, sf_dir):
    # the details' first columns only: measures and the clock decide nothing here and would pass the dedupe's shuffle
    details = S.game_details(spark, sf_dir, names=False).select("game_id", "team_id", "team_abbreviation", "player_id",
                                                                "start_position", "comment")
    f = fx.fact_build(details, S.games(spark, sf_dir), measures={}, names=S.player_names(spark, sf_dir))
    r = fx.conditional_rate(f, "dim_player_name", "dim_not_with_team")
    return r.withColumn("flag_rate", F.round("flag_rate", 6))


@register("denormalise_fact", oracle="""
 SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, p.p_brand, p.p_type, s.s_name, n.n_name
 FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
 LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
 LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""")
def q_denormalise_fact(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    d = fx.denormalise_fact(li, [
        (read_table(spark, sf_dir, "part"), "l_partkey", "p_partkey", ["p_brand", "p_type"]),
        (read_table(spark, sf_dir, "supplier"), "l_suppkey", "s_suppkey", ["s_name", "s_nationkey"]),
        (read_table(spark, sf_dir, "nation"), "s_nationkey", "n_nationkey", ["n_name"]),
    ])
    return d.drop("s_nationkey")


@register("normalise_fact", oracle="""
 SELECT 'fact' AS part, l_orderkey, l_linenumber, l_partkey AS part_key, CAST(NULL AS VARCHAR) AS p_brand,
        CAST(NULL AS VARCHAR) AS p_type
 FROM lineitem
 UNION ALL
 SELECT DISTINCT 'dimension', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), l.l_partkey, p.p_brand, p.p_type
 FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""")
def q_normalise_fact(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("part_key"))
    p = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part_key"), "p_brand", "p_type")
    fact, dim = fx.normalise_fact(li.join(p, "part_key", "left"), ["l_orderkey", "l_linenumber", "part_key"], "part_key",
                                  ["p_brand", "p_type"])
    none = [F.lit(None).cast("bigint").alias(c) for c in ("l_orderkey", "l_linenumber")]
    text = [F.lit(None).cast("string").alias(c) for c in ("p_brand", "p_type")]
    f = fact.select(F.lit("fact").alias("part"), F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
                    F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "part_key", *text)
    return f.unionByName(dim.select(F.lit("dimension").alias("part"), *none, "part_key", "p_brand", "p_type"))


@register("sample_fact", oracle="""
 SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey % 10 < 3""")
def q_sample_fact(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return fx.sample_fact(o, "o_custkey", 10, 3, method="modulo")


@register("sample_fact_hash", oracle="""
 SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE md5(CAST(o_custkey AS VARCHAR)) < '4ccccccc'""")
def q_sample_fact_hash(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return fx.sample_fact(o, "o_custkey", 10, 3, method="md5")


@register("bucketed_join", oracle="""
 SELECT o.o_orderkey, o.o_custkey, count(*) AS n_lines, round(sum(l.l_quantity), 2) AS sum_qty
 FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2""")
def q_bucketed_join(spark, sf_dir):
    tag = uuid.uuid4().hex  # a run's own tables: another run at the same time must not replace them
    loc = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bucketed-{tag}"
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_custkey")
    li = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_quantity")
    n = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))  # as many as a shuffle of this input would have
    j = fx.bucketed_join(spark, o, li, "orderkey", n, loc, (f"bkt_orders_{tag}", f"bkt_lineitem_{tag}"))
    return j.groupBy(F.col("orderkey").alias("o_orderkey"), "o_custkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 2).alias("sum_qty"))


_SECRET = "held outside the table"
_KEY = hashlib.sha256(_SECRET.encode()).hexdigest()


@register("retention_split", oracle=f"""
 SELECT CASE WHEN ts IS NULL THEN 'undated' ELSE 'recent' END AS tier, event_id, user_id,
        CAST(NULL AS VARCHAR) AS user_id_hash, event_type, CAST(ts AS DATE) AS day
 FROM events WHERE ts IS NULL OR CAST(ts AS DATE) >= DATE '2024-01-16'
 UNION ALL
 SELECT 'archived', event_id, CAST(NULL AS BIGINT),
        sha256('{_KEY}/outer/' || sha256('{_KEY}/inner/' || CAST(user_id AS VARCHAR))), event_type, CAST(ts AS DATE)
 FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-16'""")
def q_retention_split(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    recent, old, undated = fx.retention_split(e, "ts", "2024-01-16", ["user_id"], secret=_SECRET)
    day = F.to_date("ts").alias("day")

    def tier(df, name):
        return df.select(F.lit(name).alias("tier"), "event_id", "user_id", F.lit(None).cast("string").alias("user_id_hash"),
                         "event_type", day)

    a = old.select(F.lit("archived").alias("tier"), "event_id", F.lit(None).cast("bigint").alias("user_id"),
                   "user_id_hash", "event_type", day)
    return tier(recent, "recent").unionByName(tier(undated, "undated")).unionByName(a)


@register("daily_aggregate", oracle="""
 SELECT event_type AS host, CAST(ts AS DATE) AS day, count(*) AS hits, count(DISTINCT user_id) AS unique_visitors
 FROM events WHERE event_type IS NOT NULL GROUP BY 1, 2""")
def q_daily_aggregate(spark, sf_dir):
    return fx.daily_aggregate(S.web_events(spark, sf_dir), "host", "event_time", "user_id")


@register("snapshot_fact", oracle=f"""
 WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS d, arg_max(value, ts) AS v FROM events GROUP BY 1, 2),
 firsts AS (SELECT user_id, min(d) AS f FROM daily GROUP BY 1),
 spine AS (SELECT user_id, CAST(unnest(generate_series(f, {S.EVENTS_AS_OF}, INTERVAL 1 DAY)) AS DATE) AS snapshot_date
           FROM firsts)
 SELECT s.user_id, s.snapshot_date, dl.v AS value, dl.d AS last_change_date
 FROM spine s ASOF JOIN daily dl ON s.user_id = dl.user_id AND s.snapshot_date >= dl.d""")
def q_snapshot_fact(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return fx.snapshot_fact(e, "user_id", "ts", "value", S.events_bounds(spark, sf_dir)[2])


MILESTONES = ["signup", "view", "click", "purchase"]


@register("accumulating_snapshot", oracle="""
 SELECT user_id, min(ts) FILTER (WHERE event_type = 'signup') AS signup_at,
        min(ts) FILTER (WHERE event_type = 'view') AS view_at,
        min(ts) FILTER (WHERE event_type = 'click') AS click_at,
        min(ts) FILTER (WHERE event_type = 'purchase') AS purchase_at
 FROM events GROUP BY 1""")
def q_accumulating_snapshot(spark, sf_dir):
    return fx.accumulating_snapshot(read_table(spark, sf_dir, "events"), "user_id", "event_type", "ts", MILESTONES)


@register("factless_fact", oracle="SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events")
def q_factless_fact(spark, sf_dir):
    return fx.factless_fact(read_table(spark, sf_dir, "events"), "user_id", "ts")


@register("factless_coverage", oracle="""
 SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS n_user_id FROM events GROUP BY 1""")
def q_factless_coverage(spark, sf_dir):
    presence = fx.factless_fact(read_table(spark, sf_dir, "events"), "user_id", "ts")
    return fx.factless_coverage(presence, "user_id")


@register("olap_cube", oracle="""
 SELECT o_orderstatus, o_orderpriority, CAST(GROUPING(o_orderstatus, o_orderpriority) AS BIGINT) AS grouping_id,
        count(*) AS n_orders, round(sum(o_totalprice), 2) AS sum_price
 FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def q_olap_cube(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return fx.olap_cube(o, ["o_orderstatus", "o_orderpriority"],
                        [F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("sum_price")])


@register("master_entity", oracle="""
 WITH c AS (SELECT c_custkey AS person, any_value(c_name) AS name FROM customer GROUP BY 1),
 o AS (SELECT o_custkey AS person, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1),
 e AS (SELECT user_id AS person, count(*) AS n_events FROM events GROUP BY 1)
 SELECT coalesce(c.person, o.person, e.person) AS person, c.name, o.n_orders, o.spent, e.n_events
 FROM c FULL JOIN o ON c.person = o.person FULL JOIN e ON coalesce(c.person, o.person) = e.person""")
def q_master_entity(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("person"), F.col("c_name").alias("name"))
    o = read_table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("person")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("spent"))
    e = read_table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("person")).agg(
        F.count(F.lit(1)).alias("n_events"))
    return fx.master_entity([(c.unionByName(c), "customer"), (o, "orders"), (e, "events")], "person")


@register("olap_rollup", oracle="""
 SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year,
        CAST(GROUPING(o_orderpriority, year(o_orderdate)) AS BIGINT) AS grouping_id,
        count(*) AS n_orders, round(sum(o_totalprice), 2) AS sum_price
 FROM orders GROUP BY ROLLUP (o_orderpriority, year(o_orderdate))""")
def q_olap_rollup(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").withColumn("order_year", F.year("o_orderdate"))
    return fx.olap_cube(o, ["o_orderpriority", "order_year"],
                        [F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("sum_price")],
                        kind="rollup")
