"""Bindings of the test tables to the shapes the modelling pipelines expect.

The pipelines were written for sports / film / web-event sources that do not
ship with the test data; these views re-express the TPC-H-like tables in
those shapes (see FIXTURES.md section 3). Every view is a lazy projection or
aggregate of the given tables, so its size grows with them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.expr import day_range, threshold_class
from tessera.sources.tables import read_table

# Fixed values of the stand-in bindings.
# Scoring classes on a season's average order value (strict ">", else "bad").
SCORING_THRESHOLDS = [(300000, "star"), (250000, "good"), (200000, "average")]
SCORING_ELSE = "bad"
# Quality classes on an actor's running average rating (strict ">", else "bad").
QUALITY_THRESHOLDS = [(8, "star"), (7, "good"), (6, "average")]
QUALITY_ELSE = "bad"
# Bounds of the tables' periods, as SQL for the oracles (the functions below read the same for the queries).
PLAYER_AS_OF = "(SELECT CAST(max(year(o_orderdate)) AS INTEGER) FROM orders)"
ACTOR_AS_OF = "(SELECT CAST(max(year(l_shipdate)) AS INTEGER) FROM lineitem)"
EVENTS_START = "(SELECT CAST(min(ts) AS DATE) FROM events)"
EVENTS_MONTH = "(SELECT CAST(date_trunc('month', max(ts)) AS DATE) FROM events)"
EVENTS_AS_OF = "(SELECT CAST(max(ts) AS DATE) FROM events)"


def player_as_of(spark: SparkSession, sf_dir: str) -> int:
    """Year of the latest order (one column, one row back)."""
    return read_table(spark, sf_dir, "orders").agg(F.year(F.max("o_orderdate"))).first()[0] or 0


def actor_as_of(spark: SparkSession, sf_dir: str) -> int:
    """Year of the latest shipment."""
    return read_table(spark, sf_dir, "lineitem").agg(F.year(F.max("l_shipdate"))).first()[0] or 0


def events_bounds(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """First day with events, first of the last month and last day with events, as ISO dates."""
    low, high = read_table(spark, sf_dir, "events").agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    return (str(low), str(high.replace(day=1)), str(high)) if high else ("1970-01-01",) * 3


def day_before(day: str) -> str:
    return str(dt.date.fromisoformat(day) - dt.timedelta(days=1))


def player_seasons(spark: SparkSession, sf_dir: str, first_year: int | None = None,
                   last_year: int | None = None, where=None) -> DataFrame:
    """(player_id, season, gp, pts, scoring_class): one row per customer-year of orders.

    A year range becomes a range on ``o_orderdate`` itself, so it reaches the
    Parquet scan (a filter on ``year(o_orderdate)`` would not). ``where`` is a
    further condition on orders.
    """
    o = read_table(spark, sf_dir, "orders")
    if where is not None:
        o = o.where(where)
    if first_year is not None or last_year is not None:
        o = o.where(day_range(o, "o_orderdate",
                              None if first_year is None else f"{first_year}-01-01",
                              None if last_year is None else f"{last_year}-12-31"))
    # Average in whole cents (integer division) so every engine gets the same double.
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    f = o.groupBy(F.col("o_custkey").alias("player_id"), F.year("o_orderdate").alias("season")).agg(
        F.count(F.lit(1)).alias("gp"), (F.sum(cents).cast("long") / F.count(F.lit(1))).alias("_c")
    )
    f = f.select("player_id", "season", "gp", (F.floor("_c") / 100).alias("pts"))
    return f.withColumn("scoring_class", threshold_class("pts", SCORING_THRESHOLDS, SCORING_ELSE))


def actor_films(spark: SparkSession, sf_dir: str, last_year: int | None = None) -> DataFrame:
    """(actor_id, actor, year, film, votes, rating, filmid): one row per line item."""
    li = read_table(spark, sf_dir, "lineitem")
    if last_year is not None:
        li = li.where(day_range(li, "l_shipdate", None, f"{last_year}-12-31"))
    film_id = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return li.select(
        F.col("l_partkey").alias("actor_id"),
        F.concat(F.lit("actor "), F.col("l_partkey").cast("string")).alias("actor"),
        F.year("l_shipdate").alias("year"),
        F.concat(F.lit("film "), film_id).alias("film"),
        F.col("l_quantity").cast("int").alias("votes"),
        (F.col("l_quantity") / 5).alias("rating"),
        film_id.alias("filmid"),
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(game_id, game_date_est, season, home_team_id, visitor_team_id, home_team_wins, pts_home, pts_away)."""
    o = read_table(spark, sf_dir, "orders")
    even = (F.col("o_orderkey") % 2) == 0
    return o.select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date_est"),
        F.year("o_orderdate").alias("season"),
        F.when(even, F.lit("F")).otherwise(F.lit("O")).alias("home_team_id"),
        F.when(even, F.lit("O")).otherwise(F.lit("F")).alias("visitor_team_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1)).otherwise(F.lit(0)).alias("home_team_wins"),
        F.round(F.col("o_totalprice") / 1000, 0).cast("int").alias("pts_home"),
        (F.col("o_custkey") % 120).cast("int").alias("pts_away"),
    )


def player_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(player_id, player_name): the suppliers."""
    return read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("player_id"),
                                                        F.col("s_name").alias("player_name"))


#: The box score's other measures as whole-number formulas of a line item (the SQL views use the same text).
BOX_MEASURES = {
    "fga": "l_linenumber + CAST(l_quantity AS INT)", "fg3m": "l_linenumber % 3",
    "fg3a": "l_linenumber % 3 + CAST(l_quantity AS INT) % 5", "ftm": "CAST(l_quantity AS INT) % 7",
    "fta": "CAST(l_quantity AS INT) % 7 + l_linenumber", "oreb": "l_partkey % 4", "dreb": "l_partkey % 9",
    "reb": "l_partkey % 4 + l_partkey % 9", "ast": "l_suppkey % 11", "stl": "l_partkey % 3", "blk": "l_suppkey % 4",
    "turnovers": "CAST(l_quantity AS INT) % 6", "pf": "l_linenumber % 6", "plus_minus": "l_partkey % 41 - 20",
}


def game_details(spark: SparkSession, sf_dir: str, names: bool = True) -> DataFrame:
    """One row per (line item): game = order, player = supplier, team = line status.

    Without ``names`` the player's name is left out (a fact joins it after its dedupe).
    """
    li = read_table(spark, sf_dir, "lineitem")
    comment = (
        F.when(F.col("l_returnflag") == "R", F.lit("DNP - Coach's Decision"))
        .when(F.col("l_returnflag") == "A", F.lit("NWT - Personal"))
    )
    minutes = F.concat(
        F.col("l_quantity").cast("int").cast("string"), F.lit(":"),
        F.lpad(F.round(F.col("l_discount") * 100).cast("int").cast("string"), 2, "0"),
    )
    rows = li.select(
        F.col("l_orderkey").alias("game_id"),
        F.col("l_linestatus").alias("team_id"),
        F.col("l_linestatus").alias("team_abbreviation"),
        F.col("l_suppkey").alias("player_id"),
        F.col("l_returnflag").alias("start_position"),
        comment.alias("comment"),
        minutes.alias("min"),
        F.col("l_linenumber").alias("fgm"),
        F.col("l_quantity").alias("pts"),
        F.col("l_partkey").alias("line_part"),
        F.col("l_extendedprice").alias("line_price"),
        *[F.expr(e).cast("long").alias(c) for c, e in BOX_MEASURES.items()],
    )
    return rows.join(player_names(spark, sf_dir), "player_id", "left") if names else rows


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the team reference table, each row three times (the duplicated table).

    A table that grows with the scale factor (the fixed 25 nations would not).
    """
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("team_id"),
        F.substring("c_mktsegment", 1, 3).alias("abbreviation"),
        F.col("c_name").alias("nickname"),
        F.col("c_nationkey").alias("city"),
        (F.lit(1900) + F.col("c_custkey") % 100).cast("int").alias("yearfounded"),
    )
    return c.unionByName(c).unionByName(c)


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, event_time, host, event_id, value): events with host = event_type."""
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", "user_id", F.col("ts").alias("event_time"),
                    F.col("event_type").alias("host"), "value")
