"""Registered queries: keyed tables in versions (W1) and late corrections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.expr import day_range
from tessera.operators import corrections as co
from tessera.operators import cumulative as cu
from tessera.operators import scd
from tessera.plans import sql_views as V
from tessera.plans import standins as S
from tessera.plans.q_cumulative import _SNAP_COLS, flat_players
from tessera.plans.q_scd import _SCD_COLS, TRACKED
from tessera.plans.q_writers import _cust_state, _scratch
from tessera.plans.registry import ORACLES, register
from tessera.sources.tables import read_table
from tessera.sources.versioned import VersionedTable

PA = S.PLAYER_AS_OF


@register("upsert_versioned", oracle=ORACLES["upsert"])
def q_upsert_versioned(spark, sf_dir):
    """W1 on a stored table without partitions: the customers' state to 1999, then the years from 2000 on, twice."""
    o = read_table(spark, sf_dir, "orders")
    table = VersionedTable(spark, _scratch(spark, "customers"), "o_custkey")
    table.overwrite(_cust_state(o.where(day_range(o, "o_orderdate", end="1999-12-31"))))
    for _ in range(2):
        table.upsert(_cust_state(o.where(day_range(o, "o_orderdate", start="2000-01-01"))))
    return table.read()


@register("upsert_moved_partition", oracle="""
 SELECT o_custkey, count(*) AS n_orders, CAST(max(year(o_orderdate)) AS INTEGER) AS last_year
 FROM orders GROUP BY 1""")
def q_upsert_moved_partition(spark, sf_dir):
    """W1 where the key does not hold the partition column: customers by the year of their last order, a year at a time.

    Each year's customers move from the partition of their last year to the new one.
    """
    o = read_table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("y"))
    table = VersionedTable(spark, _scratch(spark, "customer-years"), "o_custkey", ["last_year"])
    last = o.agg(F.max("y")).first()[0]

    def state(rows):
        return rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.max("y").alias("last_year"))

    table.overwrite(state(o.where(F.col("y") <= last - 2)))
    for year in (last - 1, last):
        seen = state(o.where(F.col("y") == year))
        before = table.read().select("o_custkey", F.col("n_orders").alias("_n"))
        table.upsert(seen.join(before, "o_custkey", "left").select(
            "o_custkey", (F.col("n_orders") + F.coalesce("_n", F.lit(0))).alias("n_orders"), "last_year"))
    return table.read().select("o_custkey", "n_orders", "last_year")


def _late():
    """Orders that arrive late: up to 1998, every eleventh."""
    return (F.col("o_orderkey") % 11 == 0) & (F.year("o_orderdate") <= 1998)


def _late_seasons(spark, sf_dir):
    return S.player_seasons(spark, sf_dir, where=_late()).select("player_id", "season")


def _snapshots(seasons, pa, history):
    return cu.cumulative_backfill(seasons, "player_id", "season", ["gp", "pts"], pa, carry=["scoring_class"],
                                  history=history, current="current_season")


@register("cumulative_correction", oracle="WITH " + V.PLAYER_SNAPSHOTS.replace("{as_of}", PA)
          + f" SELECT {_SNAP_COLS} FROM snap")
def q_cumulative_correction(spark, sf_dir):
    """The table is stored without the late orders, then corrected for them; it equals a full rebuild."""
    pa = S.player_as_of(spark, sf_dir)
    table = VersionedTable(spark, _scratch(spark, "players"), ["player_id", "current_season"], ["current_season"])
    table.overwrite(_snapshots(S.player_seasons(spark, sf_dir, last_year=pa, where=~_late()), pa, "season_stats"))
    co.correct_snapshots(table, S.player_seasons(spark, sf_dir, last_year=pa), _late_seasons(spark, sf_dir), "player_id",
                         "season", ["gp", "pts"], pa, ["scoring_class"], "season_stats", "current_season")
    return flat_players(table.read())


@register("scd2_correction", oracle="WITH " + V.PLAYER_SCD.replace("{as_of}", PA) + f" SELECT {_SCD_COLS} FROM scd")
def q_scd2_correction(spark, sf_dir):
    """Intervals stored without the late orders; the corrected players' intervals are replaced."""
    pa = S.player_as_of(spark, sf_dir)
    table = VersionedTable(spark, _scratch(spark, "players-scd"), ["player_id", "start_period"])
    before = _snapshots(S.player_seasons(spark, sf_dir, last_year=pa, where=~_late()), pa, None)
    table.overwrite(scd.scd2_backfill(before, "player_id", "current_season", TRACKED, pa))
    now = _snapshots(S.player_seasons(spark, sf_dir, last_year=pa), pa, None)
    co.correct_intervals(table, now, _late_seasons(spark, sf_dir), "player_id", "current_season", "season", TRACKED, pa)
    return table.read().select(*_SCD_COLS.split(", "))
