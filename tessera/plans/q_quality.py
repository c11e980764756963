"""Registered queries: data-quality checks (Q1-Q5; Q6 lives with the reduced facts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import facts as fx
from tessera.operators import quality as qa
from tessera.plans import standins as S
from tessera.plans.q_facts import _FACT_SQL
from tessera.plans.registry import register
from tessera.sources.tables import read_table

PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]
# The declared enum of event types (the fifth type in the data is flagged).
EVENT_TYPES = ["view", "click", "purchase", "signup"]


def _card_sql(c: str) -> str:
    return (f"SELECT '{c}' AS column_name, (SELECT count(*) FROM part) AS n_rows, count(DISTINCT {c}) AS n_distinct, "
            f"count({c}) AS n_non_null FROM part")


@register("cardinality_profile", oracle="SELECT *, CASE WHEN n_distinct = n_non_null THEN 'unique' "
          "WHEN n_distinct <= 50 THEN 'low' ELSE 'high' END AS cardinality FROM ("
          + " UNION ALL ".join(_card_sql(c) for c in PART_COLS) + ")")
def q_cardinality_profile(spark, sf_dir):
    return qa.cardinality_profile(read_table(spark, sf_dir, "part"), PART_COLS)


@register("key_check", oracle="""
 WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n,
                   count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL) AS nulls
            FROM lineitem GROUP BY 1, 2)
 SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(nulls) AS BIGINT) AS n_null_key_rows,
        count(*) FILTER (WHERE n > 1) AS n_duplicate_keys,
        CAST(coalesce(sum(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) AS n_extra_rows,
        sum(nulls) = 0 AND count(*) FILTER (WHERE n > 1) = 0 AS is_valid
 FROM k""")
def q_key_check(spark, sf_dir):
    return qa.key_check(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("fact_key_check", oracle=_FACT_SQL + """,
 k AS (SELECT dim_game_date, dim_player_id, dim_team_id, count(*) AS n,
              count(*) FILTER (WHERE dim_game_date IS NULL OR dim_player_id IS NULL OR dim_team_id IS NULL) AS nulls
       FROM fct GROUP BY 1, 2, 3)
 SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(nulls) AS BIGINT) AS n_null_key_rows,
        count(*) FILTER (WHERE n > 1) AS n_duplicate_keys,
        CAST(coalesce(sum(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) AS n_extra_rows,
        sum(nulls) = 0 AND count(*) FILTER (WHERE n > 1) = 0 AS is_valid
 FROM k""")
def q_fact_key_check(spark, sf_dir):
    # The fact's declared key (date, player, team) checked after the dedupe on the business key.
    keys = fx.fact_keys(S.game_details(spark, sf_dir, names=False), S.games(spark, sf_dir))
    return qa.key_check(keys, ["dim_game_date", "dim_player_id", "dim_team_id"])


@register("additivity_check", oracle="""
 SELECT (SELECT count(*) FROM (SELECT DISTINCT event_type, user_id FROM events WHERE user_id IS NOT NULL)) AS sum_of_slices,
        count(DISTINCT user_id) AS overall,
        (SELECT count(*) FROM (SELECT DISTINCT event_type, user_id FROM events WHERE user_id IS NOT NULL))
          = count(DISTINCT user_id) AS is_additive
 FROM events""")
def q_additivity_check(spark, sf_dir):
    return qa.additivity_check(read_table(spark, sf_dir, "events"), "event_type", "user_id")


@register("domain_check", oracle=f"""
 SELECT event_type, count(*) AS n_rows,
        coalesce(event_type IN ({", ".join(repr(v) for v in EVENT_TYPES)}), false) AS in_domain
 FROM events GROUP BY 1""")
def q_domain_check(spark, sf_dir):
    return qa.domain_check(read_table(spark, sf_dir, "events"), "event_type", EVENT_TYPES)


@register("domain_quarantine", oracle=f"""
 SELECT event_id, event_type FROM events
 WHERE NOT coalesce(event_type IN ({", ".join(repr(v) for v in EVENT_TYPES)}), false)""")
def q_domain_quarantine(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    _ok, bad = qa.domain_quarantine(e, "event_type", EVENT_TYPES)
    return bad


@register("domain_bounds", oracle="""
 SELECT CAST(min(year(l_shipdate)) AS INTEGER) AS min_value, CAST(max(year(l_shipdate)) AS INTEGER) AS max_value
 FROM lineitem""")
def q_domain_bounds(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"))
    return qa.domain_bounds(li, "year")
