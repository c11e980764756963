"""Physical-plan shape checks: shuffles, pushdown, no cartesian products, bucketed join."""

import pytest

from conftest import SF_SMALL
from tessera.plans.registry import QUERIES, load_all

load_all()

WRITE_QUERIES = {"bucketed_join", "overwrite_partition", "upsert_partitions", "evolve_schema", "stream_dedup",
                 "microbatch_dedup", "cumulative_incremental_load", "graph_tables"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def n_exchanges(text: str) -> int:
    return sum(1 for line in text.splitlines() if "Exchange hashpartitioning" in line or
               "Exchange rangepartitioning" in line or "Exchange SinglePartition" in line)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITE_QUERIES))
def test_no_cartesian_or_nested_loop(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p
    # no Python in the row path: no (Arrow/batch) Python evaluation nodes
    assert "EvalPython" not in p and "FlatMapGroupsInPandas" not in p and "MapInPandas" not in p


def test_scd2_backfill_single_exchange_after_facts(spark):
    # AQE off to read the static plan; exchanges: facts aggregate (1) + snapshot window (1); the
    # streak aggregate reuses the window's partitioning.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(QUERIES["scd2_backfill"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert n_exchanges(p) == 2, p


def test_dedup_partial_window_group_limit(spark):
    p = plan(QUERIES["dedup_first"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = QUERIES["activity_flags"](spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(user_id)" in text
    # only the columns used are read from the 6-column events table
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text


def test_bucketed_join_has_no_exchange_below_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = QUERIES["bucketed_join"](spark, SF_SMALL)
        p = plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    join_part = p.split("SortMergeJoin", 1)[1]
    assert "Exchange" not in join_part, p
