"""Every registered query against its DuckDB oracle at sf0.001 (the driver's gate runs sf0.01)."""

import os
import sys

import duckdb
import pytest

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import oracle_check  # noqa: E402
from oracle_check import digest  # noqa: E402

oracle_check.EXACT = True  # hash repr() of every float: no rounding tolerance
from tessera.plans.registry import ORACLES, QUERIES, load_all  # noqa: E402
from tessera.sources.tables import TABLES, table_path  # noqa: E402

load_all()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return c


def test_every_query_is_registered_with_entry():
    import __spark_entry__ as e
    own = {k for k in e.queries() if k != "pipeline" and not k.startswith("op")}  # the corpus operators have tests of their own
    assert own == set(QUERIES)
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert df.columns == ["player_id", "scoring_class", "is_active", "start_period", "end_period", "current_period"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    hs, _ = digest(srows, df.columns)
    ho, _ = digest(orows, ocols)
    assert hs == ho


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0
