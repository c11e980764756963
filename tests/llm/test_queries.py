"""The registered corpus queries, SQL where there is some, and the pipeline stage by stage."""

import brute
import duckdb
import pytest

import corpus_pipeline
from tessera.llm.queries import ORACLES, QUERIES
from tessera.sources.tables import read_table

SF_SMALL = "/root/testdata/sf0.001"


def table(name):
    return duckdb.sql(f"SELECT * FROM '{SF_SMALL}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def texts():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet' ORDER BY 1").fetchall()


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    want = c.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(map(tuple, QUERIES[name](spark, SF_SMALL).select(*columns).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_queries_match_brute_force(spark, texts):
    def rows(name):
        df = QUERIES[name](spark, SF_SMALL)
        return {r[0]: tuple(r[1:]) for r in df.collect()}

    assert rows("op3_minmax_dedup") == brute.near(texts, 3, 85)
    assert rows("op4_recompression") == brute.passages(texts)
    assert rows("op7_bwt_dedup") == brute.byte_repeats(texts)
    got = rows("op5_bloom_lm")
    for d, want in brute.base_scores(texts).items():
        assert got[d][:4] == want[:4] and got[d][4] == pytest.approx(want[4], abs=1e-6)
    held = [v for v in got.values() if v[0]]
    assert sum(v[5] for v in held) > sum(v[4] for v in held)  # better than single words on texts it did not see
    assert {d: v[:6] for d, v in rows("op9_quality_forest").items()} == {d: brute.rules(x) for d, x in texts}


def test_quality_separates_labelled_rows(spark):
    kept = {r.doc_id: r.kept for r in QUERIES["op9_quality_forest"](spark, "/root/testdata/sf0.01").collect()}
    labels = duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    good, bad = ([kept[d] for d, q in labels if q == v] for v in (1, 0))
    assert sum(good) > 0.95 * len(good) and sum(bad) < 0.1 * len(bad)


def test_pipeline_stages(spark, texts):
    docs = read_table(spark, SF_SMALL, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL).cache()
        assert docs.columns == columns
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    first = seen["quality_rules"]
    assert first and all(not brute.rules(x)[5] for x in first.values())
    lines = seen["line_dedup"]
    assert set(lines) == set(first)
    near = brute.near(sorted(lines.items()), 5, 80)
    assert set(seen["near_dedup"]) == {d for d, v in near.items() if v[2]}
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_SMALL}/benchmark.parquet'").fetchall()
    leaked = {d for d, _ in brute.leaks(sorted(seen["near_dedup"].items()), items)}
    assert set(seen["decontamination"]) == set(seen["near_dedup"]) - leaked
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert {r.doc_id for r in pieces} == set(seen["decontamination"])


def test_pipeline_run(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.count() > 0 and "sequence_id" in out.columns
