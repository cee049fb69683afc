"""Driver contract: entry runs; every oracle key is a query; a sample of
queries equals its DuckDB oracle on sf0.001."""
import math

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF

TABLES = "customer orders lineitem events".split()
FAST = ["feature_mart_20", "bureau_features", "card_features", "prev_application_features", "balance_status_features",
        "profit_sweep", "precision_recall_curve", "chi2_independence", "stratified_split", "group_impact_report",
        "target_encode", "validate_records", "table_profile"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "SK_ID_CURR" in df.columns


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


ALL_SQL = sorted(set(entry.oracle_sql()) - set(entry.CORPUS_SQL))   # tests/llm checks the corpus queries


@pytest.mark.parametrize("name", ALL_SQL)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = entry.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    cur = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert len(srows) == len(drows)
    for a, b in zip(srows, drows):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                assert x == pytest.approx(y, rel=1e-9, abs=2e-6)
            else:
                assert x == y


def test_model_queries_run(spark):
    """The held-out run reports both problems; each streamed request is scored or quarantined."""
    rows = entry.queries()["final_test_run"](spark, SF).where("section <> 'curve'").collect()
    assert {(r["problem"], r["section"]) for r in rows} == {(p, s) for p in ("payment_difficulty", "refusal")
                                                            for s in ("metric", "confusion", "report")}
    n = entry.queries()["validate_records"](spark, SF).count()
    stream = entry.queries()["score_stream"](spark, SF)
    assert stream.count() == n and stream.where("(probability is null) = (errors is null)").count() == 0
