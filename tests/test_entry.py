"""Driver contract: entry runs; every registered query runs and matches its oracle at sf0.001."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from millwright.plans import catalog
from scripts.check_oracle import key, norm

SLOW = {"train_failure", "train_rul"}
NO_ORACLE = {"train_failure", "train_rul", "isolation_forest", "feature_importances"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"health_score", "risk_level", "diagnostic_hint"} <= set(df.columns)


def test_every_sql_query_has_an_oracle():
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == NO_ORACLE
    assert set(catalog.queries()) <= set(E.queries()) and set(catalog.oracle_sql()) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF001)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(norm(r[c]) for c in cols) for r in sdf.collect()), key=key)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = {c: i for i, c in enumerate(dcols)}
    drows = sorted((tuple(norm(r[idx[c]]) for c in cols) for r in res.fetchall()), key=key)
    assert srows == drows


if os.environ.get("MW_SLOW") == "1":  # test_jobs.py runs the trainers at a small size
    @pytest.mark.parametrize("name", sorted(SLOW))
    def test_trainers_run(spark, name):
        rows = E.queries()[name](spark, "/root/testdata/sf0.01").collect()
        assert sum(1 for r in rows if r["selected"]) == 1
