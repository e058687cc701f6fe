"""Registered queries against their DuckDB oracle on the smallest tables, and
the flagship entry point."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001, SF01

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
CHECKED = ["psi_levels", "ks_statistic", "pr_auc", "roc_auc", "threshold_sweep", "gate_result",
           "decision_timeline", "signals_all", "profile_stats", "time_split", "rebalance_positives"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    got = sorted((tuple(_norm(x) for x in r) for r in df.collect()), key=str)
    res = con.execute(E.oracle_sql()[name])
    want = sorted((tuple(_norm(x) for x in r) for r in res.fetchall()), key=str)
    assert df.columns == [d[0] for d in res.description]
    assert got == want


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "action" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_fixture_timeline_at_sf001(spark):
    rows = {r.batch_id: (r.action, r.confirmed_streak)
            for r in E.queries()["decision_timeline"](spark, SF01).collect()}
    assert rows["2000-07"] == ("RECALIBRATE_THRESHOLD", 2)
    assert rows["2000-12"] == ("RETRAIN", 2) and rows["2001-01"] == ("WATCH", 3)
    assert rows["2001-02"] == ("RETRAIN", 4) and rows["2001-11"] == ("HALT", 0)
