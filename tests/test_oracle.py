"""Every query with a SQL twin gives the rows DuckDB gives; the others give rows."""

import duckdb
import pytest

from sparkwright.plans.registry import ORACLES, QUERIES, load_all
from tools.check import TABLES, compare

load_all()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def _no_row_pairing(df):
    """Whole tables must never meet in a cross or nested-loop join."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, con, sf, name):
    df = QUERIES[name](spark, sf)
    _no_row_pairing(df)
    message, _, fine = compare(spark, con, name, sf, df)
    assert fine, message


# Dozens of model fits each; tools/check.py runs them.
SLOW = {"model_comparison", "cross_dataset_summary"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_rows(spark, sf, name):
    df = QUERIES[name](spark, sf)
    _no_row_pairing(df)
    assert df.count() > 0
