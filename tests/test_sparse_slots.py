from sparkwright.plans.registry import QUERIES, load_all

load_all()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sparse_slots_stay_sparse(spark, sf):
    assert "UDF(features" not in _plan(QUERIES["to_sparse_vector"](spark, sf))
